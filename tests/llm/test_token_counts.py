import random

import public_tokenizers
import pytest
import sentencepiece

from tractline.llm import token_counts
from tractline.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, n_tokens int, part string, pieces int"
HOSTILE = [
    "",
    " ",
    "   ",
    "\n",
    "▁",
    " ▁ a▁b",
    "<s> x </s><unk><0x41>",
    "a\nb\tc\r\n\x00d",
    "é ﬁ　全角 ＡＢ",
    "你好世界" * 50,
    "สวัสดีครับ",
    "\U0001f600\U0001f468‍\U0001f469",
    "a" * 5000,
    "ab" * 3000 + " " * 400 + "x",
    "__->(_$_{" * 40,
    "x" + " " * 37 + "y  z   ",
    "http://example.org/" + "aZ9%-_" * 200,
]


def whole(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(library.encode(t or "")) for t in texts]


@pytest.fixture(scope="module")
def parts():
    with open(MODEL, "rb") as file:
        return token_counts.PreTokens(file.read())


def test_counts_of_parts_add_up_to_the_whole(parts):
    rng = random.Random(7)
    alphabet = "abcdeEST  \n\t▁._-{}()$é你界​0123"
    texts = HOSTILE + ["".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(400)]
    for text, want in zip(texts, whole(texts), strict=True):
        cut = parts.cut(text)
        assert sum(n * k for n, k in zip(parts.count(list(cut)), cut.values(), strict=True)) == want, repr(text[:80])


def test_long_parts_are_cut_where_no_piece_reaches(parts):
    assert max(map(len, parts.cut("q你" * 2000))) < 40
    assert "".join(p * n for p, n in parts.cut("word").items()) == " word"


def test_edge_cases_and_clashing_columns(spark):
    rows = [(i, t, 1, "p", 2) for i, t in enumerate(HOSTILE)] + [(None, None, 1, "p", 2)] * 2 + [(3, "two words", 1, "p", 2)] * 2
    got = token_counts.count_tokens(spark.createDataFrame(rows, SCHEMA), MODEL, limit=100).collect()
    counts = whole([r[1] for r in rows])
    want = [(r[0], len((r[1] or "").encode()), n, n > 100) for r, n in zip(rows, counts, strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert token_counts.count_tokens(spark.createDataFrame([], SCHEMA), MODEL).collect() == []


def test_rare_and_long_parts_meet_by_a_shuffled_join(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT_PARTS", 2)
    monkeypatch.setattr(token_counts, "HOT_BYTES", 6)
    texts = ["the cat " * 5 + f"w{i} " + "z" * 40 for i in range(60)]
    got = token_counts.count_tokens(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string"), MODEL)
    assert [r.n_tokens for r in got.orderBy("doc_id").collect()] == whole(texts)


def test_models_that_change_texts_are_refused(monkeypatch):
    class Changing(sentencepiece.SentencePieceProcessor):
        def decode(self, ids):
            return super().decode(ids).lower()

    monkeypatch.setattr(token_counts.sentencepiece, "SentencePieceProcessor", Changing)
    with open(MODEL, "rb") as file, pytest.raises(ValueError):
        token_counts.PreTokens(file.read())


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op11_token_counts"](spark, folder).orderBy("doc_id").collect()
    want = whole([d.text for d in docs])
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [
        (d.doc_id, len((d.text or "").encode()), n, n > 4096) for d, n in zip(docs, want, strict=True)
    ]
