"""Tokens of whole texts, counted once per distinct pre-token.

A sentencepiece BPE model merges neighbouring characters only into pieces of its vocabulary, so no merge
reaches over two neighbouring characters that no piece holds side by side. Texts are cut at such places.
The pieces of a cut part, a pre-token, depend on nothing around it: each distinct one is counted once, and a
text has the sum of its pre-tokens' counts times their frequencies. No token ids are kept anywhere.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import stored

#: A text of more tokens is over the limit.
LIMIT = 4096
#: The counts of so many pre-tokens at most are broadcast, the most frequent ones.
HOT_PARTS = 1 << 19
#: Longer pre-tokens are never broadcast, so those that are hold at most HOT_PARTS x HOT_BYTES bytes.
HOT_BYTES = 64
#: Pre-tokens above this length are cut once more, at every pair of characters that no piece holds.
_LONG = 32
_SPACE = "▁"
_GUARD = "\n"
_ENCODED = 4096
#: Distinct pre-tokens a task counts before it hands them on.
_HELD = 1 << 18


class PreTokens:
    """Cuts texts where no piece of the vocabulary reaches across, and counts the pieces of a part.

    The model must leave texts as they are but for the space mark and one space put in front; others are
    refused, since a cut could then change what they see.
    """

    def __init__(self, model: bytes) -> None:
        self.model = model
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [
            library.id_to_piece(i)
            for i in range(library.vocab_size())
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))
        ]
        joined = [p for p in plain if len(p) > 1]
        self.pairs = {pair for p in joined for pair in zip(p, p[1:])}
        letters = {c for p in joined for c in p} - {_SPACE}
        sample = " AÅﬁ  　b\t"
        as_is = library.decode(library.encode(sample)) == sample
        if _GUARD in letters or not as_is or any(b == _SPACE != a for a, b in self.pairs):
            raise ValueError("the model's pieces do not allow texts to be cut at spaces")
        inside = "".join(re.escape(c) for c in sorted(letters))
        self.parts = re.compile(f" *[{inside}]+| +|[^{inside} ]")

    def cut(self, text: str) -> Counter[str]:
        """Pre-tokens of a text and how often each occurs. Space marks are written as spaces."""
        if not text:
            return Counter()
        found = Counter(self.parts.findall((" " + text).replace(_SPACE, " ")))
        for part in [p for p in found if len(p) > _LONG]:
            times = found.pop(part)
            for piece in self._finer(part):
                found[piece] += times
        return found

    def _finer(self, part: str) -> list[str]:
        marked = part.replace(" ", _SPACE)
        at = [i for i, pair in enumerate(zip(marked, marked[1:]), 1) if pair not in self.pairs]
        return [part[i:j] for i, j in zip([0, *at], [*at, len(part)])]

    def count(self, parts: list[str]) -> list[int]:
        """Pieces of each pre-token.

        The library puts a space in front of what it is given. A part that begins with one gets it that
        way; another is put behind a character that joins nothing, whose own pieces are taken off.
        """
        library = self._library()
        guard = len(library.encode(_GUARD))
        led = [p.startswith(" ") for p in parts]
        texts = [p[1:] if space else _GUARD + p for p, space in zip(parts, led, strict=True)]
        # A lone space leaves nothing to give; it is one piece behind the guard as well.
        counts = []
        for part, text, space, ids in zip(parts, texts, led, library.encode(texts, num_threads=1), strict=True):
            counts.append(len(ids) - (0 if space else guard) if text else len(library.encode(_GUARD + part)) - guard)
        return counts

    def _library(self) -> sentencepiece.SentencePieceProcessor:
        if "library" not in self.__dict__:
            self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        return self.library

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "library"}


def piece_counts(docs: DataFrame, parts: PreTokens) -> DataFrame:
    """``part``, ``texts`` (rows that hold it) and ``pieces`` of every distinct pre-token, stored."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held: Counter[str]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], names=["part", "texts"])

        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(parts.cut(text.as_py()).keys())
                if len(held) > _HELD:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ENCODED):
                some = batch.slice(at, _ENCODED)
                counts = pa.array(parts.count(some.column(0).to_pylist()), pa.int64())
                yield pa.record_batch([some.column(0), some.column(1), counts], names=["part", "texts", "pieces"])

    cuts = docs.filter("text IS NOT NULL").select("text").mapInArrow(cut, "part string, texts bigint")
    distinct = cuts.groupBy("part").agg(F.sum("texts").alias("texts"))
    return stored(distinct.mapInArrow(count, "part string, texts bigint, pieces bigint"), "token-pieces")


def frequent(pieces: DataFrame, most: int) -> Column:
    """Whether a pre-token is among the frequent ones, of which there are at most ``most``.

    They are told by their number of texts, in steps of an eighth of a doubling; of the steps the driver gets a count each.
    """
    step = F.floor(F.log2("texts") * 8)
    total, least = 0, None
    for row in pieces.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        total += row.n
        if total > most:
            break
        least = row.step
    return F.lit(False) if least is None else (step >= least) & (F.octet_length("part") <= HOT_BYTES)


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row of ``docs`` (``doc_id``, ``text``).

    ``model`` is the file of a sentencepiece BPE model; executors get its bytes. Counts are what the library
    gives for the whole text, without begin, end or other added tokens. The counts of frequent pre-tokens, at
    most ``HOT_PARTS`` of at most ``HOT_BYTES`` bytes, are broadcast and summed where a text is cut, so only rare
    ones are shuffled to meet theirs. A null or empty text has 0 bytes and 0 tokens. Repeated rows, and rows
    of equal or null ``doc_id``, have a result each. An empty table gives an empty one. Other columns are not
    read, so their names are no matter.
    """
    parts = PreTokens(Path(model).read_bytes())
    pieces = piece_counts(docs, parts)
    hot = frequent(pieces, HOT_PARTS)
    counts = pieces.filter(hot).select("part", "pieces").toArrow()
    known = docs.sparkSession.sparkContext.broadcast(dict(zip(*(c.to_pylist() for c in counts.columns), strict=True)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row_id", "doc_id", "n_bytes", "n_tokens", "part", "times"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text with the tokens of its frequent pre-tokens, and one per rare pre-token in it."""
        counted, row = known.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, at, tokens, rare, times = [], [], [], [], []
            for i, text in enumerate(batch.column(2)):
                found = parts.cut(text.as_py() or "")
                rest = [p for p in found if p not in counted]
                tokens.append(sum(counted[p] * n for p, n in found.items() if p in counted))
                at.extend([i, *[None] * len(rest)])
                rows.extend([row] * (len(rest) + 1))
                tokens.extend([None] * len(rest))
                rare.extend([None, *rest])
                times.extend([None, *[found[p] for p in rest]])
                row += 1
            at = pa.array(at, pa.int64())
            long = lambda values: pa.array(values, pa.int64())
            own = [batch.column(0).take(at), batch.column(1).take(at)]
            yield pa.record_batch([long(rows), *own, long(tokens), pa.array(rare, pa.string()), long(times)], names=names)

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    schema = f"row_id bigint, doc_id {kind}, n_bytes bigint, n_tokens bigint, part string, times bigint"
    held = docs.select("doc_id", size, "text").mapInArrow(scan, schema)
    # A text's own row meets nothing; a key of its own keeps such rows out of one partition.
    held = held.withColumn("part", F.coalesce("part", F.concat(F.lit("\n"), F.col("row_id").cast("string"))))
    met = held.join(pieces.filter(~hot).select("part", "pieces"), "part", "left")
    counted = met.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.coalesce("n_tokens", F.col("times") * F.col("pieces"))).alias("n_tokens"),
    )
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
