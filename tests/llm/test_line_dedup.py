import random
import re

from tractline.llm import line_dedup

SCHEMA = "doc_id bigint, text string, lines_removed int, line string, n int"


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows, min_words=5):
    """Every pair of lines is compared."""
    places = []
    for d, t in rows:
        for pos, line in enumerate((t or "").split("\n") if t is not None else ()):
            places.append(((d is None, d or 0, pos), [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w], line, d))
    out = {d: (None if t is None else [], 0) for d, t in rows}
    for place, words, line, d in places:
        near = lambda v: v == words or min(len(v), len(words)) >= min_words and within_one_edit(v, words)  # noqa: B023, E731
        lost = bool(words) and any(q < place and near(v) for q, v, *_ in places)
        kept, n = out[d]
        out[d] = (kept, n + 1) if lost else (kept + [line], n)
    return {d: (None if k is None else "\n".join(k), n) for d, (k, n) in out.items()}


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 99, "x", 1) for d, t in rows], SCHEMA)
    got = line_dedup.dedup_lines(df).collect()
    return {r.doc_id: (r.text, r[-1]) for r in got}, len(got)


def test_against_every_pair_of_lines(spark):
    rng = random.Random(4)
    words = ["a", "b", "c", "dd", "é", "THE"]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 9))] for _ in range(40)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            rng.choice([lambda: w.pop(i), lambda: w.insert(i, "new"), lambda: w.__setitem__(i, "zz")])()
        return rng.choice([" ", "  ", "\t"]).join(w)

    rows = [(d, "\n".join(line() for _ in range(rng.randint(1, 6)))) for d in range(60)]
    assert run(spark, rows) == (plain(rows), 60)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, "short line"), (5, "short line\nshort line"), (6, long), (7, long + " more"),
        (8, "one two three four five\none two three four five"), (None, "one two three four FIVE"),
        (9, "five four three two one"), (10, "word\n \n word\t\nother"), (11, "http://a.b/" + "c" * 9000), (12, "http://a.b/" + "c" * 9000),
        (13, "你好世界"), (14, "你好世界\n你好"), (15, "short lines\nshort  line "),
    ]
    want = plain([r for r in rows if r[0] not in (6, 7)]) | {6: (long, 0), 7: ("", 1)}
    got, n = run(spark, rows)
    assert got == want and n == len(rows)


def test_repeated_rows_and_no_rows(spark):
    row = (3, "one two three four five", 1, "x", 1)
    got = line_dedup.dedup_lines(spark.createDataFrame([row, row, (2, "one two three four five", 1, "x", 1)], SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(2, row[1]), (3, ""), (3, "")]
    alone = line_dedup.dedup_lines(spark.createDataFrame([row, row], SCHEMA)).collect()
    assert [r.text for r in alone] == [row[1]] * 2
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_rows_of_one_id_with_different_texts(spark):
    """Each line's words come from the row that holds it, whichever row of the id that is."""
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "a b c d e q"), (3, "u v w x y q"), (None, "k l m n o p"), (None, "r s t u v w"), (4, "k l m n o p")]
    got = line_dedup.dedup_lines(spark.createDataFrame([(d, t, 99, "x", 1) for d, t in rows], SCHEMA)).collect()
    assert sorted((r.doc_id or 99, r.text) for r in got) == sorted(
        [(1, "a b c d e f"), (1, "u v w x y z"), (2, ""), (3, ""), (99, ""), (99, "r s t u v w"), (4, "k l m n o p")]
    )
