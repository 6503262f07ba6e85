"""Groups of texts that share four fifths of their word shingles, found exactly by matching parts of the sets.

Two sets of Jaccard similarity 0.8 or more differ in at most a ninth of their summed sizes. The hash range
is cut into more parts than they can differ in shingles, so they hold the very same shingles in some part;
every non-empty part becomes a key. The number of parts depends on the size, so a set is keyed at its own
level and at the one below, whose sets it may still resemble. Pairs under a common key are candidates, and
the shingles of every candidate pair are compared; equal sets are one node from the start.

SimHash comes first: sets whose fingerprints ``simhash`` links are compared before any key is asked, so that keys are
left with what a fingerprint cannot tell. A pair is only compared where its sketches allow it: a sketch has the parity
of the shingles in each of 512 places, every shingle that one set lacks turns one of them, and sets that differ in more
places than alike sets may have differing shingles are not alike. A set of more shingles than places turns them
nearly at random, so it has a wide sketch too, of as many places as shingles, which is asked before its texts are read.
No such test loses a pair.

Keys are shuffled in a few turns, each of a part of them, and a turn's shuffle is deleted before the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.llm import simhash
from tractline.llm.common import discard, share, stored
from tractline.llm.graph import components
from tractline.session import broadcast_within

WORDS = 5
_SEED = 42
#: Digests that a task remembers to key equal sets once.
_SEEN = 200_000
#: Nodes of a key that are compared with all its others in one round, at most.
_CENTRES = 64
#: Words of 64 bits in a sketch.
_SKETCH = 8
#: Turns in which keys are shuffled.
_TURNS = 4
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_HALF, _ODD = np.uint64(32), np.uint64(0x9E3779B97F4A7C15)


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is run inside are deleted when it ends, not at some later collection of garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct XXH64 of every shingle of ``words`` words; empty where there is no word.

    A-Z are lowered, words end at ASCII white space. Fewer words than a shingle are one shingle.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    line, ends, starts, at = b" ".join(tokens), [], [], 0
    for token in tokens:
        starts.append(at)
        at += len(token)
        ends.append(at)
        at += 1
    spans = zip(starts, ends[words - 1 :], strict=False) if len(tokens) > words else [(0, len(line))]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[s:e], _SEED) for s, e in spans), dtype=np.uint64))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the sets share four fifths of their union or more."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def _level(size: int) -> tuple[int, int, int]:
    """The level of a set, and the largest sets of it and of the level below (0 for none).

    A set's partners are at most a quarter larger, so they are on its level or the next one.
    """
    level, below, top = 0, 0, 1
    while top < size:
        level, below, top = level + 1, top, max(top + 1, top * 5 // 4)
    return level, below, top


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _HALF)) * _ODD
    return values ^ (values >> np.uint64(29))


def _level_keys(hashes: np.ndarray, level: int, top: int) -> np.ndarray:
    """Keys of the non-empty parts at a level whose smaller sets have at most ``top`` shingles.

    Two such sets differ in ``top // 4`` shingles or fewer, so they agree on more than ``spare`` parts. Where
    no more than ``spare`` of a set's parts are empty, one they agree on is not. Other sets are also keyed by
    their lowest shingles: as many as must hold a common one.
    """
    spare = 1 + top // 64 if top > 3 else 0
    parts = np.uint64(top // 4 + 1 + spare)
    part = ((hashes >> _HALF) * parts) >> _HALF
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    salt = part[starts] + np.uint64(level << 40)
    keys = _mixed(_mixed(np.add.reduceat(hashes, starts)) ^ _mixed(salt * _ODD))
    if int(parts) - len(starts) > spare:
        lowest = hashes[: len(hashes) - (4 * len(hashes) + 4) // 5 + 1]
        keys = np.r_[keys, _mixed(_mixed(lowest) + np.uint64((level << 40) + (1 << 39)))]
    return keys


def keys_of(hashes: np.ndarray) -> np.ndarray:
    """Keys of a set (sorted); two sets of similarity 0.8 or more share one."""
    if not len(hashes):
        return hashes
    level, below, top = _level(len(hashes))
    with np.errstate(over="ignore"):
        keys = [_level_keys(hashes, level, top)]
        if below:
            keys.append(_level_keys(hashes, level - 1, below))
    return np.concatenate(keys)


def sketch_of(hashes: np.ndarray) -> list[int]:
    """The size of a set and the parity of its shingles in each place, as signed longs."""
    return [len(hashes), *_parities(hashes, 64 * _SKETCH).view(np.int64).tolist()]


def _parities(hashes: np.ndarray, places: int) -> np.ndarray:
    """The parity of the shingles in each of ``places`` places (a power of two), as bits."""
    return np.packbits((np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1).astype(np.uint8))


def wide_sketch_of(hashes: np.ndarray) -> bytes | None:
    """The parities in at least as many places as the set has shingles; none where a sketch has as many."""
    if len(hashes) <= 64 * _SKETCH:
        return None
    return _parities(hashes, 1 << (len(hashes) - 1).bit_length()).tobytes()


def wide_may_be_alike(size: int, wide: bytes, other_size: int, other: bytes) -> bool:
    """Whether sets with these wide sketches can share four fifths of their union.

    A place's number is the hash's low bits, so the halves of a sketch together are the sketch of half its places.
    """
    a, b = np.frombuffer(wide, np.uint8), np.frombuffer(other, np.uint8)
    while len(a) != len(b):
        a, b = sorted((a, b), key=len)
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return 9 * int(np.bitwise_count(a ^ b).sum()) <= size + other_size


def _may_be_alike(one: str, two: str) -> Column:
    """Whether sets with these sketches can share four fifths of their union: they differ in a ninth of their sizes at most."""
    a, b = F.col(one), F.col(two)
    sizes = F.least(a[0], b[0]) * 5 >= F.greatest(a[0], b[0]) * 4
    apart = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(1, _SKETCH + 1)), F.lit(0))
    return sizes & (apart * 9 <= a[0] + b[0])


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """``_row``, ``doc_id``, ``node`` (the set's digest), ``fingerprint``, ``sketch``, ``wide`` (sketch) and ``keys``.

    A set repeated in a task has the last four once.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            nodes, keys, bounds = [], [np.empty(0, np.uint64)], [0]
            prints: list[int | None] = []
            sketches: list[list[int] | None] = []
            wide: list[bytes | None] = []
            for x in batch.column(2):
                text = x.as_py()
                hashes = shingles(text, words)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), _SEED))
                if nodes[-1] not in seen:
                    keys.append(keys_of(hashes))
                    bounds.append(bounds[-1] + len(keys[-1]))
                    prints.append(simhash.fingerprint(text, words) - 2**63)
                    sketches.append(sketch_of(hashes))
                    wide.append(wide_sketch_of(hashes))
                    if len(seen) < _SEEN:
                        seen.add(nodes[-1])
                else:
                    bounds.append(bounds[-1])
                    prints.append(None)
                    sketches.append(None)
                    wide.append(None)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)))
            node = pa.array(np.array(nodes, np.uint64).view(np.int64))
            more = [node, pa.array(prints, pa.int64()), pa.array(sketches, pa.list_(pa.int64())), pa.array(wide, pa.binary()), lists]
            names = ["_row", "doc_id", "node", "fingerprint", "sketch", "wide", "keys"]
            yield pa.record_batch([*batch.columns[:2], *more], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = f"_row bigint, doc_id {kind}, node bigint, fingerprint bigint, sketch array<bigint>, wide binary, keys array<bigint>"
    return rows.select("_row", "doc_id", "text").mapInArrow(scan, columns)


def _shared(sets: DataFrame) -> DataFrame:
    """``key``, ``node``, ``first``: the nodes under every key that several have, with the first of them."""

    def runs(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        new = np.r_[True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])]
        keys, nodes = keys[new], nodes[new]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        several, first = np.repeat(sizes > 1, sizes), np.repeat(nodes[starts], sizes)
        return pa.record_batch([pa.array(x[several]) for x in (keys, nodes, first)], names=["key", "node", "first"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if (cut or keys[0] != held[-1][0][-1]) if held else cut:
                held.append((keys[:cut], nodes[:cut]))
                yield runs(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append((keys[cut:], nodes[cut:]))
        if held:
            yield runs(*(np.concatenate(x) for x in zip(*held, strict=True)))

    rows, shared = sets.select("node", F.explode("keys").alias("key")), []
    for turn in range(_TURNS):
        part = rows.filter(F.pmod("key", F.lit(_TURNS)) == turn).repartition("key").sortWithinPartitions("key", "node")
        part = part.select("key", "node").mapInArrow(search, "key bigint, node bigint, first bigint")
        shared.append(stored(part, "near-shared"))
    whole = stored(reduce(DataFrame.unionByName, shared), "near-shared")
    discard(*shared)
    return whole


def _ends(pairs: DataFrame) -> DataFrame:
    """``node``: the nodes of ``pairs``."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    return broadcast_within(ends.distinct())


def _widely_alike(pairs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``pairs`` (stored, deleted after) without those whose wide sketches rule them out."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            kept = [wide is None or other is None or wide_may_be_alike(n, wide, m, other) for n, wide, m, other in sketches]
            yield pa.record_batch([c.filter(pa.array(kept, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    wide = distinct.filter(F.col("wide").isNotNull()).join(_ends(pairs), "node")
    wide = stored(wide.select("node", F.col("sketch")[0].alias("size"), "wide"), "near-wide")
    both = pairs
    for end in "ab":
        both = both.join(wide.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("wide").alias(f"wide_{end}")), end, "left")
    both = both.select("a", "b", "size_a", "wide_a", "size_b", "wide_b")
    left = stored(both.mapInArrow(ask, "a bigint, b bigint"), "near-pairs")
    discard(pairs, wide)
    return left


def _verified(pairs: DataFrame, distinct: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """The ``pairs`` (``a``, ``b``) of nodes whose sets are alike, from the texts themselves."""
    pairs = _widely_alike(stored(pairs.distinct(), "near-pairs"), distinct)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.array([shingles(x.as_py(), words).tobytes() for x in batch.column(1)], pa.binary())
            yield pa.record_batch([batch.column(0), held], names=["node", "held"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([np.frombuffer(x.as_py(), np.uint64) for x in batch.column(i)] for i in (2, 3))
            kept = pa.array([alike(x, y) for x, y in zip(one, two, strict=True)], pa.bool_())
            yield pa.record_batch([c.filter(kept) for c in batch.columns[:2]], names=["a", "b"])

    # While they are few enough to be sent around, no text of any other row is shuffled.
    wanted = broadcast_within(distinct.join(_ends(pairs), "node").select("node", F.col("first._row").alias("_row")))
    held = rows.select("_row", "text").join(wanted, "_row").select("node", "text").mapInArrow(texts, "node bigint, held binary")
    held = stored(held, "near-held")
    both = pairs.join(held.select(F.col("node").alias("a"), F.col("held").alias("one")), "a")
    both = both.join(held.select(F.col("node").alias("b"), F.col("held").alias("two")), "b")
    links = stored(both.select("a", "b", "one", "two").mapInArrow(compare, "a bigint, b bigint"), "near-links")
    discard(pairs, held)
    return links


def _undecided(held: DataFrame, roots: DataFrame, distinct: DataFrame) -> DataFrame:
    """``key``, ``node``, ``root``, ``sketch`` of ``held`` (``key``, ``node``) under the keys whose nodes have several roots."""
    rooted = stored(held.join(roots, "node"), "near-rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key")
    left = rooted.join(apart, "key").join(distinct.select("node", "sketch"), "node")
    left = stored(left.select("key", "node", "root", "sketch"), "near-apart")
    discard(rooted)
    return left


def _moved(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (``node``, ``root``) after ``links`` (``a``, ``b``) between nodes."""
    ends = [roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")) for end in "ab"]
    between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    joined = components(between)
    moved = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    moved = stored(moved.select("node", F.coalesce("to", "root").alias("root")), "near-roots")
    discard(joined, roots)
    return moved


def _first_pairs(shared: DataFrame, distinct: DataFrame) -> DataFrame:
    """``a``, ``b``: nodes that SimHash links, and each node with the least one that begins any of its keys.

    There are no more of them than links of fingerprints and nodes.
    """
    prints = stored(distinct.groupBy("fingerprint").agg(F.min("node").alias("a")), "near-prints")
    equal = distinct.join(prints, "fingerprint").select("a", F.col("node").alias("b"))
    linked = simhash.links(prints.select("fingerprint")).toDF("one", "two").distinct()
    for print_, end in (("one", "a"), ("two", "b")):
        linked = linked.join(prints.select(F.col("fingerprint").alias(print_), F.col("a").alias(end)), print_)
    begun = shared.groupBy("node").agg(F.min("first").alias("a")).select("a", F.col("node").alias("b"))
    pairs = equal.unionByName(linked.select("a", "b")).unionByName(begun).filter("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for end, sketch in (("a", "one"), ("b", "two")):
        pairs = pairs.join(distinct.select(F.col("node").alias(end), F.col("sketch").alias(sketch)), end)
    pairs = stored(pairs.filter(_may_be_alike("one", "two")).select("a", "b"), "near-first")
    discard(prints)
    return pairs


def _roots(shared: DataFrame, distinct: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``node`` and ``root`` of every node of ``distinct``; equal roots mean connected.

    ``_first_pairs`` are compared first. After that, in rounds, a few centres of each key are compared with its
    nodes of other roots; a centre is then done there, and so is a key whose nodes have one root. Every pair under
    a key is compared unless links connect it or the sketches rule it out, and a crowd of copies is one root
    after a round or two. Centres per key rise fourfold up to ``_CENTRES``.
    """
    roots = stored(distinct.select("node", F.col("node").alias("root")), "near-roots")
    pairs = _first_pairs(shared, distinct)
    links = _verified(pairs, distinct, rows, words)
    discard(pairs)
    roots = _moved(roots, links)
    held, centres = _undecided(shared.select("key", "node"), roots, distinct), 1
    while not held.isEmpty():
        least = F.min(F.struct(F.xxhash64("node").alias("h"), "node", "root", "sketch")).alias("centre")
        picked = held.groupBy("key", share("node", of=centres).alias("bucket")).agg(least)
        picked = stored(picked.select("key", "centre", F.col("centre.sketch").alias("other")), "near-centres")
        pairs = held.join(picked, "key").filter((F.col("root") != F.col("centre.root")) & _may_be_alike("sketch", "other"))
        pairs = pairs.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
        discard(links)
        links = _verified(pairs, distinct, rows, words)
        roots = _moved(roots, links)
        done = picked.select("key", F.col("centre.node").alias("node"))
        left = _undecided(held.select("key", "node").join(done, ["key", "node"], "left_anti"), roots, distinct)
        discard(held, picked)
        held, centres = left, min(centres * 4, _CENTRES)
    discard(held, links)
    return roots


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each group of near copies: the smallest ``doc_id`` (null last).

    Texts are linked when the Jaccard similarity of their sets of ``words``-word shingles is 0.8 or more; a
    group is what links connect. Of rows that repeat that ``doc_id``, one stays. Null, empty and blank texts
    are one group. All columns stay.

    A crowd of copies costs no square of its size; see ``_roots``.
    """
    with _shuffles_deleted(docs.sparkSession):
        rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "near-rows")
        sets = stored(_sets(rows, words), "near-sets")
        place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")
        once = [F.min(place).alias("first"), *[F.max(c).alias(c) for c in ("fingerprint", "sketch", "wide")]]
        distinct = stored(sets.groupBy("node").agg(*once), "near-distinct")
        shared = _shared(sets)
        discard(sets)
        roots = _roots(shared, distinct, rows, words)
        kept = stored(distinct.join(roots, "node").groupBy("root").agg(F.min("first").alias("first")).select("first._row"), "near-kept")
        discard(shared, distinct, roots)
        # Those that go are fewer than those that stay, and while they can be sent around no text is shuffled.
        gone = broadcast_within(rows.select("_row").join(kept, "_row", "left_anti"))
        discard(kept)
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)
