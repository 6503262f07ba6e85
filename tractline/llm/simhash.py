"""SimHash fingerprints and their groups, found through a hierarchical index in Gray order.

Every text gets 64 majority bits of the hashes of its word shingles. Distinct fingerprints are dealt
out by keys that two fingerprints within the distance must share (some block of bits must be equal),
deeper keys where a key is common. Under each key they are sorted by Gray rank and cut into nodes,
nodes into upper nodes; a node keeps the bits its members share, and a search adds up the differences
to those bits and leaves a whole node out as soon as they exceed the distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import stored
from tractline.llm.graph import components

WORDS = 3
DISTANCE = 3
_SEED = 42
#: Under a key that more fingerprints have, deeper keys are used.
_RUN = 1024
_TINY, _NODE = 24, 16
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = np.arange(8) * 256


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The majority bits of the XXH64 of every shingle of ``words`` words; 0 where there is no word.

    A-Z are lowered, words end at ASCII white space. Fewer words than a shingle are one shingle.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return 0
    line, ends, starts, at = b" ".join(tokens), [], [], 0
    for token in tokens:
        starts.append(at)
        at += len(token)
        ends.append(at)
        at += 1
    spans = zip(starts, ends[words - 1 :], strict=False) if len(tokens) > words else [(0, len(line))]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[s:e], _SEED) for s, e in spans), dtype=np.uint64)
    by_byte = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((by_byte + _PLACES).ravel(), minlength=2048).reshape(8, 256) @ _BITS_OF_BYTE
    bits = (2 * counts.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``fingerprint`` (the 64 bits as a signed long) of every row of ``docs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(x.as_py(), words) for x in batch.column(len(keep))], dtype=np.uint64)
            yield pa.record_batch([*batch.columns[:-1], pa.array(bits.view(np.int64))], names=[*keep, "fingerprint"])

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep]
    return docs.select(*keep, "text").mapInArrow(scan, ", ".join([*kinds, "fingerprint bigint"]))


def _gray_rank(bits: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def _deeper(rows: DataFrame, width: int, distance: int) -> DataFrame:
    """Each row once per block of its ``width`` loose bits: the block goes into the key, the others stay loose.

    There is one block more than the distance, so two fingerprints within it agree on some block.
    """
    blocks = distance + 1
    cuts = [width * i // blocks for i in range(blocks + 1)]

    def without(i: int) -> Column:
        low, high, size = cuts[i], cuts[i + 1], cuts[i + 1] - cuts[i]
        loose = F.col("loose")
        block = F.shiftrightunsigned(loose, low).bitwiseAND(F.lit((1 << size) - 1))
        above = F.lit(0).cast("bigint") if high >= 64 else F.shiftleft(F.shiftrightunsigned(loose, high), low)
        rest = above.bitwiseOR(loose.bitwiseAND(F.lit((1 << low) - 1)))
        return F.struct(F.xxhash64("key", F.lit(i), block).alias("key"), rest.alias("loose"))

    each = F.explode(F.array(*[without(i) for i in range(blocks)])).alias("x")
    return rows.select("fingerprint", each).select("fingerprint", "x.key", "x.loose")


def keyed(distinct: DataFrame, distance: int = DISTANCE, run: int = _RUN) -> DataFrame:
    """``key``, ``fingerprint``: any two within ``distance`` share a key; no key above ``run`` but at the last level.

    The last level's keys leave at most 27 bits loose.
    """
    width = 64
    rows = distinct.select("fingerprint", F.lit(0).cast("bigint").alias("key"), F.col("fingerprint").alias("loose"))
    done = []
    while True:
        rows, width = _deeper(rows, width, distance), width - width // (distance + 1)
        if width <= 27:
            break
        rows = stored(rows, "simhash-keys")
        common = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > run).select("key")
        common = stored(common, "simhash-common")
        if common.isEmpty():
            break
        done.append(rows.join(common, "key", "left_anti"))
        rows = rows.join(common, "key", "left_semi")
    for more in done:
        rows = rows.unionByName(more)
    return rows.select("key", "fingerprint")


def _nodes(values: np.ndarray, size: int, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The bits that each ``size`` neighbours share, as value and mask."""
    shared = np.full(len(values), ~np.uint64(0)) if shared is None else shared
    starts = np.arange(0, len(values), size)
    differ = np.bitwise_or.reduceat(values, starts) ^ np.bitwise_and.reduceat(values, starts)
    return values[starts], ~differ & np.bitwise_and.reduceat(shared, starts)


def _tree_links(values: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that join up what is connected among ``values`` (in Gray order): a walk over the index.

    Every position is taken out of the index once, when first reached, so links are fewer than values.
    """
    low, low_mask = _nodes(values, _NODE)
    top, top_mask = _nodes(low, _NODE, low_mask)
    inner, offsets = np.arange(_NODE), np.arange(_NODE)
    loose = np.ones(len(values), dtype=bool)
    for first in range(len(values)):
        if not loose[first]:
            continue
        loose[first] = False
        todo = [first]
        while todo:
            at = todo.pop()
            x = values[at]
            near = np.flatnonzero(np.bitwise_count((top ^ x) & top_mask) <= distance)
            near = (near[:, None] * _NODE + inner).ravel()
            near = near[near < len(low)]
            near = near[np.bitwise_count((low[near] ^ x) & low_mask[near]) <= distance]
            near = (near[:, None] * _NODE + offsets).ravel()
            near = near[near < len(values)]
            near = near[loose[near]]
            found = near[np.bitwise_count(values[near] ^ x) <= distance].tolist()
            loose[found] = False
            todo += found
            for other in found:
                yield at, other


def _links(keys: np.ndarray, values: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links within runs of equal keys. Runs of a few values are a single leaf and compared outright."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    tiny = np.repeat(sizes <= _TINY, sizes)
    for step in range(1, min(_TINY, int(sizes.max()))):
        same = (keys[step:] == keys[:-step]) & tiny[step:]
        if not same.any():
            break
        at = np.flatnonzero(same)
        at = at[np.bitwise_count(values[at] ^ values[at + step]) <= distance]
        left.append(at)
        right.append(at + step)
    for start, size in zip(starts[sizes > _TINY], sizes[sizes > _TINY], strict=True):
        pairs = np.array(list(_tree_links(values[start : start + size], distance)), dtype=np.int64).reshape(-1, 2)
        left.append(pairs[:, 0] + start)
        right.append(pairs[:, 1] + start)
    ends = [values[np.concatenate(x)].view(np.int64) for x in (left, right)]
    return pa.record_batch([pa.array(x) for x in ends], names=["a", "b"])


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a``, ``b``: links between the distinct fingerprints that connect all within ``distance``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
            whole = np.flatnonzero(keys != keys[-1])
            cut = whole[-1] + 1 if len(whole) else 0
            if cut:
                yield _links(keys[:cut], values[:cut], distance)
            keys, values = keys[cut:], values[cut:]
        if len(keys):
            yield _links(keys, values, distance)

    rows = keyed(distinct, distance).withColumn("rank", _gray_rank(F.col("fingerprint")))
    runs = rows.repartition("key").sortWithinPartitions("key", "rank").select("key", "fingerprint")
    return runs.mapInArrow(search, "a bigint, b bigint")


def _rooted(distinct: DataFrame, distance: int) -> DataFrame:
    """``distinct`` (stored, one row per fingerprint) with ``root``, equal for connected fingerprints."""
    roots = components(links(distinct, distance)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    return stored(rooted, "simhash-roots")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` of every row of ``docs``.

    Rows are linked when their fingerprints differ in ``distance`` bits or fewer; ``component_id`` is
    the smallest ``doc_id`` that can be reached. Null, empty and blank texts have the fingerprint 0
    and are linked like others. Repeated rows are rows of their own with equal results; a null
    ``doc_id`` is never the smallest, unless the group has no other. Other columns are not read.
    """
    prints = stored(fingerprints(docs, words), "simhash-prints")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    rooted = _rooted(distinct, distance)
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-groups")
    named = stored(rooted.join(smallest, "root").select("fingerprint", "component_id"), "simhash-named")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the smallest ``doc_id`` (null last).

    Of rows that repeat that ``doc_id``, one stays. Null, empty and blank texts are one group. All columns stay.
    """
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "simhash-rows")
    prints = stored(fingerprints(rows, words, ("_row", "doc_id")), "simhash-prints")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min(place).alias("first")), "simhash-distinct")
    kept = _rooted(distinct, distance).groupBy("root").agg(F.min("first").alias("first")).select("first._row")
    return rows.join(kept, "_row", "left_semi").select(*docs.columns)
