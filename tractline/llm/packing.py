"""Texts packed into sequences of bounded length, best fit first, without conflicts inside a sequence.

A bin carries the sources and the duplicate clusters it holds as bitmaps; it takes no second text of
either. Open bins are ordered by what is left in them. For each text, longest first, the search starts at
the tightest bin that is long enough and goes on to the next until one is compatible. Rows are dealt into
groups of bounded size that are packed apart.
"""

from __future__ import annotations

from bisect import insort
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.llm.common import share, stored

CAPACITY = 2048
#: Texts packed together; bounds a task's memory, and a few thousand fill bins as well as millions do.
GROUP_ITEMS = 8192
_PACKED = "row_id bigint, piece int, bin bigint, offset int"


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))


class Bins:
    """Open bins by residual; bins of equal residual by their source bitmap, then in order of opening."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.held: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
        self.open = np.zeros(capacity + 1, dtype=np.int64)
        self.with_source: dict[int, np.ndarray] = {}
        self.residual: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _count(self, residual: int, sources: int, by: int) -> None:
        self.open[residual] += by
        at = 0
        while sources:
            if sources & 1:
                self.with_source.setdefault(at, np.zeros(self.capacity + 1, dtype=np.int64))[residual] += by
            sources, at = sources >> 1, at + 1

    def find(self, size: int, source: int | None, cluster: int) -> int | None:
        """The tightest bin of at least ``size`` without the source and the cluster (a bitmap, 0 for none)."""
        free = self.open[size:]
        if source is not None and source in self.with_source:
            free = free - self.with_source[source][size:]
        bit = 0 if source is None else 1 << source
        for left in np.flatnonzero(free):
            best = None
            for sources, numbers in self.held[size + left].items():
                if not sources & bit:
                    number = next((n for n in numbers if not self.clusters[n] & cluster), None)
                    if number is not None and (best is None or number < best):
                        best = number
            if best is not None:
                return best
        return None

    def put(self, size: int, source: int | None, cluster: int) -> tuple[int, int]:
        """The bin that takes the text, and where in it the text begins."""
        number = self.find(size, source, cluster)
        if number is None:
            number = len(self.residual)
            self.residual.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        else:
            held = self.held[self.residual[number]]
            held[self.sources[number]].remove(number)
            if not held[self.sources[number]]:
                del held[self.sources[number]]
            self._count(self.residual[number], self.sources[number], -1)
        offset = self.capacity - self.residual[number]
        self.residual[number] -= size
        self.sources[number] |= 0 if source is None else 1 << source
        self.clusters[number] |= cluster
        insort(self.held[self.residual[number]].setdefault(self.sources[number], []), number)
        self._count(self.residual[number], self.sources[number], 1)
        return number, offset


def pack_group(group: int, items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Bins of one group: ``items`` has ``row_id``, ``piece``, ``words``, ``source`` and ``cluster``."""
    items = items.sort_values(["words", "cluster", "row_id", "piece"], ascending=[False, True, True, True], ignore_index=True)
    sources = {s: i for i, s in enumerate(sorted(items["source"].dropna().unique()))}
    # A cluster of one text cannot conflict and needs no bit.
    several = sorted(c for c, n in Counter(items["cluster"]).items() if n > 1)
    bits = {c: 1 << i for i, c in enumerate(several)}
    bins = Bins(capacity)
    placed = [
        bins.put(words, sources.get(source), bits.get(cluster, 0))
        for words, source, cluster in zip(items["words"].tolist(), items["source"], items["cluster"], strict=True)
    ]
    numbers, offsets = zip(*placed, strict=True)
    return items[["row_id", "piece"]].assign(bin=np.array(numbers, dtype=np.int64) + (group << 32), offset=offsets)


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Where each text of ``docs`` (``doc_id``, ``text``, ``source``) lies: one row per piece.

    Columns: ``doc_id``, ``piece`` and ``start`` (a text above ``capacity`` words is cut; its pieces are
    numbered from 0 and begin at these words), ``words``, ``bin`` and ``offset`` (the word of the bin where
    the piece begins). No bin exceeds ``capacity``, holds two texts of one source, or two equal texts; a null
    source conflicts with nothing. Texts that are null or have no word need no room: one row with 0 words and
    null ``bin`` and ``offset``. Repeated rows are packed as rows of their own. Other columns are not read.
    """
    n = F.coalesce(word_count(F.col("text")), F.lit(0))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("cluster"), n.alias("n"))
    rows = stored(rows.withColumn("row_id", F.monotonically_increasing_id()), "pack-rows")
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(capacity))
    items = rows.select("*", F.posexplode(starts).alias("piece", "start"))
    items = items.withColumn("words", F.least(F.col("n") - F.col("start"), F.lit(capacity)))
    groups = max(1, -(-items.count() // GROUP_ITEMS))
    dealt = items.filter("words > 0").select(
        share("row_id", "piece", of=groups).alias("group"), "row_id", "piece", "words", "source", "cluster"
    )

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pack_group(int(key[0]), frame, capacity)

    packed = dealt.groupBy("group").applyInPandas(run, _PACKED)
    return items.join(packed, ["row_id", "piece"], "left").select("doc_id", "piece", "start", "words", "bin", "offset")
