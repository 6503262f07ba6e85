"""Shards of exactly even counts that keep linked rows together, by balanced label propagation.

Linked rows start on hashed shards. In every round each group of linked rows votes by counting its
members per shard; members elsewhere ask to move to the winner. Requests from shard i to shard j are
granted up to a quota: as many as ask the other way, plus a part of what j has free. Rows without
links are no part of the rounds; at the end they fill the shards to the exact count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tractline.llm.common import ranked, share, stored

SHARDS = 40
ROUNDS = 6
_SLICES = 64


def _quotas(df: DataFrame, shards: int, total: int) -> DataFrame:
    """One row per shard: how many rows it must hold; counts differ by one at most."""
    return df.sparkSession.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        (F.lit(total // shards) + (F.col("id") < total % shards).cast("bigint")).alias("quota"),
    )


def _pieces(links: DataFrame, shards: int, total: int) -> DataFrame:
    """``row_id``, ``piece``, ``start``: the rows of every group with two members or more.

    Only a group larger than a shard is cut, into as few pieces as shards can hold. Such pieces start
    together on shards next to each other; ``start`` is null for other groups.
    """
    largest = max(1, total // shards)
    groups = stored(
        links.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "shard-groups"
    )
    linked = stored(links.join(groups, "group"), "shard-members")
    whole = linked.filter(F.col("members") <= largest).select(
        "row_id", F.xxhash64("group", F.lit(0).cast("bigint")).alias("piece"), F.lit(None).cast("int").alias("start")
    )
    # Groups larger than a shard are fewer than shards, or than rows where shards outnumber these.
    cut = F.ceil(F.col("members") / F.lit(largest))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    large = groups.filter(F.col("members") > largest).select("group", F.coalesce(F.sum(cut).over(before), F.lit(0)).alias("first"))
    rows = ranked(linked.filter(F.col("members") > largest), ["group"], ["row_id"], "rank").join(F.broadcast(large), "group")
    number = F.floor(F.col("rank") / F.lit(largest))
    start = F.pmod(F.col("first") + number, F.lit(shards)).cast("int")
    return whole.unionByName(rows.select("row_id", F.xxhash64("group", number).alias("piece"), start.alias("start")))


def _granted(asked: DataFrame, quotas: DataFrame) -> DataFrame:
    """``shard``, ``target``, ``slice`` of the requests that fit the quotas.

    ``asked`` has ``shard``, ``target`` and ``slice`` of every linked row, so all tables here have at
    most shards x shards x slices rows.
    """
    held = asked.groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    free = quotas.join(held, "shard", "left").select(
        F.col("shard").alias("target"), F.greatest(F.col("quota") - F.coalesce("held", F.lit(0)), F.lit(0)).alias("free")
    )
    moves = asked.filter("shard <> target").groupBy("shard", "target", "slice").agg(F.count(F.lit(1)).alias("n"))
    wanted = moves.groupBy("shard", "target").agg(F.sum("n").alias("wanted"))
    back = wanted.select(F.col("target").alias("shard"), F.col("shard").alias("target"), F.col("wanted").alias("back"))
    into = Window.partitionBy("target")
    swap = F.least(F.col("wanted"), F.coalesce("back", F.lit(0)))
    rest = F.col("wanted") - swap
    part = F.floor(F.col("free") * rest / F.greatest(F.sum(rest).over(into), F.lit(1)))
    allowed = (
        wanted.join(back, ["shard", "target"], "left")
        .join(free, "target")
        .select("shard", "target", (swap + F.least(rest, part)).alias("allowed"))
    )
    upto = Window.partitionBy("shard", "target").orderBy("slice")
    return (
        moves.withColumn("upto", F.sum("n").over(upto))
        .join(allowed, ["shard", "target"])
        .filter("upto <= allowed")
        .select(F.col("shard").alias("_from"), F.col("target").alias("_to"), F.col("slice").alias("_slice"))
    )


def propagate(pieces: DataFrame, shards: int, total: int, rounds: int = ROUNDS) -> DataFrame:
    """``row_id``, ``piece``, ``shard`` of the linked rows after at most ``rounds`` rounds."""
    quotas = _quotas(pieces, shards, total)
    state = stored(pieces.select("row_id", "piece", F.coalesce("start", share("row_id", of=shards)).alias("shard")), "shard-start")
    for turn in range(rounds):
        votes = state.groupBy("piece", "shard").agg(F.count(F.lit(1)).alias("n"))
        best = F.max_by("shard", F.struct("n", F.xxhash64("piece", "shard")))
        winners = votes.groupBy("piece").agg(best.alias("target"))
        asked = stored(
            state.join(winners, "piece").withColumn("slice", share("piece", F.lit(turn), of=_SLICES)), "shard-round"
        )
        granted = _granted(asked, quotas)
        fits = (F.col("shard") == F.col("_from")) & (F.col("target") == F.col("_to")) & (F.col("slice") == F.col("_slice"))
        state = asked.join(F.broadcast(granted), fits, "left").select(
            "row_id", "piece", F.coalesce("_to", "shard").alias("shard"), F.col("_to").isNotNull().alias("_moved")
        )
        state = stored(state, "shard-state")
        if state.filter("_moved").isEmpty():
            break
        state = state.drop("_moved")
    return state.select("row_id", "piece", "shard")


def balanced_shards(rows: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (stored, with a unique ``row_id``) with ``shard`` and ``slot``.

    ``links`` has ``row_id`` and ``group``; a null group links nothing. Shard counts differ by one
    at most, slots are gapless from 0 in each shard. No rows give no rows; fewer rows than shards
    leave the last shards empty. A group that no shard can hold starts on as few as it needs; rows over a
    shard's count go elsewhere. Other columns pass through.
    """
    total = rows.count()
    links = links.filter(F.col("group").isNotNull())
    linked = propagate(_pieces(links, shards, total), shards, total, rounds)
    places = ranked(stored(linked, "shard-linked"), ["shard"], ["row_id"], "slot")
    quotas = F.broadcast(_quotas(rows, shards, total))
    places = places.join(quotas, "shard").filter("slot < quota").select("row_id", "shard", "slot")
    placed = stored(rows.join(places, "row_id", "left"), "shard-placed")

    held = placed.filter("shard IS NOT NULL").groupBy("shard").agg(F.count(F.lit(1)).alias("held"))
    room = quotas.join(held, "shard", "left").select(
        F.col("shard").alias("_shard"), F.coalesce("held", F.lit(0)).alias("_held"), "quota"
    )
    size = F.col("quota") - F.col("_held")
    up = Window.orderBy("_shard")
    room = room.withColumn("_end", F.sum(size).over(up)).withColumn("_start", F.col("_end") - size)
    rest = stored(placed.filter("shard IS NULL").drop("shard", "slot"), "shard-rest")
    rest = ranked(rest.withColumn("_all", F.lit(0)), ["_all"], ["row_id"], "_rank", buckets=1024)
    inside = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end"))
    filled = rest.join(F.broadcast(room), inside).select(
        *rows.columns, F.col("_shard").alias("shard"), (F.col("_held") + F.col("_rank") - F.col("_start")).alias("slot")
    )
    return placed.filter("shard IS NOT NULL").unionByName(filled)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) on a shard; rows of equal text are linked.

    ``size`` is the UTF-8 bytes of the text plus 16. A null text has no bytes, a null checksum and
    no links; empty texts are equal texts. Repeated rows are rows of their own. Other columns of
    ``docs`` are not read.
    """
    light = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("_group"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    light = stored(light, "shard-rows")
    links = light.select("row_id", F.col("_group").alias("group"))
    return balanced_shards(light.drop("_group"), links, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
