"""The trie of conversations by their turns, built as a z-fast trie.

The compacted trie has a node where conversations part or end. Its dictionary is keyed by handles: a node that
lies between depths p (its parent's, excluded) and d (its own) is filed under its path's first f turns, f being
the number in that range that the highest power of two divides. To find where a conversation leaves the trie,
a binary search over its length looks only at such numbers and so needs a join per halving, not per turn.

Conversations are inserted in batches. All those that wait are searched for together; of those that leave
the trie at the same point with the same next turn one is drawn, by hash, and becomes a leaf, while the others
meet it further down in the next batch. An expected logarithmic number of batches is enough, also where
conversations are prefixes of each other.

Paths are told apart by 128-bit hashes of their prefixes, so that texts are read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractline.llm.common import discard, stored

#: Rebuilt conversations take so many first turns from the first conversation of their group of GROUP ids.
GROUP, SHARED_TURNS = 5, 9
_ROOT = "0"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def _key(path: Column, depth: Column) -> Column:
    """Names the first ``depth`` turns of a path, an array of prefix hashes."""
    last = F.get(path, depth - 1)
    return F.when(depth == 0, _ROOT).otherwise(F.concat_ws(":", depth, F.hex(last["x"]), F.hex(last["y"])))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` (from 1), ``role``, ``digest`` and ``bytes`` of each turn, with an id, stored.

    Turns are ordered by ``turn``, null first; equal ones by role and then by the SHA-256 of the text.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.sha2(text, 256).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return stored(turns.withColumn("at", F.row_number().over(order)).drop("turn"), "trie-turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``at``, ``role``, ``digest``, ``bytes`` of rebuilt conversations; a turnless one has one row without ``at``."""
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS).cast("int").alias("shared")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    first = (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first")
    ids = sizes.select("conv_id", shared, first)
    ids = ids.join(sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("first_n")), "first", "left")
    ids = ids.withColumn("kept", F.least("shared", F.coalesce("first_n", F.lit(0))).cast("int")).drop("first_n")
    content = ["role", "digest", "bytes"]
    heads = turns.filter(F.col("at") < SHARED_TURNS).withColumnRenamed("conv_id", "first")
    heads = ids.join(heads, "first").filter("at <= shared").select("conv_id", "at", *content)
    own = ids.join(turns, "conv_id").filter("at > shared")
    own = own.select("conv_id", (F.col("at") - F.col("shared") + F.col("kept")).alias("at"), *content)
    empty = [F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in ("at", *content)]
    return heads.unionByName(own).unionByName(ids.select("conv_id", *empty))


def with_paths(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth`` and ``path`` per conversation of ``turns`` (``conv_id``, ``at``, ``role``, ``digest``, ``bytes``).

    ``path`` has an element per turn: two 64-bit hashes ``x``, ``y`` of the turns so far and their text bytes in
    all. A row without ``at`` adds no turn. A conversation's hashes, 24 bytes a turn, are held in one row.
    """
    hashed = [F.xxhash64(F.lit(seed), "at", "role", "digest").alias(name) for seed, name in ((1, "x"), (2, "y"))]
    turns = turns.select("conv_id", "at", "bytes", *hashed)
    so_far = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.col("at").isNotNull()
    sums = [F.bit_xor(F.when(held, F.col(c))).over(so_far).alias(c) for c in ("x", "y")]
    turns = turns.select("conv_id", "at", *sums, F.sum("bytes").over(so_far).alias("bytes"))
    steps = F.sort_array(F.collect_list(F.when(held, F.struct("at", "x", "y", "bytes"))))
    path = F.transform(steps, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"), s["bytes"].alias("bytes")))
    paths = turns.groupBy("conv_id").agg(path.alias("path"))
    return stored(paths.select("conv_id", F.size("path").alias("depth"), "path"), "trie-paths")


def locate(waiting: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Where each waiting path leaves the trie: ``leaves`` (a depth) and the node on whose edge that is, if on one.

    The deepest node that is a prefix of the path is found by fat binary search: each step halves the depths
    in question, so one more step than ``longest`` has bits ends it. The node's child by the next turn, if
    there is one, is compared with the path along its edge.
    """
    found = waiting.withColumns({"low": F.lit(0), "high": F.col("depth")})
    handle = _key(F.col("path"), fattest(F.col("up_depth"), F.col("depth")))
    below = nodes.filter("depth > 0")
    as_met = [F.col(c).alias(name) for c, name in (("depth", "n_depth"), ("up_depth", "n_up"), ("node", "n_node"))]
    handles = below.select(handle.alias("probe"), *as_met)
    # What is done is spread over all partitions by keys of its own.
    own = F.concat(F.lit("-"), F.col("conv_id").cast("string"))
    for _ in range(longest.bit_length() + 1):
        middle = fattest(F.col("low"), F.col("high"))
        open_ = F.col("low") < F.col("high")
        found = found.withColumns({"middle": middle, "probe": F.when(open_, _key(F.col("path"), middle)).otherwise(own)})
        found = found.join(handles, "probe", "left")
        hit = F.col("n_node").isNotNull()
        whole = hit & (F.col("n_depth") <= F.col("depth")) & (_key(F.col("path"), F.col("n_depth")) == F.col("n_node"))
        # A node that is met but is no prefix as a whole is the one on whose edge the path leaves.
        found = found.select(
            *waiting.columns,
            F.when(whole, F.col("n_depth")).when(hit, F.col("n_up")).otherwise(F.col("low")).alias("low"),
            F.when(~open_ | whole, F.col("high")).when(hit, F.col("n_up")).otherwise(F.col("middle") - 1).alias("high"),
        )
    next_ = F.when(F.col("low") < F.col("depth"), _key(F.col("path"), F.col("low") + 1)).otherwise(own)
    edges = below.select(
        _key(F.col("path"), F.col("up_depth") + 1).alias("probe"),
        F.col("node").alias("edge"),
        F.col("depth").alias("n_depth"),
        F.col("path").alias("n_path"),
    )
    found = found.withColumn("probe", next_).join(edges, "probe", "left")
    same = lambda d: (F.get("path", d - 1)["x"] == F.get("n_path", d - 1)["x"]) & (
        F.get("path", d - 1)["y"] == F.get("n_path", d - 1)["y"]
    )
    along = F.filter(F.sequence(F.col("low") + 1, F.least("depth", "n_depth")), same)
    leaves = F.when(F.col("edge").isNull(), F.col("low")).otherwise(F.col("low") + F.size(along))
    return found.select(*waiting.columns, "edge", leaves.alias("leaves"))


def insert(located: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie with a batch of ``located`` paths, and the paths that wait for the next batch.

    Every point where a path leaves an edge becomes a node, and the edge is cut there, at several depths if need
    be. Of the paths that go on from a point by the same turn, the one of least hash becomes a leaf.
    """
    point = _key(F.col("path"), F.col("leaves"))
    splits = located.filter("edge IS NOT NULL").select("edge", F.col("leaves").alias("depth"), point.alias("point")).distinct()
    old = nodes.select(F.col("node").alias("edge"), "path", "up", "up_depth")
    splits = splits.join(old, "edge").select(
        "edge", F.col("point").alias("node"), "depth", F.slice("path", F.lit(1), F.col("depth")).alias("path"), "up", "up_depth"
    )
    chain = Window.partitionBy("edge").orderBy("depth")
    cut = nodes.withColumn("edge", F.col("node")).unionByName(splits).withColumns(
        {
            "up": F.coalesce(F.lag("node").over(chain), F.col("up")),
            "up_depth": F.coalesce(F.lag("depth").over(chain), F.col("up_depth")),
        }
    )
    going = located.filter("leaves < depth").withColumn("next", _key(F.col("path"), F.col("leaves") + 1))
    drawn = going.groupBy("next").agg(F.min(F.struct(F.xxhash64("conv_id").alias("h"), "conv_id")).alias("drawn"))
    drawn = drawn.select(F.col("drawn.conv_id").alias("conv_id"), F.lit(True).alias("drawn"))
    going = going.join(drawn, "conv_id", "left")
    leaf = going.filter("drawn").select(
        _key(F.col("path"), F.col("depth")).alias("node"), "depth", "path", point.alias("up"), F.col("leaves").alias("up_depth")
    )
    return cut.drop("edge").unionByName(leaf), going.filter("drawn IS NULL").select("conv_id", "depth", "path")


def build_trie(paths: DataFrame) -> DataFrame:
    """The compacted trie of ``paths`` (``conv_id``, ``depth``, ``path``), which must have no path twice.

    Columns: ``node`` (its name), ``depth``, ``path``, ``up`` and ``up_depth`` (the parent; null at the root).
    """
    spark = paths.sparkSession
    longest = paths.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    empty = F.filter(F.array(F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("x", "y", "bytes")])), lambda _: F.lit(False))
    nodes = spark.range(1).select(
        F.lit(_ROOT).alias("node"),
        F.lit(0).alias("depth"),
        empty.alias("path"),
        F.lit(None).cast("string").alias("up"),
        F.lit(None).cast("int").alias("up_depth"),
    )
    nodes, waiting = stored(nodes, "trie-nodes"), paths.filter("depth > 0")
    while not waiting.isEmpty():
        located = stored(locate(waiting, nodes, longest), "trie-located")
        grown, left = insert(located, nodes)
        grown, left = stored(grown, "trie-nodes"), stored(left, "trie-waiting")
        discard(nodes, located, waiting)
        nodes, waiting = grown, left
    discard(waiting)
    return nodes


def subtrees(values: DataFrame, sums: list[str], least: list[str]) -> DataFrame:
    """``values`` (``node``, ``up`` and numbers) with each number summed, or its least taken, over the node's subtree.

    Pointers double: after k rounds a node has gathered everything less than 2**k levels below it and points
    2**k levels up, so rounds are as many as the height has bits.
    """
    gather = {c: F.sum for c in sums} | {c: F.min for c in least}
    join = {c: lambda a, b: F.coalesce(a + b, a, b) for c in sums} | {c: F.least for c in least}
    at = stored(values.select("node", F.col("up").alias("jump"), *gather), "trie-sums")
    while not at.filter("jump IS NOT NULL").isEmpty():
        given = at.filter("jump IS NOT NULL").groupBy(F.col("jump").alias("node"))
        given = given.agg(*[f(c).alias(f"_{c}") for c, f in gather.items()])
        # Nothing lies above the root, so its children need not meet there to find out.
        on = F.when(F.col("jump") != _ROOT, F.col("jump")).otherwise(F.concat(F.lit("-"), F.col("node")))
        above = at.select(F.col("node").alias("on"), F.col("jump").alias("next"))
        moved = at.withColumn("on", F.coalesce(on, F.concat(F.lit("-"), F.col("node")))).join(above, "on", "left")
        moved = moved.join(given, "node", "left")
        moved = moved.select("node", F.col("next").alias("jump"), *[f(F.col(c), F.col(f"_{c}")).alias(c) for c, f in join.items()])
        moved = stored(moved, "trie-sums")
        discard(at)
        at = moved
    return at.drop("jump")


def end_digests(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of the decimal ids of ``ends`` (``node``, ``conv_id``), ascending and comma-joined.

    A digest is a chain over its ids, so those of one node pass through one task, but as a sorted stream of
    which nothing is kept.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(names: list[str], digests: list[str]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(names, pa.string()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])

        node, digest = None, None
        for batch in batches:
            names, digests = [], []
            for name, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name == node:
                    digest.update(f",{conv_id}".encode())
                    continue
                if node is not None:
                    names.append(node)
                    digests.append(digest.hexdigest())
                node, digest = name, hashlib.sha256(str(conv_id).encode())
            yield row(names, digests)
        if node is not None:
            yield row([node], [digest.hexdigest()])

    dealt = ends.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    return dealt.mapInArrow(scan, "node string, ends_sha256 string")


def trie_nodes(paths: DataFrame) -> DataFrame:
    """Every node of the trie of ``paths`` (``conv_id``, unique; ``depth``; ``path``) with its figures, one row each.

    Columns: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. Conversations of equal turns are one path with several
    ends. Edges are expanded to a node per turn at the end. No conversations, no members: an empty result.
    """
    ends = stored(paths.select("conv_id", _key(F.col("path"), F.col("depth")).alias("node")), "trie-ends")
    at_node = ends.groupBy("node").agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n_convs"))
    at_node = stored(at_node, "trie-ends")
    one_each = paths.join(at_node.select(F.col("first").alias("conv_id")), "conv_id")
    nodes = build_trie(stored(one_each, "trie-waiting"))
    single = F.sha2(F.col("first").cast("string").cast("binary"), 256)
    digests = at_node.filter("n_convs = 1").select("node", single.alias("ends_sha256"))
    shared = ends.join(at_node.filter("n_convs > 1").select("node"), "node")
    digests = digests.unionByName(end_digests(shared))

    children = nodes.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    children = stored(nodes.select("node", "up", "up_depth", "depth").join(children, "node", "left").na.fill(0, ["n_children"]), "trie-children")
    values = children.join(at_node, "node", "left").na.fill(0, ["n_convs"])
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")
    summed = subtrees(values.withColumn("n_leaves", leaf), ["n_convs", "n_leaves"], ["first"])
    bytes_ = lambda d: F.when(d == 0, 0).otherwise(F.get("path", d - 1)["bytes"])
    edge = bytes_(F.col("depth")) - bytes_(F.coalesce("up_depth", F.lit(0)))
    summed = stored(
        summed.join(nodes, "node").select("node", "up", "n_convs", "n_leaves", "first", ((F.col("n_convs") - 1) * edge).alias("saved")),
        "trie-figures",
    )
    saved = subtrees(summed.select("node", "up", "saved"), ["saved"], [])
    parents = summed.select(F.col("node").alias("up"), F.col("first").alias("above"))
    full = (
        summed.join(saved.select("node", F.col("saved").alias("total")), "node")
        .join(nodes.drop("up"), "node")
        .join(children.select("node", "n_children"), "node")
        .join(digests, "node", "left")
        .filter("n_convs > 0")
    )
    # The root's children are the children of one node; adaptive execution splits them, its side being unique.
    full = full.join(parents, "up", "left")
    depths = F.sequence(F.coalesce(F.col("up_depth") + 1, F.lit(0)), F.col("depth"))
    full = full.withColumn("at", F.explode(depths)).withColumn("bottom", F.col("at") == F.col("depth"))
    below = F.col("total") - F.col("saved")
    own = (F.col("n_convs") - 1) * (bytes_(F.col("depth")) - bytes_(F.greatest(F.col("at") - 1, F.lit(0))))
    top = F.col("at") == F.col("up_depth") + 1
    long = {
        "conv_id": F.col("first"),
        "depth": F.col("at"),
        "parent_conv_id": F.when(F.col("at") == 0, None).when(top, F.col("above")).otherwise(F.col("first")),
        "n_convs": F.col("n_convs"),
        "n_children": F.when(F.col("bottom"), F.col("n_children")).otherwise(1),
        "n_leaves": F.col("n_leaves"),
        "saved_tokens": below + own,
    }
    digest = F.coalesce(F.when(F.col("bottom"), F.col("ends_sha256")), F.lit(_NO_ENDS))
    return full.select(*[c.cast("bigint").alias(name) for name, c in long.items()], digest.alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``trie_nodes`` of the rebuilt conversations of a table (``conv_id``, ``turn``, ``role``, ``text``).

    Rows without ``conv_id`` belong to no conversation and take no part. Null roles and texts are empty. Equal
    turns are ordered as in ``numbered_turns``; repeated rows are turns of their own. Other columns are not read.
    """
    return trie_nodes(with_paths(rebuilt(numbered_turns(conversations))))


SQL = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
    SELECT conv_id, list_reduce(
        list_concat([4294967295], flatten([
            [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(conv_id::VARCHAR, '')
        ])),
        lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE xor(a >> 1, (a & 1) * 3988292384) END
    ) AS a, count(*) AS n
    FROM turns GROUP BY conv_id
), ids AS (
    SELECT c.conv_id, xor(c.a, 4294967295) % 9 AS h, c.conv_id - c.conv_id % 5 AS first_id,
        least(xor(c.a, 4294967295) % 9, coalesce(f.n, 0)) AS kept
    FROM crc c LEFT JOIN crc f ON f.conv_id = c.conv_id - c.conv_id % 5
), parts AS (
    SELECT i.conv_id, t.pos, role, text FROM ids i JOIN turns t ON t.conv_id = i.first_id AND t.pos <= i.h
    UNION ALL
    SELECT i.conv_id, t.pos - i.h + i.kept, role, text FROM ids i JOIN turns t ON t.conv_id = i.conv_id AND t.pos > i.h
), convs AS (
    SELECT i.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS path
    FROM ids i LEFT JOIN parts USING (conv_id) GROUP BY i.conv_id
), prefixes AS (
    SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path FROM convs
), named AS (
    SELECT conv_id, depth, depth = len(path) AS ends, coalesce(strlen(path[depth].text), 0) AS bytes,
        min(conv_id) OVER same AS node, count(*) OVER same AS n
    FROM prefixes WINDOW same AS (PARTITION BY depth, path[1:depth])
), nodes AS (
    SELECT node, depth, any_value(n) AS n, any_value(bytes) AS bytes,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM named GROUP BY node, depth
), up AS (
    SELECT a.*, p.node AS parent FROM nodes a LEFT JOIN named p ON p.conv_id = a.node AND p.depth = a.depth - 1
), children AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS k FROM up WHERE depth > 0 GROUP BY parent, depth
), sized AS (
    SELECT up.*, coalesce(k, 0) AS k FROM up LEFT JOIN children USING (node, depth)
), sums AS (
    SELECT above.node, above.depth, count(*) FILTER (s.k = 0) AS leaves, sum((s.n - 1) * s.bytes) AS saved
    FROM sized s JOIN named above ON above.conv_id = s.node AND above.depth <= s.depth GROUP BY above.node, above.depth
)
SELECT node::BIGINT AS conv_id, depth::BIGINT AS depth, parent::BIGINT AS parent_conv_id, n::BIGINT AS n_convs,
    k::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
FROM sized JOIN sums USING (node, depth)
"""
