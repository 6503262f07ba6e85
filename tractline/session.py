"""Session settings, the shared scratch folder and the broadcast size check."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Adaptive execution does the run-time work every plan here relies on: it splits skewed join
# partitions, coalesces small ones and turns a shuffled join into a broadcast one when the
# measured side is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python call site of every column expression makes large plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tractline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``.

    On a cluster the folder must be visible to every executor, so the setting is required there;
    only a local master falls back to the machine's own temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tractline-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table into the scratch folder and read again.

    That cuts the lineage with files every executor can read, so a lost executor costs one task; it also
    fixes generated ids, and gives later joins a plain scan whose exchange adaptive execution may split.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    written.stored_at = folder
    return written


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``stored`` frames that nothing reads any more; other frames are left alone."""
    for frame in frames:
        folder = frame.__dict__.get("stored_at")
        if folder is not None:
            delete_folder(frame.sparkSession, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)


BROADCAST_BYTES = 128 * 1024 * 1024
_ROW_BYTES, _FIELD_BYTES = 32, 16


def _bytes(df: DataFrame, nested: Column | None) -> Column:
    """What a row takes in a broadcast table at most."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fixed = F.lit(_ROW_BYTES + _FIELD_BYTES * len(df.schema.fields)).cast("bigint")
    return reduce(lambda a, b: a + b, texts, fixed if nested is None else fixed + F.coalesce(nested, F.lit(0)))


def broadcast_within(df: DataFrame, max_bytes: int = BROADCAST_BYTES, nested: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint only when measuring proves that it fits in ``max_bytes``.

    Rows are counted and text lengths added up, so neither many rows nor long texts slip through.
    Above the limit the join stays a shuffled one: a table that outgrows it costs time and never
    memory. The table is worked out once, into the scratch folder, and both measured and joined from
    there. Tables with nested columns are measured only where ``nested`` gives the
    bytes these take in a row.
    """
    fields = df.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)) for f in fields) and nested is None:
        return df
    if max_bytes <= 0:
        return df
    df = stored(df, "measured")
    (measured,) = df.agg(F.coalesce(F.sum(_bytes(df, nested)), F.lit(0))).first()
    return F.broadcast(df) if measured <= max_bytes else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides, unless the other side has a broadcast hint of its own.

    Without it Spark may send a side to the driver and every executor by a guess from the size of the files
    below, which knows neither how far their columns are compressed nor how many rows an ``explode`` makes of one.
    """
    return df.hint("merge")


def spread_unless(known: Column, df: DataFrame) -> Column:
    """0 where ``known`` is true, else a number that differs from row to row.

    As a further join key it keeps rows that cannot match anything out of one partition. Columns that
    hold maps cannot be hashed and are left out.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    other = 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(1 << 20))
    return F.when(known, 0).otherwise(other).cast("int")


def no_spread(*keys: str) -> Column:
    """0 on the other side of a join with ``spread_unless``, in a form that is no literal.

    A literal is folded into the join's condition, and the spread is then no join key any more.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns that later filters and joins use, without their being computed again.

    A filter on a plain computed column is pushed below it, which repeats the expression in the
    filter. Filters on a generator's output stay above it, so a one-element ``inline`` holds the
    values in place and costs one small struct per row.
    """
    held = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], held)
