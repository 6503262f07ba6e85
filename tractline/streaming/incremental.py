"""Work only on files that were not worked on before.

Two forms: a file stream that remembers finished files in its checkpoint, and a batch form that
compares a folder with a manifest table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.sources.csv_folder import FolderScan, scan_files

FILES_PER_BATCH = 1000
# The columns of Spark's binary file source. Only the path is read.
FILE_COLUMNS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def run_new_files(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    handle: Callable[[FolderScan, int], None],
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Call ``handle(scan, batch_id)`` for the CSV files not yet recorded in ``checkpoint``, then stop.

    The stream only carries file paths, at most ``files_per_batch`` at a time; the rows are read by
    the batch reader, which binds columns by header name. A batch that failed is handed over again
    with the same id, so a handler that overwrites its own batch's folder writes every file once.
    """
    paths = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(row.path for row in batch.collect())
        if files:
            handle(scan_files(batch.sparkSession, files), batch_id)

    query = (
        paths.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_new_files(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    shape: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Add the new files of one shape to the parquet table ``target``, one folder per batch."""

    def handle(scan: FolderScan, batch_id: int) -> None:
        if shape in scan.frames:
            transform(scan.frames[shape]).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    run_new_files(spark, folder, checkpoint, handle, files_per_batch)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``file_name``, ``modified`` and ``length`` of the CSV files directly in ``folder``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    name = F.substring_index("path", "/", -1)
    return files.select("path", name.alias("file_name"), F.col("modificationTime").alias("modified"), "length")


def files_to_do(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Files in ``folder`` that ``manifest`` does not have.

    A manifest with ``modified`` and ``length``, as :func:`record_files` writes it, also lets a replaced file
    through; one with ``file_name`` only goes by the name.
    """
    keys = ["file_name", *[c for c in ("modified", "length") if c in manifest.columns]]
    done = manifest.select(*keys).where(F.col("file_name").isNotNull())
    return list_files(spark, folder).join(done, keys, "left_anti")


def record_files(files: DataFrame, manifest: str) -> None:
    """Append ``files``, as :func:`files_to_do` gave them, to the parquet table ``manifest`` after they were worked on."""
    files.write.mode("append").parquet(manifest)
