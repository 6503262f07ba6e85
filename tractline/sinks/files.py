"""Result writers. Each writes a folder of CSV files and refuses to write inside its input."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractline.functions.values import drop_work_columns, long_coordinate_names
from tractline.operators.locations import build_location
from tractline.operators.ranks import paged
from tractline.schemas import INVALID

BATCH_ROWS = 100_000
FILE_ROWS = 5_000_000
# The writer would otherwise trim every field.
_CSV = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def check_target(path: str, input_path: str | None) -> None:
    """Refuse a target that is the input folder or lies below it."""
    if input_path is None:
        return
    target, source = (posixpath.normpath(p) + "/" for p in (path, input_path))
    if target.startswith(source):
        raise ValueError("the output folder must not lie inside the input folder")


def _write(df: DataFrame, path: str, input_path: str | None, mode: str) -> None:
    """One folder per source file when the rows carry ``source_file``.

    Rows are brought together by source file first, so each gets a few files and not one per task;
    the rebalancing splits a source file that holds very many rows.
    """
    check_target(path, input_path)
    writer = df.write
    if "source_file" in df.columns:
        writer = df.hint("rebalance", "source_file").write.partitionBy("source_file")
    writer.option("maxRecordsPerFile", FILE_ROWS).csv(path, mode=mode, **_CSV)


def result_table(df: DataFrame) -> DataFrame:
    """Linked rows as they are handed on: long coordinate names, no vintage, no work columns."""
    return drop_work_columns(long_coordinate_names(df)).drop("year_for_fips")


def write_with_coordinates(df: DataFrame, path: str, input_path: str | None = None, mode: str = "errorifexists") -> None:
    """Rows with coordinates, result and reason."""
    _write(result_table(df).drop("FIPS"), path, input_path, mode)


def write_with_fips(df: DataFrame, path: str, input_path: str | None = None, mode: str = "errorifexists") -> None:
    """Rows of both vintages with their tract code."""
    _write(result_table(df), path, input_path, mode)


def write_location(df: DataFrame, path: str, input_path: str | None = None, mode: str = "errorifexists") -> None:
    """LOCATION with refreshed coordinates, without tract codes, by location id."""
    _write(build_location(df), path, input_path, mode)


def write_location_history(df: DataFrame, path: str, input_path: str | None = None, mode: str = "errorifexists") -> None:
    """Every column and row as read."""
    _write(df.drop("source_file"), path, input_path, mode)


def write_category_batches(
    df: DataFrame,
    path: str,
    input_path: str | None = None,
    mode: str = "errorifexists",
    batch_rows: int = BATCH_ROWS,
    partitions: int | None = None,
) -> None:
    """One folder per category and in it one per page, each a file of ``batch_rows`` rows ordered by person and start.

    Pages are numbered from 0 and every page but a category's last is full. Places in the order come from range
    partitions, which include the visit id, so a person with very many visits is spread over several. A page
    is then one task's work. ``partitions`` overrides the session's number of ranges.
    """
    check_target(path, input_path)
    order = ["person_id", "visit_start_date", "visit_occurrence_id"]
    (
        paged(df, order, batch_rows, ["category"], partitions)
        .repartition("category", "page")
        .sortWithinPartitions("category", "page", *order)
        .write.partitionBy("category", "page")
        .csv(path, mode=mode, **_CSV)
    )


def write_invalid(df: DataFrame, path: str, input_path: str | None = None, mode: str = "errorifexists") -> None:
    """Rows without any usable location, otherwise unchanged."""
    _write(df.where(F.col("category") == INVALID).drop("category"), path, input_path, mode)
