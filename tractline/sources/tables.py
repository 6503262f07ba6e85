"""Clinical tables from a database, from parquet or from CSV files."""

from __future__ import annotations

import posixpath
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tractline.functions.values import parse_date
from tractline.schemas import (
    LOCATION_COLUMNS,
    LOCATION_HISTORY_COLUMNS,
    PERSON_COLUMNS,
    VISIT_COLUMNS,
    ContractError,
    require,
)
from tractline.sources.csv_folder import list_csv_files, read_csv_files

# The four tables, their required columns and the column each is split by.
CDM_TABLES = {
    "person": (PERSON_COLUMNS, "person_id"),
    "visit_occurrence": (VISIT_COLUMNS, "visit_occurrence_id"),
    "location": (LOCATION_COLUMNS, "location_id"),
    "location_history": (LOCATION_HISTORY_COLUMNS, "location_id"),
}


@dataclass(frozen=True)
class CdmTables:
    person: DataFrame
    visit: DataFrame
    location: DataFrame
    history: DataFrame


def _checked(frames: dict[str, DataFrame]) -> CdmTables:
    """Column names in lower case, required columns present, dates as dates."""
    ready = {}
    for name, df in frames.items():
        df = df.toDF(*[c.lower() for c in df.columns])
        columns, _ = CDM_TABLES[name]
        require(df.columns, columns, name.upper())
        dates = [c for c in columns if c.endswith("_date")]
        texts = {c for c, kind in df.dtypes if kind == "string"}
        ready[name] = df.withColumns({c: parse_date(df[c]) if c in texts else df[c].cast("date") for c in dates})
    return CdmTables(ready["person"], ready["visit_occurrence"], ready["location"], ready["location_history"])


def read_parquet_tables(spark: SparkSession, folder: str) -> CdmTables:
    """The four tables from ``<folder>/<table>.parquet``."""
    return _checked({name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in CDM_TABLES})


def read_csv_tables(spark: SparkSession, folder: str, multi_line: bool = False) -> CdmTables:
    """The four tables from ``<table>.csv`` files (or folders of parts) in ``folder``, names in any case, by header.

    Ids become numbers (NULL where they are none) and dates are ISO or ``MM/dd/yyyy``.
    """
    found = {posixpath.basename(f).lower().removesuffix(".csv"): f for f in list_csv_files(spark, folder, parts=True)}
    missing = [name for name in CDM_TABLES if name not in found]
    if missing:
        raise ContractError(f"files are missing for: {missing}")
    frames = {}
    for name, (columns, _) in CDM_TABLES.items():
        df = read_csv_files(spark, [found[name]], multi_line).drop("source_file")
        require(df.columns, columns, name.upper())
        ids = [c for c in columns if c.endswith("_id") and c != "country_concept_id"]
        frames[name] = df.withColumns({c: df[c].try_cast("bigint") for c in ids})
    return _checked(frames)


#: Widths of the nested ranges of ids in which the beginning of a share is looked for: 2**16 in each.
_WIDTHS = (2**48, 2**32, 2**16, 1)


def cuts_query(table: str, key: str, partitions: int) -> str:
    """SQL for the smallest ``key`` of each of ``partitions`` equal shares of a table's rows, in order.

    It runs in the database, which sends one number per share. A key that fills several shares is one cut. The shares
    are those of ``NTILE``, but no step sorts the table: rows are counted per range of ids, and a share's first row is
    looked for in ever narrower ranges. Running totals are over the 2**16 ranges in one range of the step before (twice
    as many around zero).
    """
    shares = int(partitions)
    numbers = " UNION ALL ".join(f"SELECT {i} AS share_no" for i in range(shares))
    first = f"CAST(share_no * (n - n % {shares}) / {shares} AS BIGINT) + CASE WHEN share_no < n % {shares} THEN share_no ELSE n % {shares} END"
    total = f"(SELECT COUNT({key}) AS n FROM {table}) total"
    found = f"SELECT 0 AS low, row_no FROM (SELECT {first} AS row_no, n FROM ({numbers}) numbers CROSS JOIN {total}) firsts WHERE row_no < n"
    outer = None
    for width in _WIDTHS:
        inner = f"{key} - {key} % {width}"
        parent, groups = ("0", inner) if outer is None else (outer, f"{outer}, {inner}")
        counts = f"SELECT {parent} AS parent, {inner} AS low, COUNT(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY {groups}"
        running = "SUM(n) OVER (PARTITION BY parent ORDER BY low ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        ranges = f"SELECT parent, low, {running} - n AS before, {running} AS up_to FROM ({counts}) counts"
        found = (
            f"SELECT ranges.low AS low, row_no - before AS row_no FROM ({found}) found JOIN ({ranges}) ranges "
            "ON found.low = parent AND row_no >= before AND row_no < up_to"
        )
        outer = inner
    return f"SELECT DISTINCT low FROM ({found}) cuts"


def range_predicates(key: str, cuts: Iterable[int]) -> list[str]:
    """Conditions that deal the rows of a table into ranges of ``key``: every row meets exactly one.

    Below the second cut, between neighbouring cuts, and from the last one on; rows without a key are in the first.
    """
    cuts = sorted({int(c) for c in cuts if c is not None})
    if len(cuts) < 2:
        return ["1 = 1"]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts[1:], cuts[2:])]
    return [f"{key} < {cuts[1]} OR {key} IS NULL", *inner, f"{key} >= {cuts[-1]}"]


def read_database_tables(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    schema: str = "CDM",
    partitions: int = 64,
) -> CdmTables:
    """The four tables over JDBC, each read in up to ``partitions`` parallel id ranges of about equal rows.

    The ranges come from the database's own shares of the key, so gaps and dense stretches of ids make no
    task larger. User and password go in ``properties``, never in the URL, so that no log or plan shows them.
    Date and column filters applied later are pushed to the database.
    """
    if "password" in url.lower():
        raise ValueError("pass the password in properties, not in the URL")
    frames = {}
    for name, (_, key) in CDM_TABLES.items():
        table = f"{schema}.{name.upper()}"
        cuts = spark.read.jdbc(url, f"({cuts_query(table, key, partitions)}) cut_list", properties=properties)
        predicates = range_predicates(key, [row[0] for row in cuts.collect()])
        frames[name] = spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return _checked(frames)
