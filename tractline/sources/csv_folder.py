"""A folder of CSV files with differing headers as one DataFrame per kind of input."""

from __future__ import annotations

import csv
import posixpath
import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.schemas import ADDRESS_PARTS, ContractError, require_location, require_location_history

COORDINATES, SINGLE, MULTI = "coordinates", "single", "multi"
LOCATION, LOCATION_HISTORY = "location", "location_history"
#: Files open at once, and bytes a reader takes at once, when only headers are wanted.
_OPEN_FILES, _HEAD_BYTES = 32, 1 << 13
_AS_READ = "_row_as_read"

# Field text that readers of such files take for a missing value, exactly as written.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


@dataclass
class FolderScan:
    """Frames per shape, and the files that were not read with the reason."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, str] = field(default_factory=dict)


def normalize_names(columns: Iterable[str]) -> list[str]:
    """Header names in lower case without surrounding white space; repeats are an error."""
    names = [c.lower().strip() for c in columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ContractError(f"repeated column names: {repeated}")
    return names


def normalize_header(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def detect_shape(file_name: str, columns: Iterable[str]) -> str | None:
    """What a file is, by its name for the two clinical tables and by its columns otherwise.

    Coordinates win over address columns, and a single address column over separate ones.
    """
    stem = posixpath.splitext(posixpath.basename(file_name))[0].lower()
    if stem in (LOCATION, LOCATION_HISTORY):
        return stem
    present = set(columns)
    if {"latitude", "longitude"} <= present:
        return COORDINATES
    if "address" in present:
        return SINGLE
    if set(ADDRESS_PARTS) <= present:
        return MULTI
    return None


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_MARKERS), c)


def list_csv_files(spark: SparkSession, folder: str, parts: bool = False) -> list[str]:
    """Paths of the ``*.csv`` files directly in ``folder`` (suffix in lower case), by name.

    ``parts`` also takes folders of that suffix, in which a writer left one file in parts.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        raise FileNotFoundError(f"not a folder: {folder}")
    found = [s for s in fs.listStatus(path) if (parts or s.isFile()) and s.getPath().getName().endswith(".csv")]
    return sorted(s.getPath().toString() for s in found)


def _plain(path: str) -> str:
    """A file's path in one spelling, as listings and row metadata differ in theirs."""
    return re.sub("^([a-z]+):/+(?=/)", r"\1:", unquote(path))


def read_headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """The header line of every file; a file without any line has an empty header.

    A line reader opens each file through Spark's own file systems, a few at a time, and is closed after the
    first line, so no more than a buffer of a file is read. It runs where the files are listed, in the
    driver: a task has no way to stop Spark's readers after a file's beginning.
    """
    jvm = spark._jvm
    settings = spark._jsc.hadoopConfiguration()

    def first_line(file: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(file)
        stream = path.getFileSystem(settings).open(path, _HEAD_BYTES)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"), _HEAD_BYTES)
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    with ThreadPoolExecutor(_OPEN_FILES) as pool:
        lines = dict(zip(files, pool.map(first_line, files)))
    return {file: next(csv.reader([line.removeprefix("\ufeff")]), []) for file, line in lines.items()}


def count_malformed(spark: SparkSession, files: list[str], n_columns: int, multi_line: bool = False) -> dict[str, int]:
    """The files with rows of more fields than their header has, each with how many such rows.

    Such a row has a separator too many, so its values stand under the wrong names. The reader marks every row
    whose number of fields is not the header's; of those the fields outside quotes are counted. A row of
    fewer fields only lacks its last values. Of all files the driver gets a row each at most.
    """
    names = [f"_c{i}" for i in range(n_columns)]
    schema = ", ".join(f"{c} STRING" for c in [*names, _AS_READ])
    # Without all columns the reader does not see how many fields there are.
    df = spark.read.schema(schema).option("columnPruning", "false").csv(
        files, header=True, multiLine=multi_line, escape='"', encoding="UTF-8", columnNameOfCorruptRecord=_AS_READ
    )
    fields = F.size(F.split(F.regexp_replace(_AS_READ, '"(?:[^"]|"")*"', ""), ",", -1))
    counted = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        # The first column is read as well: a scan of the marks alone is refused.
        F.count_if(F.col(_AS_READ).isNotNull() & (fields > n_columns)).alias("n"), F.count(names[0])
    )
    bad = {_plain(row.path): row.n for row in counted.where("n > 0").collect()}
    return {file: bad[_plain(file)] for file in files if _plain(file) in bad}


def read_csv_files(spark: SparkSession, files: list[str], multi_line: bool = False) -> DataFrame:
    """Files with one common header as text columns by header name, plus ``source_file``.

    No schema is given: the reader would bind it by position and swap columns silently. Text that
    stands for a missing value becomes NULL. ``multi_line`` allows line breaks inside quotes at
    the price of not splitting files.
    """
    df = spark.read.csv(files, header=True, multiLine=multi_line, escape='"', encoding="UTF-8")
    names = normalize_names(df.columns)
    return df.select(
        *[missing_to_null(F.col(f"`{old}`")).alias(new) for old, new in zip(df.columns, names)],
        F.col("_metadata.file_name").alias("source_file"),
    )


def scan_files(spark: SparkSession, files: list[str], multi_line: bool = False) -> FolderScan:
    """Group files by shape and header and read each group; a bad file is reported, not fatal.

    A file with a row that has more fields than its header is rejected as a whole, which takes a pass over the
    files. The number of plans is the number of distinct headers, not of files.
    """
    scan = FolderScan()
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)
    for file, header in read_headers(spark, files).items():
        try:
            shape = detect_shape(file, normalize_names(header))
            # The two clinical tables are checked on the header as it is written.
            if shape == LOCATION:
                require_location(header)
            elif shape == LOCATION_HISTORY:
                require_location_history(header)
        except ContractError as error:
            scan.rejected[file] = str(error)
            continue
        if shape is None:
            scan.rejected[file] = "no location columns"
        else:
            groups[shape, tuple(header)].append(file)
    for (shape, header), members in sorted(groups.items()):
        for file, rows in count_malformed(spark, members, len(header), multi_line).items():
            scan.rejected[file] = f"rows with more fields than the header: {rows}"
            members.remove(file)
        if not members:
            continue
        df = read_csv_files(spark, members, multi_line)
        known = scan.frames.get(shape)
        scan.frames[shape] = df if known is None else known.unionByName(df, allowMissingColumns=True)
    return scan


def scan_folder(spark: SparkSession, folder: str, multi_line: bool = False) -> FolderScan:
    return scan_files(spark, list_csv_files(spark, folder), multi_line)
