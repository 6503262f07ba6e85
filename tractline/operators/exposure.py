"""Linked rows joined to environmental and social variables, checks and date shifting.

Three tables describe the variables: ``data_source(source_id, ...)``,
``variable_index(variable_id, source_id, ...)`` and
``variable_value(variable_id, geocode, year, value)``. What is not fixed by those tables, such as
which year of a variable applies to a visit, is our choice and stated where it is made.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tractline.functions.values import in_range, number_in
from tractline.operators.tracts import TractIndex, assign_tracts, with_fips
from tractline.session import BROADCAST_BYTES, broadcast_within, no_spread, spread_unless

LEVELS = ("tract", "county", "state", "zcta")
_LISTED = 200
_ELEMENT_BYTES = 16


def select_variables(
    values: DataFrame,
    index: DataFrame | None = None,
    variable_ids: Iterable[int] | None = None,
    source_ids: Iterable[int] | None = None,
) -> DataFrame:
    """Values of the given variables and of variables from the given data sources.

    Both lists narrow the result; None means no limit. A short list becomes a scan filter, a long one
    a table to join with; the index is joined only when sources are named.
    """
    if variable_ids is not None:
        ids = sorted(set(variable_ids))
        if len(ids) <= _LISTED:
            values = values.where(F.col("variable_id").isin(*ids))
        else:
            listed = values.sparkSession.createDataFrame([(i,) for i in ids], "variable_id bigint")
            values = values.join(F.broadcast(listed), "variable_id", "left_semi").select(*values.columns)
    if source_ids is not None:
        if index is None:
            raise ValueError("source_ids needs the variable index")
        chosen = index.where(F.col("source_id").isin(*source_ids)).select("variable_id").distinct()
        values = values.join(broadcast_within(chosen), "variable_id", "left_semi")
    return values


def roll_up(
    df: DataFrame,
    level: str,
    fips: str = "FIPS",
    crosswalk: DataFrame | None = None,
    geocode: str = "geocode",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``geocode``: the code of ``level`` that the row's tract belongs to.

    ZCTAs do not nest in tracts, so they need a ``crosswalk(FIPS, zcta, weight)``; a tract goes to
    its ZCTA of largest weight, the smaller code on a tie.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    if level == "zcta":
        if crosswalk is None:
            raise ValueError("zcta needs a crosswalk")
        rank = F.struct(-F.col("weight"), F.col("zcta"))
        main = crosswalk.groupBy(F.col("FIPS").alias("_fips")).agg(F.min_by("zcta", rank).alias(geocode))
        main = broadcast_within(main.where("_fips is not null").withColumn("_one", no_spread("_fips")), broadcast_bytes)
        rows = df.withColumn("_spread", spread_unless(F.col(fips).isNotNull(), df))
        same = (F.col(fips) == F.col("_fips")) & (F.col("_spread") == F.col("_one"))
        return rows.join(main, same, "left").drop("_fips", "_spread", "_one")
    length = {"tract": 11, "county": 5, "state": 2}[level]
    return df.withColumn(geocode, F.substring(fips, 1, length))


def wide_values(values: DataFrame, variables: Mapping[int, str]) -> DataFrame:
    """One row per (geocode, year) with a column per variable.

    A repeated value of the same variable, place and year counts once, as the larger.
    """
    chosen = select_variables(values, variable_ids=list(variables))
    # One aggregate per variable instead of a pivot: a single shuffle, combined on the map side.
    return chosen.groupBy("geocode", "year").agg(
        *[F.max(F.when(F.col("variable_id") == key, F.col("value"))).alias(name) for key, name in variables.items()]
    )


def value_histories(values: DataFrame, variables: Mapping[int, str]) -> DataFrame:
    """``geocode`` and ``_history``: the place's years in order, each with the latest values up to then.

    A place has at most one element per year that occurs, however many rows ask for it.
    """
    wide = wide_values(values, variables).where("geocode IS NOT NULL AND year IS NOT NULL")
    so_far = Window.partitionBy("geocode").orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = [F.last(name, ignorenulls=True).over(so_far).alias(name) for name in variables.values()]
    filled = wide.select("geocode", "year", *latest)
    return filled.groupBy("geocode").agg(F.sort_array(F.collect_list(F.struct("year", *variables.values()))).alias("_history"))


def _as_of(history: Column, year: Column) -> Column:
    """The last element of ``history`` (sorted by ``year``) not after ``year``, by binary search; else NULL."""
    # As many steps as the length has bits, each adding its power of two if the element there is early enough.
    steps = F.sequence(F.length(F.bin(F.size(history).cast("bigint"))) - 1, F.lit(0), F.lit(-1))

    def step(found: Column, bit: Column) -> Column:
        further = found + F.call_function("shiftleft", F.lit(1), bit)
        return F.when(F.get(history["year"], further - 1) <= year, further).otherwise(found)

    return F.get(history, F.aggregate(steps, F.lit(0), step) - 1)


def join_by_geocode(
    rows: DataFrame,
    values: DataFrame,
    variables: Mapping[int, str],
    geocode: str = "FIPS",
    year: str = "year",
    year_rule: str = "exact",
    last_year: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add a column per variable, matched on place and year; rows without values get NULLs.

    The values are made wide first, so the join adds at most one row per input row and its key is
    unique on one side: a place that holds very many of the rows only needs its partition split,
    which adaptive execution does. Rows without a place are spread by a hash. ``year_rule`` "exact" takes the
    row's own year, "latest" the newest value of each variable not after it: places carry their history in
    order, and a row finds its year in it. Values after ``last_year`` count for no row.
    """
    if year_rule not in ("exact", "latest"):
        raise ValueError("year_rule must be 'exact' or 'latest'")
    latest, key = year_rule == "latest", F.col(year)
    spread = rows.withColumn("_spread", spread_unless(F.col(geocode).isNotNull() & key.isNotNull(), rows))
    same = (F.col(geocode) == F.col("_geocode")) & (F.col("_spread") == F.col("_one"))
    if latest:
        held = value_histories(values, variables).withColumnRenamed("geocode", "_geocode").withColumn("_one", no_spread("_geocode"))
        nested = F.size("_history") * (_ELEMENT_BYTES * (2 + len(variables)))
        joined = spread.join(broadcast_within(held, broadcast_bytes, nested), same, "left")
        asked = F.least(key, F.lit(last_year)) if last_year is not None else key
        return joined.withColumn("_found", F.when(key.isNotNull(), _as_of(F.col("_history"), asked))).select(
            *rows.columns, *[F.col("_found")[name].alias(name) for name in variables.values()]
        )
    wide = wide_values(values, variables).withColumnsRenamed({"geocode": "_geocode", "year": "_year"}).withColumn("_one", no_spread("_geocode", "_year"))
    joined = spread.join(broadcast_within(wide, broadcast_bytes), same & (key == F.col("_year")), "left")
    return joined.drop("_geocode", "_year", "_spread", "_one")


def join_spatially(
    rows: DataFrame,
    tracts: DataFrame | TractIndex,
    values: DataFrame,
    variables: Mapping[int, str],
    vintage: str = "year_for_fips",
    **options,
) -> DataFrame:
    """Coordinates to tract to variables. ``options`` are those of :func:`join_by_geocode`."""
    return join_by_geocode(with_fips(assign_tracts(rows, tracts, vintage=vintage)), values, variables, **options)


def check_output(
    exposure: DataFrame, variables: Iterable[str], person: str = "person_id", source: str | None = None
) -> DataFrame:
    """One report row, or one per ``source``: how many rows miss each required field."""

    def rows_where(condition: Column) -> Column:
        return F.count_if(condition)

    lat, lon = number_in(exposure, "latitude"), number_in(exposure, "longitude")
    bad_fips = ~F.coalesce(F.col("FIPS").rlike(r"^[0-9]{11}$"), F.lit(False))
    return exposure.groupBy(*([source] if source else [])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        rows_where(F.col(person).isNull()).alias("missing_person"),
        rows_where(~in_range(lat, lon)).alias("bad_coordinates"),
        rows_where(bad_fips).alias("bad_fips"),
        *[rows_where(F.col(v).isNull()).alias(f"missing_{v}") for v in variables],
    )


def shift_dates(
    df: DataFrame, person: str, date_columns: Iterable[str], secret: str, max_days: int = 182
) -> DataFrame:
    """Move every date of a person by the same 1 to ``max_days`` days, back or forward.

    The offset comes from a keyed hash of the person id, so gaps within a person are unchanged and
    the table needs no lookup of offsets. The secret enters as a one-row table read by a subquery
    and so never appears in the query plan, its explanation or the event log.
    """
    if not secret:
        raise ValueError("a secret is required")
    if max_days < 1:
        raise ValueError("max_days must be at least 1")
    key = df.sparkSession.createDataFrame([(secret,)], "key string").scalar()
    inner = F.sha2(F.concat(key, F.col(person).cast("string")), 256)
    digest = F.sha2(F.concat(key, inner), 256)
    step = F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(2 * max_days)).cast("int")
    moved = df.withColumn("_days", F.when(step < max_days, step - max_days).otherwise(step - max_days + 1))
    for name in date_columns:
        if isinstance(df.schema[name].dataType, T.DateType):
            moved = moved.withColumn(name, F.date_add(name, F.col("_days")))
        else:
            moved = moved.withColumn(name, F.timestamp_add("DAY", F.col("_days"), F.col(name)))
    return moved.drop("_days")


def check_catalog(source: DataFrame, index: DataFrame, values: DataFrame) -> DataFrame:
    """Broken references: variables without a source and values without a variable.

    One row per missing id with the number of rows that refer to it. References are counted per id
    before the join, so its input has one row per id however many rows use that id.
    """
    return _orphans(index, source, "source_id", "variable_index").unionByName(
        _orphans(values, index, "variable_id", "variable_value")
    )


def _orphans(referring: DataFrame, referred: DataFrame, key: str, label: str) -> DataFrame:
    counts = referring.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(referred.select(key).distinct(), key, "left_anti").select(
        F.lit(label).alias("table_name"), F.col(key).cast("bigint").alias("missing_id"), "n_rows"
    )


def checked_values(source: DataFrame, index: DataFrame, values: DataFrame) -> DataFrame:
    """Values whose variable and data source are both in the catalog."""
    known = index.join(source.select("source_id").distinct(), "source_id", "left_semi").select("variable_id").distinct()
    return values.join(broadcast_within(known), "variable_id", "left_semi")
