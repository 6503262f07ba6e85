"""Visits matched to the residence valid at the time, and their category."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.functions.text import is_blank_coordinate
from tractline.functions.values import visit_year
from tractline.schemas import (
    ADDRESS,
    INVALID,
    LATLONG,
    LOCATION_COLUMNS,
    LOCATION_HISTORY_COLUMNS,
    PERSON_COLUMNS,
    UNCLASSIFIED,
    VISIT_COLUMNS,
    require,
)
from tractline.session import shuffled

DEFAULT_CUTOFF = "2012-01-01"
_FOREVER = "9999-12-31"


def person_visits(person: DataFrame, visit: DataFrame) -> DataFrame:
    """Every person with each of their visits; a person without visits keeps one row."""
    require(person.columns, PERSON_COLUMNS, "PERSON")
    require(visit.columns, VISIT_COLUMNS, "VISIT_OCCURRENCE")
    return person.select("person_id").join(visit.select(*VISIT_COLUMNS), "person_id", "left")


def located_history(location: DataFrame, history: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every location with each residence recorded for it; an unused location keeps one row.

    ``carry`` names further columns of ``location`` to keep.
    """
    require(location.columns, LOCATION_COLUMNS, "LOCATION")
    require(history.columns, LOCATION_HISTORY_COLUMNS, "LOCATION_HISTORY")
    stays = history.select("location_id", "entity_id", "start_date", "end_date")
    return location.select(*LOCATION_COLUMNS, *carry).join(shuffled(stays), "location_id", "left")


def since_cutoff(visit: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Visits that start on or after ``cutoff``; a missing start date drops the visit."""
    return visit.where(F.col("visit_start_date") >= F.lit(cutoff).cast("date"))


def visits_in_residence(
    person: DataFrame,
    visit: DataFrame,
    location: DataFrame,
    history: DataFrame,
    cutoff: str | None = DEFAULT_CUTOFF,
    open_ended: bool = False,
    bin_days: int | None = None,
    last_bin_from: dt.date | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Visits whose start and end both lie inside a residence of the same person.

    Both ends are inclusive and overlapping residences give one row each. Missing dates drop the
    row; with ``open_ended`` a missing residence end means the residence still holds.

    The dates are compared inside time bins: a residence is repeated for each bin it covers, a
    visit has the one bin of its start date, and the join key is (person, bin). A person with an
    extreme number of visits and residences is so spread over many keys and a visit only meets
    residences of its own period. By default a bin is as long as the mean residence, read from
    the two date columns of ``history``: residences are then repeated about twice in total, and
    a visit meets only about twice the residences that hold it. Starts from ``last_bin_from`` on
    (today by default) share one bin and starts before the cutoff cannot occur, so an end date far
    in the future adds no copies. How the bins are cut never changes the result.

    Persons join the residences, the smaller side, so visits are shuffled exactly once. ``carry``
    names columns already worked out per location that the visits should receive.
    """
    require(person.columns, PERSON_COLUMNS, "PERSON")
    require(visit.columns, VISIT_COLUMNS, "VISIT_OCCURRENCE")
    first_day = dt.date.fromisoformat(cutoff) if cutoff else dt.date(1900, 1, 1)
    last_day = max(first_day, last_bin_from or dt.date.today())
    end = F.coalesce("end_date", F.lit(_FOREVER).cast("date")) if open_ended else F.col("end_date")
    if bin_days is None:
        bin_days = _mean_stay(history.select("start_date", end.alias("end_date")), first_day, last_day)
    first, last = _bin_number(first_day, bin_days), _bin_number(last_day, bin_days)

    def bin_of(date: Column) -> Column:
        number = F.floor(F.unix_date(date) / bin_days).cast("int")
        return F.least(F.greatest(number, F.lit(first)), F.lit(last))

    residences = (
        located_history(location, history, carry)
        .withColumn("end_date", end)
        .where(F.col("entity_id").isNotNull() & (F.col("start_date") <= F.col("end_date")))
    )
    if cutoff:
        residences = residences.where(F.col("end_date") >= F.lit(cutoff).cast("date"))
    residences = residences.join(
        shuffled(person.select(F.col("person_id").alias("entity_id"))), "entity_id"
    ).withColumn("_bin", F.explode(F.sequence(bin_of(F.col("start_date")), bin_of(F.col("end_date")))))

    visits = since_cutoff(visit, cutoff) if cutoff else visit
    visits = visits.select(*VISIT_COLUMNS).withColumn("_bin", bin_of(F.col("visit_start_date")))

    v, r = visits.alias("v"), residences.alias("r")
    inside = (
        (F.col("v.person_id") == F.col("r.entity_id"))
        & (F.col("v._bin") == F.col("r._bin"))
        & F.col("v.visit_start_date").between(F.col("r.start_date"), F.col("r.end_date"))
        & F.col("v.visit_end_date").between(F.col("r.start_date"), F.col("r.end_date"))
    )
    return v.join(shuffled(r), inside).select(
        "v.person_id",
        "v.visit_occurrence_id",
        "v.visit_start_date",
        visit_year(F.col("v.visit_start_date")).alias("year"),
        *[f"r.{name}" for name in (*LOCATION_COLUMNS, *carry)],
    )


def _mean_stay(stays: DataFrame, first_day: dt.date, last_day: dt.date) -> int:
    """Mean length in days of the stays' parts between the two days, at least 1."""
    start, end = F.greatest("start_date", F.lit(first_day)), F.least("end_date", F.lit(last_day))
    (mean,) = stays.where(start <= end).agg(F.avg(F.date_diff(end, start) + 1)).first()
    return max(1, round(mean or 1))


def _bin_number(day: dt.date, bin_days: int) -> int:
    return (day - dt.date(1970, 1, 1)).days // bin_days


def _blank_flags(numeric: bool) -> tuple[Column, Column, Column]:
    return (
        is_blank_coordinate(F.col("latitude"), numeric),
        is_blank_coordinate(F.col("longitude"), numeric),
        is_blank_coordinate(F.col("address_1")),
    )


def with_coordinates_given(df: DataFrame, numeric: bool = False) -> DataFrame:
    """Rows whose latitude and longitude are both present."""
    lat, lon, _ = _blank_flags(numeric)
    return df.where(~lat & ~lon)


def without_location(df: DataFrame, numeric: bool = False) -> DataFrame:
    """Rows with neither coordinate and no street address."""
    lat, lon, street = _blank_flags(numeric)
    return df.where(lat & lon & street)


def with_address_only(df: DataFrame, numeric: bool = False) -> DataFrame:
    """Rows with neither coordinate that do have a street address."""
    lat, lon, street = _blank_flags(numeric)
    return df.where(lat & lon & ~street)


def classify(df: DataFrame, numeric: bool = False) -> DataFrame:
    """The three categories in one pass, as column ``category``.

    A row with exactly one blank coordinate fits none of them; it is kept as ``Unclassified`` so
    that the counts add up.
    """
    lat, lon, street = _blank_flags(numeric)
    return df.withColumn(
        "category",
        F.when(~lat & ~lon, LATLONG)
        .when(lat & lon & street, INVALID)
        .when(lat & lon, ADDRESS)
        .otherwise(UNCLASSIFIED),
    )
