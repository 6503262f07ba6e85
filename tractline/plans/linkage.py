"""The end-to-end jobs as plans over the operators.

Building a plan runs small jobs where a choice needs a measured fact: the shape of the tracts, unless a
``TractIndex`` is given, the mean stay and the size of the caller's hospital list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractline.functions.status import geocode_result, hospital_form_multi, hospital_form_single, reason
from tractline.functions.text import compose_single, zip_strip_suffix
from tractline.functions.values import (
    drop_work_columns,
    long_coordinate_names,
    number_in,
    vintage_of,
    year_in,
)
from tractline.operators.geocode import DEFAULT_THRESHOLD, geocode
from tractline.operators.hospitals import flag_hospitals
from tractline.operators.locations import needs_geocoding, trim_text
from tractline.operators.summaries import supported_vintages
from tractline.operators.tracts import CODES, TractIndex, assign_codes, assign_tracts, with_fips
from tractline.operators.visits import DEFAULT_CUTOFF, classify, visits_in_residence
from tractline.schemas import ADDRESS, ADDRESS_PARTS, LATLONG, LOCATION_COLUMNS, VINTAGES, ContractError, require

# LOCATION's street, city, state and ZIP. The unit in address_2 does not help matching.
LOCATION_PARTS = ("address_1", "city", "state", "zip")


def _with_vintage(df: DataFrame, pivot: int) -> DataFrame:
    """``year_for_fips`` from the year; rows without a year column count as the newer vintage."""
    year = year_in(df, "year") if "year" in df.columns else F.lit(None).cast("int")
    return df.withColumn("year_for_fips", vintage_of(year, pivot))


def _with_tracts(df: DataFrame, tracts: DataFrame | TractIndex) -> DataFrame:
    return with_fips(assign_tracts(df, tracts)).drop("year_for_fips")


def _code_of(vintage: Column) -> Column:
    """The code of the row's own vintage."""
    return F.when(vintage == VINTAGES[0], F.col(CODES[0])).otherwise(F.col(CODES[1]))


def link_coordinates(df: DataFrame, tracts: DataFrame | TractIndex, pivot: int = 2020) -> DataFrame:
    """Rows with coordinates to rows with ``FIPS``.

    A ``year_for_fips`` column of the caller's is honoured; otherwise the vintage comes from
    ``year``, and having neither is an error. Rows of any other vintage are left out.
    """
    df = long_coordinate_names(df)
    require(df.columns, ("latitude", "longitude"), "coordinates")
    if "year_for_fips" in df.columns:
        df = supported_vintages(df.withColumn("year_for_fips", year_in(df, "year_for_fips")))
    elif "year" in df.columns:
        df = _with_vintage(df, pivot)
    else:
        raise ContractError("coordinates need a year or year_for_fips column")
    return drop_work_columns(_with_tracts(df, tracts))


def geocode_addresses(
    df: DataFrame,
    address_points: DataFrame,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    drop_address_parts: bool = True,
) -> DataFrame:
    """Address rows with ``latitude``, ``longitude``, ``geocode_result`` and ``reason``."""
    single = "address" in df.columns
    columns = ("address",) if single else ADDRESS_PARTS
    require(df.columns, columns, "addresses")
    if not single:
        df = df.withColumn("zip", zip_strip_suffix(F.col("zip")))
    if "year" in df.columns:
        df = df.withColumn("year", year_in(df, "year"))
    placed = geocode(df, address_points, columns, threshold)
    result = geocode_result(F.col("latitude"), F.col("longitude"), numeric=True)
    if single:
        form, parts = hospital_form_single(compose_single(F.col("address"))), ()
    else:
        parts = tuple(F.col(c) for c in ADDRESS_PARTS)
        form = hospital_form_multi(*parts)
    placed = flag_hospitals(placed, form, hospitals, "_at_hospital").withColumn("geocode_result", result)
    placed = placed.withColumn("reason", reason(F.col("geocode_result"), F.col("_at_hospital"), *parts))
    kept = drop_work_columns(placed)
    return kept.drop(*ADDRESS_PARTS) if drop_address_parts and not single else kept


def link_addresses(
    df: DataFrame,
    address_points: DataFrame,
    tracts: DataFrame | TractIndex,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    pivot: int = 2020,
    drop_address_parts: bool = True,
) -> DataFrame:
    """Address rows to rows with coordinates, result, reason and ``FIPS``.

    Addresses are matched first, so tracts are looked up for the points that were matched and for no
    others: without any shuffle where the index is broadcast, else once per distinct point.
    """
    placed = geocode_addresses(df, address_points, hospitals, threshold, drop_address_parts)
    return _with_tracts(_with_vintage(placed, pivot), tracts)


def refresh_location(
    location: DataFrame, address_points: DataFrame, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """LOCATION with coordinates looked up for the rows that have none, row by row.

    Looked up are address_1, city, state and ZIP, as in :func:`link_locations`: a unit does not help.
    """
    require(location.columns, LOCATION_COLUMNS, "LOCATION")
    rows = (
        trim_text(location)
        .withColumn("_needed", needs_geocoding())
        .withColumnsRenamed({"latitude": "given_latitude", "longitude": "given_longitude"})
    )
    placed = geocode(rows, address_points, LOCATION_PARTS, threshold, F.col("_needed"))

    def chosen(name: str):
        given = number_in(rows, f"given_{name}")
        return F.when(F.col("_needed"), F.col(name)).otherwise(given).alias(name)

    return placed.select(
        *[chosen(c) if c in ("latitude", "longitude") else F.col(c) for c in LOCATION_COLUMNS]
    )


def link_locations(
    location: DataFrame,
    address_points: DataFrame | None,
    tracts: DataFrame | TractIndex,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    numeric: bool = False,
) -> DataFrame:
    """LOCATION rows with category, coordinates, result, reason and a tract code per vintage.

    The coordinates are the given ones in category ``Latlong``, the matched ones in ``Address`` and
    NULL otherwise. Everything a visit needs to know about its place is worked out here, once per location.
    """
    require(location.columns, LOCATION_COLUMNS, "LOCATION")
    rows = classify(location.withColumn("zip", zip_strip_suffix(F.col("zip"))), numeric)
    # Elsewhere a zero stands for a missing coordinate and must not be read as a place.
    names = ("latitude", "longitude")
    given = rows.withColumns({c: F.when(F.col("category") == LATLONG, number_in(rows, c)) for c in names})
    if address_points is not None:
        known = given.withColumnsRenamed({c: f"given_{c}" for c in names})
        looked_up = F.col("category") == ADDRESS
        found = geocode(known, address_points, LOCATION_PARTS, threshold, looked_up)
        given = found.withColumns({c: F.when(looked_up, F.col(c)).otherwise(F.col(f"given_{c}")) for c in names})
    placed = assign_codes(given, tracts)
    parts = [F.col(c) for c in LOCATION_PARTS]
    placed = (
        flag_hospitals(placed, hospital_form_multi(*parts), hospitals, "_at_hospital")
        .withColumn("geocode_result", geocode_result(F.col("latitude"), F.col("longitude"), numeric=True))
        .withColumn("reason", reason(F.col("geocode_result"), F.col("_at_hospital"), *parts))
    )
    return placed.select(*LOCATION_COLUMNS, "category", "geocode_result", "reason", *CODES)


def link_visits(
    person: DataFrame,
    visit: DataFrame,
    location: DataFrame,
    history: DataFrame,
    tracts: DataFrame | TractIndex,
    address_points: DataFrame | None = None,
    hospitals: DataFrame | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    cutoff: str | None = DEFAULT_CUTOFF,
    pivot: int = 2020,
    open_ended: bool = False,
    numeric: bool = False,
) -> DataFrame:
    """Visits with the place they were made from: category, coordinates, result, reason, ``FIPS``.

    Category, address match and tract depend on the location alone, so they are worked out per
    location and carried through the residence join; a visit only picks the code of its vintage.
    Rows of category ``Invalid`` and ``Unclassified`` stay, with no code.
    """
    places = link_locations(location, address_points, tracts, hospitals, threshold, numeric)
    carried = ("category", "geocode_result", "reason", *CODES)
    visits = visits_in_residence(
        person, visit, places, history, cutoff=cutoff, open_ended=open_ended, carry=carried
    )
    return visits.withColumn("FIPS", _code_of(vintage_of(F.col("year"), pivot))).drop(*CODES)
