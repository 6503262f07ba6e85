"""Coordinates, years, dates and tract codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractline.functions.text import strip
from tractline.schemas import VINTAGES

# A cast alone would also take Java's "36.5d" and hexadecimal forms.
_DECIMAL_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def parse_number(c: Column) -> Column:
    """Text to double; NULL for anything that is not a plain decimal number. Never raises."""
    return F.regexp_extract(strip(c.cast("string")), _DECIMAL_NUMBER, 0).try_cast("double")


def number_in(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as double, parsing it only when it is stored as text."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name).cast("double")
    return parse_number(F.col(name))


def in_range(latitude: Column, longitude: Column) -> Column:
    """The limits test on coordinates that are numbers already."""
    return F.coalesce(latitude.between(-90, 90) & longitude.between(-180, 180), F.lit(False))


def parse_date(c: Column) -> Column:
    """ISO or ``MM/dd/yyyy`` text to date; NULL for anything else."""
    text = strip(c.cast("string"))
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "MM/dd/yyyy"))


def has_coordinates(latitude: Column, longitude: Column) -> Column:
    """Both numeric and inside the geographic limits, ends included. (0, 0) is valid.

    Works on text and on numbers. NaN sorts above every number in Spark, so it fails the upper
    bound.
    """
    return in_range(parse_number(latitude), parse_number(longitude))


def year_of(c: Column) -> Column:
    """A year as int; NULL when it does not parse or is not whole."""
    number = parse_number(c)
    return F.when(number % 1 == 0, number.try_cast("int"))


def year_in(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as a year, parsing it only when it is not stored as an integer."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.col(name).try_cast("int")
    return year_of(F.col(name))


def vintage_of(year: Column, pivot: int = 2020) -> Column:
    """Census vintage of a year: 2010 before ``pivot``, otherwise 2020. A missing year is 2020."""
    return F.when(year < pivot, VINTAGES[0]).otherwise(VINTAGES[1])


def visit_year(start: Column) -> Column:
    return F.year(start)


def format_fips(tract_id: Column) -> Column:
    """An 11-digit tract code with its leading zero; NULL when the input is longer than that.

    A code that went through a number may have lost its zero or gained ``.0``.
    """
    digits = F.regexp_replace(strip(tract_id.cast("string")), r"\.0$", "")
    return F.when(F.length(digits).between(1, 11), F.lpad(digits, 11, "0"))


_TO_SHORT = {"latitude": "lat", "longitude": "lon", "Latitude": "lat", "Longitude": "lon"}
_TO_LONG = {"lat": "latitude", "lon": "longitude"}


def short_coordinate_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(_TO_SHORT)


def long_coordinate_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(_TO_LONG)


# Columns the geocoder adds that do not belong in results.
GEOCODER_COLUMNS = ("matched_street", "matched_zip", "matched_city", "matched_state", "score", "precision", "address")


def drop_work_columns(df: DataFrame, names: tuple[str, ...] = GEOCODER_COLUMNS) -> DataFrame:
    """Drop the named columns that exist, and every column whose name starts with ``_``."""
    return df.drop(*names, *[c for c in df.columns if c.startswith("_")])
