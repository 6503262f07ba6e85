"""Outcome of placing a row: geocode result, reason and the hospital comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tractline.functions.text import is_blank, null_to_blank, strip, zip_compare_form
from tractline.functions.values import has_coordinates, in_range

# Result and reason texts that reports group by.
GEOCODED = "Geocoded"
IMPRECISE = "Imprecise Geocode"
HOSPITAL_GIVEN = "Hospital address given"
BLANK_ADDRESS = "Blank/Incomplete address"
ZIP_MISSING = "Zip missing"
STREET_MISSING = "Street missing"


def geocode_result(latitude: Column, longitude: Column, numeric: bool = False) -> Column:
    """``numeric`` says that the coordinates are numbers already and need no parsing."""
    usable = in_range(latitude, longitude) if numeric else has_coordinates(latitude, longitude)
    return F.when(usable, GEOCODED).otherwise(IMPRECISE)


def hospital_form_multi(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """The full address as compared with the hospital list, from separate columns."""
    parts = [F.lower(strip(null_to_blank(p))) for p in (street, city, state)]
    return strip(F.concat_ws(" ", *parts, zip_compare_form(null_to_blank(zip_code))))


def hospital_form_single(address: Column) -> Column:
    """The same from one composed address column."""
    return strip(F.lower(null_to_blank(address)))


def reason(
    result: Column,
    at_hospital: Column,
    street: Column | None = None,
    city: Column | None = None,
    state: Column | None = None,
    zip_code: Column | None = None,
) -> Column:
    """Why a row was not placed precisely, or that it was placed at a hospital.

    A part that the input does not have counts as blank, so an imprecise single-column row is
    always ``Blank/Incomplete address``.
    """
    blank = {
        name: F.lit(True) if part is None else is_blank(part)
        for name, part in (("street", street), ("city", city), ("state", state), ("zip", zip_code))
    }
    return (
        F.when((result == GEOCODED) & at_hospital, HOSPITAL_GIVEN)
        .when(result == GEOCODED, "")
        .when(blank["street"] & blank["city"] & blank["state"] & blank["zip"], BLANK_ADDRESS)
        .when(blank["zip"], ZIP_MISSING)
        .when(blank["street"], STREET_MISSING)
        .otherwise("")
    )
