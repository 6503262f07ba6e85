"""Table contracts: required columns, input shapes and the errors raised when they are not met."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The column contracts and folder names other tools rely on.
LOCATION_COLUMNS = (
    "location_id",
    "address_1",
    "address_2",
    "city",
    "state",
    "zip",
    "county",
    "location_source_value",
    "country_concept_id",
    "country_source_value",
    "latitude",
    "longitude",
)
LOCATION_HISTORY_COLUMNS = (
    "location_id",
    "relationship_type_concept_id",
    "domain_id",
    "entity_id",
    "start_date",
    "end_date",
)
PERSON_COLUMNS = ("person_id",)
VISIT_COLUMNS = ("visit_occurrence_id", "person_id", "visit_start_date", "visit_end_date")
ADDRESS_PARTS = ("street", "city", "state", "zip")
VINTAGES = (2010, 2020)

LATLONG, ADDRESS, INVALID, UNCLASSIFIED = "Latlong", "Address", "Invalid", "Unclassified"

EDGE = T.StructType([T.StructField(name, T.DoubleType()) for name in ("x1", "y1", "x2", "y2")])

TRACTS = T.StructType(
    [
        T.StructField("tract_id", T.StringType()),
        T.StructField("block_group_id", T.StringType()),
        T.StructField("vintage", T.IntegerType()),
        T.StructField("ring", T.ArrayType(EDGE)),
    ]
)
ADDRESS_POINTS = T.StructType(
    [
        T.StructField("point_id", T.LongType()),
        T.StructField("street", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]
)


class ContractError(ValueError):
    """An input table does not have the columns its role requires."""


def require(columns: Iterable[str], required: Iterable[str], label: str) -> None:
    """Raise :class:`ContractError` naming every required column that is absent."""
    present = set(columns)
    missing = [name for name in required if name not in present]
    if missing:
        raise ContractError(f"{label} is missing required columns: {missing}")


def require_location(columns: Iterable[str]) -> None:
    require(columns, LOCATION_COLUMNS, "LOCATION")


def require_location_history(columns: Iterable[str]) -> None:
    require(columns, LOCATION_HISTORY_COLUMNS, "LOCATION_HISTORY")
