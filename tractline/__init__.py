"""Patient location records to linkage-ready tables, as Spark DataFrame plans."""

from tractline.operators.tracts import TractIndex, build_tract_index
from tractline.plans.linkage import (
    geocode_addresses,
    link_addresses,
    link_coordinates,
    link_locations,
    link_visits,
    refresh_location,
)
from tractline.session import build_session

__all__ = [
    "TractIndex",
    "build_session",
    "build_tract_index",
    "geocode_addresses",
    "link_addresses",
    "link_coordinates",
    "link_locations",
    "link_visits",
    "refresh_location",
]
