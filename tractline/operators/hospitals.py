"""Membership of an address in the hospital list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.session import BROADCAST_BYTES, broadcast_within, no_spread, shuffled, spread_unless

# Known hospital addresses, lower case, fields separated by single spaces.
HOSPITAL_ADDRESSES = (
    "1000 peachtree park dr ne atlanta ga 30309",
    "240 nw 25th st miami fl 33127",
    "1400 briarcliff rd ne atlanta ga 30306",
)


def default_hospitals(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a,) for a in HOSPITAL_ADDRESSES], "address string")


def flag_hospitals(
    df: DataFrame,
    address: Column,
    hospitals: DataFrame | None = None,
    flag: str = "at_hospital",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add boolean ``flag``: the compare form ``address`` is in the ``address`` column of ``hospitals``.

    The built-in list needs no join. A list of the caller's is broadcast when it is measured to
    be small and joined by key otherwise; blank addresses are then kept out of one partition.
    """
    if hospitals is None:
        return df.withColumn(flag, F.coalesce(address.isin(*HOSPITAL_ADDRESSES), F.lit(False)))
    known = hospitals.select(F.col("address").alias("_hospital")).where("_hospital is not null").distinct()
    rows = df.withColumn("_form", address)
    # Blank parts leave no letter or digit in the form, and no hospital is without one.
    rows = rows.withColumn("_spread", spread_unless(F.coalesce(F.col("_form").rlike("[^ ,]"), F.lit(False)), df))
    same = (F.col("_form") == F.col("_hospital")) & (F.col("_spread") == F.col("_one"))
    known = known.where(F.col("_hospital").rlike("[^ ,]")).withColumn("_one", no_spread("_hospital"))
    return (
        shuffled(rows).join(broadcast_within(known, broadcast_bytes), same, "left")
        .withColumn(flag, F.col("_hospital").isNotNull())
        .drop("_form", "_hospital", "_spread", "_one")
    )
