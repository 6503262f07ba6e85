"""The clinical tables, address points, tracts and variables derived from the test tables.

Each table is one SQL text that Spark and DuckDB read alike; the only differences are filled in for
Spark: adding days to a date, longitudes of points east of Greenwich, and that a join shuffles both sides. Every rule is arithmetic on the keys, so the tables grow with their
sources. Tract polygons are nested on the Spark side and flat edges on the other, derived apart.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.operators.tracts import edges_of_rings

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The tables that grow fastest with the scale factor.
SPREAD = ("orders", "lineitem", "documents")

# The orders span 1995 to 2001, so the cutoff and the vintage pivot of visits move with them.
CUTOFF = "1996-01-01"
VISIT_PIVOT = 1998

# Tracts are a square grid of half-degree cells from (-100, 25); this is its width in cells.
_WIDTH = "(SELECT CAST(ceil(sqrt(CAST(count(*) AS DOUBLE))) AS BIGINT) FROM supplier)"
_SPREAD = f"({_WIDTH} * 5000 + 2500)"


def _units(latitude: str, longitude: str) -> str:
    """Coordinates inside (and a little beyond) the grid as whole ten-thousandths of a degree."""
    return (
        f"250000 + ({latitude}) % {_SPREAD} AS lat_units, 1000000 - ({longitude}) % {_SPREAD} AS lon_units"
    )


def _degrees(units: str) -> str:
    """The same as text with four decimals, so that both engines read the same number."""
    return (
        f"CAST(CAST(floor({units} / 10000) AS BIGINT) AS STRING) || '.' || "
        f"lpad(CAST({units} % 10000 AS STRING), 4, '0')"
    )


_LATITUDE, _LONGITUDE = _degrees("lat_units"), f"'-' || {_degrees('lon_units')}"
_WEST = f"CAST({_LONGITUDE} AS DOUBLE)"
# From 39,602 suppliers on the grid reaches over Greenwich: those units are negative and their text is no number.
_EAST_OR_WEST = f"CASE WHEN lon_units < 0 THEN CAST({_degrees('(-lon_units)')} AS DOUBLE) ELSE {_WEST} END"

# Customers with an address and a place.
_HOMES = f"""(
        SELECT customer.*, {_units("c_custkey * 3797", "c_custkey * 5303")},
               CAST(100 + c_custkey % 900 AS STRING) || ' ' || c_mktsegment || ' ' ||
               CAST(1 + c_custkey % 17 AS STRING) || 'th St' AS street,
               'City ' || CAST(c_nationkey AS STRING) AS city,
               CASE c_nationkey % 6 WHEN 0 THEN 'FL' WHEN 1 THEN 'GA' WHEN 2 THEN 'CA' WHEN 3 THEN 'AL' WHEN 4 THEN 'AK'
                                    ELSE 'TX' END AS state,
               lpad(CAST(c_custkey % 200 AS STRING), 5, '0') AS zip
        FROM customer) homes"""

DERIVED = {
    "person": """
        SELECT c_custkey AS person_id FROM customer
        UNION ALL SELECT 1000000000 + s_suppkey AS person_id FROM supplier""",
    "visit": """
        SELECT o_orderkey AS visit_occurrence_id,
               CASE WHEN o_orderkey % 101 = 0 THEN 2000000000 + o_custkey ELSE o_custkey END AS person_id,
               CAST(o_orderdate AS DATE) AS visit_start_date,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    ELSE <DATE>CAST(o_orderdate AS DATE)<PLUS>CAST(o_orderkey % 15 AS INT)<END> END AS visit_end_date
        FROM orders""",
    "location": f"""
        SELECT c_custkey AS location_id, CASE WHEN c_custkey % 3 = 0 THEN 'N/A' WHEN c_custkey % 8 = 1 THEN street || ' # 1A' ELSE street END AS address_1,
               CASE WHEN c_custkey % 4 = 0 THEN '#' || CAST(c_custkey % 20 AS STRING) END AS address_2, city, state,
               CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN zip || '.0' ELSE zip END AS zip,
               CAST(NULL AS STRING) AS county, c_name || ' ' AS location_source_value,
               CAST(NULL AS STRING) AS country_concept_id,
               'UNITED STATES OF AMERICA' AS country_source_value,
               CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN '0' WHEN 3 THEN ' nan '
                    ELSE CASE WHEN c_custkey % 77 = 5 THEN '95.5' ELSE {_LATITUDE} END END AS latitude,
               CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN '0' WHEN 3 THEN NULL
                    WHEN 4 THEN 'null' ELSE {_LONGITUDE} END AS longitude
        FROM {_HOMES}
        UNION ALL
        SELECT 1000000000 + s_suppkey, s_name, NULL, 'Nowhere', 'AK', '99501', NULL, NULL, NULL, NULL, NULL, NULL
        FROM supplier""",
    "location_history": """
        SELECT c_custkey AS location_id, 32848 AS relationship_type_concept_id, 1147314 AS domain_id,
               c_custkey AS entity_id, DATE '1995-01-01' AS start_date, DATE '1997-12-31' AS end_date
        FROM customer
        UNION ALL
        SELECT c_custkey, 32848, 1147314, c_custkey, DATE '1998-01-01',
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE DATE '2000-12-31' END
        FROM customer
        UNION ALL
        SELECT c_custkey, 32848, 1147314, (c_custkey + 1) % (SELECT count(*) FROM customer),
               DATE '1997-06-01', DATE '1998-06-30'
        FROM customer WHERE c_custkey % 5 = 0""",
    # Some streets also lie in a city whose name ends like theirs, under a smaller id.
    "address_points": f"""
        SELECT c_custkey AS point_id, street, city, state, zip,
               CAST({_LATITUDE} AS DOUBLE) AS latitude, CAST({_LONGITUDE} AS DOUBLE) AS longitude
        FROM {_HOMES}
        UNION ALL
        SELECT -c_custkey, street, 'West ' || city, state, NULL, CAST({_LATITUDE} AS DOUBLE) + 25e-2, CAST({_LONGITUDE} AS DOUBLE)
        FROM {_HOMES} WHERE c_custkey % 3 = 0""",
    # One address row per order: its customer's address, exact, in other writing, with a typo, with
    # another house number or cut short; some without ZIP, some without anything.
    "address_multi": f"""
        SELECT<SHUFFLED> o_orderkey AS entity_id,
               CASE o_orderkey % 7
                    WHEN 1 THEN upper(street) || '.'
                    WHEN 2 THEN replace(street, 'E', '')
                    WHEN 3 THEN '9' || street
                    WHEN 4 THEN substr(street, 1, 8)
                    WHEN 5 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' END
                    WHEN 6 THEN replace(street, 'U', 'O') || CASE WHEN o_orderkey % 2 = 0 THEN ' Apt 204' ELSE ', Unit B' END
                    ELSE street END AS street,
               CASE WHEN o_orderkey % 35 = 5 THEN ' NULL ' WHEN o_orderkey % 11 = 2 THEN 'West ' || city ELSE city END AS city,
               CASE WHEN o_orderkey % 35 = 5 THEN NULL ELSE state END AS state,
               CASE WHEN o_orderkey % 35 = 5 THEN 'none' WHEN o_orderkey % 4 = 0 THEN NULL
                    WHEN o_orderkey % 6 = 1 THEN zip || '.0'
                    WHEN o_orderkey % 10 = 3 AND o_custkey % 200 >= 100 THEN substr(zip, 3, 3) ELSE zip END AS zip,
               CASE WHEN o_orderkey % 19 = 0 THEN 'abc' WHEN o_orderkey % 23 = 0 THEN NULL
                    WHEN o_orderkey % 29 = 0 THEN '2019.5'
                    ELSE CAST(2012 + o_orderkey % 12 AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END
               END AS year
        FROM orders JOIN {_HOMES} ON o_custkey = c_custkey""",
    "hospitals": f"""
        SELECT DISTINCT lower(street || ' ' || city || ' ' || state || ' ' || zip) AS address
        FROM {_HOMES} WHERE c_acctbal > 9000""",
    # Two places per customer however many orders there are: mostly copies, as such files are.
    "coordinates": f"""
        SELECT o_orderkey AS entity_id, 2012 + o_orderkey % 12 AS year,
               CASE WHEN o_orderkey % 41 = 0 THEN 'abc' ELSE {_LATITUDE} END AS latitude,
               CASE WHEN o_orderkey % 43 = 0 THEN '' ELSE {_LONGITUDE} END AS longitude
        FROM (SELECT orders.*, {_units("(2 * o_custkey + o_orderkey % 2) * 7919", "(2 * o_custkey + o_orderkey % 2) * 104729")}
              FROM orders) o""",
    "messy_zip": """
        SELECT o_orderkey AS row_id,
               CASE o_orderkey % 10
                    WHEN 0 THEN NULL WHEN 1 THEN '32209.0' WHEN 2 THEN ' 32209 ' WHEN 3 THEN '32209-1234'
                    WHEN 4 THEN '02139' WHEN 5 THEN '32209.0 ' WHEN 6 THEN chr(9) || 'NaN' || chr(9)
                    WHEN 7 THEN '32209.0.0' WHEN 8 THEN 'AB1.0'
                    ELSE CAST(o_custkey AS STRING) || '.0' END AS zip
        FROM orders""",
    "messy_value": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_tax AS tax,
               CASE (l_partkey + l_linenumber) % 16
                    WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NA' WHEN 3 THEN ' n/a ' WHEN 4 THEN 'None'
                    WHEN 5 THEN chr(9) WHEN 6 THEN '0' WHEN 7 THEN '0.0' WHEN 8 THEN 'NULL ' WHEN 9 THEN 'NaN'
                    WHEN 10 THEN 'abc' WHEN 11 THEN '2019.0' WHEN 12 THEN '2019.5' WHEN 13 THEN '-90'
                    WHEN 14 THEN ' 36.5 ' ELSE CAST(l_partkey % 2500 AS STRING) END AS value,
               CASE (l_suppkey + l_linenumber) % 9
                    WHEN 0 THEN '180' WHEN 1 THEN '-180.0' WHEN 2 THEN '180.1' WHEN 3 THEN 'inf' WHEN 4 THEN NULL
                    WHEN 5 THEN '1e2' WHEN 6 THEN '36.5d' ELSE '-' || CAST(l_suppkey % 300 AS STRING) END AS other
        FROM lineitem""",
    "data_source": "SELECT n_nationkey AS source_id, n_name AS name FROM nation",
    "variable_index": """
        SELECT p_partkey AS variable_id, p_size % 30 AS source_id, p_name AS name FROM part""",
    "variable_rows": """
        SELECT CASE WHEN l_orderkey % 50 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS variable_id,
               lpad(CAST(l_suppkey % 56 + 1 AS STRING) || lpad(CAST(l_suppkey AS STRING), 9, '0'), 11, '0') AS geocode,
               CAST(year(l_shipdate) AS INT) AS year, l_quantity AS value
        FROM lineitem""",
    # Three variables per tract and ship year; whole-number sums keep both engines' values equal.
    "variable_value": """
        SELECT CAST(l_linenumber % 3 + 1 AS INT) AS variable_id,
               lpad(CAST(l_suppkey % 56 + 1 AS STRING) || lpad(CAST(l_suppkey AS STRING), 9, '0'), 11, '0') AS geocode,
               CAST(year(l_shipdate) AS INT) AS year, sum(l_quantity) AS value
        FROM lineitem
        WHERE NOT (l_suppkey % 4 = 1 AND year(l_shipdate) % 2 = 0)
        GROUP BY 1, 2, 3""",
    "crosswalk": """
        SELECT lpad(CAST(s_suppkey % 56 + 1 AS STRING) || lpad(CAST(s_suppkey AS STRING), 9, '0'), 11, '0') AS FIPS,
               lpad(CAST(s_suppkey * 7 % 300 AS STRING), 5, '3') AS zcta, 1 + s_suppkey % 3 AS weight FROM supplier
        UNION ALL
        SELECT lpad(CAST(s_suppkey % 56 + 1 AS STRING) || lpad(CAST(s_suppkey AS STRING), 9, '0'), 11, '0') AS FIPS,
               lpad(CAST(s_suppkey * 11 % 300 AS STRING), 5, '3') AS zcta, 2 AS weight FROM supplier""",
}

# Polygon edges for the SQL side: a square, a notch in every fifth top edge, a hole in every seventh.
_GRID = f"""
    SELECT s_suppkey AS k, CAST(s_suppkey % 56 + 1 AS STRING) || lpad(CAST(s_suppkey AS STRING), 9, '0') AS tract_id,
           vintage, -100e0 + (s_suppkey % {_WIDTH}) * 5e-1 + offset_by AS x0,
           25e0 + floor(s_suppkey / {_WIDTH}) * 5e-1 + offset_by AS y0
    FROM supplier CROSS JOIN (SELECT 2010 AS vintage, 0e0 AS offset_by UNION ALL SELECT 2020, 25e-2) v"""
TRACT_EDGES = f"""
    SELECT k, tract_id, vintage, x0 + ax AS x1, y0 + ay AS y1, x0 + bx AS x2, y0 + by_ AS y2
    FROM ({_GRID}) g JOIN (VALUES
        (0, 0e0, 0e0, 5e-1, 0e0), (0, 5e-1, 0e0, 5e-1, 5e-1), (0, 0e0, 5e-1, 0e0, 0e0),
        (1, 5e-1, 5e-1, 0e0, 5e-1),
        (2, 5e-1, 5e-1, 25e-2, 375e-3), (2, 25e-2, 375e-3, 0e0, 5e-1),
        (3, 125e-3, 125e-3, 25e-2, 125e-3), (3, 25e-2, 125e-3, 25e-2, 25e-2),
        (3, 25e-2, 25e-2, 125e-3, 25e-2), (3, 125e-3, 25e-2, 125e-3, 125e-3)
    ) e(kind, ax, ay, bx, by_)
    ON kind = 0 OR (kind = 1 AND k % 5 <> 0) OR (kind = 2 AND k % 5 = 0) OR (kind = 3 AND k % 7 = 0)"""


def spark_text(name: str) -> str:
    text = DERIVED[name].replace("<DATE>", "date_add(").replace("<PLUS>", ", ").replace("<END>", ")")
    return text.replace("<SHUFFLED>", " /*+ MERGE(homes) */").replace(_WEST, _EAST_OR_WEST)


def duckdb_text(name: str) -> str:
    return DERIVED[name].replace("<DATE>", "(").replace("<PLUS>", " + ").replace("<END>", ")").replace("<SHUFFLED>", "")


class Domain:
    """The derived tables of one test-data folder as DataFrames, each made when first used."""

    def __init__(self, spark: SparkSession, folder: str, written: str | None = None):
        """``written`` is a folder that :meth:`write` filled; the tables are then read from there."""
        self.spark, self.folder, self.written = spark, folder.rstrip("/"), written
        self._made: dict[str, DataFrame] = {}

    def write(self, target: str, files: int) -> None:
        for name in DERIVED:
            self[name].repartition(files).write.parquet(f"{target}/{name}")
        self.tracts.repartition(files).write.parquet(f"{target}/tracts")

    def base(self, name: str) -> DataFrame:
        """A test table. The larger ones are single files of one row group, which Spark cannot
        split; they are spread over the cores. A table of many files is read as it is."""
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in SPREAD and df.rdd.getNumPartitions() == 1:
            return df.repartition(self.spark.sparkContext.defaultParallelism)
        return df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.base(name)
            elif self.written:
                self._made[name] = self.spark.read.parquet(f"{self.written}/{name}")
            else:
                text = spark_text(name)
                used = {t: self.base(t) for t in TABLES if f" {t}" in text}
                for table in used:
                    text = text.replace(f"FROM {table}", f"FROM {{{table}}} AS {table}").replace(
                        f"JOIN {table}", f"JOIN {{{table}}} AS {table}"
                    )
                self._made[name] = self.spark.sql(text, **used)
        return self._made[name]

    @cached_property
    def tracts(self) -> DataFrame:
        """Nested polygons: corner points of closed rings, turned into edges by the package."""
        if self.written:
            return self.spark.read.parquet(f"{self.written}/tracts")
        supplier = self["supplier"]
        width = supplier.agg(F.ceil(F.sqrt(F.count(F.lit(1)).cast("double"))).cast("bigint")).scalar()
        grid = (
            supplier.select(F.col("s_suppkey").alias("k"), F.explode(F.array(F.lit(2010), F.lit(2020))).alias("vintage"))
            .withColumn("_off", F.when(F.col("vintage") == 2020, 0.25).otherwise(0.0))
            .withColumn("_w", width)
            .withColumn("_x", -100.0 + (F.col("k") % F.col("_w")) * 0.5 + F.col("_off"))
            .withColumn("_y", 25.0 + F.floor(F.col("k") / F.col("_w")) * 0.5 + F.col("_off"))
        )

        def corners(*points: tuple[float, float]):
            return F.array(
                *[F.struct((F.col("_x") + dx).alias("x"), (F.col("_y") + dy).alias("y")) for dx, dy in points]
            )

        plain = corners((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5), (0, 0))
        notched = corners((0, 0), (0.5, 0), (0.5, 0.5), (0.25, 0.375), (0, 0.5), (0, 0))
        hole = corners((0.125, 0.125), (0.25, 0.125), (0.25, 0.25), (0.125, 0.25), (0.125, 0.125))
        outer = F.when(F.col("k") % 5 == 0, notched).otherwise(plain)
        rings = F.when(F.col("k") % 7 == 0, F.array(outer, hole)).otherwise(F.array(outer))
        code = F.concat((F.col("k") % 56 + 1).cast("string"), F.lpad(F.col("k").cast("string"), 9, "0"))
        return grid.select(
            code.alias("tract_id"),
            F.concat(code, F.lit("1")).alias("block_group_id"),
            "vintage",
            edges_of_rings(rings).alias("ring"),
        )
