"""Every operator run over the derived tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import sql as q
from bindings.domain import CUTOFF, VISIT_PIVOT, Domain
from tractline.functions import status, text, values
from tractline.operators import exposure, hospitals, locations, summaries, tracts, visits
from tractline.operators.geocode import address_text, geocode
from tractline.plans import jobs, linkage
from tractline.schemas import ADDRESS_PARTS, LOCATION_COLUMNS, LOCATION_HISTORY_COLUMNS
from tractline.session import scratch_folder
from tractline.sinks import files
from tractline.sinks.location_store import LocationStore
from tractline.sources import csv_folder, tables
from tractline.streaming import incremental

BUILDERS: dict[str, Callable[[Domain], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VARIABLES = {1: "mean_noise", 2: "deprivation", 3: "traffic"}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Domain], DataFrame]):
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, folder: build(Domain(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def over(names: str, body: str, *ctes: str) -> str:
    """``WITH`` the derived tables in ``names`` and further CTEs, then ``body``."""
    parts = [q.derived(*names.split())] if names else []
    return "WITH " + ",\n".join([*parts, *ctes]) + "\n" + body


def _read_back(d: Domain, folder: str) -> DataFrame:
    """A written result, as text by header name."""
    return d.spark.read.csv(folder, header=True, escape='"')


def _scratch(d: Domain, label: str) -> str:
    return scratch_folder(d.spark, label)


# --- columns: text ---------------------------------------------------------------------------


@query("c1_zip_strip_suffix", over("messy_zip", f"SELECT row_id, zip, {q.zip_suffix('zip')} AS zip_clean FROM messy_zip"))
def _(d):
    return d["messy_zip"].withColumn("zip_clean", text.zip_strip_suffix(F.col("zip")))


@query(
    "c1_zip_before_dot",
    over("messy_zip", "SELECT row_id, zip, split_part(coalesce(zip, ''), '.', 1) AS zip_head FROM messy_zip"),
)
def _(d):
    return d["messy_zip"].withColumn("zip_head", text.zip_before_dot(F.col("zip")))


@query(
    "c1_zip_compare_form",
    over(
        "messy_zip",
        f"SELECT row_id, zip, regexp_replace(lower({q.strip('zip')}), '\\.0$', '') AS zip_compare FROM messy_zip",
    ),
)
def _(d):
    return d["messy_zip"].withColumn("zip_compare", text.zip_compare_form(F.col("zip")))


@query(
    "c2_null_to_blank",
    over(
        "address_multi",
        "SELECT entity_id, coalesce(street, '') AS street, coalesce(city, '') AS city, "
        "coalesce(state, '') AS state, coalesce(zip, '') AS zip FROM address_multi",
    ),
)
def _(d):
    return d["address_multi"].select("entity_id", *[text.null_to_blank(F.col(c)).alias(c) for c in ADDRESS_PARTS])


@query(
    "c3_compose_multi",
    over(
        "address_multi",
        f"SELECT entity_id, {q.joined(*ADDRESS_PARTS)} AS joined, "
        f"{q.punct(q.title(q.joined(*ADDRESS_PARTS)))} AS address FROM address_multi",
    ),
)
def _(d):
    parts = [F.col(c) for c in ADDRESS_PARTS]
    return d["address_multi"].select(
        "entity_id",
        text.join_parts(*parts[:3], text.zip_before_dot(parts[3])).alias("joined"),
        text.compose_multi(*parts).alias("address"),
    )


@query("c3_compose_single", f"SELECT doc_id, {q.punct(q.title('text'))} AS address FROM documents")
def _(d):
    return d["documents"].select("doc_id", text.compose_single(F.col("text")).alias("address"))


@query(
    "c3_compose_location",
    over(
        "location",
        "SELECT location_id, trim(coalesce(address_1, '') || ' ' || coalesce(address_2, '') || ' ' || "
        "coalesce(city, '') || ' ' || coalesce(state, '') || ' ' || coalesce(zip, '')) AS address FROM location",
    ),
)
def _(d):
    parts = [F.col(c) for c in ("address_1", "address_2", "city", "state", "zip")]
    return d["location"].select("location_id", text.compose_location(*parts).alias("address"))


@query("c4_title_case", f"SELECT doc_id, {q.title('text')} AS title FROM documents")
def _(d):
    return d["documents"].select("doc_id", text.title_case(F.col("text")).alias("title"))


@query("c5_strip_punct", f"SELECT doc_id, {q.punct('text')} AS plain FROM documents")
def _(d):
    return d["documents"].select("doc_id", text.strip_punctuation(F.col("text")).alias("plain"))


@query(
    "c6_blank_text",
    over("messy_value", f"SELECT order_id, line_id, value, {q.blank('value')} AS is_blank FROM messy_value"),
)
def _(d):
    return d["messy_value"].select("order_id", "line_id", "value", text.is_blank(F.col("value")).alias("is_blank"))


@query(
    "c7_blank_omop",
    over(
        "messy_value",
        f"SELECT order_id, line_id, value, {q.blank_coordinate('value')} AS blank_text, "
        "(tax IS NULL OR isnan(tax) OR tax = 0) AS blank_number FROM messy_value",
    ),
)
def _(d):
    return d["messy_value"].select(
        "order_id",
        "line_id",
        "value",
        text.is_blank_coordinate(F.col("value")).alias("blank_text"),
        text.is_blank_coordinate(F.col("tax"), numeric=True).alias("blank_number"),
    )


# --- columns: values -------------------------------------------------------------------------


@query(
    "c8_has_coords",
    over(
        "messy_value",
        f"SELECT order_id, line_id, value, other, {q.has_coordinates('value', 'other')} AS has_coords FROM messy_value",
    ),
)
def _(d):
    return d["messy_value"].select(
        "order_id", "line_id", "value", "other", values.has_coordinates(F.col("value"), F.col("other")).alias("has_coords")
    )


@query(
    "c9_year_normalize",
    over("messy_value", f"SELECT order_id, line_id, value, {q.whole_year('value')} AS year FROM messy_value"),
)
def _(d):
    return d["messy_value"].select("order_id", "line_id", "value", values.year_of(F.col("value")).alias("year"))


@query(
    "c10_vintage",
    over("address_multi", f"SELECT entity_id, year, {q.vintage(q.whole_year('year'))} AS year_for_fips FROM address_multi"),
)
def _(d):
    return d["address_multi"].select(
        "entity_id", "year", values.vintage_of(values.year_of(F.col("year"))).alias("year_for_fips")
    )


@query(
    "c11_visit_year",
    over("visit", "SELECT visit_occurrence_id, CAST(year(visit_start_date) AS INTEGER) AS year FROM visit"),
)
def _(d):
    return d["visit"].select("visit_occurrence_id", values.visit_year(F.col("visit_start_date")).alias("year"))


@query(
    "c12_rename_coords",
    over("coordinates", "SELECT entity_id, year, latitude AS lat, longitude AS lon FROM coordinates"),
)
def _(d):
    return values.short_coordinate_names(
        values.long_coordinate_names(values.short_coordinate_names(d["coordinates"]))
    )


@query("c13_drop_if_present", over("coordinates", "SELECT entity_id, year, latitude, longitude FROM coordinates"))
def _(d):
    work = {"_rid": F.col("entity_id"), "score": F.lit(1.0), "matched_zip": F.lit("x"), "address": F.lit("x")}
    return values.drop_work_columns(d["coordinates"].withColumns(work))


@query(
    "c14_fips_format",
    over("tract_edges", f"SELECT DISTINCT k, vintage, {q.fips('tract_id')} AS FIPS FROM tract_edges"),
)
def _(d):
    return d.tracts.select(
        F.substring("tract_id", -9, 9).cast("bigint").alias("k"),
        "vintage",
        values.format_fips(F.col("tract_id")).alias("FIPS"),
    )


@query(
    "c15_geocode_result",
    over("coordinates", f"SELECT entity_id, {q.result('latitude', 'longitude')} AS geocode_result FROM coordinates"),
)
def _(d):
    return d["coordinates"].select(
        "entity_id", status.geocode_result(F.col("latitude"), F.col("longitude")).alias("geocode_result")
    )


@query(
    "c16_reason",
    over(
        "address_multi coordinates hospitals",
        f"""SELECT entity_id, geocode_result,
               {q.reason('geocode_result', 'h IS NOT NULL', *ADDRESS_PARTS)} AS reason,
               {q.reason('geocode_result', 's IS NOT NULL')} AS reason_single
        FROM (SELECT a.*, {q.result('c.latitude', 'c.longitude')} AS geocode_result, h.address AS h, s.address AS s
              FROM address_multi a JOIN coordinates c ON a.entity_id = c.entity_id
              LEFT JOIN hospitals h ON h.address = {q.hospital_form(*[f'a.{c}' for c in ADDRESS_PARTS])}
              LEFT JOIN hospitals s ON s.address =
                  {q.strip(f"lower({q.punct(q.title('coalesce(a.street, chr(0))'))})")}) t""".replace(
            "coalesce(a.street, chr(0))", "coalesce(a.street || ' ' || a.city || ' ' || a.state || ' ' || a.zip, '')"
        ),
    ),
)
def _(d):
    parts = [F.col(c) for c in ADDRESS_PARTS]
    whole = F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2], F.lit(" "), parts[3])
    rows = d["address_multi"].join(d["coordinates"].select("entity_id", "latitude", "longitude"), "entity_id")
    rows = rows.withColumn("geocode_result", status.geocode_result(F.col("latitude"), F.col("longitude")))
    rows = hospitals.flag_hospitals(rows, status.hospital_form_multi(*parts), d["hospitals"], "h")
    rows = hospitals.flag_hospitals(rows, status.hospital_form_single(text.compose_single(whole)), d["hospitals"], "s")
    return rows.select(
        "entity_id",
        "geocode_result",
        status.reason(F.col("geocode_result"), F.col("h"), *parts).alias("reason"),
        status.reason(F.col("geocode_result"), F.col("s")).alias("reason_single"),
    )


# --- filters and classification --------------------------------------------------------------

_CATEGORY = (
    f"CASE WHEN NOT {q.blank_coordinate('latitude')} AND NOT {q.blank_coordinate('longitude')} THEN 'Latlong' "
    f"WHEN {q.blank_coordinate('latitude')} AND {q.blank_coordinate('longitude')} THEN "
    f"CASE WHEN {q.blank_coordinate('address_1')} THEN 'Invalid' ELSE 'Address' END ELSE 'Unclassified' END"
)
_LOCATION_LIST = ", ".join(LOCATION_COLUMNS)


@query(
    "f1_visit_cutoff",
    over(
        "visit",
        "SELECT visit_occurrence_id, person_id, visit_start_date, visit_end_date FROM visit "
        f"WHERE visit_start_date >= DATE '{CUTOFF}'",
    ),
)
def _(d):
    return visits.since_cutoff(d["visit"], CUTOFF)


def _category_filter(name: str, keep: Callable[[DataFrame], DataFrame], category: str) -> None:
    query(
        name,
        over("location", f"SELECT location_id, latitude, longitude, address_1 FROM location WHERE {_CATEGORY} = '{category}'"),
    )(lambda d: keep(d["location"]).select("location_id", "latitude", "longitude", "address_1"))


_category_filter("f2_cat_latlong", visits.with_coordinates_given, "Latlong")
_category_filter("f3_cat_invalid", visits.without_location, "Invalid")
_category_filter("f4_cat_address", visits.with_address_only, "Address")


@query("f5_classify", over("location", f"SELECT location_id, {_CATEGORY} AS category FROM location"))
def _(d):
    return visits.classify(d["location"]).select("location_id", "category")


@query(
    "f6_vintage_split",
    over(
        "coordinates",
        "SELECT * FROM (SELECT entity_id, latitude, longitude, CAST(1990 + 10 * (entity_id % 4) AS INTEGER) AS "
        "year_for_fips FROM coordinates) t WHERE year_for_fips IN (2010, 2020)",
    ),
)
def _(d):
    given = (1990 + 10 * (F.col("entity_id") % 4)).cast("int")
    return summaries.supported_vintages(
        d["coordinates"].select("entity_id", "latitude", "longitude", given.alias("year_for_fips"))
    )


@query(
    "f7_needs_geocoding",
    over(
        "location",
        f"SELECT location_id, NOT {q.has_coordinates('latitude', 'longitude')} AS needs_geocoding FROM location",
    ),
)
def _(d):
    return d["location"].select("location_id", locations.needs_geocoding().alias("needs_geocoding"))


# --- joins -----------------------------------------------------------------------------------


@query(
    "j1_person_visit",
    over(
        "person visit",
        "SELECT p.person_id, visit_occurrence_id, visit_start_date, visit_end_date "
        "FROM person p LEFT JOIN visit v ON p.person_id = v.person_id",
    ),
)
def _(d):
    return visits.person_visits(d["person"], d["visit"])


@query(
    "j2_location_history",
    over(
        "location location_history",
        f"SELECT {', '.join('l.' + c for c in LOCATION_COLUMNS)}, entity_id, start_date, end_date "
        "FROM location l LEFT JOIN location_history h ON l.location_id = h.location_id",
    ),
)
def _(d):
    return visits.located_history(d["location"], d["location_history"])


def _visit_rows(open_ended: bool = False) -> str:
    end = "coalesce(end_date, DATE '9999-12-31')" if open_ended else "end_date"
    return f"""visit_rows AS (
    SELECT p.person_id, v.visit_occurrence_id, v.visit_start_date,
           CAST(year(v.visit_start_date) AS INTEGER) AS year, {', '.join('l.' + c for c in LOCATION_COLUMNS)}
    FROM person p LEFT JOIN visit v ON p.person_id = v.person_id
    LEFT JOIN (SELECT l.*, entity_id, start_date, {end} AS stay_end
               FROM location l LEFT JOIN location_history h ON l.location_id = h.location_id) l
      ON p.person_id = l.entity_id
    WHERE v.visit_start_date BETWEEN l.start_date AND l.stay_end
      AND v.visit_end_date BETWEEN l.start_date AND l.stay_end
      AND v.visit_start_date >= DATE '{CUTOFF}')"""


def _located_visits(d: Domain, **options) -> DataFrame:
    return visits.visits_in_residence(
        d["person"], d["visit"], d["location"], d["location_history"], cutoff=CUTOFF, **options
    )


_VISIT_TABLES = "person visit location location_history"


@query("j3_visit_in_residence", over(_VISIT_TABLES, "SELECT * FROM visit_rows", _visit_rows()))
def _(d):
    return _located_visits(d)


@query("j3_visit_in_open_residence", over(_VISIT_TABLES, "SELECT * FROM visit_rows", _visit_rows(open_ended=True)))
def _(d):
    return _located_visits(d, open_ended=True)


_ASKED = "asked_rows AS (SELECT entity_id AS rid, street, city, state, zip FROM address_multi)"
_MATCHED = (
    "b.street AS matched_street, b.city AS matched_city, b.state AS matched_state, b.zip AS matched_zip, "
    "round(b.score, 9) AS score, "
    "CASE WHEN b.score = 1 THEN 'exact' WHEN b.score IS NOT NULL THEN 'close' END AS \"precision\""
)


@query(
    "j4_reattach_parts",
    over(
        "address_multi address_points",
        f"SELECT a.entity_id, {q.punct(q.title(q.joined(*['a.' + c for c in ADDRESS_PARTS])))} AS address, "
        "a.street, a.city, a.state, a.zip, b.latitude, b.longitude "
        "FROM address_multi a LEFT JOIN best b ON a.entity_id = b.rid",
        _ASKED,
        q.match_multi("asked_rows"),
    ),
)
def _(d):
    placed = geocode(d["address_multi"], d["address_points"]).withColumn("address", address_text())
    return locations.in_row_order(
        placed.select("entity_id", "address", *ADDRESS_PARTS, "latitude", "longitude"), "entity_id"
    )


@query(
    "j5_geocode_address",
    over(
        "address_multi address_points",
        f"SELECT a.entity_id, b.latitude, b.longitude, {_MATCHED} "
        "FROM address_multi a LEFT JOIN best b ON a.entity_id = b.rid",
        _ASKED,
        q.match_multi("asked_rows"),
    ),
)
def _(d):
    placed = geocode(d["address_multi"], d["address_points"])
    return placed.select(
        "entity_id",
        "latitude",
        "longitude",
        *[f"matched_{c}" for c in ADDRESS_PARTS],
        F.round("score", 9).alias("score"),
        "precision",
    )


_SINGLE = "concat_ws(' ', street, city, state, split_part(zip, '.', 1))"
_ASKED_SINGLE = f"asked_rows AS (SELECT entity_id AS rid, {q.punct(q.title(q.without_unit(_SINGLE)))} AS address FROM address_multi)"


def _single_rows(d: Domain) -> DataFrame:
    whole = F.concat_ws(" ", "street", "city", "state", text.zip_before_dot(F.col("zip")))
    return d["address_multi"].select("entity_id", "year", F.when(F.col("zip").isNull(), F.concat_ws(" ", "street", "city", "state")).otherwise(whole).alias("address"))


@query(
    "j5_geocode_single_column",
    over(
        "address_multi address_points",
        f"SELECT a.entity_id, b.latitude, b.longitude, {_MATCHED} "
        "FROM address_multi a LEFT JOIN best b ON a.entity_id = b.rid",
        _ASKED_SINGLE,
        q.match_single("asked_rows"),
    ),
)
def _(d):
    placed = geocode(_single_rows(d), d["address_points"], ("address",))
    return placed.select(
        "entity_id",
        "latitude",
        "longitude",
        *[f"matched_{c}" for c in ADDRESS_PARTS],
        F.round("score", 9).alias("score"),
        "precision",
    )


_POINTS = f"""pts AS (
    SELECT entity_id AS rid, {q.number('longitude')} AS x, {q.number('latitude')} AS y, {q.vintage('year')} AS v
    FROM coordinates WHERE {q.has_coordinates('latitude', 'longitude')})"""


@query(
    "j6_point_to_tract",
    over(
        "coordinates tract_edges",
        "SELECT c.entity_id, h.tract_id, h.tract_id || '1' AS block_group_id "
        "FROM coordinates c LEFT JOIN hits h ON c.entity_id = h.rid",
        _POINTS,
        q.tract_hits("pts"),
    ),
)
def _(d):
    rows = d["coordinates"].withColumn("year_for_fips", values.vintage_of(F.col("year")))
    return tracts.assign_tracts(rows, d.tracts).select("entity_id", "tract_id", "block_group_id")


@query("j6_point_to_tract_shuffled", ORACLES["j6_point_to_tract"])
def _(d):
    rows = d["coordinates"].withColumn("year_for_fips", values.vintage_of(F.col("year")))
    index = tracts.build_tract_index(d.tracts, broadcast_bytes=0)
    return tracts.assign_tracts(rows, index).select("entity_id", "tract_id", "block_group_id")


@query(
    "j7_hospital_flag",
    over(
        "address_multi hospitals",
        f"SELECT entity_id, {q.hospital_form(*ADDRESS_PARTS)} IN (SELECT address FROM hospitals) AS at_hospital "
        "FROM address_multi",
    ),
)
def _(d):
    form = status.hospital_form_multi(*[F.col(c) for c in ADDRESS_PARTS])
    return hospitals.flag_hospitals(d["address_multi"], form, d["hospitals"]).select("entity_id", "at_hospital")


@query("j7_hospital_flag_shuffled", ORACLES["j7_hospital_flag"])
def _(d):
    form = status.hospital_form_multi(*[F.col(c) for c in ADDRESS_PARTS])
    flagged = hospitals.flag_hospitals(d["address_multi"], form, d["hospitals"], broadcast_bytes=0)
    return flagged.select("entity_id", "at_hospital")


# --- reductions, set operations, order -------------------------------------------------------


@query(
    "a1_all_null",
    over(
        "location",
        "SELECT count(county) = 0 AS county, count(latitude) = 0 AS latitude, count(zip) = 0 AS zip FROM location",
    ),
)
def _(d):
    return summaries.all_null(d["location"], "county", "latitude", "zip")


@query(
    "a2_vintages_present",
    over("coordinates", f"SELECT DISTINCT {q.vintage('year')} AS year_for_fips FROM coordinates"),
)
def _(d):
    return summaries.vintages_present(d["coordinates"].withColumn("year_for_fips", values.vintage_of(F.col("year"))))


_CATEGORY_COUNTS = over(
    _VISIT_TABLES,
    f"SELECT category, vintage, count(*) AS n_rows FROM (SELECT {_CATEGORY} AS category, "
    f"{q.vintage('year', VISIT_PIVOT)} AS vintage FROM visit_rows) t GROUP BY 1, 2",
    _visit_rows(),
)


@query("a3_row_counts", _CATEGORY_COUNTS)
def _(d):
    rows = visits.classify(_located_visits(d)).withColumn("vintage", values.vintage_of(F.col("year"), VISIT_PIVOT))
    return summaries.row_counts(rows, "category", "vintage")


@query(
    "u1_union_vintages",
    over(
        "coordinates",
        f"SELECT entity_id, {q.vintage('year')} AS year_for_fips, latitude, longitude, "
        "CASE WHEN year >= 2020 THEN 'new' END AS note FROM coordinates",
    ),
)
def _(d):
    rows = d["coordinates"].select(
        "entity_id", values.vintage_of(F.col("year")).alias("year_for_fips"), "latitude", "longitude"
    )
    older = rows.where("year_for_fips = 2010")
    newer = rows.where("year_for_fips = 2020").withColumn("note", F.lit("new"))
    return locations.union_vintages(older, newer)


_TRIMMED = ", ".join(
    c if c == "location_id" else f"{q.strip(c)} AS {c}" for c in LOCATION_COLUMNS
)


@query("u2_location_build", over(_VISIT_TABLES, f"SELECT DISTINCT {_TRIMMED} FROM visit_rows", _visit_rows()))
def _(d):
    rows = _located_visits(d)
    return locations.build_location(
        rows.where(F.col("year") < VISIT_PIVOT), rows.where(F.col("year") >= VISIT_PIVOT), rows.select("person_id")
    )


@query(
    "u2_location_incremental",
    over(_VISIT_TABLES, f"SELECT DISTINCT {_TRIMMED} FROM visit_rows WHERE location_id % 5 <> 4", _visit_rows()),
)
def _(d):
    """Two deliveries that overlap, the second one twice, as one table."""
    rows = _located_visits(d)
    store = LocationStore(d.spark, _scratch(d, "location"), buckets=8)
    store.merge("first", rows.where("location_id % 5 < 3"))
    for _ in range(2):
        store.merge("second", rows.where("location_id % 5 IN (2, 3)"))
    return store.read()


@query("d1_distinct", over("coordinates", "SELECT DISTINCT latitude, longitude FROM coordinates"))
def _(d):
    return locations.distinct_rows(d["coordinates"].select("latitude", "longitude"))


@query("o1_sort_row_id", over("coordinates", "SELECT entity_id, latitude, longitude FROM coordinates ORDER BY entity_id"))
def _(d):
    return locations.in_row_order(d["coordinates"].select("entity_id", "latitude", "longitude"), "entity_id")


@query("o2_sort_visits", over("visit", "SELECT * FROM visit ORDER BY person_id, visit_start_date, visit_occurrence_id"))
def _(d):
    return locations.in_visit_order(d["visit"])


@query(
    "l1_offset_fetch",
    over("visit", "SELECT * FROM visit ORDER BY person_id, visit_start_date, visit_occurrence_id LIMIT 1000 OFFSET 500"),
)
def _(d):
    return locations.page(d["visit"], ("person_id", "visit_start_date", "visit_occurrence_id"), offset=500, rows=1000)


# --- exposure --------------------------------------------------------------------------------

_PLACES = """places AS (
    SELECT o_orderkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           lpad(CAST(o_custkey % n % 56 + 1 AS VARCHAR) || lpad(CAST(o_custkey % n AS VARCHAR), 9, '0'), 11, '0') AS FIPS
    FROM orders, (SELECT count(*) AS n FROM supplier))"""


def _places(d: Domain) -> DataFrame:
    """Every order as a row that was linked already: its customer's tract and its year."""
    n = d["supplier"].agg(F.count(F.lit(1))).scalar()
    k = F.col("_k")
    return d["orders"].withColumn("_k", F.col("o_custkey") % n).select(
        F.col("o_orderkey").alias("entity_id"),
        F.year("o_orderdate").alias("year"),
        F.lpad(F.concat((k % 56 + 1).cast("string"), F.lpad(k.cast("string"), 9, "0")), 11, "0").alias("FIPS"),
    )


def _wide(source: str) -> str:
    columns = ", ".join(f"max(value) FILTER (variable_id = {i}) AS {name}" for i, name in VARIABLES.items())
    return f"wide AS (SELECT geocode, year, {columns} FROM {source} GROUP BY geocode, year)"


_NAMES = ", ".join(VARIABLES.values())


@query(
    "x1_exposure_by_fips",
    over(
        "variable_value",
        f"SELECT entity_id, p.year, FIPS, {_NAMES} FROM places p "
        "LEFT JOIN wide w ON p.FIPS = w.geocode AND p.year = w.year",
        _PLACES,
        _wide("variable_value"),
    ),
)
def _(d):
    return exposure.join_by_geocode(_places(d), d["variable_value"], VARIABLES)


@query("x1_exposure_by_fips_shuffled", ORACLES["x1_exposure_by_fips"])
def _(d):
    return exposure.join_by_geocode(_places(d), d["variable_value"], VARIABLES, broadcast_bytes=0)


@query(
    "x1_exposure_latest_year",
    over(
        "variable_value",
        "SELECT entity_id, p.year, FIPS, "
        + ", ".join(
            f"(SELECT arg_max(value, v.year) FROM variable_value v WHERE v.geocode = p.FIPS AND v.variable_id = {i} "
            f"AND v.year <= p.year) AS {name}"
            for i, name in VARIABLES.items()
        )
        + " FROM places p",
        _PLACES,
    ),
)
def _(d):
    return exposure.join_by_geocode(
        _places(d), d["variable_value"], VARIABLES, year_rule="latest", last_year=2005, broadcast_bytes=0
    )


@query(
    "x2_exposure_spatial",
    over(
        "coordinates tract_edges variable_value",
        f"SELECT c.entity_id, c.year, {q.fips('h.tract_id')} AS FIPS, {_NAMES} FROM coordinates c "
        f"LEFT JOIN hits h ON c.entity_id = h.rid LEFT JOIN wide w ON {q.fips('h.tract_id')} = w.geocode "
        "AND c.year - 15 = w.year",
        _POINTS,
        q.tract_hits("pts"),
        _wide("variable_value"),
    ),
)
def _(d):
    rows = d["coordinates"].withColumns(
        {"year_for_fips": values.vintage_of(F.col("year")), "exposure_year": F.col("year") - 15}
    )
    linked = exposure.join_spatially(rows, d.tracts, d["variable_value"], VARIABLES, year="exposure_year")
    return linked.select("entity_id", "year", "FIPS", *VARIABLES.values())


@query(
    "x3_select_variables",
    over(
        "variable_rows variable_index",
        "SELECT variable_id, geocode, year, value FROM variable_rows WHERE variable_id <= 1000 AND variable_id IN "
        "(SELECT variable_id FROM variable_index WHERE source_id IN (1, 3, 5, 7, 24))",
    ),
)
def _(d):
    wanted = list(range(0, 1001))
    return exposure.select_variables(d["variable_rows"], d["variable_index"], wanted, [1, 3, 5, 7, 24])


@query(
    "x4_rollup_geocode",
    over(
        "crosswalk",
        """SELECT entity_id, FIPS, left(FIPS, 5) AS county, left(FIPS, 2) AS state, zcta FROM places LEFT JOIN (
             SELECT FIPS AS f, zcta FROM (SELECT *, row_number() OVER (PARTITION BY FIPS ORDER BY weight DESC, zcta) AS r
                                          FROM crosswalk) t WHERE r = 1) c ON FIPS = f""",
        _PLACES,
    ),
)
def _(d):
    rows = exposure.roll_up(_places(d), "county", geocode="county")
    rows = exposure.roll_up(rows, "state", geocode="state")
    rows = exposure.roll_up(rows, "zcta", crosswalk=d["crosswalk"], geocode="zcta")
    return rows.select("entity_id", "FIPS", "county", "state", "zcta")


@query("x4_rollup_geocode_shuffled", ORACLES["x4_rollup_geocode"])
def _(d):
    rows = exposure.roll_up(_places(d), "county", geocode="county")
    rows = exposure.roll_up(rows, "state", geocode="state")
    rows = exposure.roll_up(rows, "zcta", crosswalk=d["crosswalk"], geocode="zcta", broadcast_bytes=0)
    return rows.select("entity_id", "FIPS", "county", "state", "zcta")


@query(
    "x5_output_check",
    over(
        "coordinates tract_edges variable_value",
        "SELECT vintage, count(*) AS n_rows, count(*) FILTER (person_id IS NULL) AS missing_person, "
        f"count(*) FILTER (NOT {q.has_coordinates('latitude', 'longitude')}) AS bad_coordinates, "
        "count(*) FILTER (FIPS IS NULL OR length(FIPS) <> 11) AS bad_fips, "
        + ", ".join(f"count(*) FILTER ({n} IS NULL) AS missing_{n}" for n in VARIABLES.values())
        + f""" FROM (SELECT CASE WHEN entity_id % 31 <> 0 THEN entity_id END AS person_id, {q.vintage('c.year')} AS vintage,
                latitude, longitude, {q.fips('h.tract_id')} AS FIPS, {_NAMES}
              FROM coordinates c LEFT JOIN hits h ON c.entity_id = h.rid
              LEFT JOIN wide w ON {q.fips('h.tract_id')} = w.geocode AND c.year - 15 = w.year) t GROUP BY vintage""",
        _POINTS,
        q.tract_hits("pts"),
        _wide("variable_value"),
    ),
)
def _(d):
    vintage = values.vintage_of(F.col("year"))
    rows = d["coordinates"].withColumns(
        {
            "year_for_fips": vintage,
            "vintage": vintage,
            "exposure_year": F.col("year") - 15,
            "person_id": F.when(F.col("entity_id") % 31 != 0, F.col("entity_id")),
        }
    )
    linked = exposure.join_spatially(rows, d.tracts, d["variable_value"], VARIABLES, year="exposure_year")
    return exposure.check_output(linked, VARIABLES.values(), source="vintage")


_TRIAL_SECRET = "only for this trial table"
_DIGEST = f"sha256('{_TRIAL_SECRET}' || sha256('{_TRIAL_SECRET}' || CAST(person_id AS VARCHAR)))"
_STEP = f"CAST(CAST('0x' || substr({_DIGEST}, 1, 12) AS BIGINT) % 364 AS INTEGER)"
_DAYS = f"(CASE WHEN {_STEP} < 182 THEN {_STEP} - 182 ELSE {_STEP} - 181 END)"


@query(
    "x6_date_shift",
    over(
        "visit",
        f"SELECT visit_occurrence_id, person_id, visit_start_date + {_DAYS} AS visit_start_date, "
        f"visit_end_date + {_DAYS} AS visit_end_date FROM visit",
    ),
)
def _(d):
    return exposure.shift_dates(d["visit"], "person_id", ["visit_start_date", "visit_end_date"], _TRIAL_SECRET)


@query(
    "x7_catalog",
    over(
        "data_source variable_index variable_rows",
        """SELECT 'variable_index' AS table_name, CAST(source_id AS BIGINT) AS missing_id, count(*) AS n_rows
           FROM variable_index WHERE source_id NOT IN (SELECT source_id FROM data_source) GROUP BY source_id
           UNION ALL
           SELECT 'variable_value', variable_id, count(*) FROM variable_rows
           WHERE variable_id NOT IN (SELECT variable_id FROM variable_index) GROUP BY variable_id""",
    ),
)
def _(d):
    return exposure.check_catalog(d["data_source"], d["variable_index"], d["variable_rows"])


@query(
    "x7_catalog_values",
    over(
        "data_source variable_index variable_rows",
        """SELECT variable_id, geocode, year, value FROM variable_rows WHERE variable_id IN (
             SELECT variable_id FROM variable_index WHERE source_id IN (SELECT source_id FROM data_source))""",
    ),
)
def _(d):
    return exposure.checked_values(d["data_source"], d["variable_index"], d["variable_rows"])


# --- whole jobs ------------------------------------------------------------------------------

_COORDINATE_RESULT = over(
    "coordinates tract_edges",
    f"SELECT c.entity_id, c.year, c.latitude, c.longitude, {q.fips('h.tract_id')} AS FIPS "
    "FROM coordinates c LEFT JOIN hits h ON c.entity_id = h.rid",
    _POINTS,
    q.tract_hits("pts"),
)


@query(
    "link_coordinates",
    over(
        "coordinates tract_edges",
        f"SELECT c.entity_id, CAST(c.year AS INTEGER) AS year, c.latitude, c.longitude, {q.fips('h.tract_id')} AS FIPS "
        "FROM coordinates c LEFT JOIN hits h ON c.entity_id = h.rid",
        _POINTS,
        q.tract_hits("pts"),
    ),
)
def _(d):
    return linkage.link_coordinates(d["coordinates"], d.tracts).withColumn("year", F.col("year").cast("int"))


def _placed_sql(single: bool) -> str:
    if single:
        form = q.strip("lower(r.address)")
        parts: list[str] = []
        asked, match = _ASKED_SINGLE, q.match_single("asked_rows")
    else:
        parts = [f"a.{c}" for c in ADDRESS_PARTS]
        form = q.hospital_form(*parts)
        asked, match = _ASKED, q.match_multi("asked_rows")
    found = "CASE WHEN b.latitude IS NOT NULL THEN 'Geocoded' ELSE 'Imprecise Geocode' END"
    return f"""{asked},
{match},
placed AS (
    SELECT a.entity_id, {q.whole_year('a.year')} AS year, b.latitude, b.longitude, {found} AS geocode_result,
           {q.reason(found, f'{form} IN (SELECT address FROM hospitals)', *parts)} AS reason,
           {q.vintage(q.whole_year('a.year'))} AS v
    FROM address_multi a JOIN asked_rows r ON a.entity_id = r.rid LEFT JOIN best b ON a.entity_id = b.rid),
pts AS (SELECT entity_id AS rid, longitude AS x, latitude AS y, v FROM placed WHERE latitude IS NOT NULL),
{q.tract_hits('pts')}"""


_ADDRESS_TABLES = "address_multi address_points hospitals tract_edges"


def _linked_addresses_sql(single: bool) -> str:
    return over(
        _ADDRESS_TABLES,
        f"SELECT p.entity_id, p.year, p.latitude, p.longitude, p.geocode_result, p.reason, {q.fips('h.tract_id')} AS FIPS "
        "FROM placed p LEFT JOIN hits h ON p.entity_id = h.rid",
        _placed_sql(single),
    )


@query("link_addresses", _linked_addresses_sql(single=False))
def _(d):
    return linkage.link_addresses(d["address_multi"], d["address_points"], d.tracts, d["hospitals"])


@query("link_addresses_single_column", _linked_addresses_sql(single=True))
def _(d):
    return linkage.link_addresses(_single_rows(d), d["address_points"], d.tracts, d["hospitals"])


@query(
    "refresh_location",
    over(
        "location address_points",
        "SELECT l.location_id, "
        + ", ".join(f"{q.strip('l.' + c)} AS {c}" for c in LOCATION_COLUMNS[1:10])
        + ", "
        + ", ".join(
            f"CASE WHEN {q.has_coordinates('l.latitude', 'l.longitude')} THEN {q.number('l.' + c)} ELSE b.{c} END AS {c}"
            for c in ("latitude", "longitude")
        )
        + " FROM location l LEFT JOIN best b ON l.location_id = b.rid",
        f"""asked_rows AS (
            SELECT location_id AS rid, address_1 AS street, city, state, zip
            FROM location WHERE NOT {q.has_coordinates('latitude', 'longitude')})""",
        q.match_multi("asked_rows"),
    ),
)
def _(d):
    return linkage.refresh_location(d["location"], d["address_points"])


_VISIT_CTES = f"""{_visit_rows()},
sorted_rows AS (SELECT *, {_CATEGORY} AS category, {q.vintage('year', VISIT_PIVOT)} AS v FROM visit_rows),
asked_rows AS (
    SELECT location_id AS rid, address_1 AS street, city, state, zip FROM location WHERE {_CATEGORY} = 'Address'),
{q.match_multi('asked_rows')},
placed AS (
    SELECT s.*, CASE category WHEN 'Address' THEN b.latitude WHEN 'Latlong' THEN {q.number('s.latitude')} END AS lat,
           CASE category WHEN 'Address' THEN b.longitude WHEN 'Latlong' THEN {q.number('s.longitude')} END AS lon
    FROM sorted_rows s LEFT JOIN best b ON s.location_id = b.rid),
pts AS (
    SELECT DISTINCT location_id AS rid, lon AS x, lat AS y, v FROM placed
    WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180),
{q.tract_hits('pts')},
linked AS (
    SELECT p.*, CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN 'Geocoded'
                     ELSE 'Imprecise Geocode' END AS geocode_result, {q.fips('h.tract_id')} AS FIPS,
           {q.hospital_form('address_1', 'city', 'state', 'zip')} IN (SELECT address FROM hospitals) AS at_hospital
    FROM placed p LEFT JOIN hits h ON p.location_id = h.rid AND p.v = h.v)"""
_ALL_TABLES = _VISIT_TABLES + " address_points hospitals tract_edges"


@query(
    "link_visits",
    over(
        _ALL_TABLES,
        "SELECT person_id, visit_occurrence_id, visit_start_date, year, location_id, address_1, address_2, city, state, "
        f"{q.zip_suffix('zip')} AS zip, county, location_source_value, country_concept_id, country_source_value, "
        "lat AS latitude, lon AS longitude, category, geocode_result, "
        f"{q.reason('geocode_result', 'at_hospital', 'address_1', 'city', 'state', 'zip')} AS reason, FIPS FROM linked",
        _VISIT_CTES,
    ),
)
def _(d):
    return _linked_visits(d)


def _linked_visits(d: Domain) -> DataFrame:
    return linkage.link_visits(
        d["person"],
        d["visit"],
        d["location"],
        d["location_history"],
        d.tracts,
        d["address_points"],
        d["hospitals"],
        cutoff=CUTOFF,
        pivot=VISIT_PIVOT,
    )


# --- sources ---------------------------------------------------------------------------------

_CSV_TEXT = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}


def _no_marker(column: str, name: str | None = None) -> str:
    return f"CASE WHEN {column} NOT IN {q.MARKERS} THEN {column} END AS {name or column}"


def _csv_inputs(d: Domain) -> str:
    """A folder with the derived tables as CSV files of three shapes and differing headers."""
    folder = _scratch(d, "inputs")
    d["address_multi"].write.csv(folder, mode="append", **_CSV_TEXT)
    _single_rows(d).write.csv(folder, mode="append", **_CSV_TEXT)
    rows = d["coordinates"]
    rows.where("year < 2018").write.csv(folder, mode="append", **_CSV_TEXT)
    rows.where("year >= 2018").select(
        "longitude", F.col("latitude").alias(" Latitude "), "year", F.col("entity_id").alias("ENTITY_ID")
    ).write.csv(folder, mode="append", **_CSV_TEXT)
    return folder


_SHAPE_COLUMNS = ("entity_id", "year", "latitude", "longitude", *ADDRESS_PARTS, "address")


def _shape_rows(shape: str, relation: str, present: tuple[str, ...]) -> str:
    columns = [
        _no_marker(f"CAST({c} AS VARCHAR)", c) if c in present else f"CAST(NULL AS VARCHAR) AS {c}" for c in _SHAPE_COLUMNS
    ]
    return f"SELECT '{shape}' AS shape, {', '.join(columns)}, '.csv' AS file_suffix FROM {relation}"


@query(
    "src_csv_folder",
    over(
        "coordinates address_multi",
        _shape_rows("coordinates", "coordinates", ("entity_id", "year", "latitude", "longitude"))
        + " UNION ALL "
        + _shape_rows("multi", "address_multi", ("entity_id", "year", *ADDRESS_PARTS))
        + " UNION ALL "
        + _shape_rows("single", f"(SELECT entity_id, year, {_SINGLE} AS address FROM address_multi)", ("entity_id", "year", "address")),
    ),
)
def _(d):
    scan = csv_folder.scan_folder(d.spark, _csv_inputs(d))
    suffix = F.regexp_extract("source_file", r"\.[^.]*$", 0)
    shapes = [
        df.select(
            F.lit(shape).alias("shape"),
            *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in _SHAPE_COLUMNS],
            suffix.alias("file_suffix"),
        )
        for shape, df in scan.frames.items()
    ]
    return locations.union_vintages(*shapes)


@query(
    "src_csv_malformed",
    over(
        "coordinates",
        "SELECT 'read' AS status, count(*) AS n_rows FROM coordinates WHERE entity_id % 50 > 1 "
        "UNION ALL SELECT 'malformed', count(*) FROM coordinates WHERE entity_id % 50 = 0",
    ),
)
def _(d):
    """A file in which some rows have a separator too many is rejected whole; the others are read."""
    folder, rows = _scratch(d, "malformed"), d["coordinates"]
    part = F.col("entity_id") % 50
    rows.where(part > 1).write.csv(folder, header=True)
    shifted = F.when(part == 0, F.concat("year", F.lit(",x"))).otherwise(F.col("year").cast("string"))
    # Without quotes the separator in the text becomes one of the row's.
    mixed = rows.where(part <= 1).withColumn("year", shifted).coalesce(1)
    mixed.write.option("quote", "").csv(folder, header=True, mode="append")
    scan = csv_folder.scan_folder(d.spark, folder)
    (read,) = scan.frames.values()
    rejected = [(int(reason.rsplit(": ", 1)[1]),) for reason in scan.rejected.values()]
    bad = d.spark.createDataFrame(rejected, "n bigint").agg(F.sum("n").alias("n_rows"))
    counted = read.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.lit("read").alias("status"), "n_rows").unionByName(bad.select(F.lit("malformed").alias("status"), "n_rows"))


@query(
    "src_omop_id_ranges",
    """WITH shares AS (SELECT l_partkey AS k, ntile(16) OVER (ORDER BY l_partkey) AS share_no FROM lineitem),
lows AS (SELECT DISTINCT min(k) OVER (PARTITION BY share_no) AS low FROM shares),
ranges AS (SELECT row_number() OVER (ORDER BY low) - 1 AS id_range, low, lead(low) OVER (ORDER BY low) AS high FROM lows)
SELECT CAST(id_range AS INTEGER) AS id_range, count(*) AS n_rows
FROM ranges JOIN lineitem ON l_partkey >= low AND (high IS NULL OR l_partkey < high) GROUP BY id_range""",
)
def _(d):
    """Rows of each id range a table is read in; the ranges come from the text a database would get."""
    rows = d["lineitem"].select("l_partkey")
    cuts = d.spark.sql(tables.cuts_query("{rows}", "l_partkey", 16), rows=rows).collect()
    ranges = tables.range_predicates("l_partkey", [r.low for r in cuts])
    number = F.coalesce(*[F.when(F.expr(p), i) for i, p in enumerate(ranges)])
    return rows.groupBy(number.alias("id_range")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "src_header_normalize",
    over("coordinates", "SELECT entity_id, year, latitude, longitude FROM coordinates"),
)
def _(d):
    return csv_folder.normalize_header(d["coordinates"].toDF(" Entity_ID", "YEAR ", "Latitude", "\tlongitude"))


@query(
    "src_detect_shape",
    over(
        "coordinates address_multi",
        "SELECT 'coordinates' AS shape, count(*) AS n_rows FROM coordinates UNION ALL "
        "SELECT 'multi', count(*) FROM address_multi UNION ALL SELECT 'single', count(*) FROM address_multi",
    ),
)
def _(d):
    scan = csv_folder.scan_folder(d.spark, _csv_inputs(d))
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(shape).alias("shape"), "n_rows")
        for shape, df in scan.frames.items()
    ]
    return locations.union_vintages(*counts)


@query("src_require_location", over("location", f"SELECT {_LOCATION_LIST} FROM location"))
def _(d):
    csv_folder.require_location(d["location"].columns)
    return d["location"].select(*LOCATION_COLUMNS)


@query("src_require_location_history", over("location_history", "SELECT * FROM location_history"))
def _(d):
    csv_folder.require_location_history(d["location_history"].columns)
    return d["location_history"].select(*LOCATION_HISTORY_COLUMNS)


@query("src_omop_tables", over(_VISIT_TABLES, "SELECT * FROM visit_rows", _visit_rows()))
def _(d):
    folder = _scratch(d, "cdm")
    for table, source in (("person", "person"), ("visit_occurrence", "visit"), ("location", "location")):
        d[source].write.parquet(f"{folder}/{table}.parquet")
    d["location_history"].write.parquet(f"{folder}/location_history.parquet")
    cdm = tables.read_parquet_tables(d.spark, folder)
    return visits.visits_in_residence(cdm.person, cdm.visit, cdm.location, cdm.history, cutoff=CUTOFF)


@query(
    "src_incremental_files",
    over(
        "coordinates",
        "SELECT CAST(entity_id AS VARCHAR) AS entity_id, CAST(year AS VARCHAR) AS year, "
        f"{_no_marker('latitude')}, {_no_marker('longitude')}, CAST(entity_id % 2 AS INTEGER) AS batch_id FROM coordinates",
    ),
)
def _(d):
    """Two deliveries and a repeat: each file is taken up once, in the run after it arrived."""
    folder, target, checkpoint = (_scratch(d, label) for label in ("inbox", "table", "progress"))
    for part in (0, 1):
        d["coordinates"].where(F.col("entity_id") % 2 == part).write.csv(folder, mode="append", **_CSV_TEXT)
        for _ in range(2):
            incremental.append_new_files(d.spark, folder, target, checkpoint, csv_folder.COORDINATES)
    return d.spark.read.parquet(target).drop("source_file")


@query(
    "src_incremental_manifest",
    over(
        "coordinates",
        "SELECT CAST(entity_id AS VARCHAR) AS entity_id, CAST(year AS VARCHAR) AS year, "
        f"{_no_marker('latitude')}, {_no_marker('longitude')} FROM coordinates WHERE year >= 2018",
    ),
)
def _(d):
    """The batch form: the manifest lists what an earlier run read."""
    folder = _scratch(d, "inbox")
    d["coordinates"].where("year < 2018").write.csv(folder, mode="append", **_CSV_TEXT)
    manifest = _scratch(d, "manifest")
    nothing = d.spark.createDataFrame([], "file_name string")
    incremental.record_files(incremental.files_to_do(d.spark, folder, nothing), manifest)
    d["coordinates"].where("year >= 2018").write.csv(folder, mode="append", **_CSV_TEXT)
    new = [r.path for r in incremental.files_to_do(d.spark, folder, d.spark.read.parquet(manifest)).collect()]
    return csv_folder.scan_files(d.spark, new).frames[csv_folder.COORDINATES].drop("source_file")


# --- sinks -----------------------------------------------------------------------------------


def _typed(df: DataFrame, *texts: str) -> DataFrame:
    """Values of a written result back in the types they were written from; ``texts`` were texts."""
    types = {
        "entity_id": "bigint", "year": "int", "latitude": "double", "longitude": "double", "reason": "string",
        "location_id": "bigint", "person_id": "bigint", "visit_occurrence_id": "bigint", "visit_start_date": "date",
        "start_date": "date", "end_date": "date", "relationship_type_concept_id": "int", "domain_id": "int",
    }
    df = df.withColumns({c: F.col(c).cast(types[c]) for c in df.columns if c in types and c not in texts})
    return df.fillna({"reason": ""}) if "reason" in df.columns else df


@query(
    "sink_with_coordinates",
    over(
        _ADDRESS_TABLES,
        "SELECT entity_id, year, latitude, longitude, geocode_result, reason, "
        "'file_' || entity_id % 7 || '.csv' AS source_file FROM placed",
        _placed_sql(single=False),
    ),
)
def _(d):
    folder = _scratch(d, "with-coordinates")
    rows = linkage.geocode_addresses(_from_files(d["address_multi"]), d["address_points"], d["hospitals"])
    files.write_with_coordinates(rows, folder)
    return _typed(_read_back(d, folder))


def _from_files(df: DataFrame) -> DataFrame:
    """Rows as if read from seven files."""
    return df.withColumn("source_file", F.concat(F.lit("file_"), F.col("entity_id") % 7, F.lit(".csv")))


@query(
    "sink_with_fips",
    f"SELECT *, 'file_' || entity_id % 7 || '.csv' AS source_file FROM ({_linked_addresses_sql(single=False)})",
)
def _(d):
    folder = _scratch(d, "with-fips")
    rows = _from_files(d["address_multi"])
    files.write_with_fips(linkage.link_addresses(rows, d["address_points"], d.tracts, d["hospitals"]), folder)
    return _typed(_read_back(d, folder))


@query(
    "sink_location",
    over(
        "location",
        "SELECT location_id, "
        + ", ".join(f"nullif({q.strip(c)}, '') AS {c}" for c in LOCATION_COLUMNS[1:])
        + " FROM location",
    ),
)
def _(d):
    folder = _scratch(d, "location")
    files.write_location(d["location"].withColumn("FIPS", F.lit("x")), folder)
    return _read_back(d, folder).withColumn("location_id", F.col("location_id").cast("bigint"))


@query("sink_location_history", over("location_history", "SELECT * FROM location_history"))
def _(d):
    folder = _scratch(d, "location-history")
    files.write_location_history(d["location_history"], folder)
    return _typed(_read_back(d, folder))


_WRITTEN_VISIT = (
    "person_id, visit_occurrence_id, visit_start_date, year, location_id, "
    + ", ".join(f"nullif({c}, '') AS {c}" for c in LOCATION_COLUMNS[1:])
)


@query(
    "sink_category_batches",
    over(
        _VISIT_TABLES,
        f"SELECT {_WRITTEN_VISIT}, {_CATEGORY} AS category, CAST(floor((row_number() OVER (PARTITION BY {_CATEGORY} "
        "ORDER BY person_id, visit_start_date, visit_occurrence_id) - 1) / 500) AS INTEGER) AS page FROM visit_rows",
        _visit_rows(),
    ),
)
def _(d):
    folder = _scratch(d, "batches")
    files.write_category_batches(visits.classify(_located_visits(d)), folder, batch_rows=500)
    return _typed(_read_back(d, folder), "latitude", "longitude")


@query(
    "sink_invalid",
    over(
        _VISIT_TABLES,
        f"SELECT {_WRITTEN_VISIT} FROM visit_rows WHERE {_CATEGORY} = 'Invalid'",
        _visit_rows(),
    ),
)
def _(d):
    folder = _scratch(d, "invalid")
    files.write_invalid(visits.classify(_located_visits(d)), folder)
    return _typed(_read_back(d, folder), "latitude", "longitude")


# --- whole jobs ------------------------------------------------------------------------------

_CODED = "entity_id, year, latitude, longitude, FIPS"


@query(
    "run_folder",
    f"SELECT 'multi' AS shape, {_CODED} FROM ({_linked_addresses_sql(single=False)}) UNION ALL "
    f"SELECT 'single', {_CODED} FROM ({_linked_addresses_sql(single=True)}) UNION ALL "
    f"SELECT 'coordinates', entity_id, CAST(year AS INTEGER), {q.number('latitude')}, {q.number('longitude')}, FIPS "
    f"FROM ({ORACLES['link_coordinates']})",
)
def _(d):
    output = _scratch(d, "folder-results")
    jobs.run_folder(d.spark, _csv_inputs(d), output, d["address_points"], d.tracts, d["hospitals"])
    shapes = []
    for shape in (csv_folder.MULTI, csv_folder.SINGLE, csv_folder.COORDINATES):
        rows = _read_back(d, f"{output}/with_fips/{shape}")
        types = {"entity_id": "bigint", "year": "int", "latitude": "double", "longitude": "double", "FIPS": "string"}
        shapes.append(rows.select(F.lit(shape).alias("shape"), *[F.col(c).try_cast(t).alias(c) for c, t in types.items()]))
    return locations.union_vintages(*shapes)


@query(
    "run_cdm",
    "SELECT person_id, visit_occurrence_id, visit_start_date, year, location_id, "
    + ", ".join(_no_marker(c) for c in LOCATION_COLUMNS[1:10])
    + f", latitude, longitude, category, geocode_result, reason, FIPS FROM ({ORACLES['link_visits']})",
)
def _(d):
    """The clinical tables as CSV files with dates as month, day and year."""
    folder, output = _scratch(d, "cdm-csv"), _scratch(d, "cdm-results")
    sources = {"PERSON": "person", "VISIT_OCCURRENCE": "visit", "LOCATION": "location", "LOCATION_HISTORY": "location_history"}
    for name, source in sources.items():
        df = d[source]
        dates = {c: F.date_format(c, "MM/dd/yyyy") for c, kind in df.dtypes if kind == "date"}
        df.withColumns(dates).write.csv(f"{folder}/{name}.csv", **_CSV_TEXT)
    cdm = tables.read_csv_tables(d.spark, folder)
    jobs.run_cdm(cdm, output, d.tracts, d["address_points"], d["hospitals"], cutoff=CUTOFF, pivot=VISIT_PIVOT)
    return _typed(_read_back(d, f"{output}/with_fips"))
