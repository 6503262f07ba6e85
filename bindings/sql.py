"""Pieces of SQL the checks are built from, written apart from the package's expressions."""

from __future__ import annotations

from bindings.domain import TRACT_EDGES, duckdb_text

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
MARKERS = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)


def derived(*names: str) -> str:
    """CTE list of derived tables, to follow WITH."""
    return ",\n".join(f"{n} AS ({TRACT_EDGES if n == 'tract_edges' else duckdb_text(n)})" for n in names)


def strip(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def blank(x: str) -> str:
    return f"(lower({strip(text(x))}) IN ('nan', 'na', 'n/a', 'none', 'null', ''))"


def blank_coordinate(x: str) -> str:
    return f"(lower(trim({text(x)})) IN ('', 'na', 'null', 'none', 'nan', '0', 'n/a'))"


def number(x: str) -> str:
    cast = f"TRY_CAST({strip(f'CAST({x} AS VARCHAR)')} AS DOUBLE)"
    return f"(CASE WHEN isfinite({cast}) THEN {cast} END)"


def has_coordinates(lat: str, lon: str) -> str:
    return f"coalesce({number(lat)} BETWEEN -90 AND 90 AND {number(lon)} BETWEEN -180 AND 180, false)"


def whole_year(x: str) -> str:
    return f"(CASE WHEN {number(x)} = floor({number(x)}) THEN TRY_CAST({number(x)} AS INTEGER) END)"


def vintage(year: str, pivot: int = 2020) -> str:
    return f"CAST(CASE WHEN {year} < {pivot} THEN 2010 ELSE 2020 END AS INTEGER)"


def title(x: str) -> str:
    """Runs of cased letters with their first letter raised; all else is left as it is."""
    runs = f"regexp_extract_all(lower({x}), '[\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}ªº]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}ªº]+')"
    return (
        f"array_to_string(list_transform({runs}, "
        "lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || r[2:]), '')"
    )


def punct(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9 ]', ' ', 'g')"


def match_form(x: str) -> str:
    return f"lower(trim(regexp_replace({punct(x)}, ' +', ' ', 'g')))"


def known(x: str) -> str:
    return f"(CASE WHEN {blank(x)} THEN '' ELSE {match_form(text(x))} END)"


def zip_suffix(x: str) -> str:
    return strip(f"regexp_replace({text(x)}, '\\.0$', '')")


def joined(street: str, city: str, state: str, zip_code: str) -> str:
    zip_text = f"split_part({text(zip_code)}, '.', 1)"
    return f"lower({text(street)} || ' ' || {text(city)} || ' ' || {text(state)} || ' ' || {zip_text})"


def hospital_form(street: str, city: str, state: str, zip_code: str) -> str:
    parts = " || ' ' || ".join(f"lower({strip(text(p))})" for p in (street, city, state))
    code = f"regexp_replace(lower({strip(text(zip_code))}), '\\.0$', '')"
    return strip(f"{parts} || ' ' || {code}")


def reason(result: str, hospital: str, *parts: str) -> str:
    b = [blank(p) for p in parts] or ["true"] * 4
    street, city, state, zip_code = b
    return (
        f"CASE WHEN {result} = 'Geocoded' THEN CASE WHEN {hospital} THEN 'Hospital address given' ELSE '' END "
        f"WHEN {street} AND {city} AND {state} AND {zip_code} THEN 'Blank/Incomplete address' "
        f"WHEN {zip_code} THEN 'Zip missing' WHEN {street} THEN 'Street missing' ELSE '' END"
    )


def result(lat: str, lon: str) -> str:
    return f"CASE WHEN {has_coordinates(lat, lon)} THEN 'Geocoded' ELSE 'Imprecise Geocode' END"


def fips(tract_id: str) -> str:
    return f"right('00000000000' || {tract_id}, 11)"


def without_unit(x: str) -> str:
    units = "apt|apartment|unit|ste|suite|rm|room|lot|#"
    name = "([a-z]?[0-9]+[a-z]?|[a-z])(-[a-z0-9]+)?"
    return f"regexp_replace({x}, '(?i)[\\s,]+({units})[\\s.#]*{name}\\b', ' ', 'g')"


def street(x: str) -> str:
    return f"(CASE WHEN {blank(x)} THEN '' ELSE {match_form(without_unit(text(x)))} END)"


def _zip5(x: str) -> str:
    first = f"split_part({x}, ' ', 1)"
    return f"(CASE WHEN regexp_full_match({first}, '[0-9]{{3,4}}') THEN lpad({first}, 5, '0') ELSE substr({x}, 1, 5) END)"


def _number(x: str) -> str:
    return f"regexp_extract({x}, '^([0-9]+)\\b', 1)"


def _numbers(x: str) -> str:
    return f"regexp_extract_all({x}, '[0-9]+')"


# Every address point with the forms that queries are compared with.
POINTS = f"""
points AS (
    SELECT point_id, latitude, longitude, street, city, state, zip,
           {street('street')} AS p_street, {known('city')} AS p_city, {known('state')} AS p_state,
           {_zip5(known(f"split_part({text('zip')}, '.', 1)"))} AS p_zip
    FROM address_points),
points_keyed AS (
    SELECT *, {_number('p_street')} AS p_number, p_city || ' ' || p_state AS p_place FROM points)"""

_BEST = """
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, point_id) AS place_in_row
        FROM {scored} WHERE score >= 7e-1)
    WHERE place_in_row = 1"""


def match_multi(rows: str) -> str:
    """CTEs ending in ``best(rid, ...)`` for a relation with rid, street, city, state, zip."""
    return f"""{POINTS},
asked AS (
    SELECT rid, {street('street')} AS q_street, {known('city')} AS q_city, {known('state')} AS q_state,
           {_zip5(known(f"split_part({text('zip')}, '.', 1)"))} AS q_zip
    FROM {rows}),
asked_keyed AS (SELECT *, {_number('q_street')} AS q_number FROM asked),
scored AS (
    SELECT rid, p.*, 1e0 - levenshtein(q_street, p_street) / greatest(length(q_street), length(p_street)) AS score
    FROM asked_keyed q JOIN points_keyed p
      ON q_number <> '' AND q_number = p_number AND {_numbers('q_street')} = {_numbers('p_street')}
     AND CASE WHEN q_zip <> '' THEN q_zip = p_zip
              ELSE q_city <> '' AND q_state <> '' AND q_city = p_city AND q_state = p_state END),
best AS ({_BEST.format(scored='scored')})"""


def match_single(rows: str) -> str:
    """The same for a relation with rid and one composed ``address`` text."""
    end = "' ([0-9]{3,5})( [0-9]{4})?$'"
    return f"""{POINTS},
asked AS (
    SELECT rid, {match_form('address')} AS q_all FROM {rows} WHERE address IS NOT NULL),
asked_keyed AS (
    SELECT rid, {_zip5(f"regexp_extract(q_all, {end}, 1)")} AS q_zip, regexp_replace(q_all, {end}, '') AS q_text,
           {_number(f"regexp_replace(q_all, {end}, '')")} AS q_number
    FROM asked),
places AS (SELECT DISTINCT p_place FROM points_keyed WHERE p_city <> '' AND p_state <> ''),
asked_places AS (
    SELECT q_text, arg_max(p_place, length(p_place)) AS q_place
    FROM (SELECT DISTINCT q_text FROM asked_keyed WHERE q_zip = '') JOIN places ON ends_with(q_text, ' ' || p_place)
    GROUP BY q_text),
pairs AS (
    SELECT rid, p.*,
           CASE WHEN ends_with(q_text, ' ' || p_place)
                THEN left(q_text, length(q_text) - length(p_place) - 1) ELSE q_text END AS a,
           CASE WHEN ends_with(q_text, ' ' || p_place) THEN p_street ELSE p_street || ' ' || p_place END AS b
    FROM asked_keyed q LEFT JOIN asked_places USING (q_text) JOIN points_keyed p
      ON q_number <> '' AND q_number = p_number
     AND {_numbers('q_text')} = {_numbers("p_street || ' ' || p_place")}
     AND CASE WHEN q_zip <> '' THEN q_zip = p_zip
              ELSE p_city <> '' AND p_state <> '' AND q_place = p_place END),
scored AS (SELECT *, 1e0 - levenshtein(a, b) / greatest(length(a), length(b)) AS score FROM pairs),
best AS ({_BEST.format(scored='scored')})"""


def tract_hits(points: str, name: str = "hits") -> str:
    """CTE ``name(rid, v, tract_id)`` for a relation with rid, x, y, v: every edge, no grid."""
    return f"""{name} AS (
    SELECT rid, v, min(tract_id) AS tract_id FROM (
        SELECT p.rid, p.v, e.tract_id
        FROM {points} p JOIN tract_edges e
          ON e.vintage = p.v AND (e.y1 > p.y) <> (e.y2 > p.y)
         AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / nullif(e.y2 - e.y1, 0) + e.x1
        GROUP BY p.rid, p.v, e.tract_id HAVING count(*) % 2 = 1)
    GROUP BY rid, v)"""
