"""Text cleaning as native column expressions (JVM side, no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when a field is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Text that means "no value", after stripping and lower-casing.
BLANK_TEXT = ("nan", "na", "n/a", "none", "null", "")
BLANK_COORDINATE_TEXT = ("", "na", "null", "none", "nan", "0", "n/a")

# Upper case starts at a cased letter that does not follow a cased letter. \p{L} would be wrong
# here: scripts without case do not end a word's first-letter position.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_REST_OF_TEXT = 2**31 - 1
# Marks a word start that no space announces. Text that already holds it takes the slower way.
_MARK = "\x01"


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def zip_strip_suffix(c: Column) -> Column:
    """ZIP as text without one trailing ``.0``; NULL becomes blank."""
    return strip(F.regexp_replace(null_to_blank(c), r"\.0$", ""))


def zip_before_dot(c: Column) -> Column:
    """The part of a ZIP before its first dot, the form used when an address is composed."""
    return F.substring_index(null_to_blank(c), ".", 1)


def zip_compare_form(c: Column) -> Column:
    """ZIP as compared with the hospital list."""
    return F.regexp_replace(F.lower(strip(c)), r"\.0$", "")


def title_case(c: Column) -> Column:
    """Upper-case every cased letter that follows a character without case: ``16th`` -> ``16Th``.

    ``initcap`` starts words at spaces only, so a marked space is put before every other word start
    and taken out again. The cost is linear in the text length.
    """
    marked = F.regexp_replace(c, f"([^{_CASED} ])(?=[{_CASED}])", f"$1{_MARK} ")
    titled = F.replace(F.initcap(marked), F.lit(f"{_MARK} "), F.lit(""))
    return F.when(F.contains(c, F.lit(_MARK)), _title_by_pieces(c)).otherwise(titled)


def _title_by_pieces(c: Column) -> Column:
    """The same for any text: cut at word starts and capitalise the first character of each piece."""
    pieces = F.split(F.lower(c), f"(?<![{_CASED}])(?=[{_CASED}])")
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.initcap(F.substring(p, 1, 1)), F.substring(p, 2, _REST_OF_TEXT))),
        "",
    )


def strip_punctuation(c: Column) -> Column:
    """Each character outside ``[a-zA-Z0-9 ]`` becomes one space; runs are kept."""
    return F.regexp_replace(c, "[^a-zA-Z0-9 ]", " ")


def join_parts(*parts: Column) -> Column:
    """Parts joined by one space and lower-cased; blank parts leave their spaces behind."""
    return F.lower(F.concat_ws(" ", *[null_to_blank(p) for p in parts]))


def compose_multi(street: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Address text of a row that has its parts in separate columns."""
    return strip_punctuation(title_case(join_parts(street, city, state, zip_before_dot(zip_code))))


def compose_single(address: Column) -> Column:
    """Address text of a row that has one address column."""
    return strip_punctuation(title_case(null_to_blank(address)))


def compose_location(address_1: Column, address_2: Column, city: Column, state: Column, zip_code: Column) -> Column:
    """Address text of a LOCATION row."""
    parts = [null_to_blank(p) for p in (address_1, address_2, city, state, zip_code)]
    return strip(F.concat_ws(" ", *parts))


def is_blank(c: Column) -> Column:
    """True for NULL and for text that stands for a missing value."""
    return F.lower(strip(null_to_blank(c))).isin(*BLANK_TEXT)


def is_blank_coordinate(c: Column, numeric: bool = False) -> Column:
    """The blank test used to sort visits into categories; it also treats ``0`` as missing.

    Only spaces are trimmed, so a lone tab is not blank. ``numeric`` is for sources that store
    coordinates as numbers.
    """
    if numeric:
        return c.isNull() | F.isnan(c) | (c == 0)
    return F.lower(F.trim(null_to_blank(c))).isin(*BLANK_COORDINATE_TEXT)


def match_form(c: Column) -> Column:
    """Lower-case letters and digits separated by single spaces, for address matching."""
    return F.lower(F.trim(F.regexp_replace(c, "[^a-zA-Z0-9]+", " ")))


# Words that announce a unit; its own name is a number with a letter at most, or one letter.
UNIT = r"(?i)[\s,]+(?:apt|apartment|unit|ste|suite|rm|room|lot|#)[\s.#]*(?:[a-z]?\d+[a-z]?|[a-z])(?:-[a-z0-9]+)?\b"


def without_unit(c: Column) -> Column:
    """An address without its unit: ``100 Oak St Apt 204`` -> ``100 Oak St``."""
    return F.regexp_replace(c, UNIT, " ")


def zip5(c: Column) -> Column:
    """Five digits of a ZIP in match form; three or four digits have lost their leading zeros."""
    first = F.substring_index(c, " ", 1)
    return F.when(first.rlike(r"^\d{3,4}$"), F.lpad(first, 5, "0")).otherwise(F.substring(c, 1, 5))
