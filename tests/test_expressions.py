import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tractline.functions import status, text, values

def a():
    return F.col("a")


def test_zip_forms(column):
    zips = [None, "02139", "32209.0", " 32209 ", "32209-1234", "32209.0.0", "\t32209\n", "32209.0 "]
    assert column(zips, text.zip_strip_suffix(a())) == [
        "", "02139", "32209", "32209", "32209-1234", "32209.0", "32209", "32209.0",
    ]
    assert column(["32209.0", None, "a.b.c", "x"], text.zip_before_dot(a())) == ["32209", "", "a", "x"]
    assert column([" AB1.0 ", "32209", None], text.zip_compare_form(a())) == ["ab1", "32209", None]


def test_title_case_follows_any_character_without_case(column):
    given = ["1250 w 16th st", "o'brien", "ÉLAN-vital", "straße ßa", "東京a b", "a\x01 b\x01c", "x1ªy", "", None, "  a"]
    assert column(given, text.title_case(a())) == [g if g is None else g.title() for g in given]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=126), max_size=30), min_size=1, max_size=20))
def test_title_case_on_ascii(column, words):
    assert column(words, text.title_case(a())) == [w.title() for w in words]


def test_compose_keeps_the_spaces_of_blank_parts(spark):
    df = spark.createDataFrame([("12 Oak St.", None, "FL", "32209.0"), (None, None, None, None)], "a string, b string, c string, d string")
    got = [r.v for r in df.select(text.compose_multi(a(), F.col("b"), F.col("c"), F.col("d")).alias("v")).collect()]
    assert got == ["12 Oak St   Fl 32209", "   "]


def test_compose_location_trims_outside_only(spark):
    df = spark.createDataFrame([(" 1 A St", None, "B", "CA", None)], "a string, b string, c string, d string, e string")
    parts = [F.col(c) for c in "abcde"]
    assert df.select(text.compose_location(*parts).alias("v")).first().v == "1 A St  B CA"


def test_strip_punctuation_keeps_runs(column):
    assert column(["a,b  c#é1\n", None], text.strip_punctuation(a())) == ["a b  c  1 ", None]


@pytest.mark.parametrize("word", ["nan", "NA", "n/A", " None ", "NULL", "", "\t", " "])
def test_blank_text(column, word):
    assert column([word], text.is_blank(a())) == [True]


def test_blank_lists_differ(column):
    given = [None, "0", "0.0", "\t", "Nan", " n/a "]
    assert column(given, text.is_blank(a())) == [True, False, False, True, True, True]
    assert column(given, text.is_blank_coordinate(a())) == [True, True, False, False, True, True]
    numeric = text.is_blank_coordinate(a().try_cast("double"), numeric=True)
    assert column([None, "0", "0.0", "NaN", "1.5"], numeric) == [True, True, True, True, False]


def test_coordinates_in_range(column):
    cases = {
        "0": True, "0.0": True, "90": True, "90.1": False, "-90": True, "NaN": False, "inf": False, "abc": False,
        " 36.5 ": True, "1e1": True, "36.5d": False, ".5": True, "5.": True, "": False, None: False,
    }
    assert column(list(cases), values.has_coordinates(a(), F.lit("180"))) == list(cases.values())
    assert column(["1"], values.has_coordinates(a(), F.lit("-180.01"))) == [False]


def test_year_and_vintage(column):
    given = ["2019", "2020", None, "abc", "2019.0", "2019.5", " 2021 ", "1e99", "2e3"]
    years = [2019, 2020, None, None, 2019, None, 2021, None, 2000]
    assert column(given, values.year_of(a())) == years
    assert column(given, values.vintage_of(values.year_of(a()))) == [2010 if y and y < 2020 else 2020 for y in years]
    assert column(["1997"], values.vintage_of(values.year_of(a()), pivot=1998)) == [2010]


def test_dates_in_both_forms(column):
    given = ["2013-12-16", "12/16/2013", "16.12.2013", None]
    assert column(given, values.parse_date(a())) == [dt.date(2013, 12, 16)] * 2 + [None, None]


def test_fips_keeps_its_leading_zero(column):
    given = ["1001020100", "12031000101", "1001020100.0", "120310001011", "", None]
    assert column(given, values.format_fips(a())) == ["01001020100", "12031000101", "01001020100", None, None, None]


def test_reason_rules(spark):
    rows = [
        ("1 a st", "x", "FL", "32209", "30", "-80", False, ""),
        ("1 a st", "x", "FL", "32209", "30", "-80", True, status.HOSPITAL_GIVEN),
        ("1 a st", "x", "FL", "32209", None, None, True, ""),
        ("", "x", "FL", "33414", None, None, False, status.STREET_MISSING),
        (" nan ", "x", "FL", "NULL", None, None, False, status.ZIP_MISSING),
        ("n/a", None, "", "none", None, None, False, status.BLANK_ADDRESS),
        ("1 a st", "x", "FL", "32209", "91", "-80", False, ""),
    ]
    df = spark.createDataFrame(rows, "street string, city string, state string, zip string, lat string, lon string, h boolean, want string")
    df = df.withColumn("result", status.geocode_result(F.col("lat"), F.col("lon")))
    parts = [F.col(c) for c in ("street", "city", "state", "zip")]
    got = df.select("want", status.reason(F.col("result"), F.col("h"), *parts).alias("got"), status.reason(F.col("result"), F.col("h")).alias("single"), "result").collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert all(r.single == status.BLANK_ADDRESS for r in got if r.result == status.IMPRECISE)


def test_hospital_forms(spark):
    from tractline.operators.hospitals import HOSPITAL_ADDRESSES, default_hospitals, flag_hospitals

    df = spark.createDataFrame(
        [(" 240 NW 25th St ", "Miami", "FL", "33127.0"), ("240, NW 25th St", "Miami", "FL", "33127"), (None, None, None, None)],
        "street string, city string, state string, zip string",
    )
    form = status.hospital_form_multi(*[F.col(c) for c in df.columns])
    for known in (None, default_hospitals(spark)):
        got = [r.at_hospital for r in flag_hospitals(df, form, known).orderBy(F.col("zip").desc_nulls_last()).collect()]
        assert got == [True, False, False]
    single = df.select(text.compose_single(F.concat_ws(" ", *df.columns)).alias("s"))
    forms = [r.f for r in single.select(status.hospital_form_single(F.col("s")).alias("f")).collect()]
    # The comma leaves two spaces behind, so that address does not compare equal.
    assert forms[1] == "240  nw 25th st miami fl 33127" and forms[1] not in HOSPITAL_ADDRESSES


def test_rename_and_drop(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3, 4, 5)], "Latitude double, longitude double, _rid int, score int, keep int")
    assert values.short_coordinate_names(df).columns == ["lat", "lon", "_rid", "score", "keep"]
    assert values.long_coordinate_names(values.short_coordinate_names(df)).columns[:2] == ["latitude", "longitude"]
    assert values.drop_work_columns(df).columns == ["Latitude", "longitude", "keep"]
