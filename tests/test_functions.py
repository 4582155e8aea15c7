import math

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import geo, numbers, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("function", "value", "want"),
    [
        (text.fold_accents, " ÉMILE Öz ", "emile oz"), (text.fold_accents, None, None), (text.normal_name, "J.R. Groß-Müller", "j r gross muller"), (text.normal_name, "Işık", "isik"),
        (text.name_tokens, "  Ana-María  Díaz ", ["ana", "maria", "diaz"]), (text.name_tokens, "", []), (text.latin_letters, "O'Neil-3 Ñ", "oneil n"),
        (text.strip_notes, "Paris[1] (old) [note a]", "Paris"), (text.strip_code, "Ann Lee (FRA)", "Ann Lee"), (text.strip_code, "Ann (Lee)", "Ann (Lee)"),
        (text.strip_qualifier, "3rd arrondissement of Paris", "Paris"), (text.strip_qualifier, "Alpha City DISTRICT", "Alpha"), (text.strip_qualifier, "Beta Municipality", "Beta"),
        (text.strip_qualifier, "Beta municipality", None), (text.strip_qualifier, "Gamma District", "Gamma"), (text.strip_qualifier, "Delta", None),
        (text.given_and_surname, "DE SILVA Ana Maria", "Ana De Silva"), (text.surname, "Pelé", "Pelé"), (text.surname, "Virgil van Dijk", "van Dijk"), (text.surname, "Ana de la Cruz", "de la Cruz"),
        (text.surname, "Ana Maria Cruz", "Cruz"), (text.title_of_link, "//h.org/wiki/A_b%C3%A9+c#x", "A bé+c"), (text.title_of_link, "/wiki/X", "X"), (text.title_of_link, "https://h.org/w/X", None),
        (text.link_of_title, "A b (c)/é", "A_b_(c)/%C3%A9"), (text.last_token, "1 GK", "GK"), (text.id_list, "3;1;2", ["3", "1", "2"]), (text.id_list, "", []),
        (text.metaphone, None, None),
        (numbers.parse_number, "1,234.5", 1234.5), (numbers.parse_number, "..", None), (numbers.parse_number, "x1", None), (numbers.period_midpoint, "2018 to 2021", 2019), (numbers.period_midpoint, "2018", None),
        (numbers.is_sovereign, "GB-ENG", False), (numbers.is_sovereign, "FR", True), (numbers.none_if_blank, "", None),
    ],
)
def test_of_text(spark, function, value, want):
    assert one(spark, function(F.lit(value).cast("string"))) == want


def test_metaphone_keys(spark):
    same = [("Smith", "Smyth"), ("Philip", "Filip"), ("Catherine", "Katherine"), ("Wright", "Rite")]
    rows = spark.createDataFrame(same, "a string, b string").select(text.metaphone("a").alias("a"), text.metaphone("b").alias("b")).collect()
    assert [r["a"] == r["b"] for r in rows[:3]] == [True] * 3


def test_places_and_parts(spark):
    assert tuple(one(spark, text.split_place(F.lit("Lyon, Rhône, France[2]")))) == ("Lyon", "France")
    assert tuple(one(spark, text.split_place(F.lit("France")))) == ("", "France") and tuple(one(spark, text.split_place(F.lit("nan")))) == ("", "")
    assert one(spark, text.joined_ids(F.array(F.lit("b"), F.lit("a"), F.lit("b")))) == "a;b"
    parts = lambda s: text.name_tokens(F.lit(s))
    assert one(spark, text.tail_compatible(parts("J Smith"), parts("Ann John Smith"))) and not one(spark, text.tail_compatible(parts("K Smith"), parts("Ann John Smith")))
    assert one(spark, text.similarity(F.lit("abcd"), F.lit("bcde"))) == pytest.approx(0.75)


def test_numbers(spark):
    assert one(spark, numbers.ratio(F.lit(7), F.lit(3))) == 2.33 and one(spark, numbers.ratio(F.lit(7), F.lit(0))) is None
    assert one(spark, numbers.millions(F.lit(1234567))) == 1.23 and one(spark, numbers.none_if_zero(F.lit(0))) is None
    assert one(spark, numbers.scaled_currency(F.lit(2500.0), F.lit(1.25))) == 3.13
    assert tuple(one(spark, numbers.point_of_wkt(F.lit("Point(-3.5 40.25)")))) == (40.25, -3.5) and one(spark, numbers.point_of_wkt(F.lit("x"))) is None
    stats = F.array(F.struct(F.lit("Fouls").alias("type"), F.lit("9").alias("value")), F.struct(F.lit("Cards").alias("type"), F.lit(None).cast("string").alias("value")))
    assert [one(spark, numbers.statistic(stats, k)) for k in ("Fouls", "Cards", "None")] == [9, 0, 0]
    latest = lambda *v: one(spark, numbers.latest_value([F.lit(x).cast("string") for x in v]))
    assert latest("..", None, "0.8", "0.7") == 0.8 and latest("..", "x", "0.7") is None
    assert one(spark, numbers.month_index(F.lit(2024), F.lit(1))) == 24288


def test_geo(spark):
    km = one(spark, geo.haversine_km(*map(F.lit, (48.8566, 2.3522, 51.5074, -0.1278))))
    assert km == pytest.approx(343.6, abs=1)
    assert one(spark, geo.gaussian_density(F.lit(5.0), F.lit(0.0), 75.0)) == pytest.approx(5 / (2 * math.pi * 75**2))
    assert one(spark, geo.log2_risk(F.lit(2.0), F.lit(4.0), F.lit(0.5), 10.0)) == pytest.approx(0)
