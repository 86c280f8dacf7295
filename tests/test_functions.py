"""Hand-made boundary rows (FIXTURES §4) for the column expressions."""

import datetime as dt

from pyspark.sql import functions as F

from pitchside.functions import (
    alias_exact, alias_regex, bin_label, code_prefix, coerce_double, coerce_int, day_name,
    infer_group, month_name, parse_date, strip_ws, temperature_range_label, title_case,
    weekday0, weekend_flag,
)
from pitchside.functions.labels import climate_zone, decade, outcome_label, range_bucket, winner_label


def col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_bins_right_closed(spark):
    assert col(spark, [9.9, 10.0, 20.0, 30.0, 30.1], "double", bin_label) == \
        ["Cold", "Cold", "Moderate", "Warm", "Hot"]


def test_bins_left_closed_and_null(spark):
    got = col(spark, [9.9, 10.0, 20.0, 30.0, None], "double", lambda c: bin_label(c, closed="left"))
    assert got == ["Cold", "Moderate", "Warm", "Hot", None]


def test_range_label_null_falls_to_last_branch(spark):
    got = col(spark, [5.0, 15.0, 25.0, None], "double", temperature_range_label)
    assert got == ["Cold (< 10°C)", "Moderate (10-20°C)", "Warm (20-30°C)", "Hot (> 30°C)"]


def test_climate_zone_and_buckets(spark):
    assert col(spark, [14.9, 15.0, 25.0, None], "double", climate_zone) == \
        ["Temperate", "Subtropical", "Tropical", "Tropical"]
    assert col(spark, [12.4, 12.5, 13.0], "double", range_bucket) == [10.0, 15.0, 15.0]
    assert col(spark, [1994, 2000, 1930], "int", decade) == [1990, 2000, 1930]


def test_bad_date_and_bad_score(spark):
    assert col(spark, ["bad", "2014-06-14", "1950-07", None], "string", parse_date) == \
        [None, dt.date(2014, 6, 14), dt.date(1950, 7, 1), None]
    assert col(spark, ["x", None, "3", "3.7", " 2 ", "NaN"], "string", coerce_int) == [0, 0, 3, 3, 2, 0]
    assert col(spark, ["1.5", "x", "NaN"], "string", coerce_double) == [1.5, None, None]


def test_weekday_names_weekend(spark):
    d = [dt.date(2014, 6, 14)]
    assert col(spark, d, "date", weekday0) == [5]
    assert col(spark, d, "date", day_name) == ["Saturday"]
    assert col(spark, d, "date", month_name) == ["June"]
    assert col(spark, d, "date", weekend_flag) == [1]


def test_alias_substring_chain(spark):
    got = col(spark, ["Korea DPR", 'rn">West Germany', "USA", "Korea Republic", "IR Iran", "Brazil"],
              "string", alias_regex)
    assert got == ["North Korea", "West Germany", "United States", "South Korea", "Iran", "Brazil"]
    # replacements apply in order, each on the result of the previous one
    chained = col(spark, ["NATION_10", "NATION_2"], "string",
                  lambda c: alias_regex(c, (("NATION_1", "NATION_ONE_"), ("ONE_0", "TEN"))))
    assert chained == ["NATION_TEN", "NATION_2"]


def test_alias_exact_and_strip(spark):
    got = col(spark, ["Korea", "Korea Republic", "Republic of Korea", "Iran (Islamic Republic of)", None],
              "string", alias_exact)
    assert got == ["South Korea", "Korea Republic", "South Korea", "Iran", None]
    assert col(spark, ["  a b \t", "\nx", None], "string", strip_ws) == ["a b", "x", None]


def test_codes_groups_titles(spark):
    assert col(spark, ["Brazil", "Germany FR", "Korea Republic", "USA", "Ghana", "Saudi Arabia", "Fiji"],
               "string", infer_group) == ["CONMEBOL", "UEFA", "Other", "CONCACAF", "CAF", "AFC", "Other"]
    assert col(spark, ["Brazil", "ab"], "string", code_prefix) == ["BRA", "AB"]
    assert col(spark, ["korea/japan", "USA"], "string", title_case) == ["Korea/japan", "Usa"]


def test_winner_outcome(spark):
    df = spark.createDataFrame([(2, 1), (0, 3), (1, 1)], "h int, a int")
    rows = df.select(winner_label("h", "a", F.lit("H"), F.lit("A")), outcome_label("h", "a")).collect()
    assert [tuple(r) for r in rows] == [("H", "Home Win"), ("A", "Away Win"), ("Draw", "Draw")]
