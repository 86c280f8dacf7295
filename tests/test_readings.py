"""Readings keep all their digits: values just past a bin bound get the right label."""

from datetime import date

from pitchside.operators import enrich as E


def test_seven_decimals_survive(spark):
    readings = spark.createDataFrame(
        [("A", 2000, 1, 4.8556466), ("B", 2000, 1, 10.0000003), ("C", 2000, 1, 30.0000004), ("D", 2000, 1, 10.0), ("E", 2000, 1, 1.0), ("E", 2000, 1, 2.0000001)],
        "country string, year int, month_num int, temperature double")
    got = {r.country: (r.avg_temperature_celsius, r.temperature_category) for r in E.prepare_readings(readings).collect()}
    assert got == {"A": (4.8556466, "Cold"), "B": (10.0000003, "Moderate"), "C": (30.0000004, "Hot"), "D": (10.0, "Cold"), "E": (1.50000005, "Cold")}
    yearly = {r.country: r._year_temp for r in E.yearly_from_monthly(E.prepare_readings(readings)).collect()}
    assert yearly["A"] == 4.8556466
    matches = spark.createDataFrame([(date(2000, 2, 1), "B", 2000, 2)], "match_date date, country string, year int, month int")
    row = E.enrich(matches, readings).first()
    assert (row.avg_temperature_celsius, row.temperature_category) == (10.0000003, "Moderate")
