"""Kept state: quarantine, reloaded years, partial aggregates, sketches, rules, buckets, the report document."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchside import schemas
from pitchside.functions.text import CONFEDERATION_RULES
from pitchside.operators import clean as C
from pitchside.operators import quality as Q
from pitchside.operators import rules as R
from pitchside.operators import sketches
from pitchside.plans import catalog, rollup
from pitchside.plans.pipeline import star_session
from pitchside.plans.storage_queries import matches_of_dates
from pitchside.session import scratch_path
from pitchside.sources import io, warehouse
from tests.conftest import SF0001
from tests.test_operators import raw_matches

PEOPLE = StructType().add("name", "string").add("age", "integer").add("note", "string")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# ---- quarantine

def test_csv_lines_that_do_not_fit_are_kept_as_they_were(spark, tmp_path):
    lines = ["name,age,note", "Ann,30,x", "Bob,many,y", "Cid,40", "Dan,50,a,b", '"E, F",60,"q q"', ",,"]
    (tmp_path / "p.csv").write_text("\n".join(lines))
    got = io.ingest(spark, str(tmp_path / "p.csv"), PEOPLE, str(tmp_path / "in"))
    assert sorted(map(tuple, got.rows.collect()), key=repr) == sorted([("Ann", 30, "x"), ("E, F", 60, "q q"), (None, None, None)], key=repr)
    assert sorted(r["line"] for r in got.quarantine.collect()) == ["Bob,many,y", "Cid,40", "Dan,50,a,b"]
    assert (got.lines, got.malformed) == (6, 3) and got.quarantine.first()["file"].endswith("p.csv")


def test_json_lines_and_a_source_without_faults(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"name": "Ann", "age": 3}\n{"name": "Bob", "age": "x"}\n{"name": \n')
    got = io.ingest(spark, str(tmp_path / "p.json"), PEOPLE, str(tmp_path / "in"))
    assert [r["name"] for r in got.rows.collect()] == ["Ann"] and got.quarantine.count() == 2 == got.malformed
    (tmp_path / "q.json").write_text('{"name": "Ann", "age": 3}\n')
    clean = io.ingest(spark, str(tmp_path / "q.json"), PEOPLE, str(tmp_path / "in2"))
    assert clean.rows.count() == 1 and clean.quarantine.count() == 0 == clean.malformed


# ---- rejects

def test_rejects_are_counted_by_the_write_that_cleans(spark):
    raw = raw_matches(spark, [
        ("bad", "C", "X", "A", "1", "0", "B"), ("2014-06-14", "C", "X", " A ", "x", "2", "B"),
        ("2014-06-14", "C", "X", "A", "5", "5", "B"), ("1920-01-01", "C", "X", "A", "1", "1", "B")])
    written, counts = C.clean_and_count(raw)
    assert {r.rule: r.rows for r in counts.collect()} == {"input": 4, "bad_date": 1, "out_of_years": 1, "duplicate_key": 1, "output": 1}
    assert written.count() == 1
    nothing, counts = C.clean_and_count(raw.where("Date = 'bad'"))
    assert {r.rule: r.rows for r in counts.collect()} == {"input": 1, "bad_date": 1, "out_of_years": 0, "duplicate_key": 0, "output": 0}
    none, counts = C.clean_and_count(raw.where(F.lit(False)))
    assert {r.rule: r.rows for r in counts.collect()} == dict.fromkeys(["input", "bad_date", "out_of_years", "duplicate_key", "output"], 0)


def test_the_source_is_scanned_once_for_the_rows_and_the_counts(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_matches(spark, [("2014-06-14", "C", "X", "A", "1", "2", "B")]).write.parquet(path)
    log = C.RejectLog()
    plan = C.clean_matches(spark.read.parquet(path), rejects=log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1


def test_pipeline_keeps_the_counts_of_its_own_run(spark):
    t = star_session(spark, SF0001)
    counts = {r["rule"]: r["rows"] for r in t["rejects"].collect()}
    assert counts["output"] == t["matches_clean"].count() and counts["input"] == sum(v for k, v in counts.items() if k != "input")


def test_contract_of_an_empty_and_broken_source(spark):
    raw = spark.createDataFrame([], schemas.RAW_MATCHES).drop("Round").withColumn("Year", F.col("Year").cast("long"))
    rows = {r["column_name"]: r for r in io.source_contract(raw, schemas.RAW_MATCHES, "matches").collect()}
    assert not rows["Round"]["present"] and not rows["Year"]["type_ok"] and rows["<rows>"]["actual_type"] == "empty"


# ---- years

def years_table(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, year int")


def test_a_year_loaded_twice_is_there_once(spark, tmp_path):
    path = str(tmp_path / "by_year")
    io.replace_years(years_table(spark, [(k, "a", 2000 + k % 3) for k in range(30)]), path)
    again = years_table(spark, [(100, "b", 2001), (101, "b", 2001)])
    for _ in range(2):
        io.replace_years(again, path, [2001])
    got = spark.read.parquet(path).groupBy("year").agg(F.count("id").alias("n"), F.max("v").alias("v")).collect()
    assert {tuple(r) for r in got} == {(2000, 10, "a"), (2001, 2, "b"), (2002, 10, "a")}


def test_rows_of_other_years_are_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "by_year")
    io.replace_years(years_table(spark, [(1, "a", 2000), (2, "a", 2001)]), path)
    for stray in (2001, None):
        with pytest.raises(ValueError):
            io.replace_years(years_table(spark, [(3, "b", 2000), (4, "b", stray)]), path, [2000])
    assert spark.read.parquet(path).where("v = 'a'").count() == 2


def test_a_year_has_few_files_and_dates_prune_years(spark, tmp_path):
    t = star_session(spark, SF0001)
    path = io.replace_years(t["fact_matches"], str(tmp_path / "fact"))
    assert all(len(list(d.glob("*.parquet"))) <= 4 for d in (tmp_path / "fact").glob("year=*"))
    wanted = matches_of_dates(spark.read.parquet(path), t["dim_date"].where("day_name = 'Sunday' AND month = 5 AND year % 3 = 0"))
    assert "dynamicpruning" in wanted._jdf.queryExecution().executedPlan().toString().lower()


# ---- partial aggregates

def test_state_answers_as_the_fact_does_and_adds_up(spark, tmp_path):
    t = star_session(spark, SF0001)
    fact, path = t["fact_matches"], str(tmp_path / "state")
    rollup.refresh(fact.where("year % 2 = 0"), path)
    rollup.refresh(fact.where("match_id % 3 = 0 AND year = 1995"), path, [1995])
    odd = [r[0] for r in fact.where("year % 2 = 1").select("year").distinct().collect()]
    rollup.refresh(fact, path, odd)
    star = rollup.StateStar(spark, path)
    direct = catalog.QueryCatalog(spark)
    for name, plan in rollup.PLANS.items():
        assert sorted(map(repr, plan(star).collect())) == sorted(map(repr, direct.run(name).collect())), name
        scans = [x for x in executed(plan(star)).split("\n") if "FileScan" in x]
        assert scans and not any("home_team_id" in x or "match_id" in x for x in scans), name
    halves = rollup.build(fact.where("match_id % 2 = 0")).unionByName(rollup.build(fact.where("match_id % 2 = 1")))
    assert sorted(map(repr, rollup.merge(halves).collect())) == sorted(map(repr, rollup.build(fact).select(rollup.merge(halves).columns).collect()))


# ---- sketches

def test_states_of_new_files_are_added_and_merged(spark, tmp_path):
    rng = random.Random(2)
    table, states = str(tmp_path / "t"), str(tmp_path / "s")
    values = []
    for part in range(3):
        rows = [(k, None if rng.random() < 0.1 else rng.gauss(part, 1)) for k in range(4000)]
        values += [v for _, v in rows if v is not None]
        spark.createDataFrame(rows, "k int, v double").coalesce(2).write.mode("append").parquet(table)
        df = spark.read.parquet(table)
        found = sketches.refresh_states(df, ["v"], states)
        assert found.select("file").distinct().count() == len(df.inputFiles()) == 2 * (part + 1)
    assert sketches.refresh_states(df, ["v"], states).count() == 6      # nothing new: nothing is read or added
    probs = [0.0, 0.01, 0.5, 0.9, 1.0]
    got = sketches.rank_errors(df, sketches.quantiles(found, probs)).collect()
    assert all(r["rank_error"] <= sketches.RANK_ERROR for r in got)
    ends = {r["prob"]: r["value"] for r in got}
    assert (ends[0.0], ends[1.0]) == (min(values), max(values))
    assert abs(ends[0.5] - np.quantile(values, 0.5)) < 0.05
    assert sketches.merged(found).first()["n"] == len(values)


# ---- rules

def test_rules_of_a_table_equal_the_expressions(spark):
    from pitchside.functions.text import alias_exact, infer_group
    names = ["Germany", "East Germany and Brazil", "Brazilia", "Atlantis", "", None, "Korea", "Korea DPR", "USA", "aUSAb", "Côte d'Ivoire"] * 3
    df = spark.createDataFrame([(n,) for n in names], "team string")
    idle = spark.range(5000).select((F.col("id") + 50).alias("priority"), F.lit("part").alias("kind"),
                                    F.concat(F.lit("none"), "id").alias("pattern"), F.lit("x").alias("result"))
    groups = R.apply_rules(df, "team", R.group_rules(spark).unionByName(idle), "g", F.lit("Other"))
    want = df.withColumn("g", infer_group("team", CONFEDERATION_RULES))
    assert sorted(map(repr, groups.collect())) == sorted(map(repr, want.collect()))
    aliases = R.apply_rules(df, "team", R.alias_rules(spark), "g")
    assert sorted(map(repr, aliases.collect())) == sorted(map(repr, df.withColumn("g", alias_exact("team")).collect()))
    few = len(R.apply_rules(df, "team", R.group_rules(spark), "g", F.lit("Other"))._jdf.queryExecution().logical().toString())
    assert len(groups._jdf.queryExecution().logical().toString()) < few + 500   # the plan does not grow with the rules


def test_the_smallest_priority_wins_and_an_empty_pattern_fits_all(spark):
    rules = spark.createDataFrame([(5, "part", "", "any"), (1, "part", "ab", "first"), (1, "part", "b", "also"), (0, "value", "b", "whole")], R.RULE_SCHEMA)
    df = spark.createDataFrame([("ab",), ("b",), ("zz",), ("",), (None,)], "v string")
    got = {r["v"]: r["r"] for r in R.apply_rules(df, "v", rules, "r", F.lit("none")).collect()}
    assert got == {"ab": "also", "b": "whole", "zz": "any", "": "any", None: "none"}
    assert R.apply_rules(df, "v", rules.where("priority > 9"), "r").where("r IS DISTINCT FROM v").count() == 0


# ---- buckets

def test_bucketed_work_moves_no_row_of_the_fact(spark):
    t = star_session(spark, SF0001)
    base = scratch_path(spark, "bucket_test")
    database = "b_" + base.rsplit("/", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/_db'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = warehouse.save_bucketed({"m": t["fact_matches"], "f": t["fact_matches"], "d": t["dim_location"]},
                                         {"m": "match_id", "f": "location_id", "d": "location_id"}, database, base, buckets=4)
        faults = warehouse.key_faults(stored["m"], "match_id")
        lost = warehouse.orphans(stored["f"], "location_id", stored["d"].where("location_id > 3"), "location_id")
        wide = warehouse.attach(stored["f"], "location_id", stored["d"], "location_id", ["city"])
        for df in (faults, lost, wide):
            assert "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        assert tuple(faults.first()) == (0, 0)
        assert lost.first()[0] == t["fact_matches"].where("location_id <= 3").count()
        assert wide.count() == t["fact_matches"].count() and wide.where("city IS NULL AND location_id IS NOT NULL").count() == \
            t["fact_matches"].join(t["dim_location"].where("city IS NULL"), "location_id").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        warehouse.drop_bucketed(spark, database)
    assert warehouse.bucket_count({"t": spark.range(10)}) == 1


# ---- report and text queries

def test_report_document_is_one_json_file(spark, tmp_path):
    a = spark.createDataFrame([("t", 1, None), ("s", 2, 0.5)], "table_name string, n int, share double")
    empty = a.where("n > 5")
    schema = io.save_report_document({"first": a, "none": empty}, str(tmp_path / "doc"))
    files = list((tmp_path / "doc").glob("*.txt"))
    text = json.loads(files[0].read_text())
    assert len(files) == 1 and text == {"first": [{"table_name": "s", "n": 2, "share": 0.5}, {"table_name": "t", "n": 1, "share": None}], "none": []}
    back = io.read_report_document(spark, str(tmp_path / "doc"), schema).first()
    assert [tuple(r) for r in back["first"]] == [("s", 2, 0.5), ("t", 1, None)] and back["none"] == []
    many = spark.range(io.MAX_SECTION_ROWS + 1)
    with pytest.raises(ValueError):
        io.save_report_document({"data": many}, str(tmp_path / "no"))


def test_text_queries_bind_their_parameters(spark):
    star_session(spark, SF0001)
    queries = catalog.QueryCatalog(spark)
    queries.register("by_round", "SELECT count(*) AS n FROM fact_matches WHERE round = :round AND home_goals >= :least", least=0)
    every = spark.table("fact_matches").where("round = 'A'").count()
    assert queries.run("by_round", round="A").first()["n"] == every > queries.run("by_round", round="A", least=3).first()["n"]
    assert queries.run("by_round", round="A' OR '1'='1").first()["n"] == 0 and "by_round" in queries.names()
    with pytest.raises(ValueError):
        queries.register("top10_scoring", "SELECT 1")
    with pytest.raises(TypeError):
        queries.run("top10_scoring", least=1)


def test_quality_report_uses_the_same_numbers(spark):
    t = star_session(spark, SF0001)
    df = t["fact_matches"]
    exact = Q.quantile_values(df, ["match_id", "home_goals"], (0.5,))
    assert exact["match_id"][0] == (df.count() + 1) / 2 and exact["home_goals"][0] == float(np.median([r[0] for r in df.select("home_goals").collect()]))
