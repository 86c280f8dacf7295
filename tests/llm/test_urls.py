import re

import duckdb
import pandas as pd

from pitchside.llm import url_reputation as u

PAGES = [(1, "https://A.Example.COM/de/x?y#z"), (2, "http://b.example.com/fr/1"), (3, "http://b.example.com/fr/2"), (4, None), (5, "no scheme"), (6, "ftp://net"),
         (7, "http://x.net/en"), (8, "http://www.example.net/en/a"), (9, "http://example.net/en"), (10, "http://notexample.net/en/a"), (11, "http://deep.org/fr/"),
         (12, "http://deep.org?/fr/"), (13, "http://10.0.0.1:80/a://b"), (14, "http://user@bad.example.com:8080/p"), (15, "x://bad.example.com/q\nr"), (15, "x://bad.example.com/q\nr"), (16, "://h/p")]
PAGES += [(100 + k, f"http://bad.example.com/{k}") for k in range(40)] + [(200 + k, f"http://good.example.com/{k}") for k in range(60)]
LABELS = [(100 + k, 0, 0) for k in range(30)] + [(200 + k, 1, 0) for k in range(50)] + [(2, 1, 0), (2, 0, 0), (3, None, 1), (None, 0, 0), (999, 0, 0)]


def run(spark, pages, labels):
    p = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS verdict", "'h' AS html").repartition(3)
    marks = spark.createDataFrame(labels, "page_id long, quality int, toxic int").selectExpr("page_id", "CASE WHEN quality = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END AS bad")
    return u.judge_urls(p, marks)


def test_equals_the_sql_and_the_written_rules(spark):
    got = sorted((tuple(r) for r in run(spark, PAGES, LABELS).collect()), key=repr)
    con = duckdb.connect()
    pages = pd.DataFrame(PAGES, columns=["page_id", "url"]).astype({"url": "string"})  # noqa: F841
    labels = pd.DataFrame(LABELS, columns=["doc_id", "quality", "toxic"]).astype("Int64")  # noqa: F841
    con.execute("CREATE TABLE pages AS SELECT * FROM pages")
    con.execute("CREATE TABLE labels AS SELECT * FROM labels")
    assert got == sorted((tuple(r) for r in con.execute(u.ORACLE_SQL).fetchall()), key=repr)
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    for page, host, path, rule, verdict in got:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", dict(PAGES)[page] or "")
        assert (host, path) == ((m[1].lower(), m[2]) if m else ("", ""))
        fits = [r for r in rules if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h):])]
        assert rule == max(fits, key=len, default=None)
        assert rule is None or verdict == rules[rule]
    by_host = {h: v for _, h, _, r, v in got if r is None}
    assert by_host["bad.example.com"] == "block" and by_host["good.example.com"] == "allow" and by_host[""] == "allow"


def test_shrinkage_orders_the_levels(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string").select("page_id", u.url_parts(u.F.col("url"))[0].alias("host"))
    marks = spark.createDataFrame([(i, int(q == 0)) for i, q, _ in LABELS if q is not None], "page_id long, bad int")
    rep = {r["host"]: r for r in u.host_reputation(pages, marks).collect()}
    assert rep["bad.example.com"]["mean"] > 0.8 > rep["a.example.com"]["mean"] > rep["good.example.com"]["mean"]
    assert all(r["bound"] <= r["mean"] for r in rep.values())


def test_empty_tables_and_filter(spark):
    assert run(spark, [], LABELS).collect() == []
    assert all(r.verdict == "allow" for r in run(spark, PAGES, []).collect() if r.rule is None)
    marks = spark.createDataFrame([(i, int(q == 0)) for i, q, _ in LABELS if q is not None], "page_id long, bad int")
    pages = spark.createDataFrame(PAGES, "page_id long, url string").selectExpr("*", "1 AS host")
    kept = u.filter_pages(pages, marks)
    assert kept.columns == pages.columns and not any("//bad.example.com" in (r.url or "") for r in kept.collect())


def test_rows_of_one_id_are_judged_by_their_own_url(spark):
    rows = [(1, "http://x.net/a", "p"), (1, "http://ok.com/a", "q"), (None, "http://x.net/b", "r"), (None, "http://ok.com/b", "s")]
    pages = spark.createDataFrame(rows, "page_id long, url string, _row string").selectExpr("*", "'v' AS verdict", "2 AS bound")
    kept = u.filter_pages(pages, spark.createDataFrame([], "page_id long, bad int"))
    assert kept.columns == pages.columns and sorted(r["_row"] for r in kept.collect()) == ["q", "s"]
