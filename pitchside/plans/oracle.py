"""The pipeline as one DuckDB SQL chain — the independent test oracle.

DuckDB only sees the driver's base tables, so every oracle query carries the
whole chain (raw → clean → readings → cells → enriched → dims → fact) as CTEs.
It is written from the pipeline's specification, not generated from the Spark
plan, so the two implementations check each other.
"""

from __future__ import annotations

from pitchside.functions.text import COUNTRY_ALIASES, TEAM_ALIASES

WS = r"'^\s+|\s+$'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(col: str) -> str:
    return f"regexp_replace({col}, {WS}, '', 'g')"


def alias_regex_sql(col: str, aliases=TEAM_ALIASES) -> str:
    out = col
    for pat, rep in aliases:
        out = f"regexp_replace({out}, {_q(pat)}, {_q(rep)}, 'g')"
    return out


def alias_exact_sql(col: str, aliases=COUNTRY_ALIASES) -> str:
    if not aliases:
        return col
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in aliases.items())
    return f"CASE {col} {whens} ELSE {col} END"


def coerce_int_sql(col: str) -> str:
    d = f"try_cast({col} AS DOUBLE)"
    return f"coalesce(try_cast(trunc(CASE WHEN isnan({d}) THEN NULL ELSE {d} END) AS INTEGER), 0)"


def mean_sql(col: str) -> str:
    """Exact sum of the shortest decimal forms, divided once (all digits of a reading kept)."""
    return f"CAST(SUM(CAST(CAST({col} AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / COUNT({col})"


def bin_sql(col: str, closed: str = "right") -> str:
    op = "<=" if closed == "right" else "<"
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} {op} 10 THEN 'Cold' "
            f"WHEN {col} {op} 20 THEN 'Moderate' WHEN {col} {op} 30 THEN 'Warm' ELSE 'Hot' END")


MATCH_ORDER = "k1, k2, k3, k4, k5, k6"


def matches_raw_sql(dirty: bool = False) -> str:
    iso = "strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d')"
    goals = "CAST(l.l_linenumber AS VARCHAR)"
    team = "hn.n_name"
    if dirty:
        k = "l.l_orderkey"
        iso = f"CASE WHEN {k} % 97 = 0 THEN 'bad' ELSE {iso} END"
        goals = f"CASE WHEN {k} % 89 = 0 THEN 'x' WHEN {k} % 83 = 0 THEN NULL ELSE {goals} END"
        team = f"CASE WHEN {k} % 10 = 0 THEN '  ' || hn.n_name || '  ' ELSE hn.n_name END"
    return f"""SELECT
        CAST(year(o.o_orderdate) AS INTEGER) AS "Year",
        {iso} AS "Date",
        CAST(NULL AS VARCHAR) AS "Time",
        l.l_returnflag AS "Round",
        o.o_orderpriority AS "Stadium",
        c.c_mktsegment AS "City",
        hn.n_name AS "Country",
        {team} AS "HomeTeam",
        {goals} AS "HomeGoals",
        CAST(CAST(l.l_quantity AS INTEGER) % 8 AS VARCHAR) AS "AwayGoals",
        an.n_name AS "AwayTeam",
        CAST(NULL AS VARCHAR) AS "Observation",
        l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3, l.l_suppkey AS k4,
        l.l_quantity AS k5, l.l_extendedprice AS k6
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation hn ON c.c_nationkey = hn.n_nationkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation an ON s.s_nationkey = an.n_nationkey"""


def readings_raw_sql(dirty: bool = False) -> str:
    temp = "o.o_totalprice / 10000"
    if dirty:
        k = "o.o_orderkey"
        temp = f"CASE WHEN {k} % 53 = 0 THEN -99.0 WHEN {k} % 59 = 0 THEN CAST('NaN' AS DOUBLE) ELSE {temp} END"
    return f"""SELECT
        n.n_name AS "Entity",
        CAST(n.n_nationkey AS VARCHAR) AS "Code",
        strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS "Month",
        CAST({temp} AS DOUBLE) AS "Monthly average",
        o.o_orderkey AS k1
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE o.o_orderstatus = 'F' AND n.n_regionkey <> 4"""


def clean_matches_ctes(raw: str = "m_raw", out: str = "m_clean", dedup: bool = True) -> str:
    hg = coerce_int_sql('"HomeGoals"')
    ag = coerce_int_sql('"AwayGoals"')
    body = f"""{out}_p AS (
    SELECT *, try_cast("Date" AS DATE) AS match_date FROM {raw}
),
{out}_f AS (
    SELECT
        CAST(year(match_date) AS INTEGER) AS year,
        "Date" AS date,
        "Time" AS time,
        "Round" AS round,
        {strip('"Stadium"')} AS stadium,
        {strip('"City"')} AS city,
        {strip('"Country"')} AS country,
        {alias_regex_sql(strip('"HomeTeam"'))} AS home_team,
        {hg} AS home_goals,
        {ag} AS away_goals,
        {alias_regex_sql(strip('"AwayTeam"'))} AS away_team,
        "Observation" AS observation,
        match_date,
        CAST(month(match_date) AS INTEGER) AS month,
        CAST(quarter(match_date) AS INTEGER) AS quarter,
        CAST(day(match_date) AS INTEGER) AS day,
        CAST(isodow(match_date) - 1 AS INTEGER) AS day_of_week,
        dayname(match_date) AS day_name,
        k1, k2, k3, k4, k5, k6
    FROM {out}_p
    WHERE match_date IS NOT NULL AND year(match_date) BETWEEN 1930 AND 2014
),
{out}_d AS (
    SELECT *,
        home_goals + away_goals AS total_goals,
        CASE WHEN home_goals > away_goals THEN home_team
             WHEN away_goals > home_goals THEN away_team ELSE 'Draw' END AS winner,
        CASE WHEN home_goals > away_goals THEN 'Home Win'
             WHEN away_goals > home_goals THEN 'Away Win' ELSE 'Draw' END AS outcome
    FROM {out}_f
),
{out} AS (
    SELECT * FROM {out}_d
    {"QUALIFY row_number() OVER (PARTITION BY match_date, home_team, away_team ORDER BY " + MATCH_ORDER + ") = 1" if dedup else ""}
)"""
    return body


def clean_readings_ctes(raw: str = "r_raw", out: str = "r_clean", dedup: bool = True) -> str:
    t = 'try_cast("Monthly average" AS DOUBLE)'
    return f"""{out}_p AS (
    SELECT *, try_cast("Month" AS DATE) AS date,
        CASE WHEN isnan({t}) THEN NULL ELSE {t} END AS temperature
    FROM {raw}
),
{out}_f AS (
    SELECT
        {alias_exact_sql(strip('"Entity"'))} AS country,
        "Code" AS country_code,
        "Month" AS month,
        temperature,
        date,
        CAST(year(date) AS INTEGER) AS year,
        CAST(month(date) AS INTEGER) AS month_num,
        CAST(quarter(date) AS INTEGER) AS quarter,
        k1
    FROM {out}_p
    WHERE date IS NOT NULL AND temperature IS NOT NULL AND temperature BETWEEN -50 AND 60
      AND year(date) BETWEEN 1930 AND 2014
),
{out} AS (
    SELECT * FROM {out}_f
    {"QUALIFY row_number() OVER (PARTITION BY country, date ORDER BY k1) = 1" if dedup else ""}
)"""


def enrich_ctes(matches: str = "m_clean", readings: str = "r_clean") -> str:
    return f"""cells AS (
    SELECT country, year, month_num AS month,
        {mean_sql('temperature')} AS avg_temperature_celsius
    FROM {readings}
    WHERE country IS NOT NULL AND year IS NOT NULL AND month_num IS NOT NULL
    GROUP BY country, year, month_num
),
cells_c AS (
    SELECT *, {bin_sql('avg_temperature_celsius')} AS temperature_category FROM cells
),
yearly AS (
    SELECT country, year,
        {mean_sql('avg_temperature_celsius')} AS y_temp
    FROM cells_c GROUP BY country, year
),
enriched AS (
    SELECT m.*,
        CASE WHEN c.avg_temperature_celsius IS NOT NULL THEN c.avg_temperature_celsius ELSE y.y_temp END
            AS avg_temperature_celsius,
        CASE WHEN c.avg_temperature_celsius IS NOT NULL THEN c.temperature_category
             ELSE {bin_sql('y.y_temp', 'left')} END AS temperature_category
    FROM {matches} m
    LEFT JOIN cells_c c ON m.country = c.country AND m.year = c.year AND m.month = c.month
    LEFT JOIN yearly y ON m.country = y.country AND m.year = y.year
),
enriched_ids AS (
    SELECT CAST(row_number() OVER (ORDER BY {MATCH_ORDER}) AS BIGINT) AS match_id, * FROM enriched
)"""


STAR_CTES = """dim_date AS (
    SELECT CAST(row_number() OVER (ORDER BY full_date) AS BIGINT) AS date_id,
        full_date,
        CAST(year(full_date) AS INTEGER) AS year,
        CAST(month(full_date) AS INTEGER) AS month,
        CAST(day(full_date) AS INTEGER) AS day,
        CAST(quarter(full_date) AS INTEGER) AS quarter,
        CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week,
        dayname(full_date) AS day_name,
        monthname(full_date) AS month_name,
        CAST(CASE WHEN isodow(full_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
    FROM (SELECT DISTINCT match_date AS full_date FROM enriched_ids WHERE match_date IS NOT NULL)
),
dim_team AS (
    SELECT CAST(row_number() OVER (ORDER BY team_name) AS BIGINT) AS team_id,
        team_name,
        upper(substring(team_name, 1, 3)) AS team_code,
        CONFEDERATION_CASE AS confederation
    FROM (SELECT home_team AS team_name FROM enriched_ids WHERE home_team IS NOT NULL
          UNION SELECT away_team FROM enriched_ids WHERE away_team IS NOT NULL)
),
dim_location AS (
    SELECT CAST(row_number() OVER (ORDER BY first_pos) AS BIGINT) AS location_id,
        city, country,
        CASE WHEN city IS NOT NULL AND country IS NOT NULL THEN stadium END AS stadium,
        CAST(NULL AS DOUBLE) AS latitude,
        CAST(NULL AS DOUBLE) AS longitude
    FROM (SELECT city, country, min(match_id) AS first_pos,
                 arg_min(stadium, match_id) FILTER (WHERE stadium IS NOT NULL) AS stadium
          FROM enriched_ids GROUP BY city, country)
),
dim_temperature AS (
    SELECT CAST(row_number() OVER (ORDER BY first_pos) AS BIGINT) AS temperature_id,
        country, year, month, avg_temperature_celsius, temperature_category
    FROM (SELECT country, year, month, avg_temperature_celsius, temperature_category,
                 min(match_id) AS first_pos
          FROM enriched_ids WHERE avg_temperature_celsius IS NOT NULL
          GROUP BY country, year, month, avg_temperature_celsius, temperature_category)
),
fact_matches AS (
    SELECT e.match_id, d.date_id, l.location_id, ht.team_id AS home_team_id,
        awt.team_id AS away_team_id, t.temperature_id, e.home_goals, e.away_goals,
        e.total_goals, e.round, e.year
    FROM enriched_ids e
    LEFT JOIN dim_date d ON e.match_date = d.full_date
    LEFT JOIN dim_location l ON e.city IS NOT DISTINCT FROM l.city
                            AND e.country IS NOT DISTINCT FROM l.country
    LEFT JOIN dim_team ht ON e.home_team = ht.team_name
    LEFT JOIN dim_team awt ON e.away_team = awt.team_name
    LEFT JOIN (SELECT country, year, month, min(temperature_id) AS temperature_id
               FROM dim_temperature GROUP BY country, year, month) t
           ON e.country = t.country AND e.year = t.year AND e.month = t.month
)"""


def confederation_case(col: str = "team_name") -> str:
    from pitchside.functions.text import CONFEDERATION_RULES, DEFAULT_GROUP
    whens = []
    for label, needles in CONFEDERATION_RULES:
        cond = " OR ".join(f"contains({col}, {_q(n)})" for n in needles)
        whens.append(f"WHEN {cond} THEN {_q(label)}")
    return f"CASE {' '.join(whens)} ELSE {_q(DEFAULT_GROUP)} END"


def chain(*, dirty: bool = False, star: bool = True) -> str:
    """CTE list (without the leading WITH) from the base tables to the star."""
    parts = [
        f"m_raw AS (\n    {matches_raw_sql(dirty)}\n)",
        clean_matches_ctes(),
        f"r_raw AS (\n    {readings_raw_sql(dirty)}\n)",
        clean_readings_ctes(),
        enrich_ctes(),
    ]
    if star:
        parts.append(STAR_CTES.replace("CONFEDERATION_CASE", confederation_case()))
    return ",\n".join(parts)


def with_chain(query: str, *, dirty: bool = False, star: bool = True, extra_ctes: str = "") -> str:
    """``WITH <chain>[, extra] SELECT * FROM (<query>) q``."""
    ctes = chain(dirty=dirty, star=star)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\nSELECT * FROM (\n{query.strip()}\n) q"


def _close_paren(s: str, start: int) -> int:
    depth = 0
    for i in range(start, len(s)):
        if s[i] == "(":
            depth += 1
        elif s[i] == ")":
            depth -= 1
            if depth == 0:
                return i
    raise ValueError("unbalanced parentheses")


def _split_top(s: str) -> list[str]:
    parts, depth, cur = [], 0, []
    for ch in s:
        if ch == "," and depth == 0:
            parts.append("".join(cur))
            cur = []
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur.append(ch)
    parts.append("".join(cur))
    return parts


def spark_round(sql: str) -> str:
    """Make DuckDB's ``ROUND`` follow Spark's: round the shortest decimal form
    of the double half-up (DuckDB rounds ``x * 10^n`` in binary, so
    ``ROUND(4.225, 2)`` is 4.22 there and 4.23 in Spark)."""
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k = _close_paren(sql, j + 5)
        args = _split_top(spark_round(sql[j + 6:k]))
        x, n = args[0], (args[1].strip() if len(args) > 1 else "0")
        out.append(sql[i:j])
        out.append(f"COALESCE(CAST(ROUND(TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE), ROUND({x}, {n}))")
        i = k + 1


def star_query(query: str) -> str:
    """Oracle for a catalog query: the star, and the wide match rows that the texts read."""
    from pitchside.plans.catalog_oracle import WIDE
    return with_chain(spark_round(query), extra_ctes=WIDE)
