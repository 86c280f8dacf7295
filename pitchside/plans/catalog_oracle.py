"""DuckDB counterparts of the catalog, written from the specification.

All of them read ``wide``: one row a match with every dimension attached, and flags that say
which dimensions it has.  Nothing here is generated from the Spark plans.
"""

from __future__ import annotations

WIDE = """wide AS (
    SELECT f.match_id, f.home_goals AS h, f.away_goals AS a, h + a AS g, coalesce(h, 0) + coalesce(a, 0) AS g0,
           f.home_team_id AS h_id, f.away_team_id AS a_id, x.team_name AS h_name, y.team_name AS a_name, f.round AS rnd,
           d.full_date AS day, d.year AS yr, d.month AS mon, d.month_name AS mon_name, p.city AS town, p.country AS land,
           t.avg_temperature_celsius AS c, t.temperature_category AS cat,
           d.date_id IS NOT NULL AS dated, p.location_id IS NOT NULL AS placed, t.temperature_id IS NOT NULL AS measured,
           h IS NOT NULL AND a IS NOT NULL AS played, x.team_id IS NOT NULL AND y.team_id IS NOT NULL AS paired
    FROM fact_matches f
    LEFT JOIN dim_date d USING (date_id) LEFT JOIN dim_location p USING (location_id) LEFT JOIN dim_temperature t USING (temperature_id)
    LEFT JOIN dim_team x ON x.team_id = f.home_team_id LEFT JOIN dim_team y ON y.team_id = f.away_team_id)"""

_WINS = "count_if(h > a) AS home_wins, count_if(a > h) AS away_wins, count_if(h = a) AS draws"
_SIDES = """sides AS (SELECT h_id AS id, h_name AS team, h AS won, a AS lost FROM wide WHERE h IS NOT NULL
    UNION ALL SELECT a_id, a_name, a, h FROM wide WHERE a IS NOT NULL),
totals AS (SELECT team AS team_name, count(*) AS total_matches, count_if(won > lost) AS wins, count_if(won = lost) AS draws, count_if(won < lost) AS losses,
    CAST(sum(won) AS BIGINT) AS goals_for, CAST(sum(lost) AS BIGINT) AS goals_against, CAST(sum(won) - sum(lost) AS BIGINT) AS goal_difference
    FROM sides WHERE team IS NOT NULL GROUP BY id, team)"""


def _categories(measures: str, condition: str) -> str:
    return f"SELECT cat AS temperature_category, {measures} FROM wide WHERE measured AND {condition} GROUP BY cat"


def _top(columns: str, source: str, order: str, n: int) -> str:
    return f"SELECT * EXCLUDE (k) FROM (SELECT {columns}, row_number() OVER (ORDER BY {order}) AS k FROM {source}) WHERE k <= {n}"


_MATCH = "wide WHERE dated AND paired"
_HOSTS = "count(DISTINCT yr) AS tournaments_hosted, count(*) AS total_matches"
_IMPACT = "cat AS temperature_category, c AS avg_temperature_celsius, count(*) AS total_matches"


def _result(home: str, away: str) -> str:
    return f"""SELECT r AS match_result, n AS count, ROUND(100e0 * n / (SELECT count(*) FROM wide), 2) AS percentage
FROM (SELECT CASE WHEN h > a THEN '{home}' WHEN a > h THEN '{away}' ELSE 'Draw' END AS r, count(*) AS n FROM wide GROUP BY r)"""


def _margin(winner: str, loser: str) -> str:
    return _top(f"yr AS year, {winner} AS winning_team, {loser} AS losing_team, h AS home_goals, a AS away_goals, abs(h - a) AS goal_difference, "
                "land AS host_country, c AS temperature", f"{_MATCH} AND h <> a", "abs(h - a) DESC, yr DESC, match_id", 20)


VIEWS = {
    "vw_match_details": """SELECT match_id, day AS match_date, yr AS year, mon AS month, h_name AS home_team, a_name AS away_team, h AS home_goals,
 a AS away_goals, g AS total_goals, town AS city, land AS host_country, c AS temperature, cat AS temperature_category, CAST(NULL AS BIGINT) AS attendance,
 rnd AS stage, CASE WHEN h > a THEN h_name WHEN a > h THEN a_name ELSE 'Draw' END AS winner FROM wide WHERE dated AND paired""",
    "vw_temperature_impact": _categories("count(*) AS match_count, ROUND(avg(g), 2) AS avg_goals, ROUND(avg(c), 2) AS avg_temp, "
                                         "ROUND(100e0 * count_if(h > a) / count(*), 2) AS home_win_pct", "played"),
}

TEXTS: dict[str, str] = {
    **VIEWS,
    "temperature_impact_on_goals": f"""SELECT {_IMPACT}, avg(g0) AS avg_total_goals, avg(coalesce(h, 0)) AS avg_home_goals,
 avg(coalesce(a, 0)) AS avg_away_goals, max(g0) AS max_total_goals FROM wide WHERE c IS NOT NULL GROUP BY cat, c""",
    "goals_by_temperature_category": _categories("count(*) AS match_count, ROUND(avg(g0), 2) AS avg_goals_per_match, ROUND(min(c), 2) AS min_temp, "
                                                 "ROUND(max(c), 2) AS max_temp, ROUND(avg(c), 2) AS avg_temp", "cat IS NOT NULL"),
    "home_advantage_by_temperature": _categories(f"count(*) AS total_matches, {_WINS}, ROUND(100e0 * count_if(h > a) / count(*), 2) AS home_win_percent", "played"),
    "tournament_trends_over_time": """SELECT yr AS year, count(DISTINCT match_id) AS total_matches, ROUND(avg(g0), 2) AS avg_goals_per_match,
 count(DISTINCT land) AS host_countries, ROUND(avg(c), 2) AS avg_temperature FROM wide WHERE dated GROUP BY yr""",
    "matches_by_year_and_country": """SELECT yr AS year, land AS country, count(*) AS match_count, ROUND(avg(g0), 2) AS avg_goals, ROUND(avg(c), 2) AS avg_temp
 FROM wide WHERE dated AND land IS NOT NULL GROUP BY yr, land""",
    "top_scoring_matches": _top("day AS match_date, h_name AS home_team, a_name AS away_team, h AS home_goals, a AS away_goals, g AS total_goals, town AS city, "
                                "land AS country, c AS temperature, cat AS temperature_category", f"{_MATCH} AND played", "g DESC, day DESC, match_id", 20),
    "team_performance_summary": f"WITH {_SIDES} " + _top(
        "team_name, total_matches, wins, draws, losses, ROUND(100e0 * wins / total_matches, 2) AS win_percentage, goals_for, goals_against, goal_difference, "
        "ROUND(CAST(goals_for AS DOUBLE) / total_matches, 2) AS goals_per_match", "totals", "wins DESC, goal_difference DESC, team_name", 20),
    "temperature_distribution": """SELECT s * 5 AS temp_range_start, count(*) AS match_count, ROUND(avg(g0), 2) AS avg_goals
 FROM (SELECT ROUND(c / 5) AS s, g0 FROM wide WHERE c IS NOT NULL) GROUP BY s""",
    "seasonal_patterns": """SELECT mon AS month, mon_name AS month_name, count(*) AS match_count, ROUND(avg(g0), 2) AS avg_goals, ROUND(avg(c), 2) AS avg_temperature
 FROM wide WHERE dated GROUP BY mon, mon_name""",
    "geographic_analysis": f"""SELECT land AS host_country, {_HOSTS}, ROUND(avg(g0), 2) AS avg_goals_per_match, ROUND(avg(c), 2) AS avg_temperature,
 cat AS typical_climate FROM wide WHERE dated AND land IS NOT NULL GROUP BY land, cat""",
    "goals_by_temperature_range": """SELECT band AS temperature_range, count(*) AS total_matches, ROUND(avg(g), 2) AS avg_goals_per_match, ROUND(min(c), 1) AS min_temp,
 ROUND(max(c), 1) AS max_temp FROM (SELECT *, CASE WHEN c < 10 THEN 'Cold (< 10°C)' WHEN c < 20 THEN 'Moderate (10-20°C)' WHEN c < 30 THEN 'Warm (20-30°C)'
 ELSE 'Hot (> 30°C)' END AS band FROM wide WHERE measured AND played) GROUP BY band""",
    "scoring_by_category": _categories("count(*) AS matches, ROUND(avg(h), 2) AS avg_home_goals, ROUND(avg(a), 2) AS avg_away_goals, ROUND(avg(g), 2) AS avg_total_goals, "
                                       "max(g) AS highest_scoring_match, ROUND(min(c), 1) AS min_temp, ROUND(max(c), 1) AS max_temp, ROUND(avg(c), 1) AS avg_temp", "cat IS NOT NULL"),
    "home_advantage_detail": _categories(f"count(*) AS total_matches, {_WINS}, ROUND(100e0 * count_if(h > a) / count(*), 2) AS home_win_percentage, "
                                         "ROUND(avg(h - a), 2) AS avg_goal_difference", "played"),
    "tournament_evolution": """SELECT yr AS year, count(DISTINCT match_id) AS total_matches, ROUND(avg(g), 2) AS avg_goals_per_match,
 count(DISTINCT match_id) FILTER (WHERE g >= 5) AS high_scoring_matches, ROUND(avg(c), 1) AS avg_temperature FROM wide WHERE dated GROUP BY yr""",
    "decade_comparison": """SELECT CAST(yr // 10 * 10 AS BIGINT) AS decade, count(*) AS total_matches, ROUND(avg(g), 2) AS avg_goals,
 count(DISTINCT h_id) + count(DISTINCT a_id) AS unique_teams_participated FROM wide WHERE dated AND paired GROUP BY yr // 10""",
    "seasonal_patterns_years": """SELECT mon AS month, mon_name AS month_name, count(*) AS matches_played, ROUND(avg(g), 2) AS avg_goals, ROUND(avg(c), 1) AS avg_temp,
 count(DISTINCT yr) AS years_active FROM wide WHERE dated GROUP BY mon, mon_name""",
    "host_country_performance": f"""SELECT * FROM (SELECT land AS host_country, {_HOSTS}, ROUND(avg(g), 2) AS avg_goals_per_match, ROUND(avg(c), 1) AS avg_temperature,
 cat AS typical_climate FROM wide WHERE dated AND land IS NOT NULL GROUP BY land, cat) WHERE total_matches > 4""",
    "climate_zone_win_rates": f"""SELECT zone AS climate_zone, count(*) AS total_matches, ROUND(avg(g), 2) AS avg_goals, {_WINS}
 FROM (SELECT *, CASE WHEN c < 15 THEN 'Temperate' WHEN c < 25 THEN 'Subtropical' ELSE 'Tropical' END AS zone FROM wide WHERE measured) GROUP BY zone""",
    "top_teams_all_time": f"WITH {_SIDES}, rated AS (SELECT *, ROUND(100e0 * wins / total_matches, 2) AS win_percentage FROM totals WHERE total_matches >= 10) " + _top(
        "team_name, total_matches, wins, draws, losses, win_percentage, goals_for, goals_against, goal_difference, "
        "ROUND(CAST(goals_for AS DOUBLE) / total_matches, 2) AS goals_per_match, ROUND(CAST(goals_against AS DOUBLE) / total_matches, 2) AS conceded_per_match",
        "rated", "win_percentage DESC, goal_difference DESC, team_name", 20),
    "head_to_head": _top("*", """(SELECT h_name AS team1, a_name AS team2, count(*) AS matches_played, count_if(h > a) AS team1_wins, count_if(a > h) AS team2_wins,
 count_if(h = a) AS draws, ROUND(avg(g), 2) AS avg_total_goals FROM wide WHERE paired AND played GROUP BY h_name, a_name) WHERE matches_played > 2""",
                         "matches_played DESC, avg_total_goals DESC, team1, team2", 20),
    "top_scoring_context": _top("day AS match_date, h_name AS home_team, h AS home_goals, a_name AS away_team, a AS away_goals, g AS total_goals, town AS city, land AS country, "
                                "ROUND(c, 1) AS temperature, cat AS temperature_category, rnd AS round", f"{_MATCH} AND played", "g DESC, day DESC, match_id", 20),
    "biggest_margins": _margin("h_name", "a_name"),
    "biggest_margins_corrected": _margin("CASE WHEN h > a THEN h_name ELSE a_name END", "CASE WHEN h > a THEN a_name ELSE h_name END"),
    "tournament_stats_by_year": """SELECT yr AS tournament_year, land AS host_country, count(*) AS total_matches,
 count(DISTINCT h_id) + count(DISTINCT a_id) AS teams_participated, CAST(sum(g) AS BIGINT) AS total_goals, ROUND(avg(g), 2) AS avg_goals_per_match,
 max(g) AS highest_scoring_match, ROUND(avg(c), 1) AS avg_tournament_temp FROM wide WHERE dated AND paired AND placed GROUP BY yr, land""",
    "top10_scoring": _top("match_id, day AS full_date, h_name AS home_team, h AS home_goals, a_name AS away_team, a AS away_goals, g AS total_goals, town AS city, "
                          "cat AS temperature_category", _MATCH, "g DESC NULLS LAST, match_id", 10),
    "matches_by_category": _categories("count(*) AS match_count, ROUND(avg(g), 2) AS avg_goals, ROUND(min(c), 1) AS min_temp, ROUND(max(c), 1) AS max_temp, "
                                       "ROUND(avg(c), 1) AS avg_temp", "TRUE"),
    "outcome_share": _result("Home Win", "Away Win"),
    "temperature_impact_detail": f"""SELECT {_IMPACT}, ROUND(avg(g), 2) AS avg_total_goals, ROUND(avg(h), 2) AS avg_home_goals, ROUND(avg(a), 2) AS avg_away_goals,
 max(g) AS max_total_goals FROM wide WHERE c IS NOT NULL GROUP BY cat, c""",
    "doc_top10_matches": _top("match_id, day AS full_date, h_name AS home_team, h AS home_goals, a_name AS away_team, a AS away_goals, g AS total_goals",
                              _MATCH, "g DESC NULLS LAST, match_id", 10),
    "doc_category_counts": _categories("count(*) AS match_count, avg(g) AS avg_goals", "TRUE"),
    "doc_result_share": _result("Home", "Away"),
}
