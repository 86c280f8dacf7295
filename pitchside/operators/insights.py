"""Headline findings of a run, from two small reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_insights(category_means: DataFrame, best_matches: DataFrame) -> DataFrame:
    """(insight, subject, value): mean goals of every category, the category with most, the highest-scoring match."""
    means = category_means.select(F.lit("mean_goals").alias("insight"), F.col("temperature_category").alias("subject"),
                                  F.col("avg_goals_per_match").alias("value"))
    top = (means.orderBy(F.desc("value"), "subject").limit(1).withColumn("insight", F.lit("highest_scoring_category")))
    match = (best_matches.orderBy(F.desc("total_goals"), "match_id").limit(1)
             .select(F.lit("highest_scoring_match").alias("insight"), F.concat_ws(" - ", "home_team", "away_team").alias("subject"),
                     F.col("total_goals").cast("double").alias("value")))
    return means.unionByName(top).unionByName(match)
