"""Alias and group rules kept as a table.

A rule says which result a value gets: one that equals its pattern (kind ``value``) or contains it
(kind ``part``); of several that fit, the smallest priority wins.  Rules are matched against the
*distinct* values of a column, and the winners are joined back, so neither the number of rules nor
the number of rows grows the plan.  Parts are found by equality: a value is opened into its
substrings of those lengths that patterns have, and these meet the patterns in an ordinary join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchside.functions.text import CONFEDERATION_RULES, COUNTRY_ALIASES
from pitchside.plans.joins import can_broadcast

RULE_SCHEMA = "priority long, kind string, pattern string, result string"


def alias_rules(spark: SparkSession, aliases: Mapping[str, str] = COUNTRY_ALIASES) -> DataFrame:
    """Whole-value aliases as a rule table."""
    return spark.createDataFrame([(k, "value", a, b) for k, (a, b) in enumerate(aliases.items())], RULE_SCHEMA)


def group_rules(spark: SparkSession, rules: Iterable[tuple[str, Sequence[str]]] = CONFEDERATION_RULES) -> DataFrame:
    """Ordered lists of substrings as a rule table: all patterns of a list share its priority."""
    return spark.createDataFrame([(k, "part", needle, label) for k, (label, needles) in enumerate(rules) for needle in needles], RULE_SCHEMA)


def _parts(value: Column, lengths: Column) -> Column:
    """The distinct substrings of ``value`` that have one of the ``lengths``."""
    of_length = lambda n: F.transform(F.sequence(F.lit(1), F.length(value) - n + 1), lambda p: F.substring(value, p, n))
    fitting = F.filter(lengths, lambda n: n <= F.length(value))
    return F.array_distinct(F.flatten(F.transform(fitting, lambda n: F.when(n == 0, F.array(F.lit(""))).otherwise(of_length(n)))))


def winners(values: DataFrame, rules: DataFrame) -> DataFrame:
    """``values(value)``, distinct: value and result of every value that a rule fits."""
    whole = rules.where("kind = 'value'").select(F.col("pattern").alias("part"), "priority", "result")
    parts = rules.where("kind = 'part'").select(F.col("pattern").alias("part"), "priority", "result")
    lengths = parts.agg(F.sort_array(F.collect_set(F.length("part"))).alias("lengths"))  # at most the length of the longest pattern
    opened = values.withColumn("lengths", lengths.scalar()).select("value", F.explode(_parts(F.col("value"), F.col("lengths"))).alias("part"))
    hits = values.join(whole, F.col("value") == F.col("part")).unionByName(opened.join(parts, "part"))
    # equal priorities: the smaller result, so that the winner does not depend on the order of rules
    return hits.groupBy("value").agg(F.min(F.struct("priority", "result")).alias("best")).select("value", F.col("best.result").alias("result"))


def apply_rules(df: DataFrame, column: str, rules: DataFrame, out: str, default: Column | None = None) -> DataFrame:
    """``df`` with the result of the rules for ``column`` as ``out``; ``default`` (the value itself) where none fits."""
    from pitchside.plans.pipeline import materialize

    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    found = materialize(winners(values, rules), "rule_winners")
    side = found.select(F.col("value").alias("_rule_value"), F.col("result").alias("_rule_result"))
    side = F.broadcast(side) if can_broadcast(found) else side
    joined = df.join(side, F.col(column) == F.col("_rule_value"), "left")
    result = F.coalesce("_rule_result", F.col(column) if default is None else default)
    return joined.withColumn(out, result).drop("_rule_value", "_rule_result")
