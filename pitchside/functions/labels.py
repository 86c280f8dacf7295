"""Label expressions: winners, outcomes, range bins, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Temperature bins and labels.
TEMPERATURE_BOUNDS: tuple[float, ...] = (10.0, 20.0, 30.0)
TEMPERATURE_LABELS: tuple[str, ...] = ("Cold", "Moderate", "Warm", "Hot")
# Labelled ranges (left-closed) and climate zones.
TEMPERATURE_RANGE_LABELS: tuple[str, ...] = (
    "Cold (< 10°C)", "Moderate (10-20°C)", "Warm (20-30°C)", "Hot (> 30°C)")
CLIMATE_BOUNDS: tuple[float, ...] = (15.0, 25.0)
CLIMATE_LABELS: tuple[str, ...] = ("Temperate", "Subtropical", "Tropical")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bin_label(c: str | Column, bounds: Sequence[float] = TEMPERATURE_BOUNDS,
              labels: Sequence[str] = TEMPERATURE_LABELS, closed: str = "right",
              null_label: str | None = None) -> Column:
    """Label a value by ascending bounds.

    ``closed='right'`` gives (-inf,b0], (b0,b1], …, (bn,inf); ``closed='left'``
    gives (-inf,b0), [b0,b1), …, [bn,inf).  NULL maps to ``null_label`` (NULL by
    default) and is checked first, so it can never fall into the last bin."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need one more label than bounds")
    if closed not in ("left", "right"):
        raise ValueError("closed must be 'left' or 'right'")
    col = _col(c)
    out = F.when(col.isNull(), F.lit(null_label).cast("string"))
    for b, label in zip(bounds, labels):
        cond = (col <= F.lit(b)) if closed == "right" else (col < F.lit(b))
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def temperature_range_label(c: str | Column) -> Column:
    """'Cold (< 10°C)' … 'Hot (> 30°C)'; NULL falls into the last branch as in SQL CASE."""
    col = _col(c)
    out = None
    for b, label in zip(TEMPERATURE_BOUNDS, TEMPERATURE_RANGE_LABELS):
        out = F.when(col < b, F.lit(label)) if out is None else out.when(col < b, F.lit(label))
    return out.otherwise(F.lit(TEMPERATURE_RANGE_LABELS[-1]))


def climate_zone(c: str | Column) -> Column:
    """<15 Temperate, <25 Subtropical, else (NULL included) Tropical."""
    col = _col(c)
    return (F.when(col < CLIMATE_BOUNDS[0], F.lit(CLIMATE_LABELS[0]))
            .when(col < CLIMATE_BOUNDS[1], F.lit(CLIMATE_LABELS[1]))
            .otherwise(F.lit(CLIMATE_LABELS[2])))


def range_bucket(c: str | Column, width: float = 5.0) -> Column:
    """``round(x / width) * width`` (half away from zero)."""
    return F.round(_col(c) / F.lit(width)) * F.lit(width)


def decade(c: str | Column) -> Column:
    return (F.floor(_col(c) / F.lit(10)) * F.lit(10)).cast("bigint")


def winner_label(home_goals: str | Column, away_goals: str | Column,
                 home_team: str | Column, away_team: str | Column, draw: str = "Draw") -> Column:
    hg, ag = _col(home_goals), _col(away_goals)
    return (F.when(hg > ag, _col(home_team))
            .when(ag > hg, _col(away_team))
            .otherwise(F.lit(draw)))


def outcome_label(home_goals: str | Column, away_goals: str | Column,
                  labels: tuple[str, str, str] = ("Home Win", "Away Win", "Draw")) -> Column:
    hg, ag = _col(home_goals), _col(away_goals)
    return (F.when(hg > ag, F.lit(labels[0]))
            .when(ag > hg, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))
