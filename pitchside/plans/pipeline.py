"""End-to-end plan: raw → clean → enrich → star, materialised at stage boundaries.

Stage outputs are written as Parquet under the shared ``spark.checkpoint.dir``
and read back: this cuts lineage (a lost executor re-reads files instead of
recomputing the whole chain), fixes the layout that sequential ids depend on,
and gives the planner real file sizes for its broadcast decisions.
"""

from __future__ import annotations

import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitchside.operators.clean import RejectLog, clean_matches, clean_readings, reject_counts
from pitchside.operators.enrich import join_readings, prepare_readings, yearly_from_monthly
from pitchside.operators.keys import number_rows, range_partitions, sequential_ids
from pitchside.operators.star import DIMENSION_BUILDERS, fact_matches
from pitchside.plans.joins import can_broadcast, lookup_join, row_bytes
from pitchside.session import scratch_path
from pitchside.sources.fixtures import matches_raw, readings_raw

STAR_TABLES = ("fact_matches", "dim_date", "dim_team", "dim_location", "dim_temperature")

_CACHE: dict[tuple[str, str], dict[str, DataFrame]] = {}
_LOCK = threading.Lock()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the checkpoint dir and read it back.

    The row count and an estimate of the data's size in bytes are observed
    during the write (no extra job) and kept on the returned frame as
    ``_pitchside_rows`` / ``_pitchside_bytes`` for broadcast and plan checks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows"),
               F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)      # known schema: no footer inference
    metrics = obs.get
    out._pitchside_rows, out._pitchside_bytes = metrics["rows"], metrics["bytes"]
    return out


def _checked(df: DataFrame) -> bool:
    return can_broadcast(df)


def build_star_schema(enriched: DataFrame, *, keys: str = "scalable",
                      order_col: str = "src_pos", id_partitions: int | None = None) -> dict[str, DataFrame]:
    """Enriched matches → materialised dimensions and fact.

    ``keys='scalable'`` numbers matches with range-partitioned sequential ids;
    ``keys='small'`` uses one window task when the measured row count allows it
    (``number_rows``), else the same ranged path.  The four dimensions are
    independent jobs over the enriched rows and are built concurrently."""
    if "match_id" not in enriched.columns:
        if keys == "small":
            enriched = number_rows(enriched, [order_col], "match_id")
        elif keys == "scalable":
            enriched = sequential_ids(enriched, [order_col], "match_id", num_partitions=id_partitions)
        else:
            raise ValueError("keys must be 'scalable' or 'small'")
    with ThreadPoolExecutor(len(DIMENSION_BUILDERS)) as pool:
        futures = {name: pool.submit(lambda b=build, n=name: materialize(b(enriched), n))
                   for name, build in DIMENSION_BUILDERS.items()}
        dims = {name: f.result() for name, f in futures.items()}
    dims_small = all(_checked(d) for d in dims.values())
    fact = materialize(fact_matches(enriched, dims, broadcast_dims=dims_small), "fact_matches")
    return {"fact_matches": fact, **dims, "enriched": enriched}


def build_star_from(matches_clean: DataFrame, readings_clean: DataFrame, *,
                    keys: str = "scalable") -> dict[str, DataFrame]:
    """Cleaned inputs → materialised star tables (plus the enriched silver table)."""
    # the cleaned matches are written once: their measured size sets the number of id ranges, and the
    # range partitioner samples these files instead of running the scans and the dedup a second time
    matches_clean = materialize(matches_clean, "matches_clean")
    cells = materialize(prepare_readings(readings_clean), "cells")
    cells_small = _checked(cells)
    # an aggregate of ``cells``: never larger, so the same size check covers it
    yearly = yearly_from_monthly(cells)

    def join(left, right, keys):
        return lookup_join(left, right, keys, checked=cells_small)

    # the silver table is written once, by the id pass: its range-ordered
    # layout (with row positions) is the materialised enriched table
    enriched = join_readings(matches_clean, cells, yearly=yearly, join=join)
    # by size, and a small input is still spread over the cores
    ranges = max(range_partitions(matches_clean), matches_clean.sparkSession.sparkContext.defaultParallelism)
    star = build_star_schema(enriched, keys=keys, id_partitions=ranges)
    return {**star, "cells": cells, "yearly": yearly, "matches_clean": matches_clean}


def lineage(tables: dict[str, DataFrame]) -> list[tuple[str, int | None]]:
    """(table, rows) for every materialised table, from the row counts
    observed while writing them (no extra jobs)."""
    return [(name, getattr(df, "_pitchside_rows", None)) for name, df in tables.items()]


def build_star(spark: SparkSession, sf_dir: str, *, refresh: bool = False) -> dict[str, DataFrame]:
    """Star tables for the driver fixtures at ``sf_dir`` (built once per application)."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LOCK:
        if not refresh and key in _CACHE:
            return _CACHE[key]
        # what each cleaning rule drops is counted while the cleaned tables are written, their only run
        raw, raw_readings = matches_raw(spark, sf_dir), readings_raw(spark, sf_dir)
        log = RejectLog(lambda: reject_counts(raw))
        tables = build_star_from(clean_matches(raw, rejects=log), clean_readings(raw_readings))
        tables["rejects"] = log.frame(tables["matches_clean"])
        tables["matches_clean"]._pitchside_raw_rows = log.counts(tables["matches_clean"])["input"]
        _CACHE[key] = tables
        return tables


def register_views(tables: dict[str, DataFrame], names=STAR_TABLES) -> None:
    for name in names:
        tables[name].createOrReplaceTempView(name)


def star_session(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Build (or reuse) the star and register its tables as temp views."""
    tables = build_star(spark, sf_dir)
    register_views(tables)
    return tables


def run_pipeline(spark: SparkSession, matches: DataFrame, readings: DataFrame, out: str | None = None,
                 *, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Raw matches + raw readings → star tables; optionally saved under ``out``."""
    tables = build_star_from(clean_matches(matches), clean_readings(readings))
    register_views(tables)
    if out:
        for name in STAR_TABLES:
            tables[name].write.mode("overwrite").format(fmt).save(f"{out.rstrip('/')}/{name}")
    return tables
