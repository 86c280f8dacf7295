"""Sources and sinks: explicit-schema reads, format dispatch, table sinks.

Reads never infer schemas (inference turns 'yyyy-MM' into timestamps and
'15:00' into today's date); writes run on the executors, never via pandas.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

FORMATS = {".parquet": "parquet", ".csv": "csv", ".json": "json", ".orc": "orc"}
# CSV options that keep cells byte-for-byte (the writer trims by default).
CSV_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}


# A scan of at most this many splits (≤ ~2 GB at 128 MB per split) is cheap
# to spread; a larger one already runs wide and is left as it is.
FEW_SPLITS = 16


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None,
                       few_splits: int = FEW_SPLITS) -> DataFrame:
    """Spread a scan that yields only a handful of splits over the cores.

    A single unsplittable file (one Parquet row group) becomes one task and
    serialises everything downstream of it; a round-robin repartition fixes
    that.  Only scans of at most ``few_splits`` splits are spread, so a large
    input is never shuffled just to add parallelism (its scan is already
    wide, and its joins / aggregates shuffle anyway)."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(target) if splits < target and splits <= few_splits else df


# Rows that one task of a wide plan takes: it sorts them, some hundred bytes each.
ROWS_A_TASK = 1 << 20


def bound_task_rows(df: DataFrame, key: str, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Deal a scan of many rows by the key of its next join into tasks of a bounded number of rows.

    The planner sizes tasks by the bytes of the narrow rows that are shuffled, and their number has a fixed top, so
    what the joined, wider rows take in a task grows with the table.  The count is read from the files' footers; the
    join needs this exchange anyway.  A smaller scan is spread over the cores, if it has only a few splits."""
    tasks = -(-df.select().count() // rows_a_task)
    return df.repartition(tasks, key) if tasks > df.sparkSession.sparkContext.defaultParallelism else ensure_parallelism(df)


def detect_format(path: str, default: str = "csv") -> str:
    """Format by suffix; unknown suffixes read as CSV."""
    return FORMATS.get(os.path.splitext(path.rstrip("/"))[1].lower(), default)


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str = "auto", **options) -> DataFrame:
    fmt = detect_format(path) if fmt == "auto" else fmt
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json"):
        raise ValueError(f"{fmt} sources need an explicit schema")
    return reader.options(**options).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "auto", *, mode: str = "overwrite",
                partition_by: list[str] | None = None, **options) -> str:
    fmt = detect_format(path, "parquet") if fmt == "auto" else fmt
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**options).save(path)
    return path


@dataclass(frozen=True)
class Ingested:
    """Well-formed rows, the quarantined lines (``line``, ``file``), and how many there were of each."""

    rows: DataFrame
    quarantine: DataFrame
    lines: int
    malformed: int


def ingest(spark: SparkSession, path: str, schema: StructType, into: str, fmt: str = "auto", **options) -> Ingested:
    """Read CSV or JSON lines once, keeping what does not fit the schema.

    A line with too few or too many cells, a value that is not of its column's type, or broken JSON goes to the
    quarantine under ``into`` as it was read; the others are stored beside it as Parquet.  Both are counted
    while they are written, so every line is in exactly one of them."""
    fmt = detect_format(path) if fmt == "auto" else fmt
    bad, file, flag = "_corrupt_record", "_source_file", "_malformed"
    wide = StructType([*schema.fields, StructField(bad, StringType())])
    read = read_table(spark, path, wide, fmt, mode="PERMISSIVE", columnNameOfCorruptRecord=bad, **options)
    marked = read.withColumns({file: F.input_file_name(), flag: F.col(bad).isNotNull()})
    seen = Observation(f"ingest_{uuid.uuid4().hex[:8]}")
    counted = marked.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col(flag)).alias("malformed"))
    counted.write.mode("overwrite").partitionBy(flag).parquet(into)
    stored = spark.read.schema(StructType([*wide.fields, StructField(file, StringType()), StructField(flag, BooleanType())])).parquet(into)
    return Ingested(stored.where(~F.col(flag)).select(*[f"`{f.name}`" for f in schema.fields]),
                    stored.where(F.col(flag)).select(F.col(bad).alias("line"), F.col(file).alias("file")),
                    seen.get["lines"], seen.get["malformed"])


def replace_years(df: DataFrame, path: str, years: Sequence[int] | None = None, column: str = "year", files_per_year: int = 4) -> str:
    """Write ``df`` partitioned by year, or replace the given years of the table at ``path`` and keep all others.

    With ``years`` only the folders of years that ``df`` holds are replaced (dynamic partition overwrite), so loading a
    year twice leaves the table as loading it once; rows of other years in ``df`` are an error, found before anything is
    written.  Rows of a year meet in a few tasks, so a year has a few files whatever the number of tasks."""
    if years is not None:
        stray = df.where(F.col(column).isNull() | ~F.col(column).isin(list(years))).limit(1).count()
        if stray:
            raise ValueError(f"rows outside the years {sorted(years)}")
    others = [c for c in df.columns if c != column]
    dealt = df.repartition(F.col(column), F.pmod(F.xxhash64(*others), F.lit(files_per_year)))
    writer = dealt.write.mode("overwrite").partitionBy(column)
    writer.option("partitionOverwriteMode", "static" if years is None else "dynamic").parquet(path)
    return path


def save_tables(tables: Mapping[str, DataFrame], path: str | None = None, *,
                database: str | None = None, fmt: str = "parquet") -> dict[str, str]:
    """Write each table to ``path/<name>.<fmt>`` and/or as a table in ``database``
    (external, stored under ``path`` when given)."""
    out = {}
    for name, df in tables.items():
        if path:
            out[name] = write_table(df, f"{path.rstrip('/')}/{name}.{fmt}", fmt)
        if database:
            w = df.write.mode("overwrite").format(fmt)
            if path:
                w = w.option("path", f"{path.rstrip('/')}/_tables/{name}")
            w.saveAsTable(f"{database}.{name}")
            out[f"{database}.{name}"] = name
    return out


def load_tables(spark: SparkSession, directory: str, *, register: bool = True,
                names: list[str] | None = None) -> dict[str, DataFrame]:
    """Every ``<stem>.parquet`` under ``directory`` becomes table ``stem``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    tables = {}
    for st in fs.listStatus(jvm_path):
        fname = st.getPath().getName()
        stem, ext = os.path.splitext(fname)
        if ext != ".parquet" or (names and stem not in names):
            continue
        tables[stem] = spark.read.parquet(st.getPath().toString())
        if register:
            tables[stem].createOrReplaceTempView(stem)
    return dict(sorted(tables.items()))


def source_contract(df: DataFrame, contract: StructType, source: str) -> DataFrame:
    """One row per expected column (present? same type? how many values?) plus a non-empty check; one pass."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_n{i}")
                                                        for i, f in enumerate(contract.fields) if f.name in actual])

    def row(name: str, expected: str, got: Column, present: Column, type_ok: Column, values: Column) -> Column:
        return F.struct(F.lit(source).alias("source"), F.lit(name).alias("column_name"), F.lit(expected).alias("expected_type"),
                        got.cast("string").alias("actual_type"), present.alias("present"), type_ok.alias("type_ok"), values.cast("long").alias("values"))

    rows = [row(f.name, f.dataType.simpleString(), F.lit(actual.get(f.name)), F.lit(f.name in actual),
                F.lit(actual.get(f.name) == f.dataType.simpleString()), F.col(f"_n{i}") if f.name in actual else F.lit(0))
            for i, f in enumerate(contract.fields)]
    some = F.col("_rows") > 0
    rows.append(row("<rows>", "non-empty", F.when(some, "non-empty").otherwise("empty"), some, some, F.col("_rows")))
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def save_report(frames: Mapping[str, DataFrame], path: str) -> dict[str, str]:
    """Write each report frame as JSON under ``path/<name>`` (executors write)."""
    return {name: write_table(df, f"{path.rstrip('/')}/{name}.json", "json")
            for name, df in frames.items()}


#: A section of the report document holds metrics (one row a table, column, year or rule), not data.
MAX_SECTION_ROWS = 100_000


def save_report_document(frames: Mapping[str, DataFrame], path: str) -> StructType:
    """The whole report as one JSON document, ``{section: [row, ...], ...}``, in one text file under ``path``.

    Each section is written and counted first (independent sections at the same time); then the sections are folded
    into one row by scalar subqueries and written by one task.  Returns the document's schema for reading it back."""
    from pitchside.operators.quality import _concurrently
    from pitchside.plans.pipeline import materialize

    stored = dict(_concurrently(lambda item: (item[0], materialize(item[1], f"report_{item[0]}")), frames.items()))
    large = [name for name, df in stored.items() if df._pitchside_rows > MAX_SECTION_ROWS]
    if large:
        raise ValueError(f"not metrics, but data: {large}")
    spark = next(iter(stored.values())).sparkSession
    one = spark.range(1).select(*[
        df.agg(F.sort_array(F.collect_list(F.struct(*[f"`{c}`" for c in df.columns])))).scalar().alias(name) for name, df in stored.items()])
    one.select(F.to_json(F.struct(*stored), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return one.schema


def read_report_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One row with a column for each section of the document."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("d")).select("d.*")
