"""Raw tables that several writers fill.

A raw table bears its rows' columns and three it is partitioned by: the month of
the event, the writer, and the number of the writer's batch. CSV loads append under
one writer; a stream replaces the partitions of a batch, so that a batch that
is repeated after a failure leaves what it left before. Every writer needs a
name of its own. Rows are dealt out by month, and adaptive execution cuts a month
into as many tasks as its size asks for, so a batch of one month is no one task.
Years of history make tens of partitions, not thousands.

Batches of a stream pile up small partitions; ``compact`` merges them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

LAYOUT = StructType(
    [StructField("event_month", DateType()), StructField("writer", StringType()), StructField("batch_id", LongType())]
)

#: The writer of loads that append.
LOADS = "load"


def ensure_raw(spark: SparkSession, name: str, schema: StructType) -> None:
    """Create a raw table where it is absent; refuse one of another layout."""
    if not spark.catalog.tableExists(name):
        empty = spark.createDataFrame([], StructType([*schema, *LAYOUT]))
        empty.write.partitionBy(*LAYOUT.names).saveAsTable(name)
    found = spark.table(name).columns
    if found != [*schema.names, *LAYOUT.names]:
        raise ValueError(f"{name} has columns {found}: no raw table of {schema.names} by {LAYOUT.names}")


def raw_rows(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a raw table without the columns of its layout."""
    return spark.table(name).drop(*LAYOUT.names)


def _laid_out(rows: DataFrame, time: Column, writer: str, batch: int) -> DataFrame:
    placed = rows.withColumns(
        {"event_month": F.trunc(time, "month"), "writer": F.lit(writer), "batch_id": F.lit(batch).cast("bigint")}
    )
    return placed.hint("rebalance", F.col("event_month"))


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that get rows, and only those."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append_rows(rows: DataFrame, time: Column, name: str, writer: str = LOADS) -> None:
    """Add rows under ``writer``; ``time`` is when each happened."""
    _laid_out(rows, time, writer, 0).write.insertInto(name)


def replace_batch(rows: DataFrame, time: Column, name: str, writer: str, batch: int) -> None:
    """Make ``rows`` all that batch ``batch`` of ``writer`` left in the table."""
    spark = rows.sparkSession
    # A repeated batch may have other months than before, if these follow the clock.
    _drop(spark, name, [p for p in _partitions(spark, name) if p[1:] == (writer, batch)])
    with _replacing_partitions(spark):
        _laid_out(rows, time, writer, batch).write.insertInto(name, overwrite=True)


def _partitions(spark: SparkSession, name: str) -> list[tuple[str, str, int]]:
    """(month, writer, batch) of the table's partitions, from the catalog."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        month, writer, batch = (part.partition("=")[2] for part in row["partition"].split("/"))
        found.append((month, writer, int(batch)))
    return found


def _drop(spark: SparkSession, name: str, partitions: list[tuple[str, str, int]], at_once: int = 500) -> None:
    for at in range(0, len(partitions), at_once):
        specs = ", ".join(
            "PARTITION (event_month={}, writer='{}', batch_id={})".format(
                "null" if month.startswith("__HIVE") else f"'{month}'", writer, batch
            )
            for month, writer, batch in partitions[at : at + at_once]
        )
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")


def _side_folder(spark: SparkSession, name: str) -> str:
    """Beside the table's own folder, so that it outlives the session."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/") + "_compacting"


_PLAN = "event_month string, writer string, batch_id bigint, target bigint"


def _finish(spark: SparkSession, name: str, side: str) -> None:
    """Bring a written compaction into the table; may be repeated until its folder is gone."""
    plan = [(p["event_month"], p["writer"], p["batch_id"], p["target"]) for p in spark.read.schema(_PLAN).parquet(f"{side}/plan").collect()]
    merged = spark.read.schema(spark.table(name).schema).parquet(f"{side}/rows")
    _drop(spark, name, [(month, writer, batch) for month, writer, batch, target in plan if batch != target])
    with _replacing_partitions(spark):
        merged.write.insertInto(name, overwrite=True)
    _delete(spark, side)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _delete(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def recover(spark: SparkSession, name: str) -> None:
    """Finish compactions that were written but broken off; drop those broken off before.

    Readers and ``compact`` may call this; nothing happens where all are whole.
    """
    files, path = _file_system(spark, _side_folder(spark, name))
    if not files.exists(path):
        return
    for entry in files.listStatus(path):
        side = entry.getPath().toString()
        if files.exists(_file_system(spark, f"{side}/plan/_SUCCESS")[1]):
            _finish(spark, name, side)
        else:
            files.delete(entry.getPath(), True)


def compact(spark: SparkSession, name: str) -> int:
    """Merge the batch partitions of each month and writer into one; returns how many went.

    A writer's latest batch may be repeated after a failure, so it stays as it is;
    an earlier one never is, since a stream commits a batch before the next.
    The merged rows and then the plan are written beside the table first; a run that is
    broken off after that is finished by the next. Readers miss rows while
    partitions are exchanged, so compact while none runs. Partitions without a
    month stay.
    """
    recover(spark, name)
    latest: dict[str, int] = {}
    groups: dict[tuple[str, str], list[int]] = {}
    for month, writer, batch in _partitions(spark, name):
        latest[writer] = max(batch, latest.get(writer, batch))
        groups.setdefault((month, writer), []).append(batch)
    plan = []
    for (month, writer), batches in groups.items():
        closed = [b for b in batches if b < latest[writer]]
        if len(closed) > 1 and not month.startswith("__HIVE"):
            plan += [(month, writer, b, max(closed)) for b in closed]
    if not plan:
        return 0
    side = f"{_side_folder(spark, name)}/{uuid.uuid4().hex}"
    # As many rows as the catalog names partitions.
    plans = spark.createDataFrame(plan, _PLAN)
    rows = spark.table(name)
    to = plans.select(F.col("event_month").cast("date").alias("event_month"), "writer", "batch_id", "target")
    merged = rows.join(F.broadcast(to), LAYOUT.names).withColumn("batch_id", F.col("target")).select(*rows.columns)
    merged.hint("rebalance", F.col("event_month"), F.col("writer")).write.parquet(f"{side}/rows")
    plans.coalesce(1).write.parquet(f"{side}/plan")
    _finish(spark, name, side)
    return len(plan) - len({(month, writer) for month, writer, _, _ in plan})
