"""The audit log of runs: events are appended, the state of a run is derived."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratestrata.schemas import RUN_EVENTS

RUN_KEY = ["run_id", "dag_id", "source_name"]


def run_started(spark: SparkSession, run_id: str, dag_id: str, source: str, at: datetime) -> DataFrame:
    row = (run_id, dag_id, source, "running", None, None, at, None, None)
    return spark.createDataFrame([row], RUN_EVENTS)


def run_finished(
    spark: SparkSession,
    run_id: str,
    dag_id: str,
    source: str,
    status: str,
    at: datetime,
    records_extracted: int = 0,
    records_loaded: int = 0,
    error_message: str | None = None,
) -> DataFrame:
    row = (run_id, dag_id, source, status, records_extracted, records_loaded, None, at, error_message)
    return spark.createDataFrame([row], RUN_EVENTS)


#: Files of the log from which on it is merged.
MOST_FILES = 64


def append_event(event: DataFrame, path: str, most_files: int = MOST_FILES) -> None:
    """Add an event, a small file. When there are `most_files`, they are merged first."""
    if len(_files(event.sparkSession, path)) >= most_files:
        merge_events(event.sparkSession, path)
    event.write.mode("append").parquet(path)


def _files(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    return [str(s.getPath()) for s in files.listStatus(place) if s.getPath().getName().endswith(".parquet")]


def merge_events(spark: SparkSession, path: str) -> None:
    """Write all events of the log, each once, into as few files as their size needs, then remove the files they came from.

    A crash in between leaves events twice, which changes no state, and the next merge drops them. Events
    that others add meanwhile lie in files of their own and stay.
    """
    before = _files(spark, path)
    if not before:
        return
    spark.read.schema(RUN_EVENTS).parquet(*before).distinct().hint("rebalance").write.mode("append").parquet(path)
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in before:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name), False)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of the log, each once."""
    return spark.read.schema(RUN_EVENTS).parquet(path).distinct()


def run_state(events: DataFrame) -> DataFrame:
    """One row per run. A run without a finish event is still `running`; of several finish
    events the last one counts."""
    finish = F.struct(
        "finished_at", "status", "records_extracted", "records_loaded", "error_message"
    )
    last = F.max(F.when(F.col("status") != "running", finish))
    state = events.groupBy(*RUN_KEY).agg(F.min("started_at").alias("started_at"), last.alias("last"))
    return state.select(
        *RUN_KEY,
        F.coalesce("last.status", F.lit("running")).alias("status"),
        F.col("last.records_extracted").alias("records_extracted"),
        F.col("last.records_loaded").alias("records_loaded"),
        "started_at",
        F.col("last.finished_at").alias("finished_at"),
        F.col("last.error_message").alias("error_message"),
    )


def recent_runs(state: DataFrame, n: int = 10) -> DataFrame:
    """The `n` runs started last; ties go by run id. Each map task keeps `n` rows."""
    return (
        state.orderBy(F.desc_nulls_first("started_at"), F.asc("run_id"), F.asc("source_name"))
        .limit(n)
        .select("source_name", "status", "records_loaded", "started_at", "finished_at")
    )
