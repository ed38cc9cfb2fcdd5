"""State of the change runs: snapshots of the record map, a run log and an error log.

Every run writes a new snapshot folder and then one line set to the run log. The newest run in
the log names the snapshot to read, so a run that dies half way leaves the last state in force
and no folder is ever overwritten while it is read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterforge.config import Config
from rosterforge.operators.changes import STATE_SCHEMA, error_log, no_state, requests, run_stats
from rosterforge.sources.staging import PACKED


def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The run that finished last; ids are names and have no order."""
    runs = _read_or_none(spark, f"{root}/runs")
    return None if runs is None else runs.agg(F.max_by("run_id", F.struct("finished_at", "run_id"))).first()[0]


def read_state(spark: SparkSession, root: str) -> DataFrame:
    run_id = latest_run(spark, root)
    if run_id is None:
        return no_state(spark)
    return spark.read.schema(STATE_SCHEMA).parquet(f"{root}/record_map/{run_id}")


def save_run(outcomes: DataFrame, state: DataFrame, root: str, run_id: str, failures: DataFrame | None = None) -> None:
    """Write the state after a run and the logs. The run log comes last: it makes the run count.

    A run id is used once: the folder of an earlier run is never written again, and Spark refuses.
    """
    state.write.mode("errorifexists").options(**PACKED).parquet(f"{root}/record_map/{run_id}")
    if failures is not None:
        error_log(failures, run_id).write.mode("append").parquet(f"{root}/errors")
    stats = run_stats(outcomes).select(
        F.lit(run_id).alias("run_id"), "*", F.current_timestamp().alias("finished_at")
    )
    stats.write.mode("append").parquet(f"{root}/runs")


def write_requests(plan: DataFrame, folder: str, cfg: Config) -> None:
    """Dry run: every write of the plan as one JSON line, in gzip files since lines are mostly field names."""
    lines = requests(plan, cfg).select(F.to_json(F.struct("*")).alias("value"))
    lines.write.mode("overwrite").text(folder, compression="gzip")
