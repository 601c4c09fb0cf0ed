"""Run audit: what ran, when, and how it ended."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

RUN_SCHEMA = ("name string, state string, started_at timestamp, completed_at timestamp, "
              "input_rows bigint, error_message string, detail string")


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def record(spark: SparkSession, audit: str, *runs: tuple) -> None:
    """Append rows of `RUN_SCHEMA`, as one file."""
    if runs:
        spark.createDataFrame(list(runs), RUN_SCHEMA).coalesce(1).write.mode("append").parquet(audit)


def read_runs(spark: SparkSession, audit: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(audit)


def audited(spark: SparkSession, audit: str, name: str, run: Callable[[], object]) -> object:
    """Run a step and note its outcome; a failure is noted and raised.

    A step that gives counts of what it wrote, observed in the pass that wrote it, has
    `rows` as its input rows and all counts as detail.
    """
    started = _now()
    try:
        result = run()
    except Exception as e:
        record(spark, audit, (name, "FAILED", started, _now(), None, str(e), None))
        raise
    counts = result if isinstance(result, dict) else {}
    record(spark, audit, (name, "SUCCEEDED", started, _now(), counts.get("rows"), None, json.dumps(counts) if counts else None))
    return result


def recent_runs(audit: DataFrame, hours: int = 24, as_of: Column | None = None) -> DataFrame:
    """Runs that started in the last hours, newest first."""
    now = F.current_timestamp() if as_of is None else as_of
    recent = audit.filter(F.col("started_at") >= now - F.make_dt_interval(hours=F.lit(hours)))
    return recent.orderBy(F.desc("started_at"), "name")


def last_outcomes(audit: DataFrame) -> DataFrame:
    """Newest audit row of each name: the status of every load and refresh."""
    newest = F.max_by(F.struct("state", "started_at", "completed_at", "input_rows", "error_message", "detail"), "started_at")
    return audit.groupBy("name").agg(newest.alias("last")).select("name", "last.*")


class StreamAudit(StreamingQueryListener):
    """Writes the progress and the end of each streaming query to the audit table.

    Progress is held back and written `together` reports at a time, and when a query ends.
    """

    def __init__(self, spark: SparkSession, audit: str, together: int = 100) -> None:
        self._spark, self._audit, self._together = spark, audit, together
        self._names: dict[str, str] = {}
        self._held: list[tuple] = []

    def _flush(self) -> None:
        held, self._held = self._held, []
        record(self._spark, self._audit, *held)

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            detail = json.dumps({"batch": p.batchId, "rows_per_second": p.processedRowsPerSecond})
            self._held.append((p.name or str(p.id), "RUNNING", datetime.datetime.fromisoformat(p.timestamp), _now(), p.numInputRows, None, detail))
            if len(self._held) >= self._together:
                self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self._names.get(str(event.id), str(event.id))
        self._held.append((name, "FAILED" if event.exception else "FINISHED", _now(), _now(), None, event.exception, None))
        self._flush()
