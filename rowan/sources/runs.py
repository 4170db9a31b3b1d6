"""Queryable record of every run.

Reports are JSON tables under one root, partitioned by ``run_id``: a run is a partition, the
newest run is ``max(run_id)``, and reading one run touches only its own files: ids are taken from the
listing of a table's files and then filter by literals, which prunes partitions.

A run's rows count only once the run is committed: its last write is one row of ``commits`` in one file, which
Spark renames into place. Readers resolve the commits first, so that a run that ended between two tables shows
in none of them; only the run that is writing sees its own rows before.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPLETE, REFUSED = "complete", "refused"

SCHEMAS = {
    "commits": "committed_at string, outcome string, run_id string",
    "runs": "started_at string, run_id string",
    "quality": "section string, `column` string, metric string, value double, run_id string",
    "unexpected": "`column` string, value string, n bigint, run_id string",
    "drift": (
        "previous_run_id string, `check` string, `column` string, current double, "
        "previous double, delta double, pct_change double, flagged boolean, run_id string"
    ),
    "metrics": "model string, section string, metric string, value double, run_id string",
    "history": "model string, epoch int, train_loss double, val_loss double, run_id string",
    "tuning": (
        "model string, best_params string, best_f1_mean double, best_f1_std double, "
        "num_trials bigint, run_id string"
    ),
    "thresholds": (
        "kind string, threshold double, precision double, recall double, f1 double, "
        "accuracy double, run_id string"
    ),
    "summary": (
        "dataset_rows bigint, train_rows bigint, test_rows bigint, target_positive_rate double, "
        "selected_model string, selected_framework string, selection_metric string, "
        "best_model_artifact string, models_evaluated array<string>, run_id string"
    ),
    "manifest": (
        "created_at_utc string, config string, selected_model string, "
        "selected_framework string, selection_metric string, "
        "artifact_paths map<string,string>, run_id string"
    ),
}


# Logs of runs rather than reports of one: read whether or not the run was committed.
_LOGS = ("commits", "runs")
# One row per value found: written by as many tasks as found them.
_LONG = ("unexpected",)


def new_run_id() -> str:
    """UTC time to the second, so ids sort by age, and a suffix that keeps them apart."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:6]}"


def latest(table: DataFrame) -> DataFrame:
    """Rows of the newest run of a report table."""
    newest = table.agg(F.max("run_id").alias("run_id"))
    return table.join(newest, "run_id", "left_semi")


class RunStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._own: set[str] = set()

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def start(self, run_id: str) -> None:
        """Log a run before anything can fail, so a failed one is known to later runs."""
        self._own.add(run_id)
        now = datetime.now(UTC).isoformat()
        self.append("runs", self.spark.createDataFrame([(now, run_id)], SCHEMAS["runs"]))

    def commit(self, run_id: str, outcome: str = COMPLETE) -> None:
        """Make all the run has written visible, at once. ``REFUSED`` runs ended at the gate."""
        now = datetime.now(UTC).isoformat()
        row = self.spark.createDataFrame([(now, outcome, run_id)], SCHEMAS["commits"])
        self.append("commits", row)

    def committed(self) -> list[str]:
        """The runs whose rows count, oldest first, from the names of the commits' files."""
        return self._ids("commits")

    def append(self, table: str, rows: DataFrame) -> None:
        """Add report rows (one per fact); ``run_id`` becomes the partition."""
        ordered = rows.select(*[f"`{c}`" for c in self._empty(table).columns])
        if table not in _LONG:
            # Reports are small; the shuffle keeps upstream work parallel and gives one file.
            ordered = ordered.repartition(1)
        ordered.write.mode("append").partitionBy("run_id").json(self.path(table))

    def _empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], SCHEMAS[table])

    def read(self, table: str) -> DataFrame:
        """All rows that count."""
        rows = self._rows(table)
        if table in _LOGS:
            return rows
        return rows.filter(F.col("run_id").isin([*self.committed(), *sorted(self._own)]))

    def _rows(self, table: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[table]).json(self.path(table))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self._empty(table)
            raise

    def _ids(self, table: str) -> list[str]:
        paths = self._rows(table).inputFiles()
        return sorted({unquote(p.rpartition("/run_id=")[2].partition("/")[0]) for p in paths})

    def run_ids(self, table: str) -> list[str]:
        """The runs with rows that count in a table, oldest first, from the names of its files."""
        found = self._ids(table)
        if table in _LOGS:
            return found
        counted = {*self.committed(), *self._own}
        return [r for r in found if r in counted]

    def of_run(self, table: str, *run_ids: str) -> DataFrame:
        """The given runs' rows, those of runs that do not count left out."""
        counted = set(run_ids)
        if table not in _LOGS:
            counted &= {*self.committed(), *self._own}
        return self._rows(table).filter(F.col("run_id").isin(sorted(counted)))

    def latest(self, table: str) -> DataFrame:
        return self.of_run(table, *self.run_ids(table)[-1:])

    def previous_id(self, run_id: str, skip_failed: bool = False) -> str | None:
        """The run to compare with: the last other run by id, or None if it left no report.

        ``skip_failed`` looks further back, to the last other run that did.
        """
        reported = [r for r in self.run_ids("quality") if r != run_id]
        if skip_failed:
            return max(reported, default=None)
        others = [r for r in self.run_ids("runs") if r != run_id]
        return others[-1] if others and others[-1] in reported else None

    def previous_pair(self, run_id: str, skip_failed: bool = False) -> DataFrame:
        """The run with the one to compare it with: (run_id, previous_run_id), or no row."""
        previous = self.previous_id(run_id, skip_failed)
        rows = [(run_id, previous)] if previous else []
        return self.spark.createDataFrame(rows, "run_id string, previous_run_id string")
