"""Raw tables in, snapshots and predictions out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from rowan.functions.text import normalise_na
from rowan.sources.csv_records import read_csv_records, splittable


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    lowered = path.rstrip("/").lower()
    return "csv" if lowered.endswith((".csv", ".csv.gz", ".tsv")) else "parquet"


def csv_options(path: str = "") -> dict[str, str]:
    """How CSV is read: records may hold quoted line breaks, and a record with too many or too few
    fields stops the read instead of losing values. ``mode=PERMISSIVE`` fills and cuts records."""
    return {
        "header": "true",
        "escape": '"',
        "mode": "FAILFAST",
        "columnPruning": "false",
        "sep": "\t" if path.lower().endswith(".tsv") else ",",
    }


def read_raw(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a raw table with its text untouched and missing-value tokens as nulls.

    CSV columns all come in as text (no inference pass over the file, leading zeros kept), and large
    files in several tasks. ``options`` go to Spark's reader, over ``csv_options``; a ``multiLine`` among
    them, or options that change quotes or line ends, leave the reading to Spark's reader alone.
    """
    fmt = _format_of(path, fmt)
    given = {**(csv_options(path) if fmt == "csv" else {}), **(options or {})}
    if fmt == "csv" and splittable(given):
        return normalise_na(read_csv_records(spark, path, given))
    if fmt == "csv":
        given = {"multiLine": "true", **given}
    return normalise_na(spark.read.format(fmt).options(**given).load(path))


def choose_source(dataset_path: str | None, fallback: str | None) -> str:
    """The given path if there is one, else the fallback location."""
    chosen = dataset_path or fallback
    if not chosen:
        raise ValueError("No dataset path given.")
    return chosen


def snapshot_path(root: str, run_id: str) -> str:
    return f"{root}/dataset/run_id={run_id}"


def write_snapshot(df: DataFrame, root: str, run_id: str) -> str:
    """Keep the run's input as Parquet; later passes read pruned columns from it."""
    path = snapshot_path(root, run_id)
    df.write.mode("errorifexists").parquet(path)
    return path


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)
    return path
