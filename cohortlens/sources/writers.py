"""Sinks: replace, append by run, and histories whose every version stays as a backup."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_replace(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Replace what is stored at ``path``."""
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


def append_run(df: DataFrame, path: str, by: tuple[str, ...] = ("date", "model_id")) -> None:
    """Append one run to a table laid out by run, so a reader of one run opens one folder."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def append_with_backup(df: DataFrame, root: str) -> int:
    """Add a run to the history below ``root`` and return the history's new version, counted from 1.

    A run is a folder of its own, written first, and an entry that names it, written last. So a run costs what it holds
    however long the history is, a run that breaks off has no entry and is never seen, and every version stays readable:
    the one before is the backup. Two writers of one version cannot both succeed.
    """
    spark = df.sparkSession
    version = max(entries(spark, root), default=0) + 1
    run = f"run-{version:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/runs/{run}")
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("errorifexists").json(f"{root}/entries/version={version}")
    return version


def entries(spark: SparkSession, root: str) -> dict[int, str]:
    """The run that each version of a history added."""
    try:
        listed = spark.read.schema("run string, version int").option("pathGlobFilter", "*.json").json(f"{root}/entries")
        return {r["version"]: r["run"] for r in listed.collect()}
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return {}
        raise


def read_history(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The runs of a history, or those up to ``version``; a column that a run lacks is null there."""
    runs = [run for v, run in sorted(entries(spark, root).items()) if version is None or v <= version]
    if not runs:
        raise FileNotFoundError(f"no run up to version {version} in {root}")
    return spark.read.option("mergeSchema", "true").parquet(*[f"{root}/runs/{r}" for r in runs])


def nested_topn(contributions: str | Column, n: int) -> Column:
    """The first ``n`` entries of a ranked array of (feature, value) as JSON text."""
    col = F.col(contributions) if isinstance(contributions, str) else contributions
    return F.to_json(F.slice(col, 1, n))
