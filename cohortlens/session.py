"""Session helpers: a default local session, and the shared folder that tables are cut into."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str = "8", name: str = "cohortlens", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session of one process that names none gets a temporary folder.
    """
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or spark.sparkContext.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return os.path.join(shared_dir(spark), "cohortlens", f"{tag}-{uuid.uuid4().hex}")


def cut(df: DataFrame, tag: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, keeps columns prunable, and gives the planner
    real sizes for the joins that follow. ``by`` lays the table out in folders, so that a filter on
    those columns opens only its own.
    """
    path = fresh_path(df.sparkSession, tag)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_groups(df: DataFrame, stats: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """``df`` with the columns of ``stats``, which has one row per group ``by``. NULL is a group like any other.

    A plain join: the planner picks its form from sizes, and splits hot groups at run time.
    """
    if not by:
        return df.crossJoin(stats)  # one row
    named = stats.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    return df.join(named, same, how).drop(*[f"_by_{c}" for c in by])
