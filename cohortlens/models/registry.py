"""Saved models by unit, population and library version."""

from __future__ import annotations

import json

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .boosting import NODES, BoostedForest


def model_path(root: str, unit: str, model_descr: str, version: str = pyspark.__version__) -> str:
    return f"{root}/unit={unit}/model_descr={model_descr}/version={version}"


def save_model(model: PipelineModel, root: str, unit: str, model_descr: str, facts: dict | None = None) -> str:
    """``facts``: what scoring needs besides the pipeline (step, rounds, feature names), kept next to it as JSON."""
    path = model_path(root, unit, model_descr)
    model.write().overwrite().save(path)
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(facts or {}),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")
    return path


def save_forest(model: BoostedForest, root: str, unit: str, model_descr: str, facts: dict) -> str:
    """The nodes as a table, and ``facts`` with the step as JSON next to it."""
    path, spark = model_path(root, unit, model_descr), SparkSession.active()
    model.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(json.dumps({**facts, "step": model.step}),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")
    return path


def load_forest(root: str, unit: str, model_descr: str) -> BoostedForest:
    nodes = SparkSession.active().read.schema(NODES).parquet(f"{model_path(root, unit, model_descr)}/nodes")
    return BoostedForest.of_rows(nodes.collect(), load_facts(root, unit, model_descr)["step"])


def load_facts(root: str, unit: str, model_descr: str) -> dict:
    path = f"{model_path(root, unit, model_descr)}/facts"
    return json.loads(SparkSession.active().read.text(path).first()["value"])


def load_model(root: str, unit: str, model_descr: str) -> PipelineModel:
    return PipelineModel.load(model_path(root, unit, model_descr))


def registry_rows(spark: SparkSession, entries: list[tuple[str, str, str]]) -> DataFrame:
    """(unit, model_descr, version, path) rows for the registry table."""
    rows = [(u, d, pyspark.__version__, p) for u, d, p in entries]
    return spark.createDataFrame(rows, "unit string, model_descr string, version string, path string")
