"""The whole scoring run: cohorts, outliers, Tomek links, one model per unit, quality, explanations, results."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..explain.contributions import tree_contributions
from ..functions import threshold_pred
from ..models.grouped import logit_inference, vif
from ..models.boosting import BoostedForest, boosted_forest, boosted_forests, score
from ..models.registry import load_facts, load_forest, save_forest
from ..models.search import halving_search
from ..operators.features import OneHot, as_array, assemble, feature_names
from ..operators.metrics import accuracy, roc_auc
from ..operators.neighbors import remove_outliers, tomek_undersample
from ..operators.relational import label_case
from ..session import cut
from ..sources import append_run
from .cohorts import unit_cohorts
from .dimensions import scored_campuses
from .outcomes import aggregate_outcome, pred_outcome, student_fairness, student_outcome, student_shap

GROUP = ["unit", "split"]
DESCRIBED = ["male", "underrep_minority", "first_gen_flag", "resident"]


def per_unit(spark: SparkSession, units: list[str], fit: Callable[[str], object], parallel: int = 4) -> dict[str, object]:
    """One fit per unit, a few at a time; each fit is a series of Spark jobs."""
    with ThreadPoolExecutor(min(parallel, len(units))) as pool:
        return dict(zip(units, pool.map(inheritable_thread_target(spark)(fit), units)))


def encode(df: DataFrame, categorical: list[str], unseen: str = "error") -> tuple[DataFrame, list[str]]:
    """Indicators on each unit's own training categories, and their names."""
    encoder = OneHot.fit(df.where("split = 'training'"), categorical, ["unit"], unseen)
    return encoder.transform(df), encoder.names()


def diagnostics(coded: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(logit, vif) of each unit's training rows: estimates with their tests, and inflation factors, highest first.

    The logit leaves out columns that do not vary in the unit; a fit that fails is a row with its status.
    """
    train = coded.where("split = 'training'")
    return logit_inference(train, "enrl_ind", columns, ["unit"]), vif(train, columns, ["unit"]).orderBy("unit", F.desc("vif"))


def clean(coded: DataFrame, columns: list[str], k: int = 20) -> tuple[DataFrame, DataFrame]:
    """(left, removed): training and validation rows without outliers and Tomek links, each unit and split on its own.

    ``removed`` holds the keys of the others and the ``reason``.
    """
    fitted = coded.where("split <> 'testing'")
    kept, outliers = remove_outliers(fitted, "emplid", columns, k, GROUP)
    vectors = cut(kept.withColumn("_x", as_array(columns)), "kept")
    left, linked = tomek_undersample(vectors, "emplid", "_x", "enrl_ind", "all", GROUP)
    why = [df.select(*GROUP, "emplid", F.lit(r).alias("reason")) for df, r in ((outliers, "outlier"), (linked, "tomek link"))]
    return left.drop("_x"), why[0].unionByName(why[1])


@dataclass
class Run:
    """What a run leaves behind: models per unit, and its result tables."""

    models: dict[str, BoostedForest]
    outcome: DataFrame
    predictions: DataFrame
    aggregate: DataFrame | None
    fairness: DataFrame
    quality: DataFrame
    shap: DataFrame | None
    removed: DataFrame  # rows left out of the fit, with the reason
    unscored: DataFrame  # testing rows of units that have no fitted rows
    run_date: datetime.date
    model_id: int
    design: DataFrame  # the fitted rows with their columns
    columns: list[str]

    def diagnostics(self) -> tuple[DataFrame, DataFrame]:
        """Logit and inflation factors of each unit's fitted training rows."""
        return diagnostics(self.design, self.columns)

    def publish(self, root: str) -> None:
        """Append the run to the history tables below ``root``."""
        append_run(self.outcome, f"{root}/student_outcome")
        append_run(self.fairness, f"{root}/student_fairness")
        named = {"date": F.lit(self.run_date), "model_id": F.lit(self.model_id)}
        logit, factors = self.diagnostics()
        others = {"logit": logit, "vif": factors, "student_shap": self.shap, "pred_outcome": self.predictions, "aggregate_outcome": self.aggregate,
                  "removed_rows": self.removed, "unscored_rows": self.unscored}
        for name, df in others.items():
            if df is not None:
                append_run(df.withColumns(named), f"{root}/{name}")


def searched(train: DataFrame, valid: DataFrame, search: dict, **forest) -> dict:
    """A unit's depth, gamma, step and rounds, found by halving over rounds.

    ``search`` holds ``choices``, ``min_rounds``, ``max_rounds`` and ``folds``.
    """
    folds = search.get("folds", 3)
    rows = cut(train.select("features", "enrl_ind", F.pmod(F.xxhash64("emplid"), F.lit(folds)).alias("fold")), "folds")

    def candidate(part: DataFrame, choice: dict, rounds: int):
        return boosted_forest(part, valid, "enrl_ind", **{**forest, **choice, "rounds": rounds}).transform

    best, log = halving_search(rows, "enrl_ind", "fold", folds, search["choices"], candidate, search["min_rounds"], search["max_rounds"])
    return {**best, "rounds": max(r[2] for r in log if search["choices"][r[1]] == best)}


def retention_risk(df: DataFrame, categorical: list[str], numeric: list[str], units: str, model_id: int, model_descr: str,
                   run_date: datetime.date, explain: bool = False, top_n: int = 5, unseen: str = "error",
                   search: dict | None = None, registry: str | None = None, refit: bool = True, **forest) -> Run:
    """Score the testing rows of every unit with a boosted forest fitted on its cleaned training rows.

    With a ``registry`` folder, models are saved there, and loaded from there when ``refit`` is False.
    """
    spark = df.sparkSession
    names = ["emplid", "enrl_ind", *categorical, *numeric]
    coded, indicators = encode(cut(unit_cohorts(df, names, units), "cohort"), categorical, unseen)
    columns = [*indicators, *numeric]
    coded = cut(coded.select(*GROUP, "emplid", "enrl_ind", *columns, *categorical), "coded", ("unit", "split"))
    vectors = assemble(columns)
    left, removed = clean(coded, columns)
    fitted = vectors.transform(cut(left, "fitted", ("unit", "split")))
    testing = vectors.transform(coded.where("split = 'testing'"))
    present = {r["unit"] for r in fitted.select("unit").distinct().collect()}
    chosen = [u for u in units if u in present]

    def split(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("split") == name)

    def rows(unit: str, name: str) -> DataFrame:
        return split(fitted.where(F.col("unit") == unit), name)

    def saved(unit: str) -> BoostedForest:
        facts = load_facts(registry, unit, model_descr)
        if facts["features"] != columns:
            raise ValueError(f"the saved model of {unit} has other features: {sorted(set(facts['features']) ^ set(columns))}")
        return load_forest(registry, unit, model_descr)

    if registry and not refit:
        models = {u: saved(u) for u in chosen}
    else:
        own = per_unit(spark, chosen, lambda u: searched(rows(u, "training"), rows(u, "validation"), search, **forest)) if search else {}
        fitting = fitted.where(F.col("unit").isin(chosen))
        models = boosted_forests(split(fitting, "training"), split(fitting, "validation"), "enrl_ind", "unit", settings=own, **forest)
        chosen = [u for u in chosen if u in models]  # a unit may have validation rows only
        if registry:
            for u, model in models.items():
                save_forest(model, registry, u, model_descr, {"rounds": len(model.rounds), "features": columns})

    def scored(part: DataFrame) -> DataFrame:
        return score(models, part.where(F.col("unit").isin(chosen)), "unit").withColumn("pred", threshold_pred("prob"))

    tested = scored(testing)
    judged = scored(fitted).withColumn("model_type", F.when(F.col("split") == "training", "train").otherwise("valid"))
    campus = label_case("unit", {u: scored_campuses(units, u)[0] for u in chosen})
    fairness = student_fairness(judged, run_date, model_id, model_descr, ["unit", "model_type"], y="enrl_ind").withColumn(
        "adj_acad_prog_primary_campus", campus)
    kinds = ["unit", "model_type"]
    quality = roc_auc(judged, "enrl_ind", "prob", kinds).join(accuracy(judged, "enrl_ind", "pred", kinds), kinds)
    shap = None
    if explain:
        labels = feature_names(testing)
        told = [
            tree_contributions(testing.where(F.col("unit") == u), ["unit", "emplid"], rows(u, "training"), models[u], labels)
            for u in chosen
        ]
        shap = student_shap(reduce(DataFrame.unionByName, told), top_n, run_date, model_id, keep=["unit"])
    described = set(DESCRIBED) <= set(tested.columns)
    return Run(
        models=models,
        outcome=student_outcome(tested, run_date, model_id, keep=["unit"]),
        predictions=pred_outcome(tested, {"xgbrf": "prob"}, keep=["unit"]),
        aggregate=aggregate_outcome(tested, keep=["unit"]) if described else None,
        fairness=fairness, quality=quality, shap=shap, removed=removed, run_date=run_date, model_id=model_id,
        design=fitted.drop("features"), columns=columns,
        unscored=testing.where(~F.col("unit").isin(chosen)).select("unit", "emplid", F.lit("no fitted rows").alias("reason")),
    )
