"""The whole run on the stand-in cohort: search, save, load, publish."""

import datetime

import pytest
from conftest import SF
from pyspark.sql import functions as F

from cohortlens.fixtures import CATEGORICAL, NUMERIC, view
from cohortlens.models.search import exhausting_minimum, grid, sample_rows
from cohortlens.plans.cohorts import unit_cohorts
from cohortlens.plans.flow import diagnostics, encode, retention_risk
from cohortlens.session import fresh_path

DAY = datetime.date(2001, 8, 1)


@pytest.fixture(scope="module")
def runs(spark):
    cohort, registry = view(spark, SF, "fx_cohort"), fresh_path(spark, "registry")
    common = dict(units="PU", model_id=2, model_descr="ft_ft_1yr", run_date=DAY, registry=registry, trees=4, depth=2, rounds=2)
    search = {"choices": grid(depth=[1, 2], step=[0.01, 1.0]), "min_rounds": 1, "max_rounds": 2, "folds": 2}
    first = retention_risk(cohort, CATEGORICAL, NUMERIC, search=search, explain=True, **common)
    again = retention_risk(cohort, CATEGORICAL, NUMERIC, refit=False, **common)
    return first, again


def test_loaded_models_score_alike(runs):
    first, again = (r.predictions.toPandas().sort_values(["unit", "emplid"]).reset_index(drop=True) for r in runs)
    assert len(first) > 0 and first.equals(again)


def test_every_scored_row_has_an_outcome_and_an_explanation(runs):
    run, _ = runs
    n = run.outcome.count()
    assert n == run.predictions.count() == run.aggregate.count() == run.shap.count()
    assert run.aggregate.where("sex_descr IS NULL OR first_gen_descr IS NULL").count() == 0
    assert run.shap.where("shap_descr_1 IS NULL").count() == 0
    assert {(r["unit"], r["model_type"]) for r in run.quality.collect()} == {(u, t) for u in "PU" for t in ("train", "valid")}
    assert {r[0] for r in run.fairness.select("adj_acad_prog_primary_campus").distinct().collect()} == {"PULLM", "EVERE"}


def test_diagnostics_of_every_unit(spark):
    coded, indicators = encode(unit_cohorts(view(spark, SF, "fx_cohort"), ["emplid", "enrl_ind", *CATEGORICAL, *NUMERIC]), CATEGORICAL)
    columns = ["male", "resident", "fall_lec_count", "unmet_need_ofr_mi"]
    logit, factors = diagnostics(coded.where("unit IN ('P', 'U')").cache(), columns)
    assert {(r["unit"], r["status"]) for r in logit.collect()} == {("P", "converged"), ("U", "converged")}
    assert {r["term"] for r in logit.collect()} == {"male", "resident", "fall_lec_count", "intercept"}
    rows = factors.where("unit = 'P'").collect()
    assert [r["vif"] for r in rows if r["vif"] is not None] == sorted((r["vif"] for r in rows if r["vif"] is not None), reverse=True)
    assert {r["feature"] for r in rows if r["vif"] is None} == {"unmet_need_ofr_mi"}


def test_publish_appends(spark, runs):
    root = fresh_path(spark, "published")
    for _ in range(2):
        runs[0].publish(root)
    once = runs[0].outcome.count()
    for name in ("pred_outcome", "aggregate_outcome"):
        assert spark.read.parquet(f"{root}/{name}").where(F.col("model_id") == 2).count() == 2 * once
    removed = spark.read.parquet(f"{root}/removed_rows")
    assert {r["reason"] for r in removed.select("reason").distinct().collect()} == {"outlier", "tomek link"}
    assert runs[0].unscored.count() == 0
    assert spark.read.parquet(f"{root}/student_outcome").where(F.col("model_id") == 2).count() == 2 * once
    assert spark.read.parquet(f"{root}/student_fairness").count() > 0
    logit, factors = (spark.read.parquet(f"{root}/{n}").where(F.col("model_id") == 2) for n in ("logit", "vif"))
    assert {r["unit"] for r in logit.collect()} == {r["unit"] for r in factors.collect()} == set("PU")
    assert logit.where("status = 'converged' OR status LIKE 'failed: %'").count() == logit.count()


def test_rows_as_a_resource(spark):
    df = spark.range(4000)
    part = sample_rows(df, "id", 1000, 4000)
    assert 850 < part.count() < 1150 and sample_rows(df, "id", 9000, 4000).count() == 4000
    assert exhausting_minimum(220, 5000, 3, folds=5) == 61 and exhausting_minimum(4, 30, 3, folds=5) == 20
