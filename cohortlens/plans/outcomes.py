"""Result tables: predictions, risk with descriptions, history rows, fairness rows, explanations."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pad_student_id, risk_prob, threshold_pred
from ..operators.metrics import fairness_frame
from ..operators.relational import label_case, last_wins, ranked, topn_wide

# The descriptions written for each code. The first-generation pair is kept as it is
# published, although 'Y' reads as "non-First Gen".
SEX = {1: "Male", 0: "Female"}
MINORITY = {1: "Minority", 0: "Non-minority"}
RESIDENT = {1: "Resident", 0: "non-Resident"}
FIRST_GEN = {1: "non-First Gen", 0: "First Gen"}
FIRST_GEN_CODE = {"Y": 1, "N": 0}


def aggregate_outcome(scored: DataFrame, prob: str = "prob", keep: list[str] = ()) -> DataFrame:
    """One risk row per student with indicators and their descriptions."""
    coded = scored.select(
        *keep, pad_student_id("emplid").alias("emplid"),
        F.col("male").cast("int").alias("sex_ind"),
        F.col("underrep_minority").cast("int").alias("underrep_minority_ind"),
        label_case("first_gen_flag", FIRST_GEN_CODE).alias("first_gen_ind"),
        F.col("resident").cast("int").alias("resident_ind"),
        risk_prob(prob).alias("risk_prob"),
    )
    return coded.withColumns({
        "sex_descr": label_case("sex_ind", SEX),
        "underrep_minority_descr": label_case("underrep_minority_ind", MINORITY),
        "resident_descr": label_case("resident_ind", RESIDENT),
        "first_gen_descr": label_case("first_gen_ind", FIRST_GEN),
    })


def student_outcome(scored: DataFrame, run_date: datetime.date, model_id: int, prob: str = "prob",
                    keep: list[str] = ()) -> DataFrame:
    return scored.select(
        *keep, pad_student_id("emplid").alias("emplid"), risk_prob(prob).alias("risk_prob"),
        F.lit(run_date).cast("date").alias("date"), F.lit(model_id).alias("model_id"),
    )


def pred_outcome(scored: DataFrame, models: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """emplid with <model>_prob and <model>_pred for each model's probability column."""
    cols = []
    for name, prob in models.items():
        cols += [F.col(prob).alias(f"{name}_prob"), threshold_pred(prob).alias(f"{name}_pred")]
    return scored.select(*keep, "emplid", *cols)


def student_fairness(scored: DataFrame, run_date: datetime.date, model_id: int, model_descr: str,
                     by: list[str], y: str = "y_true", pred: str = "pred") -> DataFrame:
    return fairness_frame(scored, y, pred, ["male", "underrep_minority"], by, {
        "date": F.lit(run_date).cast("date"), "model_id": model_id, "model_descr": model_descr,
    })


def student_shap(contributions: DataFrame, n: int, run_date: datetime.date, model_id: int,
                 seq: str | None = None, keep: list[str] = ()) -> DataFrame:
    """One wide row per student with the n strongest contributions. A repeated id keeps its last row."""
    rows = last_wins(contributions, "emplid", seq) if seq else contributions
    return rows.withColumn("_ranked", ranked("contributions")).select(
        *keep, pad_student_id("emplid").alias("emplid"), *topn_wide("_ranked", n),
        F.lit(run_date).cast("date").alias("date"), F.lit(model_id).alias("model_id"),
    )
