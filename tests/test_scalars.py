import datetime

import pytest
from pyspark.sql import functions as F

from cohortlens import functions as S
from cohortlens.operators import relational as R


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, t in _types(cols)))
    return df.select(expr.alias("v")).first()["v"]


def _types(cols):
    kinds = {str: "string", float: "double", int: "int", datetime.date: "date", datetime.datetime: "timestamp"}
    return [(k, kinds[type(v)]) for k, v in cols.items()]


@pytest.mark.parametrize("raw, padded", [("7", "000000007"), ("123456789", "123456789"), ("1234567890", "1234567890")])
def test_ids_are_padded_not_cut(spark, raw, padded):
    assert one(spark, S.pad_student_id("s"), s=raw) == padded


@pytest.mark.parametrize("p, risk", [(0.12345, 1 - 0.1234), (0.5, 0.5), (0.0, 1.0), (1.0, 0.0)])
def test_risk_rounds_half_even(spark, p, risk):
    assert one(spark, S.risk_prob("p"), p=p) == pytest.approx(risk, abs=1e-12)


@pytest.mark.parametrize("day, week", [
    ((2022, 1, 1), 0), ((2022, 1, 2), 1), ((2023, 1, 1), 1), ((2024, 12, 31), 52), ((2024, 8, 19), 33),
])
def test_weeks_start_on_sunday_from_zero(spark, day, week):
    assert one(spark, S.week_sunday_zero("d"), d=datetime.date(*day)) == week


def test_missing_dates_get_sentinels(spark):
    df = spark.createDataFrame([(None,)], "d date")
    row = df.select(S.coalesce_days("d").alias("d"), *S.date_fields("d", "x")).first()
    assert row.asDict() == {"d": datetime.date(2233, 10, 15), "x_day": 99999, "x_week": 99999, "x_month": 99999, "x_year": 99999}


def test_previous_day_drops_the_time(spark):
    assert one(spark, S.prev_day("t"), t=datetime.datetime(2022, 3, 1, 13, 30)) == datetime.date(2022, 2, 28)


def test_blank_term_kind_is_not_nine(spark):
    df = spark.createDataFrame([("0953",), ("0959",), ("095",), (None,)], "s string")
    assert [r[0] for r in df.select(S.term_kind("s") != "9").collect()] == [True, False, True, True]


def test_text_dates_round_trip(spark):
    assert one(spark, S.parse_day(S.format_day("d")), d=datetime.date(2022, 8, 9)) == datetime.date(2022, 8, 9)


@pytest.mark.parametrize("offset, open_", [(-1, False), (0, True), (1, True)])
def test_gate_opens_on_its_day(spark, offset, open_):
    gate = datetime.date(2022, 9, 1)
    assert one(spark, R.date_gate("d", "g"), d=gate + datetime.timedelta(days=offset), g=gate) is open_


def test_missing_gate_stays_closed(spark):
    df = spark.createDataFrame([(datetime.date(2022, 9, 1), None)], "d date, g date")
    assert df.select(R.date_gate("d", "g")).first()[0] is False


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.5000001,)], "p double")
    assert [r[0] for r in df.select(S.threshold_pred("p")).collect()] == [0, 1]


def test_unlisted_codes_have_no_label(spark):
    df = spark.createDataFrame([(1,), (0,), (2,), (None,)], "c int")
    assert [r[0] for r in df.select(R.label_case("c", {1: "a", 0: "b"})).collect()] == ["a", "b", None, None]


def test_ranked_breaks_ties_by_name(spark):
    df = spark.sql("SELECT array(struct('b' AS feature, -1D AS value), struct('a' AS feature, 1D AS value), struct('c' AS feature, 2D AS value)) AS c")
    got = df.select(R.ranked("c").alias("r")).first()["r"]
    assert [e["feature"] for e in got] == ["c", "a", "b"]
    wide = df.select(R.ranked("c").alias("r")).select(*R.topn_wide("r", 5)).first()
    assert wide["shap_descr_3"] == "b" and wide["shap_value_3"] == -1.0 and wide["shap_descr_4"] is None


def test_last_row_of_a_repeated_id_wins(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], "k string, seq int, v int")
    assert {r["k"]: r["v"] for r in R.last_wins(df, "k", "seq").collect()} == {"a": 20, "b": 30}


def test_ordinals_follow_the_key_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"), (F.col("id") % 3 > 0).cast("int").alias("g"))
    got = {r["k"]: r["ordinal"] for r in R.row_ordinal(df, ["k"]).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}
    idx = R.running_index(df, ["g"], ["k"]).toPandas().sort_values(["g", "k"])
    for _, part in idx.groupby("g"):
        assert list(part["idx"]) == list(range(1, len(part) + 1))


def test_hot_join_keeps_every_row(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = left.select("k").distinct().where("k < 2000").withColumn("w", F.col("k") * 2)
    hot = spark.createDataFrame([(0, 1000)], "k long, c long")
    inner = R.hot_join(left, right, ["k"], hot, rows=100)
    assert inner.count() == 2000 and inner.where("w = k * 2").count() == 2000
    outer = R.hot_join(left, right, ["k"], hot, "left")
    assert outer.count() == 3000 and outer.where("w IS NULL").count() == 1000


def test_complete_cases_drop_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "k int, v double")
    assert [r["k"] for r in R.complete_cases(df, ["v"]).collect()] == [1]


def test_continuous_by_name_or_containment(spark):
    df = spark.createDataFrame([(0, 3.0, "x", 2.0)], "cas int, cas_math double, kind string, gpa double")
    profile = R.column_profile(df, ["cas", "cas_math", "kind", "gpa"])
    assert {r["column"]: r["kind"] for r in profile.collect()} == {
        "cas": "binary", "cas_math": "continuous", "kind": "text", "gpa": "continuous"}
    assert sorted(r[0] for r in R.continuous_vars(profile).collect()) == ["cas_math", "gpa"]
    assert [r[0] for r in R.continuous_vars(profile, substring=True).collect()] == ["gpa"]
