import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.features import OneHot
from cohortlens.plans import calendar as C
from cohortlens.plans import cohorts as K
from cohortlens.plans import dimensions as D
from cohortlens.session import fresh_path
from cohortlens.sources import append_with_backup, read_history

TERM = ("acad_career string, strm string, term_type string, term_year int, full_acad_year int, term_begin_dt timestamp, "
        "term_census_dt timestamp, term_midterm_dt timestamp, term_end_dt timestamp")


def at(y, m, d):
    return dt.datetime(y, m, d)


@pytest.fixture(scope="module")
def cal(spark):
    rows = [
        ("UGRD", "1013", "SPR", 2001, 2001, at(2001, 1, 8), at(2001, 1, 22), at(2001, 3, 1), at(2001, 5, 4)),
        ("UGRD", "1015", "SUM", 2001, 2001, at(2001, 5, 7), None, None, at(2001, 7, 27)),
        ("UGRD", "1017", "FAL", 2001, 2002, at(2001, 8, 20), at(2001, 9, 4), at(2001, 10, 10), at(2001, 12, 14)),
        ("UGRD", "1023", "SPR", 2002, 2002, at(2002, 1, 7), at(2002, 1, 22), at(2002, 3, 1), at(2002, 5, 3)),
        ("GRAD", "1017", "FAL", 2001, 2002, at(2001, 8, 20), None, None, at(2001, 12, 14)),
    ]
    return C.academic_calendar(spark.createDataFrame(rows, TERM), 2001).cache()


def regs(spark, *rows):
    return spark.createDataFrame([("UGRD", s, n) for s, n in rows], "acad_career string, strm string, snapshot string")


def days(spark, *ds):
    return spark.createDataFrame([(dt.date(*d),) for d in ds], "as_of date")


def test_calendar_ends_and_sentinels(cal):
    rows = {r["strm"]: r for r in cal.collect()}
    assert set(rows) == {"1013", "1015", "1017"}
    assert rows["1013"]["term_end_dt"] == dt.date(2001, 5, 6)
    assert rows["1017"]["term_end_dt"] == dt.date(2233, 10, 15) and rows["1017"]["end_day"] == 99999
    assert rows["1015"]["census_year"] == 99999 and rows["1015"]["term_census_dt"] is None


def stages(spark, cal, snapshot, *ds):
    plan = C.run_plan(days(spark, *ds), cal, regs(spark, *snapshot))
    return {(r["as_of"], r["run_order"]): (r["stage"], r["model_id"], r["model_descr"]) for r in plan.collect()}


def test_cascade_falls_back(spark, cal):
    day = (2001, 10, 11)  # midterm has passed
    key = dt.date(*day)
    assert stages(spark, cal, [("1017", "midterm")], day)[(key, 1)] == ("mid", 3, "ft_ft_1yr")
    # snapshot says census: the midterm stage is closed, the census stage open
    got = stages(spark, cal, [("1017", "census")], day)
    assert got[(key, 1)] == ("cen", 2, "ft_ft_1yr") and got[(key, 4)] == ("cen", 2, "ft_tr_2yr")
    # past midterm with the wrong snapshot: admissions has no term any more, nothing runs
    assert stages(spark, cal, [("1017", "other")], day) == {}
    early = (2001, 8, 25)
    assert stages(spark, cal, [("1017", "other")], early)[(dt.date(*early), 1)][0] == "adm"


def test_spring_end_of_term_uses_the_fall_snapshot(spark, cal):
    day = (2001, 1, 9)
    assert stages(spark, cal, [("0997", "eot")], day)[(dt.date(*day), 1)][:2] == ("eot", 4)
    assert stages(spark, cal, [("0997", "census")], day) == {}
    # a term of kind 9 does not count as the latest one
    assert stages(spark, cal, [("0997", "eot"), ("0999", "census")], day)[(dt.date(*day), 1)][0] == "eot"


def test_summer_looks_at_the_date_only(spark, cal):
    day = (2001, 5, 7)
    assert stages(spark, cal, [("1013", "other")], day)[(dt.date(*day), 1)][:2] == ("eot", 7)


def test_gate_statuses(spark, cal):
    rows = C.stage_gate(days(spark, (2001, 9, 3), (2001, 9, 4), (2000, 12, 31)), cal, regs(spark, ("1017", "census"))).collect()
    status = {(r["as_of"], r["stage"]): r["status"] for r in rows}
    assert status[(dt.date(2001, 9, 3), "cen")] == "date exception"
    assert status[(dt.date(2001, 9, 4), "cen")] == "open"
    assert status[(dt.date(2001, 9, 4), "mid")] == "date exception"
    assert not any(day == dt.date(2000, 12, 31) for day, _ in status)  # before the first term


def test_refit_on_first_day_and_saturdays(spark, cal):
    got = C.retrain_plan(days(spark, (2001, 8, 20), (2001, 8, 21), (2001, 8, 25)), cal).collect()
    assert {r["as_of"].day: r["refit"] for r in got} == {20: True, 21: False, 25: True}


def test_run_table_has_28_runs(spark):
    runs = D.run_table(spark)
    assert runs.select("term_type", "model_descr", "stage").distinct().count() == 28
    assert D.scored_campuses("PU", "U")[-1] == "VANCO" and "VANCO" not in D.scored_campuses("PVU", "U")


def test_run_settings():
    got = D.run_parameters("FAL", "ft_tr_1yr", "mid")
    assert (got["units"], got["model_id"], got["bins"], got["trees"]) == ("PVU", 3, 32, 64)
    assert D.run_parameters("SUM", "ft_ft_2yr", "eot")["bins"] == 48
    assert D.run_outcome("FAL", "ft_ft_1yr") == "term" and D.run_outcome("SPR", "ft_ft_1yr") == "year"
    assert len(D.LOGIT_GRID["l1_ratio"]) * len(D.LOGIT_GRID["c"]) == 220


COHORT = "emplid string, enrl_ind int, adj_acad_prog_primary_campus string, split string, gpa double"


def test_label_of_testing_rows(spark):
    df = spark.createDataFrame([
        ("1", None, "PULLM", "testing", 3.0), ("2", 1, "PULLM", "testing", 3.0), ("3", None, "PULLM", "training", 3.0),
        ("4", 0, "PULLM", "training", None), ("5", 1, "PULLM", "training", 2.0), ("6", 1, "EVERE", "testing", 2.0),
    ], COHORT)
    names = ["emplid", "enrl_ind", "gpa"]
    assert sorted(r["emplid"] for r in K.campus_cohort(df, names, ["PULLM"]).collect()) == ["2", "5"]
    loose = K.campus_cohort(df, names, ["PULLM"], require_label=False).collect()
    assert sorted(r["emplid"] for r in loose) == ["1", "2", "5"]
    assert all(r["enrl_ind"] is None for r in loose if r["split"] == "testing")
    assert sorted(r["emplid"] for r in K.system_cohort(df, names, ["EVERE"]).collect()) == ["5", "6"]


def test_a_campus_may_be_scored_by_two_units(spark):
    df = spark.createDataFrame([("1", 1, "TRICI", "testing", 1.0), ("2", 1, "PULLM", "training", 1.0), ("3", 1, "PULLM", "testing", 1.0)], COHORT)
    got = {(r["emplid"], r["unit"]) for r in K.route_units(df).collect()}
    assert got == {("1", "T"), ("1", "U"), ("2", "P"), ("2", "U"), ("3", "P")}


def test_one_hot_drops_each_units_first_category(spark):
    df = spark.createDataFrame([("P", "a"), ("P", "b"), ("V", "b"), ("V", "c")], "unit string, c string")
    enc = OneHot.fit(df, ["c"], ["unit"])
    got = {(r["unit"], r["c"]): [r[n] for n in enc.names()] for r in enc.transform(df).collect()}
    assert enc.names() == ["c_a", "c_b", "c_c"]
    assert got == {("P", "a"): [0, 0, 0], ("P", "b"): [0, 1, 0], ("V", "b"): [0, 0, 0], ("V", "c"): [0, 0, 1]}


def test_one_hot_unseen_and_single_category(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    enc = OneHot.fit(df, ["c"])
    with pytest.raises(Exception, match="unseen category in c: z"):
        enc.transform(spark.createDataFrame([("z",)], "c string")).collect()
    zero = OneHot.fit(df, ["c"], unseen="zero")
    assert zero.transform(spark.createDataFrame([("z",)], "c string")).first()["c_b"] == 0.0
    assert OneHot.fit(df.where("c = 'a'"), ["c"]).names() == []


def test_history_and_backup(spark):
    root = fresh_path(spark, "t")
    one = spark.createDataFrame([("1", 1)], "emplid string, run int")
    two = spark.createDataFrame([("1", 2, "new")], "emplid string, run int, more string")
    with pytest.raises(FileNotFoundError):
        read_history(spark, root)
    assert append_with_backup(one, root) == 1 and read_history(spark, root).collect() == one.collect()
    assert append_with_backup(two, root) == 2 and read_history(spark, root, 1).collect() == one.collect()
    assert sorted(map(tuple, read_history(spark, root).select("emplid", "run", "more").collect())) == [("1", 1, None), ("1", 2, "new")]


def test_a_broken_run_is_not_seen_and_a_run_costs_what_it_holds(spark, tmp_path):
    root = str(tmp_path / "history")
    size = lambda: sum(f.stat().st_size for f in (tmp_path / "history").rglob("*") if f.is_file())
    run = spark.range(1000).coalesce(1)
    grown = []
    for _ in range(4):
        before = size() if grown else 0
        append_with_backup(run, root)
        grown.append(size() - before)
    assert max(grown) - min(grown) < 200
    fails = run.withColumn("x", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        append_with_backup(fails, root)
    assert read_history(spark, root).count() == 4000
    assert append_with_backup(run, root) == 5 and read_history(spark, root).count() == 5000
