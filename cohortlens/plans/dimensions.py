"""Fixed values of the runs, as small tables: stages with their gates, populations, modelled units."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CAMPUSES = ["PULLM", "VANCO", "TRICI", "EVERE", "SPOKA", "ONLIN"]

# (term_type, stage, priority, gate date column, window end column, required snapshot rank, model_id)
# A required rank of NULL means the stage looks at the date only.
STAGES = [
    ("FAL", "mid", 1, "term_midterm_dt", "term_end_dt", 2, 3),
    ("FAL", "cen", 2, "term_census_dt", "term_end_dt", 1, 2),
    ("FAL", "adm", 3, "term_begin_dt", "term_midterm_dt", None, 1),
    ("SPR", "mid", 1, "term_midterm_dt", "term_end_dt", 2, 6),
    ("SPR", "cen", 2, "term_census_dt", "term_end_dt", 1, 5),
    ("SPR", "eot", 3, "term_begin_dt", "term_end_dt", 3, 4),
    ("SUM", "eot", 1, "term_begin_dt", "term_end_dt", None, 7),
]

# (run order, population, outcome of the fall runs)
POPULATIONS = [(1, "ft_ft_1yr", "term"), (2, "ft_tr_1yr", "term"), (3, "ft_ft_2yr", "year"), (4, "ft_tr_2yr", "year")]

# Units modelled per term, population and stage. P, V and T are single campuses, U is the system model.
UNITS = {
    ("FAL", "ft_ft_1yr"): {"adm": "PVTU", "cen": "PVTU", "mid": "PVU"},
    ("FAL", "ft_ft_2yr"): {"adm": "PVTU", "cen": "PVTU", "mid": "PVU"},
    ("FAL", "ft_tr_1yr"): {"adm": "PU", "cen": "PVTU", "mid": "PVU"},
    ("FAL", "ft_tr_2yr"): {"adm": "PU", "cen": "PVTU", "mid": "PVU"},
    ("SPR", "ft_ft_1yr"): {"eot": "PVU", "cen": "PVU", "mid": "PVU"},
    ("SPR", "ft_ft_2yr"): {"eot": "PVU", "cen": "PVU", "mid": "PVU"},
    ("SPR", "ft_tr_1yr"): {"eot": "PVU", "cen": "PVU", "mid": "PVU"},
    ("SPR", "ft_tr_2yr"): {"eot": "PVU", "cen": "PVU", "mid": "PVU"},
    ("SUM", "ft_ft_1yr"): {"eot": "PVU"},
    ("SUM", "ft_ft_2yr"): {"eot": "PVU"},
    ("SUM", "ft_tr_1yr"): {"eot": "PU"},
    ("SUM", "ft_tr_2yr"): {"eot": "PU"},
}
UNIT_CAMPUS = {"P": "PULLM", "V": "VANCO", "T": "TRICI"}

# Forest settings: minimum child weight, bins and trees per round; one fall mid-term transfer run differs.
FOREST = {"min_child_weight": 8.0, "bins": 48, "trees": 96, "subsample": 0.8, "columns": 0.8, "columns_node": 0.8, "patience": 20}
FOREST_OF = {("FAL", "ft_tr_1yr", "mid"): {**FOREST, "min_child_weight": 5.0, "bins": 32, "trees": 64}}
FOREST_TRIAL = {**FOREST, "bins": 32, "trees": 64}

# Search grids: 768 forests over 2 to 500 rounds, 220 elastic-net logits over rows.
FOREST_GRID = {"depth": list(range(1, 17)), "gamma": list(range(1, 17)), "step": [0.01, 0.5, 1.0]}
FOREST_ROUNDS = {"min_rounds": 2, "max_rounds": 500, "folds": 3}
LOGIT_GRID = {"l1_ratio": [i / 10 for i in range(11)], "c": [10 ** (4 * i / 19) for i in range(20)]}
TOP_N = 5


def scored_campuses(units: str, unit: str) -> list[str]:
    """Campuses a unit scores. The system unit scores four campuses, and VANCO too where only P is modelled."""
    if unit != "U":
        return [UNIT_CAMPUS[unit]]
    small = ["EVERE", "TRICI", "SPOKA", "ONLIN"]
    return small if "V" in units else [*small, "VANCO"]


def _dimension(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of the fixed values above. Its size never grows, so it is always broadcast."""
    kinds = T.StructType.fromDDL(schema)
    columns = [pa.array(c, type=to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), kinds.fields)]
    return F.broadcast(spark.createDataFrame(pa.Table.from_arrays(columns, names=kinds.names), kinds))


def stage_table(spark: SparkSession) -> DataFrame:
    return _dimension(
        spark, STAGES,
        "term_type string, stage string, priority int, gate_column string, window_column string, "
        "required_rank int, model_id int",
    )


def unit_rows(units: str) -> list[tuple[str, str, bool, bool]]:
    """(unit, campus, trains, scores) for one run's units. The system unit trains on every campus."""
    rows = []
    for u in units:
        scores = scored_campuses(units, u)
        trains = CAMPUSES if u == "U" else scores
        rows += [(u, c, c in trains, c in scores) for c in CAMPUSES if c in trains or c in scores]
    return rows


def unit_table(spark: SparkSession, units: str = "PVTU") -> DataFrame:
    return _dimension(spark, unit_rows(units), "unit string, campus string, trains boolean, scores boolean")


def run_table(spark: SparkSession) -> DataFrame:
    """Every production run and the units it models."""
    model = {(t, s): m for t, s, _, _, _, _, m in STAGES}
    rows = [
        (t, pop, stage, model[(t, stage)], u)
        for (t, pop), stages in UNITS.items() for stage, units in stages.items() for u in units
    ]
    return _dimension(spark, rows, "term_type string, model_descr string, stage string, model_id int, unit string")


def run_parameters(term_type: str, model_descr: str, stage: str) -> dict:
    """What one production run models and with which settings, as arguments of the scoring run."""
    model = {(t, s): m for t, s, _, _, _, _, m in STAGES}
    return {
        "units": UNITS[(term_type, model_descr)][stage], "model_id": model[(term_type, stage)], "model_descr": model_descr,
        "top_n": TOP_N, **FOREST_OF.get((term_type, model_descr, stage), FOREST),
    }


def run_outcome(term_type: str, model_descr: str) -> str:
    """Whether a run predicts enrolment in the next term or the next year."""
    fall = {name: outcome for _, name, outcome in POPULATIONS}
    return fall[model_descr] if term_type == "FAL" else "year"
