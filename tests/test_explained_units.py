"""Explanations are for the units that are scored."""

from types import SimpleNamespace

from cohortlens.catalog import models


def test_every_scored_unit_is_explained(monkeypatch):
    asked = []
    monkeypatch.setattr(models, "cohort", lambda spark, sf: None)
    monkeypatch.setattr(models, "retention_risk", lambda df, categorical, numeric, units, *a, **b: asked.append(units) or SimpleNamespace(outcome=None, shap=None))
    models.retention_risk_q(None, "")
    models.retention_explained(None, "")
    assert asked == ["PVTU", "PVTU"]
