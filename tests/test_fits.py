"""What the queries of one fitted model share."""

from conftest import SF_SMALL

from vigor.operators import ml as M
from vigor.plans import ml_jobs as MJ
from vigor.plans import q_ml
from vigor.plans.registry import REGISTRY, Ctx


def test_tree_invariants_score_every_row_once(spark, monkeypatch):
    """The injury rows are stored once for fit and rules, and the rules read one stored score a row."""
    fit, score, seen = MJ.fit_injury_model, M.positive_probability, []
    monkeypatch.setattr(q_ml, "_MODELS", {})
    monkeypatch.setattr(MJ, "fit_injury_model", lambda rows: fit(rows, maxIter=2))
    monkeypatch.setattr(M, "positive_probability", lambda model, df, *a: seen.append(df) or score(model, df, *a))
    rules = REGISTRY["ml_6_tree_invariants"][0](spark, SF_SMALL)
    assert {r.rule: r.failing_rows for r in rules.collect()} == dict.fromkeys(
        ["a score for every test row", "scores are probabilities", "scores differ", "positives score higher"], 0)
    assert len(seen) == 1 and seen[0].count() == MJ.injury_features(Ctx(spark, SF_SMALL).mart_pc).count()
    assert "UDF" not in (plan := rules._jdf.queryExecution().optimizedPlan().toString()) and "Window" not in plan
