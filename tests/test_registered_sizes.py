"""Registered model queries run at the library's full sizes."""

import pytest
from conftest import SMALL

from lastmile.operators import learners, search
from lastmile.plans import flows, model_queries


class Stop(Exception):
    """Ends a query where its sizes are known."""


@pytest.mark.parametrize(
    "name, full",
    [
        ("reg_forest", learners.forest), ("reg_extra_trees", learners.extra_trees), ("reg_gbt", learners.boosted),
        ("reg_gbt_hist", learners.boosted_hist),
    ],
)
def test_ensembles(spark, monkeypatch, name, full):
    seen = {}
    monkeypatch.setattr(model_queries, "_scores", lambda _spark, _sf, **e: seen.update(e))
    monkeypatch.setattr(model_queries, "rounded", lambda found: found)
    getattr(model_queries, name)(None, None)
    (estimator,) = seen.values()
    values = lambda e: {p.name: v for p, v in e.extractParamMap().items()}
    assert values(estimator) == values(full())


@pytest.mark.parametrize(
    "name, space, points",
    [
        ("random_search", search.GRIDS, "decision_tree_regressor"), ("auto_search", search.SPACES, "ridge_regression"),
        ("search_results", search.GRIDS, "decision_tree_regressor"),
    ],
)
def test_whole_grids(spark, monkeypatch, name, space, points):
    seen = []

    def stop(candidates, fit, folds, *score):
        seen.append((candidates, folds))
        raise Stop

    monkeypatch.setattr(search, "search", stop)
    monkeypatch.setattr(model_queries, "_split", lambda spark, sf: spark.range(1).selectExpr("id AS split_key", "'train' AS split"))
    monkeypatch.setattr(search, "encoded_folds", lambda df, numbers, categories, folds, keep: folds)
    with pytest.raises(Stop):
        getattr(model_queries, name)(spark, None)
    key = lambda p: sorted(p.items())
    assert sorted(seen[0][0], key=key) == sorted(search.grid_points(space[points]), key=key) and seen[0][1] == 5


@pytest.mark.parametrize("name", ["evaluate", "tune", "improve", "operational", "precision", "hard_errors", "clustering"])
def test_flows_get_no_smaller_sizes(spark, monkeypatch, name):
    seen = []

    def stop(*given, **options):
        seen.append((given, options))
        raise Stop

    monkeypatch.setattr(flows, name, stop)
    frame = spark.range(1).selectExpr("id AS split_key", "1.0D AS target_tiempo_entrega")
    monkeypatch.setattr(model_queries, "_split", lambda spark, sf: frame)
    monkeypatch.setattr(model_queries, "tidy", lambda spark, sf: frame)
    with pytest.raises(Stop):
        getattr(model_queries, {"evaluate": "flow_eval"}.get(name, f"flow_{name}"))(spark, None)
    given, options = seen[0]
    assert len(given) == (3 if name == "tune" else 1) and not options


def test_precision_searches_the_best_plain_model(spark, monkeypatch):
    monkeypatch.setitem(search.GRIDS, "decision_tree_regressor", {"maxDepth": [2, 6]})
    split = model_queries._split(spark, SMALL)
    found = flows.precision(split, {"decision_tree_regressor": learners.tree(depth=3)}, folds=2, repeats=1)
    tuned = "decision_tree_regressor_rmse_tuned"
    scores = {r.model: r.RMSE for r in found["metrics"].collect()}
    assert set(scores) == {"decision_tree_regressor", "decision_tree_regressor_log_target", tuned}
    assert found["search"].count() == 2 and scores[tuned] < scores["decision_tree_regressor"]
    assert tuned in {r.model for r in found["cross_validation"].collect()}
