"""The model queries fit the configurations that their names stand for."""

import pytest

from checks import queries
from storecast.operators import models


class Fitted(Exception):
    pass


def settings(regressor):
    return {p.name: v for p, v in regressor.extractParamMap().items() if not p.name.endswith("Col")}


def test_the_comparison_fits_the_default_models(spark, retail, monkeypatch):
    seen = {}

    def compare(train, test, regressors=None, *args, **kwargs):
        seen.update(regressors or models.default_regressors())
        raise Fitted

    monkeypatch.setattr(models, "compare_models", compare)
    with pytest.raises(Fitted):
        queries.REGISTRY["model_comparison"](spark, "/root/testdata/sf0.001")
    wanted = models.default_regressors()
    assert {k: settings(v) for k, v in seen.items()} == {k: settings(v) for k, v in wanted.items()}
    assert [seen[f"random_forest_{k}"].getNumTrees() for k in ("default", "best")] == [100, 100]
    assert [seen[f"gradient_boosting_{k}"].getMaxIter() for k in ("default", "best")] == [100, 200]
    assert seen["random_forest_default"].getMaxDepth() == models.DEEPEST


@pytest.mark.parametrize("name", ["feature_importance", "model_roundtrip", "forecast_7d"])
def test_the_stored_forest_is_the_tuned_one(spark, monkeypatch, name):
    seen = []

    def fit(train, regressor, *args):
        seen.append(regressor)
        raise Fitted

    monkeypatch.setattr(models, "fit_model", fit)
    with pytest.raises(Fitted):
        queries.REGISTRY[name](spark, "/root/testdata/sf0.001")
    assert settings(seen[0]) == settings(models.random_forest(max_depth=6, min_leaf=5, trees=100))


@pytest.mark.parametrize("name", ["random_forest", "gradient_boosting"])
def test_metric_queries_give_the_errors_of_the_library(spark, retail, monkeypatch, name):
    """On a light model of the same kind; the configurations are checked above."""
    from pyspark.ml.evaluation import RegressionEvaluator

    light = {"random_forest": models.random_forest(3, 5, 5), "gradient_boosting": models.gradient_boosting(3)}[name]
    fit, seen = models.fit_model, []

    def fitted(train, regressor, *args):
        seen.append((regressor, fit(train, light, *args)))
        return seen[-1][1]

    monkeypatch.setattr(models, "fit_model", fitted)
    got = queries.REGISTRY[f"{name}_metrics"](spark, "/root/testdata/sf0.001").first()
    regressor, model = seen[0]
    wanted = {"random_forest": models.random_forest(max_depth=6, min_leaf=5), "gradient_boosting": models.gradient_boosting()}
    assert settings(regressor) == settings(wanted[name])
    scored = model.transform(queries._model_split(retail)[1])
    assert got.rows == scored.count()
    for metric in ("mae", "mse", "rmse", "r2"):
        theirs = RegressionEvaluator(labelCol="quantity", metricName=metric).evaluate(scored)
        assert got[metric] == pytest.approx(theirs, abs=1e-6)
