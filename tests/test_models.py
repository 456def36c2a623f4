import datetime as dt
from functools import partial

import numpy as np
import pandas as pd
import pytest

from daygrain import Series
from daygrain.operators import evaluate as ev
from daygrain.operators import feature_lists as lists
from daygrain.operators import models as M
from daygrain.operators.windows import add_targets, target_names
from daygrain.plans import forecasting as fc
from daygrain.session import shared_path

TARGETS = target_names(["t2m"])[:3]
SERIES = Series((), "date")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    n = 300
    t = 20 + 8 * np.sin(np.arange(n) / 20)
    pdf = pd.DataFrame({"date": [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)], "t2m": t, "noise": rng.normal(size=n)})
    return add_targets(spark.createDataFrame(pdf), SERIES, {"t2m": "t2m"}, 3).na.drop().cache()


forest = partial(M.random_forest, numTrees=5, maxDepth=5, featureSubsetStrategy="all")
boost = partial(M.boosted_trees, maxIter=5, maxDepth=3, stepSize=0.5)


def test_training_learns_ranks_and_averages(spark, table):
    fitted, used, rows = fc.train_and_evaluate(
        table, SERIES, ["t2m", "noise"], TARGETS, {"randomforest": forest, "boosted": boost}, top_k=1, ranker=boost
    )
    assert used == ["t2m"]
    metrics = {(r.model, r.horizon_day): r for r in ev.horizon_metrics(rows).collect()}
    assert set(m for m, _ in metrics) == {"randomforest", "boosted", "ensemble"} and len(metrics) == 9
    assert all(r.rmse < 4 and r.n == 30 for r in metrics.values())
    newest = fc.forecast_latest(table, SERIES, used, fitted).collect()
    assert len(newest) == 9 and {r.target_date - r.date for r in newest} == {dt.timedelta(days=h) for h in (1, 2, 3)}


def test_saved_models_score_the_same(spark, table):
    fitted = M.fit_horizons(table, ["t2m"], TARGETS[:1], boost)
    path = shared_path(spark, "models")
    M.save_models(fitted, path)
    loaded = M.load_models(spark, path, TARGETS[:1])
    a = M.score(table, fitted, ["t2m"], ["date"]).orderBy("date").collect()
    b = M.score(table, loaded, ["t2m"], ["date"]).orderBy("date").collect()
    assert a == b


def test_search_orders_by_validation_error(spark, table):
    tried = M.search(table.where("date < '2020-08-01'"), table.where("date >= '2020-08-01'"), ["t2m"], TARGETS[:1], forest, {"maxDepth": [1, 5]}, "date")
    assert [t["params"]["maxDepth"] for t in tried] and tried[0]["rmse"] <= tried[1]["rmse"]


def test_metrics_by_hand(spark):
    rows = spark.createDataFrame(
        [("m", 1, 1.0, 2.0), ("m", 1, 3.0, 2.0), ("m", 2, 4.0, 4.0), ("m", 2, 4.0, 2.0), ("m", 2, None, 2.0)],
        "model string, horizon_day int, forecast double, actual double",
    )
    one, two = sorted(ev.horizon_metrics(rows).collect(), key=lambda r: r.horizon_day)
    assert (one.rmse, one.mae, one.r2, one.mape) == (1.0, 1.0, None, 50.0)
    assert two.n == 2 and two.r2 == pytest.approx(1 - 4 / 2) and two.mape == pytest.approx(50)
    overall = ev.overall_metrics(rows).collect()[0]
    assert overall.rmse == pytest.approx(np.sqrt(6 / 4)) and overall.r2 == pytest.approx(-1)
    share = {(r.horizon_day, r.tolerance): r.share for r in ev.within_tolerance(rows).collect()}
    assert share[(1, 1.0)] == 100 and share[(2, 0.5)] == 50 and share[(None, 0.5)] == 25


def test_feature_lists_come_in_three_shapes(spark):
    assert lists.parse_feature_list('{"1": "b", "0": "a", "10": "c"}') == (["a", "b", "c"], None)
    assert lists.parse_feature_list('["a"]') == (["a"], None)
    assert lists.parse_feature_list('{"selected_features": ["a"], "target_names": ["t"]}') == (["a"], ["t"])
    with pytest.raises(ValueError):
        lists.parse_feature_list("[]")
    table = lists.feature_table(spark, ["x", "y"])
    assert lists.parse_feature_list(lists.to_json(table).first().json)[0] == ["x", "y"]
