"""Adaptive search and the saved artefact."""

import json
import math
import subprocess
import sys

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel

from daygrain.operators import boosting as B
from daygrain.operators import models as M
from daygrain.operators import search as S
from daygrain.operators.artefact import Artefact, RangeScaler, StrictColumns
from daygrain.session import shared_path

FEATURES, TARGETS = ["a", "b", "c"], ["t2m_d1_forecast", "t2m_d2_forecast"]
SPACE = {"rounds": S.Range(2, 8, whole=True), "learning_rate": S.Range(0.01, 0.8, log=True), "leaves": S.Range(2, 8, whole=True), "l2": S.Range(1e-8, 10, log=True)}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(260):
        a, b, c = (float(v) for v in rng.normal(size=3))
        rows.append((i, a, b, c, 20 + 3 * a + b * b, 18 - 2 * a + (b > 0), i >= 200))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, t2m_d1_forecast double, t2m_d2_forecast double, later boolean").cache()


@pytest.fixture(scope="module")
def found(table):
    data = B.binned(table, FEATURES, TARGETS, "later", bins=32)
    run = lambda: S.search(data, TARGETS, SPACE, trials=10, side_by_side=3, rungs=(2, 4), random=4, base=B.Params(least_rows=5))
    return data, run(), run()


def test_trials_are_repeatable_ordered_and_stopped_early(spark, found):
    data, first, second = found
    assert first == second and sorted(t.number for t in first) == list(range(1, 11))
    rows = S.trials_table(spark, first, SPACE).toPandas()  # noqa: F841  (read by DuckDB)
    best, wrong_order, early, late = duckdb.sql("""SELECT arg_min(trial, rmse) FILTER (NOT stopped),
        (SELECT count(*) FROM rows a JOIN rows b ON a.stopped = b.stopped AND a.rank < b.rank AND a.rmse > b.rmse),
        count(*) FILTER (stopped AND trees < rounds), count(*) FILTER (NOT stopped AND trees <> rounds) FROM rows""").fetchall()[0]
    assert best == first[0].number and wrong_order == 0 and early == sum(t.stopped for t in first) > 0 and late == 0
    assert all(r.inner(getattr(t.params, n)) >= -1e-9 and r.inner(getattr(t.params, n)) <= 1 + 1e-9 for t in first for n, r in SPACE.items())


def test_error_of_a_trial_is_that_of_its_models(spark, table, found):
    data, trials, _ = found
    best = trials[0]
    growths, _ = B.train(data, [B.Job("m", t, best.params) for t in TARGETS])
    later = table.where("later")
    scored = B.score(later, B.nodes_table(spark, data, growths), FEATURES, ["id"]).toPandas().set_index("id")
    truth = later.toPandas().set_index("id")
    square = np.mean([np.mean((scored[t] - truth[t]) ** 2) for t in TARGETS])
    assert best.rmse == pytest.approx(math.sqrt(square), rel=1e-9)


def test_proposals_come_near_to_good_trials():
    rng = np.random.default_rng(0)
    space = {"learning_rate": S.Range(0.01, 1.0, log=True), "leaves": S.Range(2, 200, whole=True)}
    trials = []
    for i in range(60):
        p = B.dataclasses.replace(B.Params(), **S.propose(space, trials, rng))
        trials.append(S.Trial(i, 0, p, 1, abs(math.log10(p.learning_rate) + 1) + abs(p.leaves - 50) / 100))
    early, late = (np.mean([t.rmse for t in trials[a:b]]) for a, b in ((0, 10), (30, 60)))
    assert late < 0.6 * early
    assert all(0.01 <= t.params.learning_rate <= 1 and 2 <= t.params.leaves <= 200 for t in trials)


def test_searching_needs_judged_rows(spark, table):
    with pytest.raises(ValueError, match="no judged rows"):
        S.search(B.binned(table, FEATURES, TARGETS), TARGETS)


def test_importance_equals_sql_over_the_saved_nodes(spark, table):
    data = B.binned(table, FEATURES, TARGETS, bins=16)
    growths, _ = B.train(data, [B.Job("m", t, B.Params(rounds=3, leaves=6, least_rows=5)) for t in TARGETS])
    path = shared_path(spark, "nodes")
    B.nodes_table(spark, data, growths).write.parquet(path)
    sql = f"""SELECT target, feature, count(*) AS splits, row_number() OVER (PARTITION BY target ORDER BY count(*) DESC, sum(gain) DESC, feature) AS rank
    FROM '{path.removeprefix("file:")}/*.parquet' WHERE feature IS NOT NULL GROUP BY target, feature"""
    got = {(r.target, r.feature, r.splits, r["rank"]) for r in B.importance(spark.read.parquet(path)).collect()}
    assert got == set(duckdb.sql(sql).fetchall())


def test_artefact_scores_the_same_in_a_new_session(spark, table, tmp_path):
    scaler = RangeScaler.fitted(table, FEATURES)
    scaled = scaler.transform(table)
    data = B.binned(scaled, FEATURES, TARGETS, bins=16)
    growths, _ = B.train(data, [B.Job("boosted", t, B.Params(rounds=3, leaves=4, least_rows=5)) for t in TARGETS])
    forest = M.fit_horizons(scaled, FEATURES, TARGETS, lambda: M.random_forest(numTrees=3, maxDepth=3))
    made = Artefact(FEATURES, TARGETS, B.nodes_table(spark, data, growths), {"forest": forest}, scaler, {"rounds": 3})
    path, rows = str(tmp_path / "artefact"), str(tmp_path / "rows")
    made.save(path)
    table.write.parquet(rows)
    loaded = Artefact.load(spark, path)
    assert loaded.names == ["boosted", "forest"] and loaded.notes == {"rounds": 3}
    wanted = {}
    for name in made.names:
        scores = [tuple(r) for r in made.score(table, name, ["id", "a"]).orderBy("id").collect()]
        assert scores == [tuple(r) for r in loaded.score(table, name, ["id", "a"]).orderBy("id").collect()]
        assert scores[0][1] == table.orderBy("id").first().a  # kept columns are not scaled
        wanted[name] = scores
    script = f"""
import json
from daygrain.operators.artefact import Artefact
from daygrain.session import local_session
spark = local_session(1)
loaded, rows = Artefact.load(spark, {path!r}), spark.read.parquet({rows!r})
print("OUT" + json.dumps({{n: [list(r) for r in loaded.score(rows, n, ["id", "a"]).orderBy("id").collect()] for n in loaded.names}}))
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, env=__import__("os").environ | {"PYTHONPATH": "/".join(B.__file__.split("/")[:-3])})
    again = json.loads(next(line for line in out.stdout.splitlines() if line.startswith("OUT"))[3:])
    assert again == {n: [list(r) for r in rows_] for n, rows_ in wanted.items()}


def test_missing_columns_are_named(spark, table):
    made = Artefact(FEATURES, TARGETS, spark.createDataFrame([], B.NODES))
    with pytest.raises(ValueError, match=r"missing columns \['b', 'c'\]"):
        made.prepared(table.drop("b", "c"))


def test_stages_persist_in_a_pipeline(spark, table, tmp_path):
    path = str(tmp_path / "pipeline")
    stages = [StrictColumns(columns=FEATURES), RangeScaler.fitted(table, FEATURES)]
    PipelineModel(stages).write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.transform(table).orderBy("id").collect() == PipelineModel(stages).transform(table).orderBy("id").collect()
    scaled = loaded.transform(table).agg({"a": "min", "b": "max"}).first()
    assert scaled[0] == 0.0 and scaled[1] == 1.0
    constant = RangeScaler(columns=["a"], lows=[2.0], highs=[2.0]).transform(spark.createDataFrame([(2.0,), (None,)], "a double"))
    assert [r.a for r in constant.collect()] == [0.0, None]
    with pytest.raises(ValueError, match="'c'"):
        loaded.transform(table.drop("c"))
