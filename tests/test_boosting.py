"""Boosted trees: whole settings, patience, and the same trees however the rows are kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import boosting, curves, models
from vigil.plans import queries


def _rows(spark, first, count):
    """A label that follows the sum of two of three columns with some noise; one value of ``x`` in seven is missing."""
    return spark.range(first, first + count).selectExpr(
        "id AS event_id", "IF(id % 7 = 0, NULL, CAST(hash(id, 1) % 50 AS DOUBLE)) AS x", "CAST(hash(id, 2) % 50 AS DOUBLE) AS y",
        "CAST(hash(id, 3) % 5 AS DOUBLE) AS z",
    ).selectExpr("*", "CAST(coalesce(x, 0) + y + hash(event_id, 4) % 30 > 25 AS INT) AS SepsisLabel")


def _learned(monkeypatch):
    courses, fit = [], boosting.BoostedTrees._fit

    def kept(self, df):
        model = fit(self, df)
        courses.append(self.course)
        return model

    monkeypatch.setattr(boosting.BoostedTrees, "_fit", kept)
    return courses


SMALL = {"rounds": 30, "depth": 3, "min_leaf": 20, "patience": 4}


def test_rounds_go_on_until_patience_ends(spark, monkeypatch):
    courses = _learned(monkeypatch)
    train, val = _rows(spark, 0, 2000), _rows(spark, 5000, 800)
    model = models.train_trees(train, ["x", "y", "z"], val, **{**SMALL, "rounds": 300, "rate": 0.3})
    course, best = courses[0], int(np.argmax(courses[0])) + 1
    assert 10 < best and len(course) == best + 4 < 300
    assert any(b <= a for a, b in zip(course[:best], course[1:best]))  # a round without gain does not end the training
    assert model.stages[-1].getNumTrees == best + 1  # the first one holds the start
    found = curves.auroc(curves.score_steps(models.score(model, val, ["x", "y", "z"]))).first()["auroc"]
    assert found == pytest.approx(max(course), abs=1e-12) and found > 0.9


def test_spread_rows_give_the_same_trees(spark, monkeypatch):
    courses = _learned(monkeypatch)
    train, val = _rows(spark, 0, 1500).repartition(3), _rows(spark, 5000, 400).repartition(2)
    train, val = boosting.written(train, "train"), boosting.written(val, "val")
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 3)
    kept = models.train_trees(train, ["x", "y", "z"], val, **{**SMALL, "rounds": 6})
    monkeypatch.setattr(boosting, "ONE_TASK", 0)
    spread = models.train_trees(train, ["x", "y", "z"], val, **{**SMALL, "rounds": 6})
    assert courses[0] == pytest.approx(courses[1], abs=1e-12)
    a, b = (models.score(m, val, ["x", "y", "z"]).agg(F.sum("proba")).first()[0] for m in (kept, spread))
    assert a == pytest.approx(b, abs=1e-9)


def test_tables_without_cut_or_second_class(spark):
    few, val = _rows(spark, 0, 30), _rows(spark, 100, 30)
    constant = models.train_trees(few, ["x", "y"], val, rounds=5)  # leaves of 500 rows: nothing to cut
    assert models.score(constant, val, ["x", "y"]).select("proba").distinct().count() == 1
    one_class = models.train_trees(few.withColumn("SepsisLabel", F.lit(0)), ["x", "y"], val.limit(0), rounds=3, min_leaf=5)
    assert models.score(one_class, val, ["x", "y"]).filter("proba < 0.01").count() == 30
    with pytest.raises(Exception, match="no rows to train on"):
        models.train_trees(few.limit(0), ["x", "y"], val, rounds=2)
    with pytest.raises(Exception, match="no label"):
        models.train_trees(few.withColumn("SepsisLabel", F.lit(None).cast("int")), ["x", "y"], rounds=2)


def test_best_cut_equals_all_cuts():
    rng = np.random.default_rng(3)
    x, g, h = rng.integers(0, 9, (2, 300)).astype(np.uint8), rng.normal(size=300), rng.random(300)
    rules = boosting.Rules(min_leaf=20, l1=0.5, l2=0.5)
    rows = np.arange(300)
    found = boosting.best_split(boosting.histogram(x, rows, np.zeros(300, int), g, h, [0, 1], 1, 9)[:, 0], rules)

    def worth(at):
        return max(abs(g[at].sum()) - 0.5, 0) ** 2 / (h[at].sum() + 0.5)

    cuts = {(k, b): x[k] <= b for k in range(2) for b in range(9)}
    gains = {c: worth(at) + worth(~at) - worth(rows >= 0) for c, at in cuts.items() if 20 <= at.sum() <= 280}
    best = max(gains, key=gains.get)
    assert found[0] == pytest.approx(gains[best]) and found[1:3] == best
    assert found[3][2] == cuts[best].sum() and found[4][2] == 300


def test_cut_points_keep_missing_values_apart():
    few = boosting.cut_points((np.array([-1e6, 1.0, 2.0, 5.0]), np.array([4.0, 1, 1, 1])), 255, models.MISSING)
    assert few.tolist() == [-1e6, 1.0, 2.0]
    many = boosting.cut_points((np.arange(1000.0), np.ones(1000)), 10, models.MISSING)
    assert len(many) == 8 and np.ptp(np.diff([0, *many])) <= 2
    a, b = np.arange(0.0, 9000), np.arange(0.5, 9000)
    values, counts = boosting.merged((a, np.ones(9000)), (b, np.ones(9000)))
    assert len(values) <= boosting.POINTS and counts.sum() == 18000 and values[-1] == 8999.5


def _settings(spark, monkeypatch, *keys):
    """What the queries hand to the learner."""
    asked, table = [], _rows(spark, 0, 2)
    monkeypatch.setattr(queries, "_training", lambda spark, sf_dir: {s: table for s in ("train", "val", "test")})
    monkeypatch.setattr(models, "BoostedTrees", lambda label, rules, missing: asked.append(rules) or 1 / 0)
    monkeypatch.setattr(models, "prepared", lambda df, inputs: df)
    for key in keys:
        with pytest.raises(ZeroDivisionError):
            queries.CATALOGUE[key](spark, "unused")
    return asked


def test_train_gbt_has_whole_settings(spark, monkeypatch):
    rules, = _settings(spark, monkeypatch, "train_gbt")
    assert (rules.rounds, rules.patience, rules.min_leaf, rules.depth, rules.rate) == (2000, 100, 500, 5, 0.05)
    assert (rules.l1, rules.l2, rules.fraction, rules.bins) == (0.5, 0.5, 0.8, 255)


def test_train_second_has_whole_settings(spark, monkeypatch):
    rules, = _settings(spark, monkeypatch, "train_second")
    assert (rules.rounds, rules.patience, rules.min_leaf, rules.depth, rules.rate) == (5000, 200, 1, 8, 0.03)
    assert (rules.l1, rules.l2, rules.bins) == (0.0, 3.0, 128)


def test_feature_importance_reads_the_whole_model(spark, monkeypatch):
    first, other = _settings(spark, monkeypatch, "train_gbt", "feature_importance")
    assert first == other
    monkeypatch.undo()
    train, val, names = _rows(spark, 0, 2000), _rows(spark, 5000, 800), ["x", "y", "z"]
    model = models.train_trees(train, names, val, **{**SMALL, "rounds": 12, "patience": 12})
    found = models.feature_importance(spark, model, names).collect()
    nodes = [int(t.numNodes) for t in model.stages[-1].trees]
    assert len(nodes) > 6 and sum(r["split"] for r in found) == sum((n - 1) // 2 for n in nodes)
    assert sum(r["gain"] for r in found) == pytest.approx(1) and {r["feature"] for r in found[:2]} == {"x", "y"}


def test_every_input_is_permuted(spark, monkeypatch):
    val = _rows(spark, 0, 300)
    monkeypatch.setattr(queries, "_trained", lambda spark, sf_dir: (None, ["x", "y", "z", "u", "v", "w"], {"val": val.selectExpr("*", *[f"0D AS {c}" for c in "uvw"])}))
    monkeypatch.setattr(models, "score", lambda model, df, inputs, name="proba": df.withColumn(name, F.coalesce("x", F.lit(0)) + F.col("y")))
    found = {r["feature"]: r["auroc_drop"] for r in queries.CATALOGUE["permutation_importance"](spark, "unused").collect()}
    assert list(found) == ["x", "y", "z", "u", "v", "w"]
    assert found["x"] > 0.1 and found["y"] > 0.1 and [found[c] for c in "zuvw"] == [0.0] * 4


def test_one_class_has_no_drop(spark, monkeypatch):
    val = _rows(spark, 0, 20).withColumn("SepsisLabel", F.lit(0))
    monkeypatch.setattr(models, "score", lambda model, df, inputs, name="proba": df.withColumn(name, F.col("y")))
    found = models.permutation_importance(None, val, ["x", "y"], ["x", "y"]).collect()
    assert [r["feature"] for r in found] == ["x", "y"] and all(r["auroc_drop"] is None for r in found)
    assert models.permutation_importance(None, val.limit(0), ["x", "y"], ["x", "y"]).count() == 2
