"""Spark ML operators: exact linear fit, save/load round trip, tree bounds."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression

from daycast.operators import models as M
from daycast.operators.metrics import regression_metrics
from daycast.plans.features import feature_table
from daycast.plans.train import train_and_compare
from daycast.sources.models_io import discover_models, model_load_score
from fixtures import daily


def test_linear_without_penalty_matches_least_squares(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=200)
    y = 3.0 * x - 2.0 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, label_diff double")
    model = Pipeline(stages=[M.assembler(["x"]), LinearRegression(
        featuresCol="features", labelCol="label_diff", regParam=0.0)]).fit(df)
    slope, intercept = np.polyfit(x, y, 1)
    lr = model.stages[-1]
    assert lr.coefficients[0] == pytest.approx(slope, rel=1e-6)
    assert lr.intercept == pytest.approx(intercept, rel=1e-6)


def _features(spark):
    return feature_table(daily(spark, 140, tx=lambda i: 1000 + (i * 37) % 101 + 3 * i,
                               gas=lambda i: 0.3 + ((i * 13) % 7) / 10))


def test_train_save_load_score_round_trip(spark, tmp_path):
    ft = _features(spark)
    params = M.ModelParams(rf_trees=5, models=["linear_regression", "decision_tree", "random_forest"])
    res = train_and_compare(ft, "2024-03-31", "2024-04-01", "2024-12-31", params,
                            run_dir=str(tmp_path / "run"))
    comp = {r["model"]: r for r in res.comparison.collect()}
    assert set(comp) == {"linear_regression", "decision_tree", "random_forest"}
    assert discover_models(spark, str(tmp_path / "run")) == ["linear_regression", "decision_tree", "random_forest"]
    # reload and re-score: identical predictions
    test = res.predictions.select("date").distinct().count()
    from daycast.operators.split import time_split, training_frame
    frame, _ = training_frame(ft)
    _, test_df = time_split(frame, "2024-03-31", "2024-04-01", "2024-12-31")
    again = model_load_score(str(tmp_path / "run"), test_df)
    a = {(r["model"], r["date"]): r["prediction"] for r in res.predictions.collect()}
    b = {(r["model"], r["date"]): r["prediction"] for r in again.collect()}
    assert a.keys() == b.keys() and len(a) == 3 * test
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12, abs=1e-12)
    rec = res.record.first()
    assert rec["feature_cols"] == sorted(rec["feature_cols"])
    assert set(rec["results"]) == set(comp)
    assert (tmp_path / "run" / "run_info").exists()


def test_tree_depth_bound_and_seeded_forest(spark):
    ft = _features(spark)
    from daycast.operators.split import training_frame
    frame, feats = training_frame(ft)
    p = M.ModelParams(dt_max_depth=3, rf_trees=4)
    tree = M.fit("decision_tree", frame, feats, p).stages[-1]
    assert tree.depth <= 3
    f1 = M.fit("random_forest", frame, feats, p).stages[-1]
    f2 = M.fit("random_forest", frame, feats, p).stages[-1]
    assert f1.toDebugString.split("\n", 1)[1] == f2.toDebugString.split("\n", 1)[1]  # uid aside


def test_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    rows = [(float(i), float(i) + (-1) ** i * 0.5 * (i % 4)) for i in range(50)]
    df = spark.createDataFrame(rows, "label_log double, prediction_log double")
    m = regression_metrics(df, spaces=["log"]).first()
    for name in ("rmse", "r2"):
        ev = RegressionEvaluator(labelCol="label_log", predictionCol="prediction_log", metricName=name)
        assert m[f"{name}_log"] == pytest.approx(ev.evaluate(df), rel=1e-12)


def test_true_delta_reconstructs_label(spark):
    ft = _features(spark)
    from daycast.operators.split import training_frame
    from daycast.functions.transforms import reconstruct
    frame, _ = training_frame(ft)
    out = frame.select("label", "label_log", *reconstruct("label_diff")).collect()
    for r in out:
        assert r["prediction_log"] == pytest.approx(r["label_log"], abs=1e-12)
        assert r["prediction_raw"] == pytest.approx(r["label"], rel=1e-9)


def test_keyed_end_to_end_run(spark, tmp_path):
    from fixtures import SF_SMALL
    from daycast.plans.end_to_end import run_end_to_end
    from daycast.sources import testdata as td
    res = run_end_to_end(spark, td.blocks(spark, SF_SMALL, with_series=True), td.price_history(spark, SF_SMALL),
                       None, None, "1999-12-31", "2000-01-01", "2001-12-31", series=["series"],
                       work_dir=str(tmp_path / "work"),
                       params=M.ModelParams(rf_trees=5, models=["linear_regression", "random_forest"]))
    assert "series" not in res.feature_cols and len(res.feature_cols) == 102
    assert res.feature_rows and res.feature_rows > 0
    comp = {r["model"]: r for r in res.comparison.collect()}
    assert set(comp) == {"linear_regression", "random_forest"}
    assert all(r["rmse_log"] > 0 for r in comp.values())
    with pytest.raises(ValueError):
        run_end_to_end(spark, td.blocks(spark, SF_SMALL), None, None, None,
                     "1999-12-31", "2000-01-01", "2001-12-31", mode="raw")


def test_direct_scoring_of_label_models(spark, tmp_path):
    """Older models predict ``label`` itself: one scoring path, no reconstruction."""
    from pyspark.ml.regression import LinearRegression
    from daycast.operators.metrics import direct_metrics
    from daycast.operators.split import training_frame
    from daycast.sources.models_io import model_save
    frame, feats = training_frame(_features(spark))
    model = Pipeline(stages=[M.assembler(feats), LinearRegression(featuresCol="features", labelCol="label",
                                                                 regParam=0.1)]).fit(frame)
    model_save(model, str(tmp_path / "old"), "linear_regression")
    pred = model_load_score(str(tmp_path / "old"), frame, reconstruct_delta=False)
    assert "prediction_raw" not in pred.columns
    m = direct_metrics(pred).first()
    assert m["rmse"] >= 0 and m["r2"] <= 1


def test_report_tables_on_model_predictions(spark):
    from daycast.operators.report import (report_bars, report_overlay, report_scatter,
                                          report_timeseries, residual_histogram)
    ft = _features(spark)
    res = train_and_compare(ft, "2024-03-31", "2024-04-01", "2024-12-31",
                            M.ModelParams(models=["linear_regression", "decision_tree"]))
    pred = res.predictions
    n = pred.filter(pred.model == "decision_tree").count()
    assert report_timeseries(pred).count() == 2 * n
    sc = report_scatter(pred)
    assert sc.count() == 4 * n and sc.filter("line_min > real OR line_max < predicted").count() == 0
    hist = residual_histogram(pred)
    assert hist.count() == 2 * 2 * 40
    assert hist.groupBy("model", "space").sum("count").filter(f"`sum(count)` != {n}").count() == 0
    assert report_bars(res.comparison).count() == 2 * 4
    ov = report_overlay(pred, ["linear_regression", "decision_tree"])
    assert ov.count() == 2 * n and {"real", "linear_regression", "decision_tree"} <= set(ov.columns)


FOREST = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from daycast.operators import models as M
from daycast.operators.split import training_frame
from daycast.plans.features import feature_table
from daycast.plans.train import fit_models
from daycast.session import get_session
from fixtures import daily
spark = get_session("local[{cores}]", shuffle_partitions={cores}, extra={{"spark.checkpoint.dir": {ckpt!r}}})
ft = feature_table(daily(spark, 140, tx=lambda i: 1000 + (i * 37) % 101 + 3 * i, gas=lambda i: 0.3 + ((i * 13) % 7) / 10))
frame, feats = training_frame(ft)
p = M.ModelParams(rf_trees=8, gbt_rounds=4, models=["random_forest", "boosted_trees"])
for name, model in fit_models(frame.repartition({cores}), feats, p).items():
    for r in model.transform(frame).orderBy("date").select("prediction").collect():
        print("P", name, repr(r[0]))
"""


def test_seeded_models_do_not_depend_on_the_cores(tmp_path):
    import os
    import subprocess
    import sys
    from fixtures import ROOT
    out = []
    for cores in (2, 4):
        code = FOREST.format(root=ROOT, tests=os.path.join(ROOT, "tests"), cores=cores, ckpt=str(tmp_path / f"c{cores}"))
        run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
        rows = [x.split() for x in run.stdout.splitlines() if x.startswith("P ")]
        assert rows, run.stderr[-2000:]
        out.append(rows)
    assert len(out[0]) == len(out[1])
    assert all(a[1] == b[1] and float(a[2]) == pytest.approx(float(b[2]), abs=1e-9) for a, b in zip(*out))


def test_training_reads_the_raw_table_once(spark, tmp_path):
    """The feature plan runs in one job; training reads what it wrote."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    base = daily(spark, 140, tx=lambda i: 1000 + (i * 37) % 101 + 3 * i, gas=lambda i: 0.3 + ((i * 13) % 7) / 10)
    counted = base.mapInPandas(count, base.schema)
    train_and_compare(feature_table(counted), "2024-03-31", "2024-04-01", "2024-12-31",
                      M.ModelParams(models=["linear_regression"]), run_dir=str(tmp_path / "run")).comparison.collect()
    assert seen.value == 140
