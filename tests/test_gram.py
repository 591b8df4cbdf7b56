"""Gram states, certified elastic nets, and models per series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daycast.operators import gram as G
from daycast.operators import models as M

COLS = [f"x{i}" for i in range(6)]


def table(spark, n=300, seed=0, series=("a", "b", None)):
    r = np.random.default_rng(seed)
    rows = []
    for s, name in enumerate(series):
        x = r.normal(size=(n, 6)) * [1, 10, 0.1, 1, 1, 0] + [0, 1e6, 3, s, 0, 5]
        x[:, 3] = x[:, 0] + 0.01 * x[:, 3]
        y = 0.3 * x[:, 0] + 0.02 * (x[:, 1] - 1e6) * (s + 1) - s + r.normal(scale=0.2, size=n)
        rows += [(name, i, float(t), *map(float, v)) for i, (t, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "series string, day int, label_diff double, " + ", ".join(f"{c} double" for c in COLS))


def test_states_merge_to_the_whole(spark):
    df = table(spark)
    x = np.array(df.select(*COLS, "label_diff").collect())
    n, mean, cross = G.fold(x)
    for parts in (1, 7, 40):
        s = G.gram_states(df.repartition(parts), [*COLS, "label_diff"]).first()
        assert s["n"] == n and np.allclose(s["mean"], mean, rtol=1e-12)
        assert np.allclose(np.reshape(s["cross"], cross.shape), cross, rtol=1e-9, atol=1e-6)
    keyed = {r["series"]: r for r in G.gram_states(df.repartition(9), [*COLS, "label_diff"], ["series"]).collect()}
    assert set(keyed) == {"a", "b", None} and all(r["n"] == 300 for r in keyed.values())


def test_equals_spark_and_is_certified(spark):
    df = table(spark)
    for reg, mix in ((0.05, 0.3), (0.01, 1.0), (0.2, 0.0)):
        own = G.fit_elastic_nets(df, COLS, "label_diff", reg, mix).first()
        spark_model = M.fit("linear_regression", df, COLS, M.ModelParams(lr_regparam=reg, lr_elasticnet=mix))
        scaler, lr = spark_model.stages[-2:]
        std = scaler.std.toArray()
        theirs = np.divide(lr.coefficients.toArray(), std, out=np.zeros(6), where=std > 0)
        assert np.allclose(own["coefficients"], theirs, rtol=1e-4, atol=1e-6)
        assert own["residual"] < 1e-9
        both = G.score_linear(df.withColumn("id", F.monotonically_increasing_id()), G.fit_elastic_nets(df, COLS, "label_diff", reg, mix), COLS)
        want = [r[0] for r in spark_model.transform(df).select("prediction").collect()]
        got = [r["prediction"] for r in both.orderBy("id").collect()]
        assert np.allclose(got, want, atol=1e-5)
    # a model that only knows the mean is no optimum
    n, mean, cross = G.fold(np.array(df.select(*COLS, "label_diff").collect()))
    assert G.elastic_net(n, mean, cross, 0.05, 0.3)[1].any()


def test_one_pass_gives_every_series_its_own_fit(spark):
    df = table(spark)
    models = {r["series"]: r for r in G.fit_elastic_nets(df.repartition(5), COLS, "label_diff", 0.05, 0.3, ["series"]).collect()}
    assert len(models) == 3
    for name, m in models.items():
        single = G.fit_elastic_nets(df.where(F.col("series").eqNullSafe(F.lit(name))), COLS, "label_diff", 0.05, 0.3).first()
        assert np.allclose(m["coefficients"], single["coefficients"], atol=1e-10) and m["intercept"] == pytest.approx(single["intercept"], rel=1e-9)
    scored = G.score_linear(df, G.fit_elastic_nets(df, COLS, "label_diff", 0.05, 0.3, ["series"]), COLS, ["series"])
    assert scored.count() == 900 and scored.columns == [*df.columns, "prediction"]


def test_degenerate_series(spark):
    df = table(spark, 5, series=("a",)).unionByName(table(spark, 1, series=("one",))).unionByName(
        table(spark, 4, series=("flat",)).withColumn("label_diff", F.lit(2.5)))
    got = {r["series"]: r for r in G.fit_elastic_nets(df, COLS, "label_diff", 0.05, 0.3, ["series"]).collect()}
    assert got["flat"]["intercept"] == 2.5 and not any(got["flat"]["coefficients"]) and got["one"]["n"] == 1
    assert G.fit_elastic_nets(df.limit(0), COLS, "label_diff", 0.05, 0.3, ["series"]).count() == 0
    r = G.correlations(G.gram_states(df, COLS), COLS)
    assert r.count() == 21 and r.where("r IS NULL").count() == 6  # x5 is constant
    holed = df.withColumn("x0", F.when(F.col("day") == 0, float("nan")).otherwise(F.col("x0")))
    assert G.gram_states(holed, COLS).first()["n"] == 7


def test_keyed_training_fits_saves_and_reloads_series_models(spark, tmp_path):
    from daycast.plans.train import train_and_compare
    from daycast.sources.models_io import model_load_score
    from daycast.operators.split import time_split, training_frame
    df = table(spark, 200).selectExpr("series", "date_add(DATE'2024-01-01', day) AS date", "100.0D + x1 AS label", "5.0D + label_diff AS label_log",
                                      "5.0D AS tx_log", *COLS)
    run = str(tmp_path / "run")
    res = train_and_compare(df, "2024-04-30", "2024-05-01", "2024-12-31", M.ModelParams(models=["linear_regression", "linear_per_series"]),
                            run_dir=run, keys=["series"])
    error = {r["model"]: r["rmse_log"] for r in res.comparison.collect()}
    assert error["linear_per_series"] < 0.6 * error["linear_regression"]  # the series' slopes differ
    _, test = time_split(training_frame(df, ["series"])[0], "2024-04-30", "2024-05-01", "2024-12-31")
    again = model_load_score(run, test, ["linear_per_series"])
    a, b = (sorted((str(r["series"]), r["date"], r["prediction"]) for r in d.collect()) for d in (again, res.predictions.where("model = 'linear_per_series'")))
    assert a == b and len(a) == test.count()
