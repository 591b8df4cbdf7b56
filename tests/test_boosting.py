"""Boosting against a plain numpy booster, in one task and in several."""

import numpy as np
import pytest

from daycast.operators import boosting as B
from daycast.operators import models as M
from daycast.sources.models_io import model_load, model_load_score, model_save


def plain_booster(x, y, ids, p):
    """Sorts every node's rows by every column; floats, no bins, no histograms."""
    base = y.mean()
    pred, trees = np.full(len(y), base), []
    for r in range(p.rounds):
        grad, used, cols = pred - y, B.sampled_rows(ids, r, p), B.sampled_columns(x.shape[1], r, p)

        def leaf(rows):
            rows = rows[used[rows]]
            return -p.learning_rate * grad[rows].sum() / (len(rows) + p.l2)

        def build(rows, depth):
            own = rows[used[rows]]
            best = (p.min_gain, None, None)
            total = grad[own].sum() ** 2 / (len(own) + p.l2) if len(own) else 0
            if depth < p.max_depth:
                for f in cols:
                    order = own[np.argsort(x[own, f], kind="stable")]
                    g = grad[order].cumsum()
                    for i in range(len(order) - 1):
                        a, b = x[order[i], f], x[order[i + 1], f]
                        if a == b:
                            continue
                        gain = g[i] ** 2 / (i + 1 + p.l2) + (g[-1] - g[i]) ** 2 / (len(order) - i - 1 + p.l2) - total
                        if gain > best[0] + 1e-9 * abs(best[0]):
                            best = (gain, f, a)
            if best[1] is None:
                pred_of[rows] = leaf(rows)
                return
            go = x[rows, best[1]] <= best[2]
            build(rows[go], depth + 1)
            build(rows[~go], depth + 1)

        pred_of = np.zeros(len(y))
        build(np.arange(len(y)), 0)
        pred = pred + pred_of
        trees.append(pred_of)
    return pred


def sample(n=240, m=5, seed=4):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(n, m)), 2)
    return x, np.sin(2 * x[:, 0]) + 0.4 * x[:, 1] + r.normal(scale=0.05, size=n)


COLS = [f"x{i}" for i in range(5)]
SMALL = B.BoostParams(rounds=12, learning_rate=0.3, max_depth=3, bins=256, seed=7)
SHORT = B.BoostParams(rounds=4, learning_rate=0.3, max_depth=3, bins=256, seed=7)


def frame(spark, x, y):
    return spark.createDataFrame([(i, float(t), *map(float, row)) for i, (t, row) in enumerate(zip(y, x))],
                                 "date int, label_diff double, " + ", ".join(f"{c} double" for c in COLS))


def ids_of(df):
    from pyspark.sql import functions as F
    rows = df.select("date", F.xxhash64("label_diff", *COLS).alias("h")).orderBy("date").collect()
    return np.array([r["h"] for r in rows], np.int64).view(np.uint64)


def test_equals_the_plain_booster_in_any_number_of_tasks(spark):
    x, y = sample()
    df = frame(spark, x, y)
    tables = []
    for p, tasks, parts in ((SMALL, 1, 3), (SHORT, 1, 5), (SHORT, 2, 5), (SHORT, 4, 1)):
        model = B.boost(df.repartition(parts), COLS, "label_diff", p, tasks=tasks)
        got = [r["prediction"] for r in model.transform(df).orderBy("date").collect()]
        assert np.allclose(got, plain_booster(x, y, ids_of(df), p), rtol=0, atol=1e-9)
        tables.append(sorted(tuple(map(str, r)) for r in model.nodes.collect()))
    assert tables[1] == tables[2] == tables[3]  # bit for bit
    # rows on a threshold between bins of the sample go the way the table says
    shifted = frame(spark, x + 0.004, y)
    assert model.transform(shifted).count() == len(y)


def test_joined_scores_equal_the_scorer(spark):
    from daycast.operators.trees import score_by_join
    x, y = sample()
    df = frame(spark, x, y)
    model = B.boost(df, COLS, "label_diff", SMALL)
    a = {r["date"]: r["prediction"] for r in model.transform(df).collect()}
    b = {r["date"]: r["prediction"] for r in score_by_join(df, model.nodes, COLS, ["date"]).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_penalty_depth_and_shares_count(spark):
    x, y = sample()
    df = frame(spark, x, y)
    strong = B.boost(df, COLS, "label_diff", B.BoostParams(rounds=3, l2=1e12))
    assert strong.nodes.where("tree >= 0").selectExpr("max(abs(value))").first()[0] < 1e-9
    assert strong.nodes.where("tree < 0").first()["value"] == pytest.approx(y.mean(), abs=1e-12)
    deep = B.boost(df, COLS, "label_diff", B.BoostParams(rounds=5, max_depth=2, column_share=0.4, min_rows=20))
    assert deep.nodes.selectExpr("max(depth)").first()[0] <= 2
    assert deep.nodes.where("tree >= 0 AND rows < 20").count() == 0
    per_tree = deep.nodes.where("feature >= 0").groupBy("tree").agg({"feature": "approx_count_distinct"}).collect()
    assert all(r[1] <= 2 for r in per_tree)


def test_coarse_bins_constant_columns_and_missing_values(spark):
    x, y = sample(400)
    x[:, 4] = 3.0
    df = frame(spark, x, y)
    model = B.boost(df, COLS, "label_diff", B.BoostParams(rounds=40, learning_rate=0.2, bins=16))
    rmse = np.sqrt(np.mean([(r["prediction"] - r["label_diff"]) ** 2 for r in model.transform(df).collect()]))
    assert rmse < 0.4 * y.std() and model.nodes.where("feature = 4").count() == 0
    holed = df.selectExpr("date", "label_diff", "CASE WHEN date = 3 THEN NULL WHEN date = 4 THEN double('NaN') ELSE x0 END AS x0", *COLS[1:])
    assert model.transform(holed).count() == 398
    B.boost(holed, COLS, "label_diff", B.BoostParams(rounds=1))
    with pytest.raises(ValueError):
        B.boost(df.limit(0), COLS, "label_diff", SMALL)
    one = B.boost(df.limit(1), COLS, "label_diff", SMALL)
    assert one.transform(df).count() == 400


def test_saved_boosting_reloads(spark, tmp_path):
    x, y = sample()
    df = frame(spark, x, y).selectExpr("*", "0.0D AS tx_log")
    model = M.fit("boosted_trees", df, COLS, M.ModelParams(gbt_rounds=5))
    path = model_save(model, str(tmp_path), "boosted_trees")
    model_save(model, str(tmp_path), "boosted_trees")  # replaces
    a = [r[0] for r in model.transform(df).orderBy("date").select("prediction").collect()]
    assert a == [r[0] for r in model_load(spark, path).transform(df).orderBy("date").select("prediction").collect()]
    assert a == [r[0] for r in model_load_score(str(tmp_path), df).orderBy("date").select("prediction").collect()]
