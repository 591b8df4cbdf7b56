"""Report tables, bounded sample, month ranges, multi-input read, NULL rules."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import SF_SMALL
from daycast.operators.output import bounded_sample
from daycast.operators.report import residual_histogram
from daycast.operators.rollup import daily_rollup
from daycast.sources import testdata as td
from daycast.sources.files import (month_ranges, multi_read, read_month_range,
                                   write_month_partitioned)


def _preds(spark, n=300):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        y = float(rng.normal(5, 1))
        rows.append(("m", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(np.expm1(y)), y,
                     y + float(rng.normal(0, 0.3))))
    df = spark.createDataFrame(rows, "model string, date date, label double, label_log double, prediction_log double")
    return df.withColumn("prediction_raw", F.expm1(F.greatest("prediction_log", F.lit(0.0))))


def test_histogram_matches_numpy(spark):
    pred = _preds(spark)
    hist = residual_histogram(pred).filter(F.col("space") == "log").orderBy("bin").collect()
    pdf = pred.select((F.col("prediction_log") - F.col("label_log")).alias("r")).toPandas()
    counts, edges = np.histogram(pdf["r"].to_numpy(), bins=40)
    assert [r["count"] for r in hist] == list(counts)
    assert [r["bin_lo"] for r in hist] == pytest.approx(list(edges[:-1]))
    assert sum(r["count"] for r in hist) == 300


def test_bounded_sample_is_top_k_by_date(spark):
    pred = _preds(spark)
    got = [r["date"] for r in bounded_sample(pred, 17).collect()]
    want = sorted(r["date"] for r in pred.select("date").collect())[:17]
    assert got == want


def test_month_ranges_clip(spark):
    b = spark.createDataFrame([(dt.date(2024, 1, 15), dt.date(2024, 3, 10))], "min_date date, max_date date")
    rows = month_ranges(b).orderBy("year_month").collect()
    assert [(r["year_month"], r["range_start"], r["range_end"]) for r in rows] == [
        ("2024-01", dt.date(2024, 1, 15), dt.date(2024, 1, 31)),
        ("2024-02", dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        ("2024-03", dt.date(2024, 3, 1), dt.date(2024, 3, 10))]


def test_month_partitioned_write_and_pruned_read(spark, tmp_path):
    daily = daily_rollup(td.blocks(spark, SF_SMALL))
    path = str(tmp_path / "daily")
    write_month_partitioned(daily, path)
    back = read_month_range(spark, path, "1997-02-10", "1997-04-20")
    want = daily.filter(F.col("day").between("1997-02-10", "1997-04-20")).count()
    assert back.count() == want
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year_month" in plan


def test_multi_read_merges_schemas(spark, tmp_path):
    daily = daily_rollup(td.blocks(spark, SF_SMALL))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    daily.filter(F.col("day") < "1998-01-01").write.parquet(a)
    daily.filter(F.col("day") >= "1998-01-01").withColumn("price_usd", F.lit(1.0)).write.parquet(b)
    both = multi_read(spark, [a, b])
    assert both.count() == daily.count() and "price_usd" in both.columns


def test_metric_summary_record_and_json(spark, tmp_path):
    from daycast.operators.metrics import model_comparison
    from daycast.sources.records import metrics_summary, summary_record, write_json_record
    a = _preds(spark)
    b = a.withColumn("model", F.lit("n")).withColumn("prediction_log", F.col("label_log"))
    b = b.withColumn("prediction_raw", F.expm1(F.greatest("prediction_log", F.lit(0.0))))
    comp = model_comparison(a.unionByName(b))
    tidy = metrics_summary(comp, "2020-01-01", "2020-12-31")
    assert tidy.count() == 8
    rec = summary_record(tidy, "runs/x", "features.parquet", ["m", "n"])
    path = str(tmp_path / "summary")
    write_json_record(rec, path)
    back = spark.read.json(path).first()
    assert back["date_range"]["start"] == "2020-01-01"
    assert back["r2_log"]["n"] == pytest.approx(1.0)
    assert back["models_loaded"] == ["m", "n"]


def test_null_predictions_count_in_no_bin_and_no_metric(spark):
    from daycast.operators.metrics import regression_metrics
    pred = _preds(spark, 60)
    holed = pred.withColumn("prediction_log", F.when(F.dayofmonth("date") == 7, None).otherwise(F.col("prediction_log")))
    whole = holed.where("prediction_log IS NOT NULL")
    hist = lambda d: [(r["bin"], r["count"]) for r in residual_histogram(d, 4).where("space = 'log'").orderBy("bin").collect()]
    assert whole.count() < 60 and hist(holed) == hist(whole)
    a, b = regression_metrics(holed, ["log"]).first(), regression_metrics(whole, ["log"]).first()
    assert a["r2_log"] == pytest.approx(b["r2_log"], rel=1e-12) and a["rmse_log"] == pytest.approx(b["rmse_log"], rel=1e-12)


def test_reports_keep_the_series(spark):
    from daycast.operators.report import report_overlay, report_scatter, report_timeseries
    pred = _preds(spark, 20)
    two = pred.withColumn("series", F.lit("a")).unionByName(pred.withColumn("series", F.lit("b")).withColumn("label", F.col("label") + 1))
    assert report_timeseries(two, ["series"]).count() == 40
    assert report_scatter(two, ["series"]).where("series = 'b'").count() == 40
    over = report_overlay(two, ["m"], ["series"])
    assert over.count() == 2 * 2 * 20
    assert over.groupBy("space", "series", "date").count().where("count > 1").count() == 0
    cut = [(r["date"], r["series"]) for r in bounded_sample(two, 7, "date", "series").collect()]
    assert cut == sorted((r["date"], r["series"]) for r in two.select("date", "series").collect())[:7]


def test_report_plan_reloads_scores_and_summarises(spark, tmp_path):
    from daycast.operators.models import ModelParams
    from daycast.plans.report import run_report
    from daycast.plans.train import train_and_compare
    from daycast.plans.features import feature_table
    from fixtures import daily
    ft = feature_table(daily(spark, 140, tx=lambda i: 1000 + (i * 37) % 101 + 3 * i, gas=lambda i: 0.3 + ((i * 13) % 7) / 10))
    run = str(tmp_path / "run")
    res = train_and_compare(ft, "2024-03-31", "2024-04-01", "2024-12-31", ModelParams(models=["linear_regression", "decision_tree"]), run_dir=run)
    rep = run_report(spark, ft, run, "2024-04-01", "2024-12-31", out_dir=str(tmp_path / "report"))
    a = {r["model"]: r["rmse_log"] for r in res.comparison.collect()}
    b = {r["model"]: r["rmse_log"] for r in rep.comparison.collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-12) for k in a)
    back = spark.read.json(str(tmp_path / "report" / "metrics_summary")).first()
    assert back["models_loaded"] == ["linear_regression", "decision_tree"]
    assert rep.residuals.count() == 2 * 2 * 40 and rep.overlay.count() == 2 * rep.predictions.where("model = 'decision_tree'").count()
