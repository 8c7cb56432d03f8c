from __future__ import annotations

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendcast import jobs
from spendcast.plans.features import feature_table
from spendcast.plans.training import current_model, model_runs
from spendcast.schemas import CAMPAIGN_SPEND, CHANNEL_COLUMNS, FEATURES, MONTHLY_REVENUE
from spendcast.sources.landing import load_new_files, stream_csv
from spendcast.sources.tables import overwrite_table
from spendcast.streaming import refresh as rf
from spendcast.workspace import remove_folder
from tests.helpers import rows

CODES = list(CHANNEL_COLUMNS)


def month_rows(years, seed=1, noise=0.0):
    rng = np.random.default_rng(seed)
    costs, income = [], []
    for year in years:
        for month in range(1, 13):
            x = rng.integers(100, 900, 4)
            for code, cost in zip(CODES, x):
                half = int(cost) // 2
                for day, part in ((3, half), (17, int(cost) - half)):
                    costs.append(("c", code, dt.date(year, month, day), Decimal(1), Decimal(part), Decimal(1)))
            revenue = 1000.0 + 3 * x[0] + 0.01 * x[1] * x[2] + x[3] + rng.normal() * noise
            income.append((year, month, float(revenue)))
    return costs, income


class Landing:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def drop(self, costs, income):
        if costs:
            self.spark.createDataFrame(costs, CAMPAIGN_SPEND).write.mode("append").parquet(f"{self.root}/spend")
        if income:
            self.spark.createDataFrame(income, MONTHLY_REVENUE).write.mode("append").parquet(f"{self.root}/revenue")

    def refresh(self, retrain=None, **more):
        return rf.Refresh(
            self.spark,
            self.spark.readStream.schema(CAMPAIGN_SPEND).parquet(f"{self.root}/spend"),
            self.spark.readStream.schema(MONTHLY_REVENUE).parquet(f"{self.root}/revenue"),
            f"{self.root}/out",
            retrain=retrain,
            **more,
        )

    def rebuilt(self):
        return feature_table(
            self.spark.read.schema(CAMPAIGN_SPEND).parquet(f"{self.root}/spend"),
            self.spark.read.schema(MONTHLY_REVENUE).parquet(f"{self.root}/revenue"),
        )

    def current(self):
        return rf.current_features(self.spark, f"{self.root}/out")


def close(found, expected):
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[:-1] == b[:-1] and a[-1] == pytest.approx(b[-1], rel=1e-12)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, str(tmp_path))


def test_refresh_equals_a_rebuild(spark, landing):
    costs, income = month_rows([2019])
    landing.drop(costs, income)
    landing.refresh().run_once()
    close(rows(landing.current()), rows(landing.rebuilt()))

    landing.refresh().run_once()
    assert len(rf.published_versions(spark, f"{landing.root}/out")) == 1

    more_costs, more_income = month_rows([2020], seed=2)
    late = [("c", "video", dt.date(2019, 3, 30), Decimal(1), Decimal(1000), Decimal(1))]
    half_month = [("c", "email", dt.date(2021, 1, 1), Decimal(1), Decimal(5), Decimal(1))]
    landing.drop(more_costs + late + half_month, more_income)
    landing.refresh().run_once()
    assert len(rf.published_versions(spark, f"{landing.root}/out")) == 2
    assert landing.current().count() == 24
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_totals_hold_listed_channels_only(spark, landing):
    costs, income = month_rows([2019])
    junk = [("c", f"junk{i}", dt.date(2019, 1, 1), Decimal(1), Decimal(5), Decimal(1)) for i in range(200)]
    landing.drop(costs + junk, income)
    landing.refresh().run_once()
    assert spark.read.parquet(rf.totals_path(f"{landing.root}/out", 0)).count() == 12 * 5
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_repeated_batch_counts_once(spark, landing):
    landing.drop(*month_rows([2019]))
    refresh = landing.refresh()
    batch = rf.arriving_rows(
        spark.read.schema(CAMPAIGN_SPEND).parquet(f"{landing.root}/spend"),
        spark.read.schema(MONTHLY_REVENUE).parquet(f"{landing.root}/revenue"),
    )
    refresh._batch(batch, 0)
    refresh._batch(batch, 0)
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_half_done_batch_is_done_again(spark, landing):
    """Totals written but not published, as after a lost driver."""
    landing.drop(*month_rows([2019]))
    batch = rf.arriving_rows(
        spark.read.schema(CAMPAIGN_SPEND).parquet(f"{landing.root}/spend"),
        spark.read.schema(MONTHLY_REVENUE).parquet(f"{landing.root}/revenue"),
    )
    rf.add_totals(None, batch).write.parquet(rf.totals_path(f"{landing.root}/out", 0))
    landing.refresh()._batch(batch, 0)
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_retrain_follows_and_a_failed_gate_keeps_the_model(spark, landing):
    retrain = rf.retrain_with(folds=0)
    landing.drop(*month_rows(range(2012, 2020)))
    landing.refresh(retrain).run_once()
    out = f"{landing.root}/out"
    runs = model_runs(spark, out).collect()
    assert [r["model_saved"] for r in runs] == [True]
    first = current_model(spark, out)

    landing.drop(*month_rows(range(2020, 2030), seed=5, noise=1e6))
    landing.refresh(retrain).run_once()
    runs = model_runs(spark, out).orderBy("version").collect()
    assert [r["model_saved"] for r in runs] == [True, False]
    assert current_model(spark, out) == first

    landing.refresh(retrain).run_once()
    assert model_runs(spark, out).count() == 2


def test_failed_features_stop_the_retrain(spark, landing):
    calls = []
    costs, income = month_rows([2019])
    broken = costs + [("c", "video", dt.date(2019, 1, 1), Decimal(1), Decimal("9" * 38), Decimal(1))] * 2
    landing.drop(broken, income)
    with pytest.raises(Exception):
        landing.refresh(lambda *args: calls.append(args)).run_once()
    assert calls == []
    assert rf.published_versions(spark, f"{landing.root}/out") == []


def test_suspend_and_resume(spark, landing):
    landing.drop(*month_rows([2019]))
    refresh = landing.refresh()
    refresh.start("1 second").processAllAvailable()
    refresh.suspend()
    assert not refresh.query.isActive
    landing.drop(*month_rows([2020], seed=2))
    assert landing.current().count() == 12
    refresh.resume("1 second").processAllAvailable()
    refresh.suspend()
    assert landing.current().count() == 24
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_nothing_published_yet(spark, tmp_path):
    with pytest.raises(LookupError):
        rf.current_features(spark, str(tmp_path / "none"))


def test_from_csv_files_to_features(spark, tmp_path):
    """New files are loaded into the tables, new rows of the tables refresh the features."""
    sources = {"spend": CAMPAIGN_SPEND, "revenue": MONTHLY_REVENUE}

    def arrive(year):
        for name, data in zip(sources, month_rows([year], seed=year)):
            frame = spark.createDataFrame(data, sources[name])
            frame.write.mode("append").option("header", "true").csv(f"{tmp_path}/landing/{name}")

    def run():
        for name, schema in sources.items():
            files = stream_csv(spark, f"{tmp_path}/landing/{name}", schema)
            load_new_files(files, f"{tmp_path}/tables/{name}", f"{tmp_path}/checkpoints/{name}").awaitTermination()
        streams = [spark.readStream.schema(s).parquet(f"{tmp_path}/tables/{n}") for n, s in sources.items()]
        rf.Refresh(spark, *streams, f"{tmp_path}/out").run_once()
        return rf.current_features(spark, f"{tmp_path}/out")

    arrive(2019)
    assert run().count() == 12
    assert run().count() == 12
    arrive(2020)
    tables = [spark.read.schema(s).csv(f"{tmp_path}/landing/{n}", header=True) for n, s in sources.items()]
    close(rows(run()), rows(feature_table(*tables)))


def test_jobs_by_name(spark, tmp_path, table_name):
    costs, income = month_rows(range(2012, 2020))
    overwrite_table(spark.createDataFrame(costs, CAMPAIGN_SPEND), "CAMPAIGN_SPEND")
    overwrite_table(spark.createDataFrame(income, MONTHLY_REVENUE), "MONTHLY_REVENUE")
    assert jobs.call(spark, "build_feature_table") == "SUCCESS"
    assert spark.table("marketing_budgets_features").count() == 96
    report = jobs.call(spark, "train_model", "MARKETING_BUDGETS_FEATURES", 10, 2, 0.85, 0.85, True, str(tmp_path))
    assert report["model_saved"] and report["train_r2"] > 0.99
    model = jobs.call(spark, "deploy_functions", str(tmp_path))
    assert model == current_model(spark, str(tmp_path))
    scored = spark.table("MARKETING_BUDGETS_FEATURES").select(
        "REVENUE",
        F.call_udf("predict_roi", F.array(*FEATURES)).alias("by_array"),
        F.call_udf("batch_predict_roi", *[F.col(f).cast("double") for f in FEATURES]).alias("by_batch"),
    )
    for row in scored.collect():
        assert row["by_array"] == pytest.approx(row["by_batch"], rel=1e-12)
        assert row["by_array"] == pytest.approx(row["REVENUE"], rel=0.01)
    with pytest.raises(LookupError):
        jobs.call(spark, "no_such_job")


def test_register_job(spark):
    jobs.register("add", lambda session, a, b: a + b)
    assert jobs.call(spark, "add", 1, 2) == 3
    with pytest.raises(ValueError):
        jobs.register("add", print, replace=False)


def test_spend_before_revenue_does_not_stop_the_feed(spark, landing):
    """The first features are empty; the model comes with the first drop it can be fitted on."""
    costs, income = month_rows(range(2012, 2020))
    retrain = rf.retrain_with(folds=5)
    spark.createDataFrame([], MONTHLY_REVENUE).write.parquet(f"{landing.root}/revenue")
    landing.drop(costs, [])
    landing.refresh(retrain).run_once()
    out = f"{landing.root}/out"
    assert landing.current().count() == 0
    first = model_runs(spark, out).first()
    assert (first["train_r2"], first["test_r2"], first["model_saved"]) == (None, None, False)
    landing.drop([], income)
    landing.refresh(retrain).run_once()
    assert landing.current().count() == 96
    assert [r["model_saved"] for r in model_runs(spark, out).orderBy("run_time").collect()] == [False, True]
    assert rf.retrain_errors(spark, out).count() == 0


def test_failed_retrain_is_recorded_and_tried_again(spark, landing):
    out, calls = f"{landing.root}/out", []

    def retrain(features, root, version):
        calls.append(version)
        if len(calls) == 1:
            raise RuntimeError("no memory")

    landing.drop(*month_rows([2019]))
    landing.refresh(retrain).run_once()
    assert landing.current().count() == 12
    assert [r["error"] for r in rf.retrain_errors(spark, out).collect()] == ["RuntimeError: no memory"]
    landing.drop(*month_rows([2020], seed=2))
    landing.refresh(retrain).run_once()
    assert calls == [0, 0, 1] and landing.current().count() == 24


def test_lost_checkpoint_is_refused_and_rebuilt(spark, landing):
    out = f"{landing.root}/out"
    landing.drop(*month_rows([2019]))
    landing.refresh().run_once()
    remove_folder(spark, rf.checkpoint_path(out, 0))
    landing.drop(*month_rows([2020], seed=2))
    with pytest.raises(rf.RefreshMismatch, match="checkpoint"):
        landing.refresh().run_once()
    assert landing.current().count() == 12
    landing.refresh().rebuild()
    assert landing.current().count() == 24
    landing.drop(*month_rows([2021], seed=3))
    landing.refresh().run_once()
    assert landing.current().count() == 36
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_other_channels_need_a_rebuild(spark, landing):
    two = dict(list(CHANNEL_COLUMNS.items())[:2])
    landing.drop(*month_rows([2019]))
    landing.refresh(channels=two).run_once()
    assert len(landing.current().columns) == 5
    landing.drop(*month_rows([2020], seed=2))
    with pytest.raises(rf.RefreshMismatch, match="channels"):
        landing.refresh().run_once()
    landing.refresh().rebuild()
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_rebuild_counts_corrected_rows(spark, landing):
    costs, income = month_rows([2019])
    landing.drop(costs, income)
    landing.refresh().run_once()
    fixed = spark.createDataFrame([(y, m, 2 * r) for y, m, r in income], MONTHLY_REVENUE)
    fixed.write.mode("overwrite").parquet(f"{landing.root}/revenue")
    landing.refresh().rebuild()
    close(rows(landing.current()), rows(landing.rebuilt()))
    landing.refresh().rebuild()
    close(rows(landing.current()), rows(landing.rebuilt()))


@pytest.mark.parametrize("files", [True, False])
def test_rebuild_of_empty_sources_is_an_empty_table(spark, landing, tmp_path, files):
    for name, schema in (("spend", CAMPAIGN_SPEND), ("revenue", MONTHLY_REVENUE)):
        if files:
            spark.createDataFrame([], schema).write.parquet(f"{landing.root}/{name}")
        else:
            (tmp_path / name).mkdir()
    landing.refresh().rebuild()
    assert landing.current().count() == 0
    assert landing.current().columns == landing.rebuilt().columns
    landing.drop(*month_rows([2019]))
    landing.refresh().run_once()
    close(rows(landing.current()), rows(landing.rebuilt()))


def test_registry_and_versions_stay_small(spark, landing, tmp_path):
    refresh = rf.Refresh(spark, None, None, f"{landing.root}/out", keep=3)
    out = f"{landing.root}/out"
    counts = []
    for batch in range(50):
        new = spark.createDataFrame([(2000 + batch, 1, "video", Decimal(1), None)], "YEAR int, MONTH int, CHANNEL string, TOTAL_COST decimal(38,0), REVENUE double")
        refresh._batch(new.coalesce(1), batch)
        if batch >= 5:
            files = [f for part in ("totals", "features") for f in (tmp_path / "out" / part).rglob("*.parquet")]
            counts.append(len(list((tmp_path / "out" / "published").glob("*.json"))))
            assert len({f.parent for f in files}) <= 2 * 3
    assert set(counts) == {3}
    assert rf.published_versions(spark, out) == [49, 48, 47]
    assert spark.read.parquet(rf.totals_path(out, 49)).count() == 50


def test_a_passing_retrain_reaches_the_scorer(spark, landing, tmp_path):
    deployed = []

    def deploy(session, root):
        deployed.append(jobs.call(session, "deploy_functions", root))

    landing.drop(*month_rows(range(2012, 2020)))
    landing.refresh(rf.retrain_with(folds=5), deploy=deploy).run_once()
    assert deployed == [current_model(spark, f"{landing.root}/out")]
    assert landing.current().select(F.call_udf("predict_roi", F.array(*FEATURES)).alias("x")).count() == 96


def test_saving_takes_a_root(spark):
    with pytest.raises(ValueError, match="model_root"):
        jobs.call(spark, "train_model", "ANY", 10, 2, 0.85, 0.85, True)
