from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendcast.functions.scoring import score
from spendcast.operators import split
from spendcast.operators.split import exact_split, key_digest, rank_cuts, with_split
from spendcast.plans import training as tr
from spendcast.schemas import FEATURES, TRAIN_REPORT
from tests.helpers import final_plan, rows

MONTHS = 200


def months(noise=0.0, constant=None, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.uniform(1e5, 6e5, size=(MONTHS, 4)).round()
    if constant is not None:
        x[:, constant] = 5000.0
    z = x / 1e5
    y = 1e6 + 2e5 * z[:, 0] - 3e4 * z[:, 1] * z[:, 2] + 5e4 * z[:, 3] ** 2 + rng.normal(size=MONTHS) * noise
    return x, y


def frame(spark, x, y):
    data = [
        (2000 + i // 12, i % 12 + 1, *[int(v) for v in x[i]], float(y[i])) for i in range(len(y))
    ]
    budgets = ", ".join(f"{f} bigint" for f in FEATURES)
    return spark.createDataFrame(data, f"YEAR int, MONTH int, {budgets}, REVENUE double")


def expand(x, degree=2):
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    columns = [np.ones(len(z))]
    for e in tr.polynomial_exponents(4, degree):
        columns.append(np.prod(z ** np.array(e), axis=1))
    return np.column_stack(columns)


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def test_split_does_not_depend_on_partitioning_and_is_complete(spark):
    df = spark.range(5000).withColumn("k", F.col("id") * 7)
    few, many = (with_split(df.repartition(n), ["id"], folds=5) for n in (2, 13))
    assert rows(few) == rows(many)
    counts = few.groupBy("IS_TEST").count().collect()
    assert sum(r["count"] for r in counts) == 5000
    share = next(r["count"] for r in counts if r["IS_TEST"]) / 5000
    assert 0.17 < share < 0.23
    sizes = [r["count"] for r in few.groupBy("FOLD").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 850
    assert rows(few) != rows(with_split(df, ["id"], seed=43, folds=5))


def sizes(df, column):
    return sorted((r[column], r["count"]) for r in df.groupBy(column).count().collect() if r[column] is not None)


@pytest.mark.parametrize("total, test", [(0, 0), (1, 1), (24, 5), (120, 24), (121, 25), (5003, 1001)])
@pytest.mark.parametrize("folds", [0, 3, 10])
def test_exact_split_has_exact_sizes(spark, total, test, folds):
    df = spark.range(total)
    split = exact_split(df.repartition(3), ["id"], folds=folds)
    assert rows(split) == rows(exact_split(df, ["id"], folds=folds))
    assert split.filter("IS_TEST").count() == test and split.count() == total
    if folds and total > 1:
        found = [n for _, n in sizes(split, "FOLD")]
        assert sum(found) == total - test and max(found) - min(found) <= 1 and len(found) == folds
        assert found == sorted(found, reverse=True)
        assert split.filter("IS_TEST AND FOLD IS NOT NULL").isEmpty()


def test_exact_split_follows_the_rank_of_the_hash(spark):
    split = exact_split(spark.range(300), ["id"], folds=7)
    ranked = split.withColumn("digest", key_digest(["id"], 42)).orderBy("digest").collect()
    assert [r["IS_TEST"] for r in ranked] == [True] * 60 + [False] * 240
    folds = [r["FOLD"] for r in ranked[60:]]
    assert folds == sorted(folds)


def test_cuts_refine_shared_prefixes_and_keep_ties_together(spark):
    shared = "ab" * 14
    digests = [f"{shared}{n:04x}" for n in range(50)] + ["0" * 32] * 30 + ["f" * 32] * 40
    df = spark.createDataFrame([(d,) for d in digests], "digest string")
    wanted = [0, 10, 30, 37, 80, 100, 120]
    total, cuts = rank_cuts(df.repartition(4), lambda n: wanted)
    assert total == 120
    below = [sum(d < c for d in digests) for c in cuts]
    assert below == [0, 30, 30, 37, 80, 120, 120]  # a cut inside equal digests moves behind them


def _digests(spark):
    shared = "ab" * 14
    digests = [f"{shared}{n:04x}" for n in range(50)] + ["0" * 32] * 30 + ["f" * 32] * 40 + [f"{shared[:9]}{n:023x}" for n in range(30)]
    return digests, spark.createDataFrame([(d,) for d in digests], "digest string").repartition(4)


@pytest.mark.parametrize("few", [0, 4, 60, 1 << 16])
def test_cuts_are_the_same_whenever_whole_digests_are_counted(spark, monkeypatch, few):
    monkeypatch.setattr(split, "_FEW", few)
    digests, df = _digests(spark)
    wanted = [0, 10, 30, 37, 75, 100, 120, 149, 150]
    total, cuts = rank_cuts(df, lambda n: wanted)
    assert total == 150
    ranked = sorted(digests)
    for rank, cut in zip(wanted, cuts):
        below = sum(d < cut for d in digests)
        assert below >= rank and ranked[below - 1 : below] != ranked[below : below + 1]
        assert below == rank or len(set(ranked[rank - 1 : below])) == 1


def test_repeated_keys_take_no_more_passes(spark):
    """Every key three times: most cuts fall into rows of one digest."""
    df = spark.range(3000).select((F.col("id") % 1000).alias("id"))
    context = spark.sparkContext
    context.setJobGroup("repeated", "repeated")
    marked = exact_split(df, ["id"], folds=10)
    jobs = context.statusTracker().getJobIdsForGroup("repeated")
    context.setJobGroup("", "")
    assert len(jobs) <= 4  # two passes, each a scan and a small sum
    sides = marked.groupBy("id").agg(F.count_distinct("IS_TEST", F.coalesce("FOLD", F.lit(-1))).alias("n"))
    assert sides.where("n <> 1").count() == 0
    assert marked.where("IS_TEST").count() == 600


def test_ten_folds_on_two_years(spark):
    x, y = months(noise=1e4)
    result = tr.train_revenue_model(frame(spark, x[:24], y[:24]), folds=10, degree=1)
    assert [s["N_ROWS"] for s in result.fold_scores] == [2] * 9 + [1]


def test_null_keys_are_split_too(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert all(r["IS_TEST"] is not None for r in with_split(df, ["a", "b"]).collect())


def test_fit_equals_a_direct_solve(spark):
    x, y = months(noise=2e4)
    df = frame(spark, x, y)
    fitted = tr.revenue_pipeline(2).fit(df.withColumn("REVENUE", F.col("REVENUE")))
    design = expand(x)
    direct = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    scored = score(df, tr.to_polynomial(fitted)).orderBy("YEAR", "MONTH").collect()
    assert [r["PREDICTED_ROI"] for r in scored] == pytest.approx(np.abs(direct), rel=1e-9)
    by_pipeline = fitted.transform(df).orderBy("YEAR", "MONTH").collect()
    assert [r["prediction"] for r in by_pipeline] == pytest.approx(direct, rel=1e-9)


def test_report_and_folds_equal_a_direct_solve(spark):
    x, y = months(noise=2e4)
    df = frame(spark, x, y)
    marks = {(r["YEAR"], r["MONTH"]): r for r in exact_split(df, ["YEAR", "MONTH"], folds=10).collect()}
    keys = [(2000 + i // 12, i % 12 + 1) for i in range(MONTHS)]
    test = np.array([marks[k]["IS_TEST"] for k in keys])
    fold = np.array([marks[k]["FOLD"] for k in keys])
    design = expand(x)
    result = tr.train_revenue_model(df, folds=10)

    weights = np.linalg.lstsq(design[~test], y[~test], rcond=None)[0]
    assert result.report["train_r2"] == pytest.approx(r2(y[~test], design[~test] @ weights), abs=1e-9)
    assert result.report["test_r2"] == pytest.approx(r2(y[test], design[test] @ weights), abs=1e-9)
    assert set(result.report) == {f.name for f in TRAIN_REPORT}
    assert result.report["model_saved"] is False and result.model_path is None

    assert [s["FOLD"] for s in result.fold_scores] == list(range(10))
    for s in result.fold_scores:
        held = ~test & (fold == s["FOLD"])
        kept = ~test & (fold != s["FOLD"])
        weights = np.linalg.lstsq(design[kept], y[kept], rcond=None)[0]
        assert s["N_ROWS"] == held.sum()
        assert s["R2"] == pytest.approx(r2(y[held], design[held] @ weights), abs=1e-8)


def test_constant_channel_still_fits(spark):
    x, y = months(constant=2)
    result = tr.train_revenue_model(frame(spark, x, y), folds=3)
    assert result.report["train_r2"] > 0.99
    assert all(np.isfinite(s["R2"]) for s in result.fold_scores)


def test_gate_keeps_the_older_model(spark, tmp_path):
    root = str(tmp_path)
    x, y = months(noise=1e4)
    good = tr.train_revenue_model(frame(spark, x, y), folds=0, save_root=root, version=1)
    assert good.report["model_saved"] and good.model_path.endswith("version=1")
    rng = np.random.default_rng(0)
    bad = tr.train_revenue_model(frame(spark, x, rng.normal(size=MONTHS)), folds=0, save_root=root, version=2)
    assert not bad.report["model_saved"] and bad.model_path is None
    runs = tr.model_runs(spark, root).orderBy("version").collect()
    assert [(r["version"], r["model_saved"]) for r in runs] == [(1, True), (2, False)]
    loaded = tr.current_model(spark, root)
    assert loaded == good.polynomial


def test_no_model_before_the_first_that_passes(spark, tmp_path):
    x, _ = months()
    y = np.random.default_rng(0).normal(size=MONTHS)
    tr.train_revenue_model(frame(spark, x, y), folds=0, save_root=str(tmp_path), version=1)
    with pytest.raises(LookupError):
        tr.current_model(spark, str(tmp_path))


def test_gate_compares_with_at_least():
    assert tr.passes_gate(0.85, 0.85)
    assert not tr.passes_gate(0.8499, 0.85)
    assert not tr.passes_gate(None, -1.0)


def test_table_without_month_is_split_by_content(spark):
    x, y = months(noise=1e4)
    df = frame(spark, x, y).drop("YEAR", "MONTH")
    assert tr.split_keys(df) == df.columns
    first = tr.train_revenue_model(df, folds=0).report
    again = tr.train_revenue_model(df.repartition(5), folds=0).report
    assert first["test_r2"] == pytest.approx(again["test_r2"], abs=1e-9)
    assert first["test_r2"] is not None


def test_null_feature_is_an_error(spark):
    x, y = months()
    df = frame(spark, x, y).withColumn("VIDEO", F.when(F.col("MONTH") > 1, F.col("VIDEO")))
    with pytest.raises(Exception, match="null"):
        tr.train_revenue_model(df, folds=0)


@pytest.mark.parametrize("side", ["test", "training"])
@pytest.mark.parametrize("column", ["VIDEO", "REVENUE"])
@pytest.mark.parametrize("value", [None, float("nan")])
def test_a_missing_number_on_either_side_is_an_error(spark, side, column, value):
    x, y = months()
    df = frame(spark, x, y)
    chosen = exact_split(df, ["YEAR", "MONTH"]).filter(F.col("IS_TEST") == (side == "test")).limit(3).select("YEAR", "MONTH").collect()
    some = F.concat_ws("-", "YEAR", "MONTH").isin([f"{r['YEAR']}-{r['MONTH']}" for r in chosen])
    broken = df.withColumn(column, F.when(some, F.lit(value).cast("double")).otherwise(F.col(column)))
    with pytest.raises(ValueError, match=f"3 {side} rows hold a null or NaN"):
        tr.train_revenue_model(broken, folds=0)


def test_the_pipeline_on_request_agrees_with_the_solved_weights(spark):
    x, y = months(noise=1e4)
    df = frame(spark, x, y)
    result = tr.train_revenue_model(df, folds=0, pipeline=True)
    both = score(score(df, result.polynomial, output="a"), tr.to_polynomial(result.pipeline), output="b").collect()
    assert [r["a"] for r in both] == pytest.approx([r["b"] for r in both], rel=1e-9)
    assert tr.train_revenue_model(df, folds=0).pipeline is None


def test_report_as_one_row(spark):
    x, y = months(noise=1e4)
    result = tr.train_revenue_model(frame(spark, x, y), folds=4)
    assert tr.report_frame(spark, result).schema == TRAIN_REPORT
    assert tr.report_frame(spark, result).count() == 1
    assert tr.fold_frame(spark, result).count() == 4


def test_folds_take_one_aggregation(spark):
    """Ten folds must not mean ten passes."""
    x, y = months(noise=1e4)
    prepared = tr.prepared_rows(frame(spark, x, y), folds=10).cache()
    prepared.count()
    polynomial = tr.train_revenue_model(frame(spark, x, y), folds=0).polynomial
    context = spark.sparkContext
    context.setJobGroup("folds", "folds")
    tr.cross_validate(prepared, polynomial, float(y.mean()), float(y.var()), 10)
    jobs = context.statusTracker().getJobIdsForGroup("folds")
    context.setJobGroup("", "")
    prepared.unpersist()
    assert len(jobs) <= 2


def test_every_fold_has_a_row_or_is_named(spark):
    x, y = months(noise=1e4)
    with pytest.raises(tr.TooFewRows, match="fold"):
        tr.train_revenue_model(frame(spark, x[:12], y[:12]), folds=10)
    with pytest.raises(tr.TooFewRows, match="no training rows"):
        tr.train_revenue_model(frame(spark, x[:12], y[:12]).limit(0), folds=0)


@pytest.mark.parametrize("degree", [2, 3])
def test_sums_stay_in_generated_code(spark, degree):
    x, y = months(noise=1e4)
    prepared = tr.prepared_rows(frame(spark, x, y), folds=4)
    polynomial = tr.train_revenue_model(frame(spark, x, y), folds=0, degree=degree).polynomial
    frames = tr.sums_of_products(prepared, polynomial, float(y.mean()), float(y.std()))
    assert len(frames) == (1 if degree == 2 else 4)
    for one in frames:
        plan = final_plan(one)
        assert plan.count("HashAggregate") == 2
        assert plan.count(") HashAggregate") == 2  # each behind the number of its generated stage


def test_training_reads_its_rows_a_few_times_and_keeps_no_copy(spark, tmp_path):
    x, y = months(noise=1e4)
    frame(spark, x, y).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    context = spark.sparkContext
    context.setJobGroup("train", "train")
    tr.train_revenue_model(table, folds=10)
    jobs = context.statusTracker().getJobIdsForGroup("train")
    context.setJobGroup("", "")
    # Keys for the cuts (again, if a cut falls into a shared prefix), means, sums: each a scan and a small sum.
    assert len(jobs) <= 8
    assert context._jsc.sc().getPersistentRDDs().isEmpty()


def test_the_latest_run_is_current_whatever_its_version(spark, tmp_path):
    """A run of a job has a time as version, one of a refresh a batch number; the later one counts."""
    root = str(tmp_path)
    x, y = months(noise=1e4)
    tr.train_revenue_model(frame(spark, x, y), folds=0, save_root=root)
    later = tr.train_revenue_model(frame(spark, x, 2 * y), folds=0, save_root=root, version=1)
    assert tr.current_model(spark, root) == later.polynomial
