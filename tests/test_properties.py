from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendcast.operators.reshape import pivot_wide, unpivot_long
from spendcast.operators.split import with_split
from tests.helpers import rows

QUICK = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
CHANNELS = {"a": "A", "b": "B", "c": "C"}
items = st.lists(
    st.tuples(st.integers(0, 4), st.sampled_from(["a", "b", "c", "other"]), st.integers(-(10**6), 10**6)), max_size=40
)


@QUICK
@given(items)
def test_pivot_equals_builtin_and_its_sums_are_the_group_sums(spark, data):
    df = spark.createDataFrame(data, "G int, N string, V long")
    wide = pivot_wide(df, "N", "V", CHANNELS)
    assert rows(wide) == rows(df.groupBy("G").pivot("N", list(CHANNELS)).sum("V"))
    totals = {}
    for group, name, value in data:
        if name in CHANNELS:
            totals[group, name] = totals.get((group, name), 0) + value
    assert {(r["G"], n): r[a] for r in wide.collect() for n, a in CHANNELS.items() if r[a] is not None} == totals


@QUICK
@given(items)
def test_unpivot_undoes_pivot(spark, data):
    df = spark.createDataFrame(data, "G int, N string, V long")
    long = unpivot_long(pivot_wide(df, "N", "V", CHANNELS), "V", "N", list(CHANNELS.values()))
    sums = df.filter("N <> 'other'").selectExpr("G", "upper(N) AS N", "V").groupBy("G", "N").sum("V")
    assert rows(long.select("G", "N", "V")) == rows(sums)


@QUICK
@given(st.lists(st.integers(0, 10**9), unique=True, max_size=50), st.integers(1, 9), st.integers(0, 10**6))
def test_split_is_stable(spark, keys, parts, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    assert rows(with_split(df, ["k"], seed, folds=4)) == rows(with_split(df.repartition(parts), ["k"], seed, folds=4))
