"""Property tests: distributed ranks, running sums and quantiles equal single-process results
for arbitrary data and partition counts."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohort_spark.operators.ordered import cumulative_sums, exact_quantiles, global_rank

values = st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=120)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, parts=st.integers(min_value=1, max_value=7))
def test_rank_is_a_permutation_in_order(spark, xs, parts):
    df = spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "x long, i long")
    got = [(r.x, r.i) for r in global_rank(df, ["x", "i"], "_r", partitions=parts).orderBy("_r").collect()]
    assert got == sorted((x, i) for i, x in enumerate(xs))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, parts=st.integers(min_value=1, max_value=7))
def test_running_sums(spark, xs, parts):
    df = spark.createDataFrame([(i % 3, i, float(x)) for i, x in enumerate(xs)], "g long, o long, v double")
    got = {(r.g, r.o): r.cum_v for r in cumulative_sums(df, ["g"], ["o"], ["v"], partitions=parts).collect()}
    acc = {}
    for i, x in enumerate(xs):
        acc[i % 3] = acc.get(i % 3, 0.0) + x
        assert got[(i % 3, i)] == pytest.approx(acc[i % 3])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, q=st.floats(min_value=0.0, max_value=1.0), parts=st.integers(min_value=1, max_value=7))
def test_quantile(spark, xs, q, parts):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = exact_quantiles(df, ["x"], [q], partitions=parts).collect()[0].value
    assert got == pytest.approx(float(np.percentile(np.array(xs, dtype=float), q * 100)), abs=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=1, max_value=300), test=st.floats(min_value=0.05, max_value=0.95),
       parts=st.integers(min_value=1, max_value=6))
def test_split_sizes_exact(spark, n, test, parts):
    import math

    from cohort_spark.operators.sample import split_column

    df = spark.range(n).withColumnRenamed("id", "k").repartition(parts)
    got = split_column(df, "k", test, 42).where("split = 'test'").count()
    assert got == math.ceil(n * test)


rows_st = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 9)), st.integers(0, 3)),
                   min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_earliest_per_key_matches_pandas(spark, rows):
    import pandas as pd

    from cohort_spark.operators.dedup import earliest_per_key

    data = [(k, d, t, i) for i, (k, d, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, d long, t long, i long")
    got = sorted(tuple(r) for r in earliest_per_key(df, "k", "d", ["t", "i"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "d", "t", "i"])
    want = (pdf.sort_values(["k", "d", "t", "i"], na_position="last").drop_duplicates("k", keep="first"))
    want = sorted((int(k), None if pd.isna(d) else int(d), int(t), int(i))
                  for k, d, t, i in want.itertuples(index=False))
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_keep_none_matches_pandas(spark, rows):
    import pandas as pd

    from cohort_spark.operators.dedup import analyze_duplicates, handle_duplicates

    df = spark.createDataFrame(rows, "k long, d long, t long")
    pdf = pd.DataFrame(rows, columns=["k", "d", "t"])
    for subset in (["k"], ["k", "d"], None):
        mask = pdf.duplicated(subset=subset, keep=False)
        assert handle_duplicates(df, subset, keep=False).count() == int((~mask).sum())
        assert analyze_duplicates(df, subset).count() == int(mask.sum())
        assert handle_duplicates(df, subset, keep="first").count() == int((~pdf.duplicated(subset=subset)).sum())
