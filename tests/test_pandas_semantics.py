"""Statistics against the pandas / NumPy semantics the reference relies on (random data with gaps)."""

import numpy as np
import pandas as pd
import pytest

from cohort_spark.functions.scalar import cut_labels
from cohort_spark.operators import encode as E
from cohort_spark.operators import stats as A
from cohort_spark.operators.sample import AGE_EDGES, AGE_LABELS


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(11)
    n = 500
    pdf = pd.DataFrame({
        "a": np.where(rng.random(n) < 0.1, np.nan, np.round(rng.normal(50, 10, n), 1)),
        "b": np.where(rng.random(n) < 0.3, np.nan, rng.integers(0, 5, n).astype(float)),
        "c": np.round(rng.exponential(3, n), 2),
        "s": rng.choice(["x", "y", "z", None], n, p=[0.5, 0.3, 0.15, 0.05]),
    })
    rows = [tuple(None if (isinstance(v, float) and np.isnan(v)) else v for v in r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(rows, "a double, b double, c double, s string")


def test_describe_median_mode(frames):
    pdf, df = frames
    got = {r["column"]: r for r in A.describe_stats(df, ["a", "b", "c"]).collect()}
    d = pdf[["a", "b", "c"]].describe()
    for c in ("a", "b", "c"):
        assert got[c]["count"] == d[c]["count"]
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"),
                             ("q75", "75%"), ("max", "max")):
            assert got[c][mine] == pytest.approx(d[c][theirs])
        assert got[c]["median"] == pytest.approx(pdf[c].median())
        assert got[c]["mode"] == pytest.approx(pdf[c].mode()[0])


def test_value_counts_and_missing(frames):
    pdf, df = frames
    got = {r.s: (r["count"], r.share) for r in A.value_counts(df, "s").collect()}
    vc, share = pdf["s"].value_counts(), pdf["s"].value_counts(normalize=True)
    assert {k: v[0] for k, v in got.items()} == vc.to_dict()
    assert all(got[k][1] == pytest.approx(share[k]) for k in got)
    assert {r["column"]: r.n_missing for r in A.missing_counts(df).collect()} == pdf.isna().sum().to_dict()


def test_cut_right_open(spark):
    ages = [0, 49.9, 50, 59, 60, 79.99, 80, 99, 100, -1, None]
    df = spark.createDataFrame([(a if a is None else float(a),) for a in ages], "age double")
    got = [r.g for r in df.select(cut_labels("age", AGE_EDGES, AGE_LABELS).alias("g")).collect()]
    want = pd.cut(pd.Series(ages, dtype=float), bins=list(AGE_EDGES), labels=list(AGE_LABELS), right=False)
    assert got == [None if pd.isna(w) else str(w) for w in want]


def test_get_dummies_drop_first(frames):
    pdf, df = frames
    got = E.get_dummies(df.select("s"))
    want = pd.get_dummies(pdf[["s"]], columns=["s"], drop_first=True)
    assert got.columns == list(want.columns)
    assert [tuple(r) for r in got.collect()] == [tuple(bool(v) for v in r) for r in want.itertuples(index=False)]


def test_pairwise_correlation(frames):
    pdf, df = frames
    got = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df, ["a", "b", "c"]).collect()}
    want = pdf[["a", "b", "c"]].corr()
    for (x, y), v in got.items():
        assert v == pytest.approx(want.loc[x, y])


def test_histogram_matches_numpy(frames):
    pdf, df = frames
    got = sorted((r.bin, r.lower, r["count"]) for r in A.histogram(df, "c", 20).collect())
    counts, edges = np.histogram(pdf["c"].dropna(), bins=20)
    assert [g[2] for g in got] == list(counts)
    assert [g[1] for g in got] == pytest.approx(list(edges[:-1]))


def _col(df, c):
    return np.array([np.nan if r[0] is None else r[0] for r in df.select(c).collect()], dtype=float)


def test_zscore_and_iqr_median(frames):
    from cohort_spark.operators import outliers as O

    pdf, df = frames
    x = pdf["a"].to_numpy(dtype=float)
    z = np.abs((x - np.nanmean(x)) / np.nanstd(x))  # population std, gaps omitted
    want = np.where(z < 1.5, x, np.nanmedian(x))
    got = _col(O.outlier_zscore_median(df, ["a"], 1.5), "a")
    assert got == pytest.approx(want)
    q1, q3 = np.nanpercentile(x, 25), np.nanpercentile(x, 75)
    keep = (x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))
    got2 = _col(O.outlier_iqr_median(df, ["a"]), "a")
    assert got2 == pytest.approx(np.where(keep, x, np.nanmedian(x)))


def test_low_missing_and_mean_mode(frames):
    from cohort_spark.operators import missing as M

    pdf, df = frames
    out = M.impute_low_missing(df, ["b", "s"], ["a", "c"], t=0.2)  # a (10 % gaps) and s (5 %) are filled
    assert _col(out, "a") == pytest.approx(pdf["a"].fillna(pdf["a"].median()).to_numpy())
    assert [r.s for r in out.select("s").collect()] == pdf["s"].fillna(pdf["s"].mode()[0]).tolist()
    assert out.where("b IS NULL").count() == int(pdf["b"].isna().sum())  # 30 % gaps: left alone
    mm = M.impute_mean_mode(df)
    for c in ("a", "b"):
        assert _col(mm, c) == pytest.approx(pdf[c].fillna(int(pdf[c].mean())).to_numpy())


def test_standard_scale_population(frames):
    pdf, df = frames
    got = _col(E.standard_scale(df, ["c"]), "c")
    x = pdf["c"].to_numpy(dtype=float)
    assert got == pytest.approx((x - x.mean()) / x.std())


def test_fairness_auc_ks_brute_force(spark):
    from cohort_spark.operators import drift as C
    from cohort_spark.operators import fairness as B
    from cohort_spark.operators import metrics as V

    rng = np.random.default_rng(4)
    n = 400
    pdf = pd.DataFrame({"y": rng.integers(0, 2, n), "p": rng.integers(0, 2, n), "g": rng.choice(list("abc"), n),
                        "s": np.round(rng.random(n), 2)})
    df = spark.createDataFrame(pdf)
    sel = pdf.groupby("g")["p"].mean()
    assert B.demographic_parity_difference(df, "p", "g").collect()[0][0] == pytest.approx(sel.max() - sel.min())
    tpr = pdf[pdf.y == 1].groupby("g")["p"].mean()
    fpr = pdf[pdf.y == 0].groupby("g")["p"].mean()
    want_eo = max(tpr.max() - tpr.min(), fpr.max() - fpr.min())
    assert B.equalized_odds_difference(df, "y", "p", "g").collect()[0][0] == pytest.approx(want_eo)
    pos, neg = pdf.s[pdf.y == 1].to_numpy(), pdf.s[pdf.y == 0].to_numpy()
    pair = ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()
    got = {r["class"]: r.auc for r in V.roc_auc_ovr(df, "y", {1: "s"}).collect()}
    assert got["1"] == pytest.approx(pair)
    a, b = df.where("g = 'a'"), df.where("g <> 'a'")
    xa, xb = np.sort(pdf.s[pdf.g == "a"]), np.sort(pdf.s[pdf.g != "a"])
    grid = np.union1d(xa, xb)
    d = np.max(np.abs(np.searchsorted(xa, grid, "right") / len(xa) - np.searchsorted(xb, grid, "right") / len(xb)))
    assert C.ks_drift(a, b, ["s"]).collect()[0].statistic == pytest.approx(d)


def test_distinct_values_limit(frames):
    pdf, df = frames
    got = {(r["column"], r.value) for r in A.distinct_values(df, limit=5).collect()}
    assert {c for c, _ in got} == {"b", "s"}
    assert {v for c, v in got if c == "s"} == set(pdf["s"].dropna())


def test_wide_correlation_one_pass_matches_pandas(spark):
    rng = np.random.default_rng(9)
    n, p = 300, 16
    base = rng.normal(size=(n, p)) * 50 + 1000
    base[:, 1] = base[:, 0] * 2 + rng.normal(size=n)
    base[rng.random((n, p)) < 0.15] = np.nan
    pdf = pd.DataFrame(base, columns=[f"v{i}" for i in range(p)])
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in base]
    df = spark.createDataFrame(rows, ", ".join(f"v{i} double" for i in range(p))).repartition(5)
    got = {(r.col_a, r.col_b): r.corr for r in A.correlation_matrix(df).collect()}  # 136 pairs > batch
    want = pdf.corr()
    assert len(got) == p * p
    for (a, b), v in got.items():
        assert v == pytest.approx(want.loc[a, b], abs=1e-9)


def test_histograms_many_columns(frames):
    pdf, df = frames
    got = A.histograms(df, ["a", "b", "c"], 10).collect()
    for c in ("a", "b", "c"):
        counts, edges = np.histogram(pdf[c].dropna(), bins=10)
        mine = sorted((r.bin, r.lower, r["count"]) for r in got if r["column"] == c)
        assert [m[2] for m in mine] == list(counts)
        assert [m[1] for m in mine] == pytest.approx(list(edges[:-1]))


def test_describe_approx_close_to_exact(frames):
    pdf, df = frames
    got = {r["column"]: r for r in A.describe_stats(df, ["a", "c"], exact=False).collect()}
    for c in ("a", "c"):
        assert got[c]["mean"] == pytest.approx(pdf[c].mean())
        x = pdf[c].dropna().sort_values().to_numpy()
        for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
            r = np.searchsorted(x, got[c][n])  # rank of the returned value
            assert abs(r / len(x) - q) < 0.02
