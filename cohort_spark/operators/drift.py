"""Drift between a reference and a current table.

Distribution comparisons run on distinct-value counts of both tables: the
Kolmogorov–Smirnov statistic from distributed running sums, chi-square,
Cramér's V, PSI and Jensen–Shannon from a full outer join of the two frequency
tables, Wasserstein distance from consecutive distinct values joined by rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.operators.columns import columns_of_kind
from cohort_spark.operators.ordered import carried_sums, range_sorted, unpivot_values

KS_TERMS = 20  # either series below is exact to double precision with far fewer


def kolmogorov_sf(lam: Column) -> Column:
    """Asymptotic two-sided p-value. From λ = 1 on the alternating series Σ 2(−1)^(k−1) exp(−2k²λ²); below
    it its theta transform 1 − √(2π)/λ Σ exp(−(2k−1)²π²/(8λ²)), as the former converges too slowly there."""
    ks = F.sequence(F.lit(1), F.lit(KS_TERMS))
    far = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + 2.0 * F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    near = F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + F.exp(-((2 * k - 1) * (2 * k - 1)) * (math.pi ** 2 / 8) / (lam * lam)))
    p = F.when(lam >= 1, far).when(lam > 0, 1.0 - F.lit(math.sqrt(2 * math.pi)) / lam * near).when(lam <= 0, F.lit(1.0))
    return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


EXACT_UP_TO = 10_000  # rows on either side; larger samples take the asymptotic p-value


def exact_ks_p(n_a: int, n_b: int, statistic: float) -> float:
    """Exact two-sided p-value of the two-sample statistic: the chance that a random order of the two samples strays as far.

    Drawing the pooled values in order is a walk over (taken of a, taken of b) that takes the next value from a sample with
    the share it has of those left. The walk is followed step by step; what reaches a point as far from the diagonal as the
    statistic is absorbed, and the absorbed mass is the p-value. Tied values count as for samples without ties, which makes
    it conservative. Work: (n_a + n_b) vector steps.
    """
    import numpy as np

    g = math.gcd(n_a, n_b)
    far = round(statistic * n_a * n_b / g)  # the statistic is a multiple of this fraction
    if far <= 0:
        return 1.0
    at = np.arange(n_a + 1)
    mass, absorbed, left = np.zeros(n_a + 1), 0.0, n_a + n_b
    mass[0] = 1.0
    for taken in range(n_a + n_b):
        from_a = mass * (n_a - at) / left
        mass = mass * (n_b - (taken - at)) / left
        mass[1:] += from_a[:-1]
        gone = abs(at * (n_b // g) - (taken + 1 - at) * (n_a // g)) >= far
        absorbed += mass[gone].sum()
        mass[gone] = 0.0
        left -= 1
    return float(min(1.0, absorbed))


def _exact_p(n_a: Column, n_b: Column, statistic: Column, up_to: int) -> Column:
    """The exact p-value of each row of a small result, where both samples have at most ``up_to`` rows."""
    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([exact_ks_p(int(x), int(y), float(z)) if 0 < x <= up_to and 0 < y <= up_to and z == z else None for x, y, z in zip(a, b, d)], dtype="float64")

    return p(n_a, n_b, statistic)


def _two_sample_counts(a: DataFrame, b: DataFrame, cols: Sequence[str], value_type: str) -> DataFrame:
    la = unpivot_values(a, cols, value_type).withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0))
    lb = unpivot_values(b, cols, value_type).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    return la.unionByName(lb).groupBy("column", "value").agg(F.sum("_a").alias("na"), F.sum("_b").alias("nb"))


def ks_drift(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None, alpha: float = 0.05, exact_up_to: int = EXACT_UP_TO) -> DataFrame:
    """Two-sample KS statistic and p-value per numeric column; ``drift`` when p < alpha. The p-value is exact
    (:func:`exact_ks_p`) where both samples have at most ``exact_up_to`` rows, else asymptotic.
    Missing values are dropped; a column without values on one side has a NULL statistic, p-value and flag."""
    cols = list(cols or [c for c in columns_of_kind(a, "number") if c in b.columns])
    counts = _two_sample_counts(a, b, cols, "double")
    ranged = range_sorted(counts, ["column"], ["value"])
    cum = carried_sums(ranged, ["column"], ["na", "nb"])
    tot = ranged.groupBy("column").agg(F.sum("na").alias("tot_a"), F.sum("nb").alias("tot_b"))
    d = (cum.join(F.broadcast(tot), "column")  # one row per column
         .groupBy("column", "tot_a", "tot_b")
         .agg(F.max(F.abs(F.try_divide("cum_na", "tot_a") - F.try_divide("cum_nb", "tot_b"))).alias("statistic")))
    en = F.sqrt(F.try_divide(F.col("tot_a") * F.col("tot_b"), F.col("tot_a") + F.col("tot_b")))
    p = kolmogorov_sf(en * F.col("statistic"))
    if exact_up_to:
        small = (F.col("tot_a") <= exact_up_to) & (F.col("tot_b") <= exact_up_to)
        p = F.when(small, _exact_p(F.coalesce("tot_a", F.lit(0)), F.coalesce("tot_b", F.lit(0)), F.coalesce("statistic", F.lit(float("nan"))), exact_up_to)).otherwise(p)
        p = F.when(F.col("statistic").isNotNull(), p)
    return d.select("column", "statistic", p.alias("p_value"),
                    F.col("tot_a").cast("bigint").alias("n_a"), F.col("tot_b").cast("bigint").alias("n_b")).withColumn(
        "drift", F.col("p_value") < alpha)


def _freq_pairs(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, na, nb, Na, Nb)`` over the union of observed values."""
    counts = _two_sample_counts(a, b, cols, "string")
    tot = counts.groupBy("column").agg(F.sum("na").alias("tot_a"), F.sum("nb").alias("tot_b"), F.count(F.lit(1)).alias("r"))
    return counts.join(F.broadcast(tot), "column")  # one row per column


def _chi2_statistic(fp: DataFrame) -> DataFrame:
    """``(column, statistic, dof)`` of the 2 × r count table given by :func:`_freq_pairs`."""
    n = F.col("tot_a") + F.col("tot_b")
    ea = (F.col("na") + F.col("nb")) * F.col("tot_a") / n
    eb = (F.col("na") + F.col("nb")) * F.col("tot_b") / n
    stat = fp.groupBy("column", "r").agg(
        F.sum(F.try_divide((F.col("na") - ea) ** 2, ea) + F.try_divide((F.col("nb") - eb) ** 2, eb)).alias("statistic"))
    return stat.select("column", "statistic", (F.col("r") - 1).cast("bigint").alias("dof"))


def chi2_sf(x: float, k: int) -> float:
    """Upper tail of the chi-square distribution (regularised upper incomplete gamma Q(k/2, x/2))."""
    if x is None or k <= 0:
        return float("nan")
    a, z = k / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    gln = math.lgamma(a)
    if z < a + 1:
        term = total = 1.0 / a
        ap = a
        for _ in range(1000):
            ap += 1
            term *= z / ap
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - gln))
    b = z + 1 - a
    c = 1 / 1e-300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - gln) * h


def chi2_drift(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None, alpha: float = 0.05,
               with_p: bool = True) -> DataFrame:
    """Chi-square test of homogeneity per text column on the 2 × r table of **counts**
    (statistic, degrees of freedom, p-value, drift when p < alpha)."""
    cols = list(cols or [c for c in columns_of_kind(a, "string") if c in b.columns])
    out = _chi2_statistic(_freq_pairs(a, b, cols))
    if not with_p:
        return out
    rows = out.collect()  # one row per column
    spark = a.sparkSession
    return spark.createDataFrame(
        [(r["column"], r["statistic"], r["dof"], chi2_sf(r["statistic"], int(r["dof"])),
          chi2_sf(r["statistic"], int(r["dof"])) < alpha) for r in rows],
        "column string, statistic double, dof bigint, p_value double, drift boolean")


def feature_drift_score(a: DataFrame, b: DataFrame, num_cols: Sequence[str] | None = None,
                        cat_cols: Sequence[str] | None = None, eps: float = 1e-4) -> DataFrame:
    """C4: ``(column, method, score)``: KS statistic for numeric columns; Cramér's V and
    population stability index (shares floored at ``eps``) for text columns."""
    num = list(num_cols if num_cols is not None else [c for c in columns_of_kind(a, "number") if c in b.columns])
    cat = list(cat_cols if cat_cols is not None else [c for c in columns_of_kind(a, "string") if c in b.columns])
    parts = []
    if num:
        parts.append(ks_drift(a, b, num, exact_up_to=0).select("column", F.lit("ks").alias("method"), F.col("statistic").alias("score")))
    if cat:
        tot = _freq_pairs(a, b, cat)  # one frequency table for chi-square, Cramér's V and PSI
        st = _chi2_statistic(tot)
        nn = tot.groupBy("column").agg(F.first(F.col("tot_a") + F.col("tot_b")).alias("N"), F.first("r").alias("r"))
        v = st.join(nn, "column").select(
            "column", F.lit("cramer_v").alias("method"),
            F.when(F.col("statistic").isNotNull(), F.when(F.col("r") > 1, F.sqrt(F.col("statistic") / F.col("N"))).otherwise(F.lit(0.0))).alias("score"))
        pa = F.greatest(F.try_divide("na", "tot_a"), F.lit(eps))
        pb = F.greatest(F.try_divide("nb", "tot_b"), F.lit(eps))
        both = (F.col("tot_a") > 0) & (F.col("tot_b") > 0)
        psi = tot.groupBy("column").agg(F.sum(F.when(both, (pb - pa) * F.log(pb / pa))).alias("score")).select(
            "column", F.lit("psi").alias("method"), "score")
        parts += [v, psi]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def wasserstein(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, wasserstein)``: ∫|F_a − F_b| over consecutive distinct values (no global window)."""
    ranged = range_sorted(_two_sample_counts(a, b, cols, "double"), ["column"], ["value"])
    tot = ranged.groupBy("column").agg(F.sum("na").alias("tot_a"), F.sum("nb").alias("tot_b"))
    cum = carried_sums(ranged, ["column"], ["na", "nb"], lead=["value"]).join(F.broadcast(tot), "column")  # one row per column
    gap = F.abs(F.try_divide("cum_na", "tot_a") - F.try_divide("cum_nb", "tot_b"))
    return (cum.where("next_value is not null").groupBy("column")
            .agg(F.sum(gap * (F.col("next_value") - F.col("value"))).alias("wasserstein")))


def jensen_shannon(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, jensen_shannon)``: JS distance (base 2) between the two frequency tables."""
    fp = _freq_pairs(a, b, cols)
    pa, pb = F.try_divide("na", "tot_a"), F.try_divide("nb", "tot_b")
    m = (pa + pb) / 2

    def kl(p):
        return F.when(p > 0, p * F.log2(p / m)).when((p <= 0) & m.isNotNull(), F.lit(0.0))

    return fp.groupBy("column").agg(F.sqrt(F.sum(kl(pa) + kl(pb)) / 2).alias("jensen_shannon"))


def drift_report(ref: DataFrame, cur: DataFrame, alpha: float = 0.05, share: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Per column test, statistic, p-value, drift flag and distance (normalised Wasserstein for
    numeric, Jensen–Shannon for text); and a one-row summary with the share of drifted columns
    and ``dataset_drift`` when that share reaches ``share``."""
    num = [c for c in columns_of_kind(ref, "number") if c in cur.columns]
    cat = [c for c in columns_of_kind(ref, "string") if c in cur.columns]
    parts = []
    if num:
        ks = ks_drift(ref, cur, num, alpha)
        sd = unpivot_values(ref, num).groupBy("column").agg(F.stddev_samp("value").alias("_sd"))
        w = wasserstein(ref, cur, num).join(sd, "column").select(
            "column", (F.col("wasserstein") / F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0)).alias("distance"))
        parts.append(ks.join(w, "column", "left").select("column", F.lit("ks").alias("test"), "statistic", "p_value",
                                                          "drift", "distance"))
    if cat:
        ch = chi2_drift(ref, cur, cat, alpha)
        js = jensen_shannon(ref, cur, cat).withColumnRenamed("jensen_shannon", "distance")
        parts.append(ch.join(js, "column", "left").select("column", F.lit("chi2").alias("test"), "statistic", "p_value",
                                                           "drift", "distance"))
    per = parts[0]
    for p in parts[1:]:
        per = per.unionByName(p)
    summary = per.agg(F.count(F.lit(1)).alias("n_columns"), F.sum(F.col("drift").cast("int")).alias("n_drifted")) \
        .withColumn("share_drifted", F.col("n_drifted") / F.col("n_columns")) \
        .withColumn("dataset_drift", F.col("share_drifted") >= share)
    return per, summary


def compare_distributions(a: DataFrame, b: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """The numbers behind overlaid histograms (numeric: ``bins`` equal-width bins of each
    table over its own range) or bar charts (text: shares per value, missing side 0)."""
    from cohort_spark.operators.joins import freq_outer_join
    from cohort_spark.operators.stats import histogram

    if col in columns_of_kind(a, "number"):
        ha = histogram(a, col, bins).withColumn("dataset", F.lit("a"))
        hb = histogram(b, col, bins).withColumn("dataset", F.lit("b"))
        return ha.unionByName(hb).select("dataset", "bin", "lower", "upper", "count")
    return freq_outer_join(a, b, col)
