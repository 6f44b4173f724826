"""A mergeable column profile (A4, A6, Q2, Q4 for tables that grow by a day at a time).

``profile_day`` reads one day and returns a row per column: counts, centred moments, extremes, a HyperLogLog sketch of the
values, a KLL sketch of the numbers and, for columns of few different values, the exact count of each. Rows of several days
merge into the row of all days together (``merge_profiles``), so a daily run reads one day and yesterday's profile, not the
history. ``profile_table`` turns profiles into the numbers of a report: exact wherever value counts are held, else from
the sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.columns import columns_of_kind
from cohort_spark.operators.ordered import fused_single_row, value_counts_long

MAX_VALUES = 1000  # columns of at most so many different values keep the exact count of each
LG_K = 14  # HyperLogLog: standard error 0.8%
KLL_K = 1024  # KLL: rank error about 0.3%

SCHEMA = ("column string, numeric boolean, n long, missing long, zeros long, mean double, m2 double, least double, most double, length long, "
          "hll binary, kll binary, counts array<struct<value:string,n:long>>")


def profile_day(df: DataFrame, cols: Sequence[str] | None = None, max_values: int = MAX_VALUES) -> DataFrame:
    """One row per column (``SCHEMA``) of one batch of rows, in two scans: one fused aggregate, and the value counts of the
    columns that its HyperLogLog estimates show to have few values. NaN counts as missing. Tables of any size are reduced to columns x
    (sketch sizes + ``max_values``) on the way."""
    cols = list(cols or df.columns)
    num = set(columns_of_kind(df, "number"))
    present = {c: F.when(~F.isnan(qcol(c).cast("double")), qcol(c)) if c in num else qcol(c) for c in cols}
    exprs = {}
    for i, c in enumerate(cols):
        v = present[c]
        exprs |= {f"n{i}": F.count(v), f"x{i}": F.count_if(v.isNull()), f"h{i}": F.hll_sketch_agg(v.cast("string"), LG_K)}
        if c in num:
            d = v.cast("double")
            exprs |= {f"z{i}": F.count_if(v == 0), f"m{i}": F.avg(d), f"s{i}": F.var_pop(d), f"a{i}": F.min(d), f"b{i}": F.max(d), f"k{i}": F.kll_sketch_agg_double(d, KLL_K)}
        else:
            exprs[f"l{i}"] = F.sum(F.length(v.cast("string")).cast("long"))
    got = fused_single_row(df, exprs)
    spark = df.sparkSession
    rows = []
    for i, c in enumerate(cols):
        n = got[f"n{i}"]
        m2 = got[f"s{i}"] * n if c in num and n else None
        rows.append((c, c in num, n, got[f"x{i}"], got.get(f"z{i}"), got.get(f"m{i}"), m2, got.get(f"a{i}"), got.get(f"b{i}"), got.get(f"l{i}"), got[f"h{i}"], got.get(f"k{i}")))
    base = spark.createDataFrame(rows, SCHEMA.split(", counts")[0])
    est = base.select("column", F.hll_sketch_estimate("hll").alias("e")).collect()  # one row per column
    few = [r["column"] for r in est if (r["e"] or 0) <= 1.1 * max_values + 10]
    if not few:
        return base.withColumn("counts", F.lit(None).cast("array<struct<value:string,n:long>>"))
    counts = (value_counts_long(df.select(*[present[c].alias(c) for c in few]), few, "string").groupBy("column")
              .agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("counts")).where(F.size("counts") <= max_values))
    none = F.when(F.col("column").isin(few) & (F.col("n") == 0), F.array().cast("array<struct<value:string,n:long>>"))
    return base.join(F.broadcast(counts), "column", "left").withColumn("counts", F.coalesce("counts", none))  # one row per column


def merge_profiles(parts: DataFrame, max_values: int = MAX_VALUES) -> DataFrame:
    """Profiles of disjoint batches into the profile of their union, a row per column. Moments merge around the common mean (no
    difference of large sums); a column keeps exact counts while every part has them and the union has few values."""
    w = Window.partitionBy("column")
    mean = F.sum(F.col("mean") * F.col("n")).over(w) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(w)
    p = parts.withColumn("all", mean)
    out = p.groupBy("column", "numeric").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.sum("zeros").alias("zeros"), F.first("all", ignorenulls=True).alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("all")) ** 2).alias("m2"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.sum("length").alias("length"), F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"), F.every(F.col("counts").isNotNull()).alias("exact"))
    counts = (p.select("column", F.explode("counts").alias("c")).groupBy("column", F.col("c.value").alias("value")).agg(F.sum("c.n").alias("n"))
              .groupBy("column").agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("counts")))  # at most parts x max_values values a column
    held = F.coalesce("counts", F.array().cast("array<struct<value:string,n:long>>"))
    return (out.join(counts, "column", "left").withColumn("counts", F.when(F.col("exact") & (F.size(held) <= max_values), held))
            .select(*[x.split()[0] for x in SCHEMA.split(", ")]))


def profile_table(profile: DataFrame) -> DataFrame:
    """``(column, count, missing, zeros, distinct, mean, std, min, q25, median, q75, max, top, avg_length, exact)``: quantiles (linear), distinct count and most
    frequent value (smallest text on ties) are exact where ``exact``, else estimates from the sketches, and ``top`` is NULL."""
    numbers = F.array_sort(F.transform("counts", lambda c: F.struct(c["value"].cast("double").alias("v"), c["n"].alias("n"))))
    ends = F.aggregate("sorted", F.array().cast("array<struct<v:double,e:long>>"),
                       lambda acc, x: F.concat(acc, F.array(F.struct(x["v"].alias("v"), (F.coalesce(F.try_element_at(acc, F.lit(-1))["e"], F.lit(0)) + x["n"]).alias("e")))))

    def quantile(q: float):
        at = F.lit(q) * (F.col("n") - 1)
        value = lambda r: F.try_element_at(F.filter("ends", lambda x: x["e"] > r), F.lit(1))["v"]
        lo, hi = value(F.floor(at)), value(F.ceil(at))
        exact = lo + (at - F.floor(at)) * (hi - lo)
        return F.when(F.col("numeric") & (F.col("n") > 0), F.when(F.col("counts").isNotNull(), exact).otherwise(F.kll_sketch_get_quantile_double("kll", F.lit(q))))

    best = F.array_min(F.transform("counts", lambda c: F.struct((-c["n"]).alias("m"), c["value"].alias("value"))))
    p = profile.withColumn("sorted", F.when(F.col("numeric"), numbers)).withColumn("ends", F.when(F.col("sorted").isNotNull(), ends))
    return p.select("column", F.col("n").alias("count"), "missing", "zeros", F.when(F.col("counts").isNotNull(), F.size("counts").cast("long")).otherwise(F.hll_sketch_estimate("hll")).alias("distinct"),
                    "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"), F.col("least").alias("min"),
                    quantile(0.25).alias("q25"), quantile(0.5).alias("median"), quantile(0.75).alias("q75"), F.col("most").alias("max"), best["value"].alias("top"),
                    F.when(~F.col("numeric") & (F.col("n") > 0), F.col("length") / F.col("n")).alias("avg_length"), F.col("counts").isNotNull().alias("exact"))


def update_profile(df: DataFrame, path: str, day: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Write the profile of one day's rows under ``path`` (a day that is run again replaces itself) and return the merged
    profile of all days written so far."""
    spark = df.sparkSession
    (profile_day(df, cols).withColumn("day", F.lit(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))
    return merge_profiles(spark.read.schema(SCHEMA + ", day string").parquet(path).drop("day"))
