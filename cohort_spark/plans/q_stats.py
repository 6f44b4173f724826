"""Queries for statistics, data quality, scalar functions, missing values, outliers and encoding.

Missing values are injected by key, identically in Spark and SQL (the test
tables have none): see :func:`lineitem_nulls` / ``LI_NULLS``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark import functions as FN
from cohort_spark.operators import encode as E
from cohort_spark.operators import missing as M
from cohort_spark.operators import outliers as O
from cohort_spark.operators import profile as PR
from cohort_spark.operators import stats as A
from cohort_spark.plans.registry import query, tb


def lineitem_nulls(spark, sf, void: bool = False):
    li = tb(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    cols = [
        "l_orderkey", "l_linenumber",
        F.when(k % 29 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(k % 11 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(k % 7 != 0, F.col("l_discount")).alias("l_discount"),
        F.when(k % 3 == 0, F.col("l_tax")).alias("l_tax"),
        F.when(k % 31 != 0, F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus"]
    if void:
        cols.append(F.lit(None).cast("double").alias("l_void"))
    return li.select(*cols)


LI_NULLS = """(SELECT l_orderkey, l_linenumber,
 CASE WHEN l_orderkey % 29 <> 0 THEN l_quantity END AS l_quantity,
 CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice END AS l_extendedprice,
 CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS l_discount,
 CASE WHEN l_orderkey % 3 = 0 THEN l_tax END AS l_tax,
 CASE WHEN l_orderkey % 31 <> 0 THEN l_returnflag END AS l_returnflag,
 l_linestatus FROM lineitem)"""
LI_NULL_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                "l_linestatus"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(parts):
    return "\nUNION ALL ".join(parts)


def _mode_sql(col, src):
    return (f"(SELECT v FROM (SELECT {col} AS v, count(*) AS c FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}) "
            f"ORDER BY c DESC, v LIMIT 1)")


# ------------------------------------------------------------------ aggregations

@query("group_min", "SELECT o_custkey, min(o_orderdate) AS min_o_orderdate FROM orders GROUP BY o_custkey")
def q_group_min(spark, sf):
    return A.group_min(tb(spark, sf, "orders"), "o_custkey", "o_orderdate")


@query("missing_counts", _union(
    [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM {LI_NULLS}" for c in LI_NULL_COLS]))
def q_missing_counts(spark, sf):
    return A.missing_counts(lineitem_nulls(spark, sf))


@query("missing_ratio", _union(
    [f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_ratio FROM {LI_NULLS}"
     for c in LI_NULL_COLS]))
def q_missing_ratio(spark, sf):
    return A.missing_ratio(lineitem_nulls(spark, sf))


_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("distinct_counts", _union(
    [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in _LI_ALL]))
def q_distinct_counts(spark, sf):
    return A.distinct_counts(tb(spark, sf, "lineitem"))


@query("distinct_values", _union([f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM orders WHERE {c} IS NOT NULL"
                                  for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "cents", "day")])
       .replace("FROM orders", "FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders)"))
def q_distinct_values(spark, sf):
    """Every column of the table; prices in cents and dates as days, whose text is the same in any engine."""
    o = tb(spark, sf, "orders")
    return A.distinct_values(o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
                                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")))


@query("describe_stats", _union([f"""SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean,
 stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25,
 quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max,
 quantile_cont({c}, 0.5) AS median, {_mode_sql(c, LI_NULLS)} AS mode FROM {LI_NULLS}""" for c in LI_NUM]))
def q_describe_stats(spark, sf):
    return A.describe_stats(lineitem_nulls(spark, sf), LI_NUM)


@query("value_counts", """SELECT o_orderpriority, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def q_value_counts(spark, sf):
    return A.value_counts(tb(spark, sf, "orders"), "o_orderpriority")


def corr_frame(spark, sf):
    li = tb(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    price = F.when(k % 11 != 0, F.col("l_extendedprice"))
    return li.select(F.when(k % 29 != 0, F.col("l_quantity")).alias("l_quantity"), price.alias("l_extendedprice"),
                     F.when(k % 7 != 0, F.col("l_discount")).alias("l_discount"),
                     (price * (1 + F.col("l_tax"))).alias("l_gross"))


CORR_SRC = """(SELECT CASE WHEN l_orderkey % 29 <> 0 THEN l_quantity END AS l_quantity,
 CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice END AS l_extendedprice,
 CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS l_discount,
 (CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice END) * (1 + l_tax) AS l_gross FROM lineitem)"""
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_gross"]


@query("correlation_matrix", _union(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM {CORR_SRC}"
     for a in CORR_COLS for b in CORR_COLS]))
def q_correlation_matrix(spark, sf):
    return A.correlation_matrix(corr_frame(spark, sf), CORR_COLS)


@query("correlated_columns", "SELECT * FROM (" + _union(
    [f"SELECT '{b}' AS \"column\", '{a}' AS correlated_with, corr({a}, {b}) AS corr FROM {CORR_SRC}"
     for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]) + ") WHERE abs(corr) > 0.9")
def q_correlated_columns(spark, sf):
    return A.correlated_columns(corr_frame(spark, sf), CORR_COLS, 0.9)


def _hist_sql(src, col, bins, where="TRUE", extra_cols=""):
    return f"""(WITH r AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src} WHERE {where}),
 b AS (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor(({col} - r.lo) / (r.hi - r.lo) * {bins}), {bins - 1}) END AS INTEGER) AS bin
       FROM {src}, r WHERE {where} AND {col} IS NOT NULL),
 c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
 SELECT {extra_cols} g.bin, r.lo + (r.hi - r.lo) * g.bin / {bins} AS lower, r.lo + (r.hi - r.lo) * (g.bin + 1) / {bins} AS upper,
        coalesce(c.n, 0) AS count
 FROM (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin)"""


@query("histogram", "SELECT * FROM " + _hist_sql("customer", "c_acctbal", 20))
def q_histogram(spark, sf):
    return A.histogram(tb(spark, sf, "customer"), "c_acctbal", 20)


BOX_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("box_stats", _union([f"""SELECT '{c}' AS "column", q1, median, q3, q3 - q1 AS iqr,
 (SELECT min({c}) FROM {LI_NULLS} WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
 (SELECT max({c}) FROM {LI_NULLS} WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
 (SELECT count(*) FROM {LI_NULLS} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
 FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3
       FROM {LI_NULLS})""" for c in BOX_COLS]))
def q_box_stats(spark, sf):
    return A.box_stats(lineitem_nulls(spark, sf), BOX_COLS)


@query("group_accuracy", """SELECT d.lang, count(*) AS n, avg(CASE WHEN l.quality = l.toxic THEN 1.0 ELSE 0.0 END) AS accuracy
FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY d.lang""")
def q_group_accuracy(spark, sf):
    j = tb(spark, sf, "labels").join(tb(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return A.group_accuracy(j, "lang", "quality", "toxic")


# ------------------------------------------------------------------ data quality (Q1-Q4)

_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("validate_table", """
SELECT 'non_empty' AS "check", count(*) > 0 AS passed, 'rows=' || count(*) || ' columns=5' AS detail FROM customer
UNION ALL SELECT 'columns_present', false, 'missing: c_phone'
UNION ALL SELECT 'no_missing_values', count(*) = count(c_custkey) AND count(*) = count(c_name) AND count(*) = count(c_nationkey)
   AND count(*) = count(c_acctbal) AND count(*) = count(c_mktsegment),
 CASE WHEN count(*) = count(c_custkey) AND count(*) = count(c_name) AND count(*) = count(c_nationkey)
   AND count(*) = count(c_acctbal) AND count(*) = count(c_mktsegment) THEN '' ELSE 'with missing: ' || concat_ws(',',
   CASE WHEN count(*) > count(c_custkey) THEN 'c_custkey' END, CASE WHEN count(*) > count(c_name) THEN 'c_name' END,
   CASE WHEN count(*) > count(c_nationkey) THEN 'c_nationkey' END, CASE WHEN count(*) > count(c_acctbal) THEN 'c_acctbal' END,
   CASE WHEN count(*) > count(c_mktsegment) THEN 'c_mktsegment' END) END
FROM customer""")
def q_validate_table(spark, sf):
    return A.validate_table(tb(spark, sf, "customer"), ["c_custkey", "c_name", "c_phone"])


def _colstat_sql(c, num):
    if num:
        stats = (f"count({c}) AS count, count(*) - count({c}) AS missing, CAST(count_if({c} = 0) AS BIGINT) AS zeros, "
                 f"count(DISTINCT {c}) AS distinct, avg({c}) AS mean, stddev_samp({c}) AS std, "
                 f"CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.5) AS median, CAST(max({c}) AS DOUBLE) AS max, ")
        avg_len = "NULL::DOUBLE AS avg_length"
    else:
        stats = (f"count({c}) AS count, count(*) - count({c}) AS missing, NULL::BIGINT AS zeros, "
                 f"count(DISTINCT {c}) AS distinct, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, "
                 f"NULL::DOUBLE AS median, NULL::DOUBLE AS max, ")
        avg_len = f"avg(length({c})) AS avg_length"
    top = _mode_sql(f"CAST({c} AS VARCHAR)", "customer")
    return f"SELECT '{c}' AS \"column\", {stats}{top} AS top, {avg_len} FROM customer"


@query("column_statistics", _union([_colstat_sql(c, c in ("c_custkey", "c_nationkey", "c_acctbal")) for c in _CUST]))
def q_column_statistics(spark, sf):
    return A.column_statistics(tb(spark, sf, "customer"))


_ORD_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
              ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("infer_schema_constraints", _union([
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) = count({c}) AS required,
 {f"CASE WHEN count(DISTINCT {c}) <= 20 THEN list_sort(list(DISTINCT {c})) END" if t == "string" else "NULL::VARCHAR[]"} AS domain
 FROM orders""" for c, t in _ORD_TYPES]))
def q_infer_schema_constraints(spark, sf):
    return A.infer_schema_constraints(tb(spark, sf, "orders"))


@query("profile_report", f"""SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_columns,
 {" + ".join(f"(count(*) - count({c}))" for c in LI_NULL_COLS)} AS n_missing_cells,
 ({" + ".join(f"(count(*) - count({c}))" for c in LI_NULL_COLS)}) / (count(*) * 8) AS missing_cell_share,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {LI_NULLS})) AS n_duplicates
FROM {LI_NULLS}""")
def q_profile_report(spark, sf):
    return A.profile_report(lineitem_nulls(spark, sf))["overview"]


PROFILE_NUM, PROFILE_TEXT = ("l_quantity", "l_discount", "l_tax", "l_extendedprice"), ("l_returnflag", "l_linestatus")


def _profile_sql(c: str) -> str:
    num, few = c in PROFILE_NUM, c != "l_extendedprice"
    q = lambda p: f"quantile_cont({c}, {p})" if num and few else "NULL::DOUBLE"
    n = lambda e: e if num else "NULL::DOUBLE"
    return f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS missing, {f"count(*) FILTER ({c} = 0)" if num else "NULL::BIGINT"} AS zeros,
 {f"count(DISTINCT {c})" if few else "NULL::BIGINT"} AS "distinct", {n(f"avg({c})")} AS mean, {n(f"stddev_samp({c})")} AS std, {n(f"min({c})")} AS min, {q(0.25)} AS q25, {q(0.5)} AS median,
 {q(0.75)} AS q75, {n(f"max({c})")} AS max, {f"(SELECT {c} FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" if not num else "NULL::VARCHAR"} AS top,
 {f"avg(length({c}))" if not num else "NULL::DOUBLE"} AS avg_length, {str(few).lower()} AS exact FROM lineitem"""


@query("profile_merge", _union([_profile_sql(c) for c in (*PROFILE_NUM, *PROFILE_TEXT)]))
def q_profile_merge(spark, sf):
    """Three batches profiled apart and merged; estimates (and the text of a number) are left out of the comparison."""
    li = tb(spark, sf, "lineitem").select("l_orderkey", *PROFILE_NUM, *PROFILE_TEXT)
    parts = [PR.profile_day(li.where(F.col("l_orderkey") % 3 == d).drop("l_orderkey")) for d in range(3)]
    t = PR.profile_table(PR.merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2])))
    t = t.withColumns({c: F.when(F.col("exact"), F.col(c)) for c in ("distinct", "q25", "median", "q75")})
    return t.withColumn("top", F.when(F.col("column").isin(*PROFILE_TEXT), F.col("top")))


# ------------------------------------------------------------------ scalar functions

@query("parse_date", """SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 13 = 0 THEN 'xx'
 ELSE strftime(o_orderdate, '%m/%Y') END, '%m/%Y') AS enroll_date FROM orders""")
def q_parse_date(spark, sf):
    o = tb(spark, sf, "orders")
    s = F.when(F.col("o_orderkey") % 13 == 0, F.lit("xx")).otherwise(F.date_format("o_orderdate", "MM/yyyy"))
    return o.select("o_orderkey", FN.parse_date(s, "%m/%Y").alias("enroll_date"))


@query("parse_date_columns", """SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 13 = 0 THEN 'n/a'
 ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def q_parse_date_columns(spark, sf):
    o = tb(spark, sf, "orders")
    s = F.when(F.col("o_orderkey") % 13 == 0, F.lit("n/a")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return FN.parse_date_columns(o.select("o_orderkey", s.alias("o_orderdate"), "o_orderpriority"))


CUST_AGE = "(SELECT *, 30 + c_custkey % 60 AS age FROM customer)"
AGE_CASE = """CASE WHEN age >= 0 AND age < 50 THEN 'Under 50' WHEN age >= 50 AND age < 60 THEN '50-59'
 WHEN age >= 60 AND age < 70 THEN '60-69' WHEN age >= 70 AND age < 80 THEN '70-79'
 WHEN age >= 80 AND age < 100 THEN '80 and above' END"""


def customer_age(spark, sf):
    return tb(spark, sf, "customer").withColumn("age", 30 + F.col("c_custkey") % 60)


@query("cut_labels", f"SELECT c_custkey, age, {AGE_CASE} AS Age_Group FROM {CUST_AGE}")
def q_cut_labels(spark, sf):
    from cohort_spark.operators.sample import AGE_EDGES, AGE_LABELS

    c = customer_age(spark, sf)
    return c.select("c_custkey", "age", FN.cut_labels("age", AGE_EDGES, AGE_LABELS).alias("Age_Group"))


def _equal_width_case(col, lo, hi, n):
    parts = [f"WHEN {col} >= {lo} + ({hi} - {lo}) * {i} / {n} AND {col} < {lo} + ({hi} - {lo}) * {i + 1} / {n} "
             f"THEN 'Bin {i + 1}'" for i in range(n)]
    return "CASE " + " ".join(parts) + " ELSE 'nan' END"


@query("cut_equal_width", f"""SELECT c_custkey, c_acctbal, {_equal_width_case('c_acctbal', 'r.lo', 'r.hi', 4)} AS acctbal_bin
FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer) r""")
def q_cut_equal_width(spark, sf):
    c = tb(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return FN.cut_equal_width(c, "c_acctbal", 4, "acctbal_bin")


@query("fill_value", f"SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0.0) AS l_quantity FROM {LI_NULLS}")
def q_fill_value(spark, sf):
    li = lineitem_nulls(spark, sf)
    return li.select("l_orderkey", "l_linenumber", FN.fill_value("l_quantity", 0.0).alias("l_quantity"))


@query("truncate_mean", """SELECT c_mktsegment, CAST(trunc(avg(c_acctbal)) AS BIGINT) AS mean_trunc FROM customer
GROUP BY c_mktsegment""")
def q_truncate_mean(spark, sf):
    return tb(spark, sf, "customer").groupBy("c_mktsegment").agg(FN.truncate_mean("c_acctbal").alias("mean_trunc"))


@query("mask_replace", """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_discount ELSE 0.0 END AS l_discount
FROM lineitem""")
def q_mask_replace(spark, sf):
    li = tb(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     FN.mask_replace("l_discount", F.col("l_discount") > 0.05, 0.0).alias("l_discount"))


@query("binarize", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS is_f FROM orders")
def q_binarize(spark, sf):
    return tb(spark, sf, "orders").select("o_orderkey", FN.binarize("o_orderstatus", "F").alias("is_f"))


MODEL_NAMES = ("SVM", "Random Forest", "XGBoost", "Logistic Regression")
NAME_CASE = ("CASE doc_id % 4 WHEN 0 THEN 'SVM' WHEN 1 THEN 'Random Forest' WHEN 2 THEN 'XGBoost' "
             "ELSE 'Logistic Regression' END")


def model_names(spark, sf):
    lab = tb(spark, sf, "labels")
    m = F.col("doc_id") % 4
    name = (F.when(m == 0, "SVM").when(m == 1, "Random Forest").when(m == 2, "XGBoost")
            .otherwise("Logistic Regression"))
    return lab.select("doc_id", name.alias("model_name"))


@query("model_family", f"""SELECT doc_id, {NAME_CASE} AS model_name,
 CASE doc_id % 4 WHEN 0 THEN 'svm' WHEN 1 THEN 'random_forest' WHEN 2 THEN 'xgboost' ELSE 'logistic_regression' END
 AS model_type FROM labels""")
def q_model_family(spark, sf):
    n = model_names(spark, sf)
    return n.withColumn("model_type", FN.model_family("model_name"))


@query("model_path", f"""SELECT doc_id, 'models/' || replace(lower({NAME_CASE}), ' ', '_') || '.model' AS path FROM labels""")
def q_model_path(spark, sf):
    n = model_names(spark, sf)
    return n.select("doc_id", FN.model_path("model_name", "models", ".model").alias("path"))


@query("slice_label", "SELECT doc_id, 'AGE_' || lang AS slice FROM documents")
def q_slice_label(spark, sf):
    return tb(spark, sf, "documents").select("doc_id", FN.slice_label("lang").alias("slice"))


# ------------------------------------------------------------------ missing values (M1-M7)

@query("drop_sparse_columns", f"SELECT * EXCLUDE (l_tax) FROM {LI_NULLS}")
def q_drop_sparse_columns(spark, sf):
    return M.drop_sparse_columns(lineitem_nulls(spark, sf), 0.5)


def _kind_sql(c, numeric):
    other = "'numeric'" if numeric else "'other'"
    return f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) < 9 THEN 'categorical' ELSE {other} END AS kind FROM lineitem"


@query("classify_columns", _union([_kind_sql(c, c not in ("l_returnflag", "l_linestatus", "l_shipdate")) for c in _LI_ALL]))
def q_classify_columns(spark, sf):
    return M.classify_columns_table(tb(spark, sf, "lineitem"), 9)


@query("impute_low_missing", f"""SELECT l_orderkey, l_linenumber,
 coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM {LI_NULLS})) AS l_quantity,
 l_extendedprice, l_discount, l_tax,
 coalesce(l_returnflag, {_mode_sql('l_returnflag', LI_NULLS)}) AS l_returnflag, l_linestatus FROM {LI_NULLS}""")
def q_impute_low_missing(spark, sf):
    return M.impute_low_missing(lineitem_nulls(spark, sf), ["l_returnflag", "l_linestatus"],
                                ["l_quantity", "l_extendedprice", "l_discount"], 0.05)


@query("impute_mean_mode", f"""SELECT {", ".join(
    f"coalesce({c}, (SELECT CAST(trunc(avg({c})) AS {'INTEGER' if c == 'l_linenumber' else 'BIGINT'}) FROM {LI_NULLS})) AS {c}"
    for c in ["l_orderkey", "l_linenumber", *LI_NUM])},
 coalesce(l_returnflag, {_mode_sql('l_returnflag', LI_NULLS)}) AS l_returnflag,
 coalesce(l_linestatus, {_mode_sql('l_linestatus', LI_NULLS)}) AS l_linestatus FROM {LI_NULLS}""")
def q_impute_mean_mode(spark, sf):
    return M.impute_mean_mode(lineitem_nulls(spark, sf))


@query("handle_missing_values", f"""SELECT {", ".join(
    f"coalesce({c}, (SELECT avg({c}) FROM {LI_NULLS})) AS {c}" for c in ["l_orderkey", "l_linenumber", *LI_NUM])},
 coalesce(l_returnflag, {_mode_sql('l_returnflag', LI_NULLS)}) AS l_returnflag,
 coalesce(l_linestatus, {_mode_sql('l_linestatus', LI_NULLS)}) AS l_linestatus FROM {LI_NULLS}""")
def q_handle_missing_values(spark, sf):
    return M.handle_missing_values(lineitem_nulls(spark, sf, void=True))


@query("handle_missing_values_strategy", f"""SELECT l_orderkey, l_linenumber,
 coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM {LI_NULLS})) AS l_quantity,
 l_extendedprice, coalesce(l_discount, 100.0) AS l_discount, l_returnflag, l_linestatus FROM {LI_NULLS}""")
def q_handle_missing_values_strategy(spark, sf):
    return M.handle_missing_values(lineitem_nulls(spark, sf, void=True), drop_threshold=0.5,
                                   strategy={"l_quantity": "median", "l_discount": "constant",
                                             "l_extendedprice": lambda c: c},
                                   constant_value=100.0)


def knn_frame(spark, sf):
    c = tb(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select("c_custkey",
                    F.when(k % 7 != 0, (k % 4).cast("double")).alias("a"),
                    F.when(k % 5 != 0, (F.col("c_nationkey") % 3).cast("double")).alias("b"),
                    F.length("c_mktsegment").cast("double").alias("s"))


KNN_SRC = """(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 4 AS DOUBLE) END AS a,
 CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey % 3 AS DOUBLE) END AS b,
 CAST(length(c_mktsegment) AS DOUBLE) AS s FROM customer)"""


def _knn_sql(target, others, all_cols, k=5, src=KNN_SRC):
    d = len(all_cols)
    common = " + ".join(f"CASE WHEN r.{o} IS NOT NULL AND d.{o} IS NOT NULL THEN 1 ELSE 0 END" for o in others)
    ssum = " + ".join(f"CASE WHEN r.{o} IS NOT NULL AND d.{o} IS NOT NULL THEN (r.{o} - d.{o}) ^ 2 ELSE 0 END"
                      for o in others)
    order = ", ".join(f"d.{c} ASC NULLS LAST" for c in all_cols)
    return f"""(SELECT c_custkey, avg(v) AS imp FROM (
  SELECT r.c_custkey, d.{target} AS v, row_number() OVER (PARTITION BY r.c_custkey ORDER BY
    sqrt({d}.0 / ({common}) * ({ssum})), ({common}) DESC, {order}) AS rn
  FROM {src} r, {src} d
  WHERE r.{target} IS NULL AND d.{target} IS NOT NULL AND ({common}) > 0) WHERE rn <= {k} GROUP BY c_custkey)"""


@query("knn_impute", f"""SELECT t.c_custkey,
 CASE WHEN t.a IS NULL THEN coalesce(ia.imp, (SELECT avg(a) FROM {KNN_SRC})) ELSE t.a END AS a,
 CASE WHEN t.b IS NULL THEN coalesce(ib.imp, (SELECT avg(b) FROM {KNN_SRC})) ELSE t.b END AS b,
 t.s
FROM {KNN_SRC} t LEFT JOIN {_knn_sql('a', ['b', 's'], ['a', 'b', 's'])} ia ON t.c_custkey = ia.c_custkey
LEFT JOIN {_knn_sql('b', ['a', 's'], ['a', 'b', 's'])} ib ON t.c_custkey = ib.c_custkey""")
def q_knn_impute(spark, sf):
    return M.knn_impute(knn_frame(spark, sf), ["a", "b", "s"], 5)


WIDE = {"a": "c_acctbal", "b": "c_acctbal / (1 + c_custkey % 17)", "e": "(c_custkey % 101) * 1.5E0 + c_acctbal / 70", "f": "c_nationkey + c_acctbal / 7000",
        "g": "(c_custkey % 37) / 3.0E0", "h": "c_acctbal * (c_custkey % 5)", "j": "c_nationkey * 1.0E0"}
WIDE_GAPS = (3, 4, 5, 7, 8, 11, 13)  # 128 presence masks
WIDE_SRC = "(SELECT c_custkey, " + ", ".join(f"CASE WHEN c_custkey % {m} > {m // 3} THEN CAST({e} AS DOUBLE) END AS {c}" for (c, e), m in zip(WIDE.items(), WIDE_GAPS)) + " FROM customer)"


@query("knn_impute_wide", f"""SELECT t.c_custkey, {", ".join(f"CASE WHEN t.{c} IS NULL THEN coalesce(i{c}.imp, (SELECT avg({c}) FROM {WIDE_SRC})) ELSE t.{c} END AS {c}" for c in WIDE)}
FROM {WIDE_SRC} t {" ".join(f"LEFT JOIN {_knn_sql(c, [o for o in WIDE if o != c], list(WIDE), src=WIDE_SRC)} i{c} ON t.c_custkey = i{c}.c_custkey" for c in WIDE)}""")
def q_knn_impute_wide(spark, sf):
    """Continuous values; presence masks that vary with the key."""
    c = tb(spark, sf, "customer")
    key = F.col("c_custkey")
    cols = [F.when(key % m > m // 3, F.expr(e).cast("double")).alias(n) for (n, e), m in zip(WIDE.items(), WIDE_GAPS)]
    return M.knn_impute(c.select("c_custkey", *cols), list(WIDE), 5)


@query("drop_id_columns", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_drop_id_columns(spark, sf):
    return M.drop_id_columns(tb(spark, sf, "customer"), ["c_custkey", "c_name"])


# ------------------------------------------------------------------ outliers

@query("outlier_zscore_median", f"""SELECT l_orderkey, l_linenumber,
 CASE WHEN abs((l_extendedprice - m) / s) < 1.5 THEN l_extendedprice ELSE med END AS l_extendedprice
FROM {LI_NULLS}, (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s,
 quantile_cont(l_extendedprice, 0.5) AS med FROM {LI_NULLS})""")
def q_outlier_zscore_median(spark, sf):
    li = lineitem_nulls(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return O.outlier_zscore_median(li, ["l_extendedprice"], 1.5)


ORD_NULLS = """(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS o_totalprice
 FROM orders)"""


def orders_price_nulls(spark, sf):
    o = tb(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey",
                    F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("o_totalprice"))


@query("outlier_iqr_median", f"""SELECT o_orderkey, o_custkey,
 CASE WHEN o_totalprice >= q1 - 1.5 * (q3 - q1) AND o_totalprice <= q3 + 1.5 * (q3 - q1) THEN o_totalprice ELSE med END
 AS o_totalprice
FROM {ORD_NULLS}, (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3,
 quantile_cont(o_totalprice, 0.5) AS med FROM {ORD_NULLS})""")
def q_outlier_iqr_median(spark, sf):
    return O.outlier_iqr_median(orders_price_nulls(spark, sf), ["o_totalprice"])


@query("outlier_to_null_zscore", f"""SELECT o_orderkey, o_custkey,
 CASE WHEN abs((o_totalprice - m) / s) > 2 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM {ORD_NULLS}, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM {ORD_NULLS})""")
def q_outlier_to_null_zscore(spark, sf):
    return O.outlier_to_null(orders_price_nulls(spark, sf), ["o_totalprice"], "zscore", 2.0)


@query("outlier_to_null_iqr", f"""SELECT o_orderkey, o_custkey,
 CASE WHEN o_totalprice < q1 - (q3 - q1) OR o_totalprice > q3 + (q3 - q1) THEN NULL ELSE o_totalprice END AS o_totalprice
FROM {ORD_NULLS}, (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM {ORD_NULLS})""")
def q_outlier_to_null_iqr(spark, sf):
    return O.outlier_to_null(orders_price_nulls(spark, sf), ["o_totalprice"], "iqr")


_ORD_ZS = f"""(SELECT o_orderkey, o_custkey,
 CASE WHEN abs((o_totalprice - m) / s) > 2 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM {ORD_NULLS}, (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM {ORD_NULLS}))"""


@query("outlier_report", _union([f"""SELECT '{c}' AS "Column", (SELECT avg({c}) FROM {ORD_NULLS}) AS Original_Mean,
 (SELECT avg({c}) FROM {_ORD_ZS}) AS Cleaned_Mean, (SELECT stddev_samp({c}) FROM {ORD_NULLS}) AS Original_Std,
 (SELECT stddev_samp({c}) FROM {_ORD_ZS}) AS Cleaned_Std,
 (SELECT count(*) - count({c}) FROM {_ORD_ZS}) AS Points_Modified""" for c in ("o_orderkey", "o_custkey", "o_totalprice")]))
def q_outlier_report(spark, sf):
    before = orders_price_nulls(spark, sf)
    return O.outlier_report(before, O.outlier_to_null(before, ["o_totalprice"], "zscore", 2.0))


@query("outlier_isolation_median")
def q_outlier_isolation_median(spark, sf):
    li = tb(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return O.outlier_isolation_median(li, ["l_extendedprice", "l_quantity"], share=0.1)


@query("outlier_isolation_invariants", """SELECT count(*) AS n_rows, true AS within_share, true AS kept_or_median, true AS extremes_flagged,
 sum(l_quantity) AS untouched FROM lineitem""")
def q_outlier_isolation_invariants(spark, sf):
    """What holds for any sound forest: at most the share of rows changes, a changed value is the median, and values far
    outside (here 0.2% of the prices times 1000) are among the changed ones."""
    li = tb(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_orderkey") % 500 == 0, F.col("l_extendedprice") * 1000)
                                          .otherwise(F.col("l_extendedprice")).alias("price"))
    out = O.outlier_isolation_median(li.withColumn("before", F.col("price")), ["price"], share=0.1)
    changed = F.count_if(~F.col("price").eqNullSafe(F.col("before")))
    far = F.count_if((F.col("l_orderkey") % 500 == 0) & (F.col("price") > 200_000))
    med = M.medians_of(li, ["price"])["price"]
    return out.agg(F.count(F.lit(1)).alias("n_rows"), (changed <= 0.1 * F.count(F.lit(1))).alias("within_share"),
                   (F.count_if((F.col("price") != F.col("before")) & (F.col("price") != F.lit(med))) == 0).alias("kept_or_median"),
                   (far == 0).alias("extremes_flagged"), F.sum("l_quantity").alias("untouched"))


@query("clean_table")
def q_clean_table(spark, sf):
    return O.clean_table(lineitem_nulls(spark, sf), ["l_quantity", "l_extendedprice"])


# ------------------------------------------------------------------ encoding

@query("standard_scale", """SELECT c_custkey, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS c_acctbal
FROM customer""")
def q_standard_scale(spark, sf):
    return E.standard_scale(tb(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def onehot_frame(spark, sf):
    return tb(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment",
                                            (F.col("c_nationkey") % 3).cast("double").alias("grp"))


@query("one_hot", "SELECT c_custkey, c_acctbal, " + ", ".join(
    [f"CAST(coalesce(c_mktsegment = '{s}', false) AS DOUBLE) AS \"c_mktsegment_{s}\"" for s in SEGMENTS]
    + [f"CAST(coalesce(c_nationkey % 3 = {g}, false) AS DOUBLE) AS \"grp_{g}.0\"" for g in range(3)]) + " FROM customer")
def q_one_hot(spark, sf):
    return E.one_hot(onehot_frame(spark, sf), ["c_mktsegment", "grp"])


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("get_dummies", "SELECT o_orderkey, " + ", ".join(
    [f"coalesce(o_orderstatus = '{s}', false) AS \"o_orderstatus_{s}\"" for s in ("O", "P")]
    + [f"coalesce(o_orderpriority = '{p}', false) AS \"o_orderpriority_{p}\"" for p in PRIORITIES[1:]]) + " FROM orders")
def q_get_dummies(spark, sf):
    return E.get_dummies(tb(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"))


@query("label_encode", """SELECT o_orderkey, o_orderpriority,
 CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS priority_code FROM orders""")
def q_label_encode(spark, sf):
    return E.label_encode(tb(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                          "priority_code")


def prep_frame(spark, sf):
    return tb(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", (F.col("c_nationkey") % 3).cast("double").alias("grp"),
        (F.col("c_custkey") % 2).cast("double").alias("parity"))


@query("fit_apply_preprocessor", """SELECT (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS c_acctbal,
 """ + ", ".join([f"CAST(c_nationkey % 3 = {g} AS DOUBLE) AS \"grp_{g}.0\"" for g in range(3)]
                 + [f"CAST(c_custkey % 2 = {g} AS DOUBLE) AS \"parity_{g}.0\"" for g in range(2)]) + """,
 c_custkey, c_name FROM customer""")
def q_fit_apply_preprocessor(spark, sf):
    df = prep_frame(spark, sf)
    from cohort_spark.session import scratch_path
    from cohort_spark.sources import load_preprocessor, save_preprocessor

    pre = E.fit_preprocessor(df, ["c_acctbal"], ["grp", "parity"])
    path = save_preprocessor(spark, pre, scratch_path(spark, "preprocessor"))  # fitted once, reused at scoring
    return E.apply_preprocessor(df, load_preprocessor(spark, path))


@query("lda_project")
def q_lda_project(spark, sf):
    li = tb(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                          "l_returnflag")
    return E.lda_project(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_returnflag")
