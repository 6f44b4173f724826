"""Queries for sources, projections, joins, de-duplication, set operations and flows.

Test-data roles: customers are participants (key ``c_custkey``), orders are
visits (``o_custkey``, ``o_orderdate``, status ``o_orderstatus``), nation holds
demographics, lineitem stands for the assessment forms. Missing values are
injected by key in the same way in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark.plans import flows
from cohort_spark.plans.registry import query, tb


def w1_inputs(spark, sf):
    customer, nation, orders = tb(spark, sf, "customer"), tb(spark, sf, "nation"), tb(spark, sf, "orders")
    status = customer.select(F.col("c_custkey").alias("PATNO"), "c_name", "c_acctbal", "c_mktsegment", "c_nationkey")
    demo = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .select(F.col("c_custkey").alias("PATNO"), "n_name", "n_regionkey", "c_nationkey"))
    return status, demo, flows.orders_as_visits(orders)


def participant_flow_q(spark, sf):
    status, demo, visits = w1_inputs(spark, sf)
    return flows.participant_flow(
        status, demo, visits, status_col="c_mktsegment", valid_status=("BUILDING", "MACHINERY", "FURNITURE"),
        status_drop=["c_name"], joined_drop=["PATNO", "c_nationkey_drop"],
        visit_col="o_orderstatus", visit_value="F", visit_ts="o_orderdate", visit_tie=["o_orderkey"],
        visit_drop=["o_orderstatus"])





W1_SQL = """
WITH st AS (SELECT c_custkey AS Participant_ID, c_acctbal, c_mktsegment, c_nationkey FROM customer),
demo AS (SELECT c.c_custkey AS PATNO, n.n_name, n.n_regionkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
comb AS (SELECT st.*, demo.n_name, demo.n_regionkey FROM st JOIN demo ON st.Participant_ID = demo.PATNO
         WHERE st.c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')),
v AS (SELECT o_custkey AS PATNO, o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS rn
      FROM orders WHERE o_orderstatus = 'F')
SELECT comb.*, v.o_orderkey, v.o_totalprice, v.o_orderdate, v.o_orderpriority
FROM comb LEFT JOIN v ON comb.Participant_ID = v.PATNO AND v.rn = 1
"""

query("participant_flow", W1_SQL)(participant_flow_q)

# ------------------------------------------------------------------ sources and sinks
import os  # noqa: E402

from cohort_spark import sources as S  # noqa: E402
from cohort_spark.operators import columns as P  # noqa: E402
from cohort_spark.operators import dedup as D  # noqa: E402
from cohort_spark.operators import joins as J  # noqa: E402
from cohort_spark.session import scratch_path  # noqa: E402


@query("read_table", "SELECT * FROM customer")
def q_read_table(spark, sf):
    return S.read_table(spark, os.path.join(sf, "customer.parquet"))


@query("read_dir", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in
    ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
     "nation", "orders", "pages", "part", "region", "supplier")))
def q_read_dir(spark, sf):
    parts = [df.groupBy().count().select(F.lit(name).alias("table_name"), F.col("count").alias("n_rows"))
             for name, df in S.read_dir(spark, sf, ".parquet")]
    return J.union_groups(parts)


@query("write_table", "SELECT * FROM customer")
def q_write_table(spark, sf):
    customer = tb(spark, sf, "customer")
    path = S.write_table(customer, scratch_path(spark, "customer_csv"), fmt="csv")
    return S.read_table(spark, path, schema=customer.schema, fmt="csv")


@query("stage_table", W1_SQL)
def q_stage_table(spark, sf):
    return S.stage_table(participant_flow_q(spark, sf), scratch_path(spark, "participants"))


@query("save_load_model", """
SELECT l_orderkey, l_linenumber,
       (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS z_quantity,
       (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER () AS z_extendedprice,
       (l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER () AS z_discount
FROM lineitem""")
def q_save_load_model(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    li = tb(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_x"),
                            StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True)])
    path = S.save_model(pipe.fit(li), scratch_path(spark, "scaler_model"))
    out = S.load_model(path).transform(li).withColumn("_a", vector_to_array("_z"))
    return out.select("l_orderkey", "l_linenumber",
                      *[F.col("_a")[i].alias("z_" + c[2:]) for i, c in enumerate(cols)])


@query("append_metrics", """
SELECT 'run1' AS run, 'toxic_as_quality' AS model, 'accuracy' AS metric, avg(CAST(quality = toxic AS DOUBLE)) AS value FROM labels
UNION ALL SELECT 'run1', 'toxic_as_quality', 'n', CAST(count(*) AS DOUBLE) FROM labels""")
def q_append_metrics(spark, sf):
    lab = tb(spark, sf, "labels")
    m = lab.agg(F.avg((F.col("quality") == F.col("toxic")).cast("double")).alias("accuracy"),
                F.count(F.lit(1)).cast("double").alias("n"))
    rows = m.select(F.lit("run1").alias("run"), F.lit("toxic_as_quality").alias("model"),
                    F.explode(F.array(F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
                                      F.struct(F.lit("n").alias("metric"), F.col("n").alias("value")))).alias("s"))
    rows = rows.select("run", "model", "s.metric", "s.value")
    return S.append_metrics(rows, scratch_path(spark, "metrics"))


# ------------------------------------------------------------------ projections and filters

@query("drop_strict", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def q_drop_strict(spark, sf):
    return P.drop_strict(tb(spark, sf, "customer"), ["c_name", "c_acctbal"])


@query("rename_key", "SELECT c_custkey AS Participant_ID, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_rename_key(spark, sf):
    return P.rename_key(tb(spark, sf, "customer"), "c_custkey", "Participant_ID")


@query("select_by_type", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
l_discount, l_tax FROM lineitem""")
def q_select_by_type(spark, sf):
    return P.select_by_type(tb(spark, sf, "lineitem"), "number")


@query("filter_isin", "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def q_filter_isin(spark, sf):
    return P.filter_isin(tb(spark, sf, "orders"), "o_orderstatus", ["F", "O"])


@query("filter_eq", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def q_filter_eq(spark, sf):
    return P.filter_eq(tb(spark, sf, "orders"), "o_orderstatus", "F")


def orders_priority_nulls(spark, sf):
    o = tb(spark, sf, "orders")
    return o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")))


@query("filter_ne_keep_null", """
SELECT * FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority) FROM orders)
WHERE o_orderpriority IS DISTINCT FROM '1-URGENT'""")
def q_filter_ne_keep_null(spark, sf):
    return P.filter_ne_keep_null(orders_priority_nulls(spark, sf), "o_orderpriority", "1-URGENT")


@query("split_target", """SELECT 'features' AS half, c_custkey, c_name, c_nationkey, c_acctbal, NULL::VARCHAR AS c_mktsegment FROM customer
UNION ALL SELECT 'target', c_custkey, NULL, NULL, NULL, c_mktsegment FROM customer""")
def q_split_target(spark, sf):
    x, y = P.split_target(tb(spark, sf, "customer"), "c_mktsegment", key="c_custkey")
    return x.withColumn("half", F.lit("features")).unionByName(y.withColumn("half", F.lit("target")), allowMissingColumns=True)


@query("attach_target", """SELECT d.doc_id, d.lang, d.n_chars, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def q_attach_target(spark, sf):
    docs = tb(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return P.attach_target(docs, tb(spark, sf, "labels"), "doc_id", "quality")


@query("drop_repeated_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_drop_repeated_columns(spark, sf):
    o = tb(spark, sf, "orders")
    wide = o.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").alias("o_custkey"),
                    F.col("o_orderstatus").alias("o_totalprice"))
    return P.drop_repeated_columns(wide)


@query("first_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50")
def q_first_n(spark, sf):
    return P.first_n(tb(spark, sf, "orders"), 50, ["o_orderkey"])


_LI_TYPES = (("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
             ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
             ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))


@query("table_info", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column, '{t}' AS dtype, count({c}) AS non_null, count(*) AS n_rows FROM lineitem"
    for i, (c, t) in enumerate(_LI_TYPES)))
def q_table_info(spark, sf):
    return P.table_info(tb(spark, sf, "lineitem"))


@query("parse_feature_record", """SELECT l_orderkey, l_linenumber, l_quantity AS f_quantity, l_discount AS f_discount,
l_tax AS f_tax FROM lineitem""")
def q_parse_feature_record(spark, sf):
    from cohort_spark.functions.scalar import parse_feature_record

    li = tb(spark, sf, "lineitem")
    rec = li.select("l_orderkey", "l_linenumber",
                    F.concat_ws(", ", "l_quantity", "l_discount", "l_tax").alias("record"))
    return parse_feature_record(rec, "record", ["f_quantity", "f_discount", "f_tax"])


# ------------------------------------------------------------------ joins

@query("join_inner_suffix", """
SELECT c.c_custkey AS Participant_ID, c.c_name, c.c_acctbal, o.o_custkey AS PATNO, o.o_orderkey,
       o.o_totalprice AS c_acctbal_drop
FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey""")
def q_join_inner_suffix(spark, sf):
    c = tb(spark, sf, "customer").select(F.col("c_custkey").alias("Participant_ID"), "c_name", "c_acctbal")
    o = tb(spark, sf, "orders").select(F.col("o_custkey").alias("PATNO"), "o_orderkey",
                                       F.col("o_totalprice").alias("c_acctbal"))
    return J.join_inner_suffix(c, o, "Participant_ID", "PATNO", ("", "_drop"))


@query("join_left_dropkey", """
SELECT c.*, s.s_name, s.s_nationkey, s.s_acctbal FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""")
def q_join_left_dropkey(spark, sf):
    return J.join_left_dropkey(tb(spark, sf, "customer"), tb(spark, sf, "supplier"), "c_custkey", "s_suppkey")


def status_frames(spark, sf):
    o = tb(spark, sf, "orders")
    out = []
    for s in ("F", "O", "P"):
        d = o.where(F.col("o_orderstatus") == s).select(
            F.col("o_custkey").alias("PATNO"), F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total"), "o_orderdate", "o_orderkey")
        out.append(D.earliest_per_key(d, "PATNO", "o_orderdate", ["o_orderkey"]).drop("o_orderdate", "o_orderkey"))
    return out


_STATUS_CTE = ",\n".join(
    f"""{s.lower()}1 AS (SELECT PATNO, status, total FROM (SELECT o_custkey AS PATNO, o_orderstatus AS status,
 o_totalprice AS total, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS rn
 FROM orders WHERE o_orderstatus = '{s}') WHERE rn = 1)""" for s in ("F", "O", "P"))


@query("outer_join_all", f"""
WITH {_STATUS_CTE}
SELECT coalesce(f1.PATNO, o1.PATNO, p1.PATNO) AS PATNO, f1.status, f1.total, o1.status AS status_dup,
       o1.total AS total_dup
FROM f1 FULL OUTER JOIN o1 ON f1.PATNO = o1.PATNO FULL OUTER JOIN p1 ON coalesce(f1.PATNO, o1.PATNO) = p1.PATNO""")
def q_outer_join_all(spark, sf):
    return J.outer_join_all(status_frames(spark, sf), "PATNO", "_dup", unique_keys=True)


@query("inner_join_all", f"""
WITH {_STATUS_CTE}
SELECT f1.PATNO, f1.status AS status_x, f1.total AS total_x, o1.status AS status_y, o1.total AS total_y,
       p1.status, p1.total
FROM f1 JOIN o1 ON f1.PATNO = o1.PATNO JOIN p1 ON f1.PATNO = p1.PATNO""")
def q_inner_join_all(spark, sf):
    return J.inner_join_all(status_frames(spark, sf), "PATNO")


@query("join_on_group_min", """
SELECT o.*, m.earliest_date FROM orders o JOIN
 (SELECT o_custkey, min(o_orderdate) AS earliest_date FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) m
 ON o.o_custkey = m.o_custkey AND o.o_orderdate = m.earliest_date""")
def q_join_on_group_min(spark, sf):
    return J.join_on_group_min(tb(spark, sf, "orders"), "o_custkey", "o_orderdate",
                               F.col("o_orderstatus") == "F")


EVENTS_SPLIT = "2024-01-16"


def events_ab(spark, sf):
    ev = tb(spark, sf, "events")
    cut = F.lit(EVENTS_SPLIT).cast("timestamp_ntz")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


_SHARES = """
a AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS share_a FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY event_type),
b AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS share_b FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY event_type)"""


@query("freq_outer_join", f"""
WITH {_SHARES}
SELECT coalesce(a.event_type, b.event_type) AS event_type, coalesce(share_a, 0) AS share_a, coalesce(share_b, 0) AS share_b
FROM a FULL OUTER JOIN b ON a.event_type = b.event_type""")
def q_freq_outer_join(spark, sf):
    a, b = events_ab(spark, sf)
    return J.freq_outer_join(a, b, "event_type")


# ------------------------------------------------------------------ de-duplication and order

def orders_date_nulls(spark, sf):
    o = tb(spark, sf, "orders")
    return o.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")))


_ORDERS_NULLED = "(SELECT * REPLACE (CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS o_orderdate) FROM orders)"


@query("earliest_per_key", f"""
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST,
 o_orderkey) AS rn FROM {_ORDERS_NULLED}) WHERE rn = 1""")
def q_earliest_per_key(spark, sf):
    return D.earliest_per_key(orders_date_nulls(spark, sf), "o_custkey", "o_orderdate", ["o_orderkey"])


LI_TWICE = "(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 3 = 0)"


def lineitem_twice(spark, sf):
    """All columns of lineitem, a third of the orders twice."""
    li = tb(spark, sf, "lineitem")
    return li.unionByName(li.where(F.col("l_orderkey") % 3 == 0))


@query("drop_duplicate_rows", f"SELECT DISTINCT * FROM {LI_TWICE}")
def q_drop_duplicate_rows(spark, sf):
    return D.drop_duplicate_rows(lineitem_twice(spark, sf))


@query("update_earliest", """SELECT * EXCLUDE rn FROM (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def q_update_earliest(spark, sf):
    """Four days of orders, the second run twice; each run reads the state before and its own day."""
    o = tb(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    path = scratch_path(spark, "first-orders")
    for day in (0, 1, 1, 2, 3):
        out = D.update_earliest(o.where(F.col("o_orderkey") % 4 == day), path, str(day), "o_custkey", "o_orderdate", ["o_orderkey"])
    return out


_LI_COLS = [c for c, _ in _LI_TYPES]
_LI_ASC = ", ".join(f"{c} ASC NULLS LAST" for c in _LI_COLS)
_LI_DESC = ", ".join(f"{c} DESC NULLS FIRST" for c in _LI_COLS)


@query("handle_duplicates_first", f"""
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ASC}) AS rn
 FROM lineitem) WHERE rn = 1""")
def q_handle_duplicates_first(spark, sf):
    return D.handle_duplicates(tb(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], keep="first")


@query("handle_duplicates_last", f"""
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_DESC}) AS rn
 FROM lineitem) WHERE rn = 1""")
def q_handle_duplicates_last(spark, sf):
    return D.handle_duplicates(tb(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], keep="last")


@query("handle_duplicates_none", """
SELECT * EXCLUDE n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1""")
def q_handle_duplicates_none(spark, sf):
    return D.handle_duplicates(tb(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], keep=False)


@query("handle_duplicates_reindex", f"""
SELECT *, row_number() OVER (ORDER BY {_LI_ASC}) - 1 AS index FROM (
 SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ASC}) AS rn
 FROM lineitem) WHERE rn = 1)""")
def q_handle_duplicates_reindex(spark, sf):
    return D.handle_duplicates(tb(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], keep="first", reindex=True)


@query("analyze_duplicates", """
SELECT * EXCLUDE n FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def q_analyze_duplicates(spark, sf):
    return D.analyze_duplicates(tb(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("count_duplicates", f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_duplicates FROM {LI_TWICE}")
def q_count_duplicates(spark, sf):
    return D.count_duplicates(lineitem_twice(spark, sf))


@query("sort_rows", f"SELECT * FROM {_ORDERS_NULLED} ORDER BY o_orderdate NULLS LAST, o_orderkey")
def q_sort_rows(spark, sf):
    return D.sort_rows(orders_date_nulls(spark, sf), ["o_orderdate", "o_orderkey"])


@query("top_k", "SELECT * FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10")
def q_top_k(spark, sf):
    return D.top_k(tb(spark, sf, "lineitem"), "l_extendedprice", 10, ["l_orderkey", "l_linenumber"])


# ------------------------------------------------------------------ set operations

@query("union_by_name", """
SELECT o_orderkey, o_custkey, o_totalprice, NULL::TIMESTAMP AS o_orderdate FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, NULL, o_orderdate FROM orders WHERE o_orderstatus = 'O'""")
def q_union_by_name(spark, sf):
    o = tb(spark, sf, "orders")
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey", "o_orderdate")
    return J.union_by_name([a, b])


@query("union_groups", "SELECT * FROM orders")
def q_union_groups(spark, sf):
    o = tb(spark, sf, "orders")
    return J.union_groups([o.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")])


EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value")


@query("same_columns", " UNION ALL ".join([f"""SELECT '{c}' AS "column", true AS same, count({c}) FILTER (ts < TIMESTAMP '2024-01-16') AS n_a,
 count({c}) FILTER (ts >= TIMESTAMP '2024-01-16') AS n_b FROM events""" for c in EVENT_COLS]))
def q_same_columns(spark, sf):
    """The check of both halves' columns, beside the values that each half has in them."""
    a, b = events_ab(spark, sf)
    held = lambda d, n: d.agg(*[F.count(c).alias(c) for c in EVENT_COLS]).unpivot([], list(EVENT_COLS), "column", n)
    return held(a, "n_a").join(held(b, "n_b"), "column").crossJoin(J.same_columns(a, b).select("same"))  # one row of the check


EXPECTED_CUSTOMER = ["c_custkey", "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal", "c_mktsegment"]


@query("missing_columns", " UNION ALL ".join([f"""SELECT '{c}' AS "column", {str(c in ("c_address", "c_phone")).lower()} AS missing,
 {"count(*) * 0" if c in ("c_address", "c_phone") else f"count({c})"} AS n_values FROM customer""" for c in EXPECTED_CUSTOMER]))
def q_missing_columns(spark, sf):
    """Every expected column, whether it is absent, and how many values it has."""
    cust = tb(spark, sf, "customer")
    absent = set(J.missing_columns(cust, EXPECTED_CUSTOMER))
    counts = cust.agg(*[(F.lit(0).cast("long") if c in absent else F.count(c)).alias(c) for c in EXPECTED_CUSTOMER])
    return counts.unpivot([], EXPECTED_CUSTOMER, "column", "n_values").withColumn("missing", F.col("column").isin(*absent))


# ------------------------------------------------------------------ flows W2, W5

def forms(spark, sf, n=5):
    """Five assessment forms from lineitem: line numbers are dealt to forms round-robin, so every
    row of the table belongs to exactly one form."""
    li = tb(spark, sf, "lineitem").withColumn("_form", (F.col("l_linenumber") - 1) % n + 1)
    out = []
    for i in range(1, n + 1):
        out.append(li.where(F.col("_form") == i).select(
            F.col("l_suppkey").alias("PATNO"), F.col("l_returnflag").alias("EVENT_ID"),
            F.date_format("l_shipdate", "MM/yyyy").alias("ORIG_ENTRY"), F.col("l_orderkey").alias("REC_ID"),
            F.col("l_quantity").alias(f"TOT{i}"), F.col("l_extendedprice").alias("PRICE")))
    return out


def _form_cte(i):
    return f"""f{i} AS (SELECT PATNO, EVENT_ID, TOT{i}, PRICE FROM (SELECT l_suppkey AS PATNO, l_returnflag AS EVENT_ID,
 l_quantity AS TOT{i}, l_extendedprice AS PRICE, row_number() OVER (PARTITION BY l_suppkey ORDER BY
 date_trunc('month', l_shipdate) NULLS LAST, l_returnflag NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST) AS rn
 FROM lineitem WHERE (l_linenumber - 1) % 5 + 1 = {i}) WHERE rn = 1)"""


@query("assessment_flow", f"""
WITH {", ".join(_form_cte(i) for i in range(1, 6))}
SELECT coalesce(f1.PATNO, f2.PATNO, f3.PATNO, f4.PATNO, f5.PATNO) AS PATNO, f1.TOT1, f1.PRICE, f2.TOT2,
       f2.PRICE AS PRICE_dup, f3.TOT3, f4.TOT4, f5.TOT5
FROM f1 FULL OUTER JOIN f2 ON f1.PATNO = f2.PATNO
FULL OUTER JOIN f3 ON coalesce(f1.PATNO, f2.PATNO) = f3.PATNO
FULL OUTER JOIN f4 ON coalesce(f1.PATNO, f2.PATNO, f3.PATNO) = f4.PATNO
FULL OUTER JOIN f5 ON coalesce(f1.PATNO, f2.PATNO, f3.PATNO, f4.PATNO) = f5.PATNO""")
def q_assessment_flow(spark, sf):
    return flows.assessment_flow(forms(spark, sf), key="PATNO", ts="ORIG_ENTRY", ts_fmt="MM/yyyy", strict=True,
                                 form_drop=[["REC_ID"]] * 5, final_drop=["EVENT_ID", "EVENT_ID_dup"])


@query("assessment_union_flow", " UNION ALL BY NAME ".join(
    f"""SELECT l_suppkey AS PATNO, l_returnflag AS EVENT_ID, strftime(l_shipdate, '%m/%Y') AS ORIG_ENTRY,
 l_quantity AS TOT{i}, l_extendedprice AS PRICE FROM lineitem WHERE (l_linenumber - 1) % 5 + 1 = {i}""" for i in range(1, 6)))
def q_assessment_union_flow(spark, sf):
    return flows.assessment_union_flow(forms(spark, sf), form_drop=[["REC_ID"]] * 5)
