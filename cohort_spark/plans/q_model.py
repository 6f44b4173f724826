"""Queries for sampling, evaluation, fairness, drift, models and the feature and model flows.

Prediction tables: ``labels`` joined to ``documents`` with four pseudo models
(``XGBoost`` = toxic, ``Random Forest`` = 1 - toxic, ``Logistic Regression`` =
doc_id % 4 >= 2, ``SVM`` = n_chars % 3 = 0) predicting ``quality``; sensitive
attributes derived from the key. Models are fitted on ``embeddings``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark.operators import drift as C
from cohort_spark.operators import fairness as B
from cohort_spark.operators import metrics as V
from cohort_spark.operators import sample as R
from cohort_spark.plans import flows
from cohort_spark.plans.q_basic import events_ab
from cohort_spark.plans.q_stats import AGE_CASE, CUST_AGE, _equal_width_case, _hist_sql, _union, customer_age
from cohort_spark.plans.registry import query, tb

# ------------------------------------------------------------------ sampling


@query("train_test_split", """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || o_orderkey::VARCHAR),
 o_orderkey) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM orders""")
def q_train_test_split(spark, sf):
    return R.split_column(tb(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2, 42)


@query("train_val_test_split", """SELECT o_orderkey, CASE WHEN r <= ceil(ceil(n * 0.3) * 0.5) THEN 'test'
 WHEN r <= ceil(n * 0.3) THEN 'val' ELSE 'train' END AS split FROM (SELECT o_orderkey,
 row_number() OVER (ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey) AS r, count(*) OVER () AS n FROM orders)""")
def q_train_val_test_split(spark, sf):
    return R.train_val_test_split(tb(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 42)


CUST_GROUPS = f"(SELECT c_custkey, age, {AGE_CASE} AS Age_Group FROM {CUST_AGE})"


def customer_groups(spark, sf):
    return customer_age(spark, sf).select("c_custkey", "age",
                                          R.cut_labels("age", R.AGE_EDGES, R.AGE_LABELS).alias("Age_Group"))


def _under_sql(group, n, seed=1):
    return f"""(SELECT c_custkey, age, Age_Group FROM (SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || c_custkey::VARCHAR),
 c_custkey) AS r FROM {CUST_GROUPS} WHERE Age_Group = '{group}') WHERE r <= {n})"""


def _over_sql(group, n, seed=1):
    return f"""(SELECT g.c_custkey, g.age, g.Age_Group FROM range({n}) d(j),
 (SELECT count(*) AS m FROM {CUST_GROUPS} WHERE Age_Group = '{group}') mm,
 (SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || c_custkey::VARCHAR), c_custkey) AS r FROM {CUST_GROUPS}
  WHERE Age_Group = '{group}') g
 WHERE g.r = ('0x' || substr(md5('{seed}:' || d.j::VARCHAR), 1, 8))::BIGINT % mm.m + 1)"""


HALF = f"(SELECT count(*) // 2 FROM {CUST_GROUPS} WHERE Age_Group = '60-69')"


@query("undersample", f"SELECT * FROM {_under_sql('60-69', HALF)}")
def q_undersample(spark, sf):
    groups = customer_groups(spark, sf)
    return R.undersample(groups, "Age_Group", "60-69", groups.where("Age_Group = '60-69'").count() // 2, "c_custkey", 1)


@query("oversample", f"SELECT * FROM {_over_sql('80 and above', 500)}")
def q_oversample(spark, sf):
    return R.oversample(customer_groups(spark, sf), "Age_Group", "80 and above", 500, "c_custkey", 1)


@query("balance_groups", f"""WITH sz AS (SELECT
 (SELECT count(*) FROM {CUST_GROUPS} WHERE Age_Group = '70-79') AS t,
 (SELECT count(*) FROM {CUST_GROUPS} WHERE Age_Group = '80 and above') AS e)
SELECT * FROM {CUST_GROUPS} WHERE Age_Group IS DISTINCT FROM '60-69'
UNION ALL SELECT c_custkey, age, Age_Group FROM (SELECT *, row_number() OVER (ORDER BY md5('1:' || c_custkey::VARCHAR),
 c_custkey) AS r FROM {CUST_GROUPS} WHERE Age_Group = '60-69') WHERE r <= (SELECT t FROM sz)
UNION ALL SELECT g.c_custkey, g.age, g.Age_Group FROM (SELECT range AS j FROM range((SELECT greatest(t - e, 0) FROM sz))) d,
 (SELECT *, row_number() OVER (ORDER BY md5('1:' || c_custkey::VARCHAR), c_custkey) AS r FROM {CUST_GROUPS}
  WHERE Age_Group = '80 and above') g
 WHERE g.r = ('0x' || substr(md5('1:' || d.j::VARCHAR), 1, 8))::BIGINT % (SELECT e FROM sz) + 1""")
def q_balance_groups(spark, sf):
    return R.balance_groups(customer_age(spark, sf).select("c_custkey", "age"), "age", "c_custkey")


# ------------------------------------------------------------------ evaluation (V1-V8)

@query("accuracy", "SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) AS accuracy FROM labels")
def q_accuracy(spark, sf):
    return V.accuracy(tb(spark, sf, "labels"), "quality", "toxic")


MODELS = ("XGBoost", "Random Forest", "Logistic Regression", "SVM")
PREDS = """(SELECT m.model, l.doc_id, l.quality AS y,
  CASE m.model WHEN 'XGBoost' THEN l.toxic WHEN 'Random Forest' THEN 1 - l.toxic
   WHEN 'Logistic Regression' THEN CAST(l.doc_id % 4 >= 2 AS INTEGER) ELSE CAST(d.n_chars % 3 = 0 AS INTEGER) END AS p,
  d.lang, d.source, CAST(l.doc_id % 2 = 0 AS DOUBLE) AS "SEX_0.0", CAST(l.doc_id % 2 = 1 AS DOUBLE) AS "SEX_1.0",
  CAST(l.doc_id % 60 AS DOUBLE) AS ENROLL_AGE
 FROM labels l JOIN documents d ON l.doc_id = d.doc_id
 CROSS JOIN (VALUES ('XGBoost'), ('Random Forest'), ('Logistic Regression'), ('SVM')) m(model))"""


def preds(spark, sf):
    j = tb(spark, sf, "labels").join(tb(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    p_of = {"XGBoost": F.col("toxic"), "Random Forest": 1 - F.col("toxic"),
            "Logistic Regression": (F.col("doc_id") % 4 >= 2).cast("int"),
            "SVM": (F.col("n_chars") % 3 == 0).cast("int")}
    models = F.array(*[F.struct(F.lit(m).alias("model"), p_of[m].alias("p")) for m in MODELS])
    return (j.select(F.explode(models).alias("m"), "doc_id", F.col("quality").alias("y"), "lang", "source")
            .select(F.col("m.model").alias("model"), "doc_id", "y", F.col("m.p").alias("p"), "lang", "source",
                    (F.col("doc_id") % 2 == 0).cast("double").alias("SEX_0.0"),
                    (F.col("doc_id") % 2 == 1).cast("double").alias("SEX_1.0"),
                    (F.col("doc_id") % 60).cast("double").alias("ENROLL_AGE")))  # one join, four models


@query("model_accuracies", f"SELECT model, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy FROM {PREDS} GROUP BY model")
def q_model_accuracies(spark, sf):
    return V.model_accuracies(preds(spark, sf), "y", "p")


@query("confusion_matrix", """WITH c AS (SELECT quality AS v FROM labels UNION SELECT toxic FROM labels)
SELECT a.v AS y_true, b.v AS y_pred, (SELECT count(*) FROM labels WHERE quality = a.v AND toxic = b.v) AS count
FROM c a, c b""")
def q_confusion_matrix(spark, sf):
    return V.confusion_matrix(tb(spark, sf, "labels"), "quality", "toxic")


REPORT_SQL = """WITH lab AS (SELECT quality AS t, toxic AS q FROM labels),
c AS (SELECT t AS v FROM lab UNION SELECT q FROM lab),
per AS (SELECT CAST(c.v AS VARCHAR) AS label, (SELECT count(*) FROM lab WHERE t = c.v) AS support,
  (SELECT count(*) FROM lab WHERE q = c.v) AS n_pred, (SELECT count(*) FROM lab WHERE t = c.v AND q = c.v) AS tp FROM c),
m AS (SELECT label, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)"""


@query("classification_report", REPORT_SQL + """
SELECT label, precision, recall, f1, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
 sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f""")
def q_classification_report(spark, sf):
    return V.classification_report(tb(spark, sf, "labels"), "quality", "toxic")


@query("f1_weighted", REPORT_SQL + " SELECT sum(f1 * support) / sum(support) AS f1_weighted FROM f")
def q_f1_weighted(spark, sf):
    return V.f1_weighted(tb(spark, sf, "labels"), "quality", "toxic")


@query("roc_curve", """WITH s AS (SELECT CAST(l_quantity AS DOUBLE) AS threshold, sum(CAST(l_linestatus = 'O' AS INTEGER)) AS pos,
 sum(CAST(l_linestatus <> 'O' AS INTEGER)) AS neg FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_quantity)
SELECT 'inf'::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL SELECT threshold, sum(neg) OVER (ORDER BY threshold DESC) / sum(neg) OVER () AS fpr,
 sum(pos) OVER (ORDER BY threshold DESC) / sum(pos) OVER () AS tpr FROM s""")
def q_roc_curve(spark, sf):
    return V.roc_curve(tb(spark, sf, "lineitem"), "l_linestatus", "l_quantity", "O")


AUC_SCORES = {"A": "l_quantity", "N": "l_discount", "R": "l_tax"}


def _roc_class_sql(cls, col):
    return f"""SELECT '{cls}' AS class, threshold,
 CASE WHEN sum(neg) OVER () > 0 THEN sum(neg) OVER (ORDER BY threshold DESC) / sum(neg) OVER () END AS fpr,
 CASE WHEN sum(pos) OVER () > 0 THEN sum(pos) OVER (ORDER BY threshold DESC) / sum(pos) OVER () END AS tpr
 FROM (SELECT CAST({col} AS DOUBLE) AS threshold, sum(CAST(l_returnflag = '{cls}' AS INTEGER)) AS pos,
  sum(CAST(l_returnflag <> '{cls}' AS INTEGER)) AS neg FROM lineitem WHERE {col} IS NOT NULL GROUP BY {col})
 UNION ALL SELECT '{cls}', 'inf'::DOUBLE, 0.0, 0.0"""


@query("roc_curves_ovr", _union([_roc_class_sql(c, s) for c, s in AUC_SCORES.items()]))
def q_roc_curves_ovr(spark, sf):
    return V.roc_curves_ovr(tb(spark, sf, "lineitem"), "l_returnflag", AUC_SCORES)


def _auc_sql(cls, col):
    return f"""SELECT '{cls}' AS class, CASE WHEN P > 0 AND N > 0 THEN (rs - P * (P + 1) / 2.0) / (P * N) END AS auc FROM (
 SELECT sum(CASE WHEN pos = 1 THEN rk END) AS rs, sum(pos) AS P, sum(1 - pos) AS N FROM (
  SELECT pos, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM (
   SELECT CAST({col} AS DOUBLE) AS s, CAST(l_returnflag = '{cls}' AS INTEGER) AS pos FROM lineitem WHERE {col} IS NOT NULL)))"""


@query("roc_auc_ovr", f"""WITH a AS ({_union([_auc_sql(c, s) for c, s in AUC_SCORES.items()])})
SELECT * FROM a UNION ALL SELECT 'mean', avg(auc) FROM a""")
def q_roc_auc_ovr(spark, sf):
    return V.roc_auc_ovr(tb(spark, sf, "lineitem"), "l_returnflag", AUC_SCORES)


def embeddings_frame(spark, sf, classes: int = 3):
    """Model input: the 64-float embedding as the feature vector, ``label % classes`` as target."""
    from cohort_spark.operators.models import assemble

    e = tb(spark, sf, "embeddings")
    return assemble(e.select("vec_id", (F.col("label") % classes).cast("double").alias("label"), "embedding"),
                    "embedding")


def model_split(spark, sf):
    from cohort_spark.operators.ordered import reliable

    s = R.split_column(embeddings_frame(spark, sf), "vec_id", 0.2, 42)
    s = reliable(s)
    return s.where("split = 'train'"), s.where("split = 'test'")


@query("evaluate_model")
def q_evaluate_model(spark, sf):
    from cohort_spark.operators.models import fit_logistic

    train, test = model_split(spark, sf)
    tables = V.evaluate_model(fit_logistic(train, "label", C=1.0), test, "label")
    parts = []
    for name, t in tables.items():  # all four tables, one cell a row
        named = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
        key = named.columns[:2] if name == "confusion" else named.columns[:1] if len(named.columns) > 1 else []
        cells = [c for c in named.columns if c not in key]
        parts.append(named.select(F.lit(name).alias("part"), F.concat_ws("|", *key).alias("row"), *cells).unpivot(["part", "row"], cells, "cell", "text")
                     .select("part", "row", "cell", F.col("text").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ fairness

LAB_DOC = "(SELECT l.*, d.lang, d.source FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def lab_doc(spark, sf):
    return tb(spark, sf, "labels").join(tb(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")


@query("demographic_parity_difference", f"SELECT max(sel) - min(sel) AS dp_diff FROM (SELECT lang, avg(toxic) AS sel FROM {LAB_DOC} GROUP BY lang)")
def q_dp(spark, sf):
    return B.demographic_parity_difference(lab_doc(spark, sf), "toxic", "lang")


@query("equalized_odds_difference", f"""SELECT greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS eo_diff FROM (
 SELECT lang, coalesce(avg(CASE WHEN quality = 1 THEN toxic END), 0.0) AS tpr,
 coalesce(avg(CASE WHEN quality = 0 THEN toxic END), 0.0) AS fpr FROM {LAB_DOC} GROUP BY lang)""")
def q_eo(spark, sf):
    return B.equalized_odds_difference(lab_doc(spark, sf), "quality", "toxic", "lang")


def _rates_sql(src, feature_sql, feature_name):
    return f"""SELECT model, cls, '{feature_name}' AS feature, CAST({feature_sql} AS VARCHAR) AS grp,
 avg(p_bin) AS sel, coalesce(avg(CASE WHEN y_bin = 1 THEN p_bin END), 0.0) AS tpr,
 coalesce(avg(CASE WHEN y_bin = 0 THEN p_bin END), 0.0) AS fpr,
 avg(CASE WHEN y_bin = p_bin THEN 1.0 ELSE 0.0 END) AS acc FROM {src} GROUP BY model, cls, grp"""


BIN_PREDS = f"""(SELECT x.*, c.cls, CAST(x.y = c.cls AS INTEGER) AS y_bin, CAST(x.p = c.cls AS INTEGER) AS p_bin
 FROM {PREDS} x, (SELECT DISTINCT quality AS cls FROM labels) c)"""


@query("fairness_by_group", f"""WITH r AS ({_union([_rates_sql(BIN_PREDS, f, f) for f in ("lang", "source")])}),
d AS (SELECT model, cls, feature, max(sel) - min(sel) AS dp_diff,
 greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS eo_diff FROM r GROUP BY model, cls, feature)
SELECT r.model, r.cls AS class, r.feature, r.grp AS "group", d.dp_diff, d.eo_diff, r.acc AS group_accuracy
FROM r JOIN d ON r.model = d.model AND r.cls = d.cls AND r.feature = d.feature""")
def q_fairness_by_group(spark, sf):
    return B.fairness_by_group(preds(spark, sf), "y", "p", ["lang", "source"])


AGE_BINNED = (f"(SELECT x.*, {_equal_width_case('ENROLL_AGE', 'r.lo', 'r.hi', 4)} AS ENROLL_AGE_BINNED FROM {PREDS} x, "
              f"(SELECT min(ENROLL_AGE) AS lo, max(ENROLL_AGE) AS hi FROM {PREDS}) r)")
BIN_AGE_PREDS = f"""(SELECT x.*, c.cls, CAST(x.y = c.cls AS INTEGER) AS y_bin, CAST(x.p = c.cls AS INTEGER) AS p_bin
 FROM {AGE_BINNED} x, (SELECT DISTINCT quality AS cls FROM labels) c)"""
BIAS_SQL = f"""WITH r AS ({_union([_rates_sql(BIN_AGE_PREDS, f'"{f}"', f) for f in ("SEX_0.0", "SEX_1.0", "ENROLL_AGE",
                                                                                    "ENROLL_AGE_BINNED")])}),
d AS (SELECT model, cls, feature, max(sel) - min(sel) AS dp_diff,
 greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS eo_diff FROM r GROUP BY model, cls, feature),
acc AS (SELECT model, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy FROM {PREDS} GROUP BY model),
bins AS (SELECT model, ENROLL_AGE_BINNED AS bin, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS slice_accuracy
 FROM {AGE_BINNED} GROUP BY model, ENROLL_AGE_BINNED),
report AS (
SELECT d.model, d.cls AS class, d.feature AS slice, acc.accuracy, d.dp_diff, d.eo_diff, acc.accuracy AS slice_accuracy
FROM d JOIN acc ON d.model = acc.model WHERE d.feature <> 'ENROLL_AGE_BINNED'
UNION ALL SELECT d.model, d.cls, 'AGE_' || bins.bin, acc.accuracy, d.dp_diff, d.eo_diff, bins.slice_accuracy
FROM d JOIN acc ON d.model = acc.model JOIN bins ON d.model = bins.model WHERE d.feature = 'ENROLL_AGE_BINNED')"""


def bias_frame(spark, sf):
    from cohort_spark.functions.scalar import cut_equal_width

    p = preds(spark, sf)
    return B.bias_report(cut_equal_width(p, "ENROLL_AGE", 4, "ENROLL_AGE_BINNED"), "y", "p",
                         ["SEX_0.0", "SEX_1.0", "ENROLL_AGE"], binned="ENROLL_AGE_BINNED")


@query("bias_report", BIAS_SQL + " SELECT * FROM report")
def q_bias_report(spark, sf):
    return bias_frame(spark, sf)


RANK_SQL = BIAS_SQL + """,
ranking AS (SELECT acc.model AS model_name, acc.accuracy, coalesce(pen.penalty, 0.0) AS penalty,
 acc.accuracy - 0.7 * coalesce(pen.penalty, 0.0) AS score,
 CASE WHEN upper(acc.model) LIKE '%XGB%' OR upper(acc.model) LIKE '%BOOST%' THEN 'xgboost'
  WHEN upper(acc.model) LIKE '%RF%' OR upper(acc.model) LIKE '%FOREST%' THEN 'random_forest'
  WHEN upper(acc.model) LIKE '%LR%' OR upper(acc.model) LIKE '%LOGISTIC%' THEN 'logistic_regression'
  WHEN upper(acc.model) LIKE '%SVM%' THEN 'svm' END AS model_type
 FROM acc LEFT JOIN (SELECT model, avg(abs(dp_diff) + abs(eo_diff)) AS penalty FROM report GROUP BY model) pen
 ON acc.model = pen.model)"""


def ranking_frame(spark, sf):
    p = preds(spark, sf)
    return B.model_ranking(V.model_accuracies(p, "y", "p"), bias_frame(spark, sf))


@query("model_ranking", RANK_SQL + " SELECT * FROM ranking")
def q_model_ranking(spark, sf):
    return ranking_frame(spark, sf)


@query("select_best", RANK_SQL + " SELECT * FROM ranking ORDER BY score DESC, model_name LIMIT 1")
def q_select_best(spark, sf):
    return B.select_best(ranking_frame(spark, sf))


# ------------------------------------------------------------------ drift

def returnflag_ab(spark, sf):
    li = tb(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    return li.where("l_returnflag = 'R'"), li.where("l_returnflag <> 'R'")


def _ks_sql(col):
    return f"""SELECT '{col}' AS "column", D AS statistic,
 CASE WHEN lam <= 0 THEN 1.0 WHEN lam < 1.2 THEN least(greatest(1.0 - sqrt(2 * pi()) / lam * list_sum(list_transform(range(1, 40),
   lambda k: exp(-((2 * k - 1) ^ 2) * pi() ^ 2 / (8 * lam * lam)))), 0.0), 1.0) ELSE least(greatest(list_sum(list_transform(range(1, 40),
   lambda k: 2.0 * pow(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam))), 0.0), 1.0) END AS p_value,
 CAST(tot_a AS BIGINT) AS n_a, CAST(tot_b AS BIGINT) AS n_b FROM (
 SELECT max(abs(ca / tot_a - cb / tot_b)) AS D, any_value(tot_a) AS tot_a, any_value(tot_b) AS tot_b,
        sqrt(any_value(tot_a) * any_value(tot_b) / (any_value(tot_a) + any_value(tot_b))) * max(abs(ca / tot_a - cb / tot_b)) AS lam FROM (
  SELECT v, sum(na) OVER (ORDER BY v) AS ca, sum(nb) OVER (ORDER BY v) AS cb, sum(na) OVER () AS tot_a, sum(nb) OVER () AS tot_b
  FROM (SELECT CAST({col} AS DOUBLE) AS v, sum(CAST(l_returnflag = 'R' AS INTEGER)) AS na,
   sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS nb FROM lineitem WHERE {col} IS NOT NULL AND l_returnflag IS NOT NULL
   GROUP BY {col})))"""


@query("ks_drift", "SELECT *, p_value < 0.05 AS drift FROM (" + _union([_ks_sql(c) for c in ("l_extendedprice", "l_quantity")]) + ")")
def q_ks_drift(spark, sf):
    a, b = returnflag_ab(spark, sf)
    return C.ks_drift(a, b, ["l_extendedprice", "l_quantity"], exact_up_to=0)


KS_SMALL = """WITH RECURSIVE s AS (SELECT s_acctbal AS v, s_nationkey % 3 = 0 AS a FROM supplier WHERE s_acctbal IS NOT NULL AND s_nationkey IS NOT NULL),
n AS (SELECT count(*) FILTER (a) AS m, count(*) FILTER (NOT a) AS n FROM s),
d AS (SELECT max(abs(ca / m - cb / n)) AS d FROM (SELECT sum(CAST(a AS INTEGER)) OVER w AS ca, sum(CAST(NOT a AS INTEGER)) OVER w AS cb FROM s WINDOW w AS (ORDER BY v)), n),
walk(t, i, p) AS (
 SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS DOUBLE)
 UNION ALL SELECT t, i, sum(p) FROM (
  SELECT w.t + 1 AS t, w.i + x.up AS i, w.p * CASE WHEN x.up = 1 THEN n.m - w.i ELSE n.n - (w.t - w.i) END / (n.m + n.n - w.t) AS p
  FROM walk AS w, n, (VALUES (0), (1)) AS x(up) WHERE w.t < n.m + n.n) AS step, n, d
 WHERE i <= m AND t - i <= n AND abs(i / m - (t - i) / n) < d - 1e-9 GROUP BY t, i)
SELECT 's_acctbal' AS "column", d AS statistic, 1 - coalesce((SELECT sum(p) FROM walk, n WHERE t = m + n), 0) AS p_value,
 m AS n_a, n AS n_b, 1 - coalesce((SELECT sum(p) FROM walk, n WHERE t = m + n), 0) < 0.05 AS drift FROM d, n"""


@query("ks_drift_exact", KS_SMALL)
def q_ks_drift_exact(spark, sf):
    """Samples small enough for the exact p-value."""
    s = tb(spark, sf, "supplier")
    return C.ks_drift(s.where(F.col("s_nationkey") % 3 == 0), s.where(F.col("s_nationkey") % 3 != 0), ["s_acctbal"])


EV_COUNTS = """(SELECT event_type AS value, sum(CAST(ts < TIMESTAMP '2024-01-16' AS INTEGER)) AS na,
 sum(CAST(ts >= TIMESTAMP '2024-01-16' AS INTEGER)) AS nb FROM events WHERE event_type IS NOT NULL GROUP BY event_type)"""
EV_TOT = f"(SELECT sum(na) AS tot_a, sum(nb) AS tot_b, count(*) AS r FROM {EV_COUNTS})"
CHI2_SQL = f"""SELECT sum((na - (na + nb) * tot_a / (tot_a + tot_b)) ^ 2 / ((na + nb) * tot_a / (tot_a + tot_b))
 + (nb - (na + nb) * tot_b / (tot_a + tot_b)) ^ 2 / ((na + nb) * tot_b / (tot_a + tot_b))) AS statistic, any_value(r) - 1 AS dof,
 any_value(tot_a + tot_b) AS N, any_value(r) AS r FROM {EV_COUNTS}, {EV_TOT}"""


#: Five event types give four degrees of freedom, for which the upper tail has this closed form.
CHI2_P = "exp(-statistic / 2) * (1 + statistic / 2)"


@query("chi2_drift", f"SELECT 'event_type' AS \"column\", statistic, dof, {CHI2_P} AS p_value, {CHI2_P} < 0.05 AS drift FROM ({CHI2_SQL})")
def q_chi2_drift(spark, sf):
    a, b = events_ab(spark, sf)
    return C.chi2_drift(a, b, ["event_type"])


@query("drift_report")
def q_drift_report(spark, sf):
    a, b = events_ab(spark, sf)
    cols = ["value", "user_id", "event_type"]
    per, summary = C.drift_report(a.select(*cols), b.select(*cols))
    return per.unionByName(summary.select(F.lit("(dataset)").alias("column"), F.lit("share").alias("test"), F.col("share_drifted").alias("statistic"),
                                          F.lit(None).cast("double").alias("p_value"), F.col("dataset_drift").alias("drift"),
                                          F.lit(None).cast("double").alias("distance")))


@query("feature_drift_score", f"""SELECT "column", 'ks' AS method, statistic AS score FROM (
 SELECT 'value' AS "column", max(abs(ca / tot_a - cb / tot_b)) AS statistic FROM (
  SELECT v, sum(na) OVER (ORDER BY v) AS ca, sum(nb) OVER (ORDER BY v) AS cb, sum(na) OVER () AS tot_a, sum(nb) OVER () AS tot_b
  FROM (SELECT value AS v, sum(CAST(ts < TIMESTAMP '2024-01-16' AS INTEGER)) AS na,
   sum(CAST(ts >= TIMESTAMP '2024-01-16' AS INTEGER)) AS nb FROM events WHERE value IS NOT NULL GROUP BY value)))
UNION ALL SELECT 'event_type', 'cramer_v', CASE WHEN r > 1 THEN sqrt(statistic / N) ELSE 0.0 END FROM ({CHI2_SQL})
UNION ALL SELECT 'event_type', 'psi', sum((greatest(nb / tot_b, 0.0001) - greatest(na / tot_a, 0.0001))
 * ln(greatest(nb / tot_b, 0.0001) / greatest(na / tot_a, 0.0001))) FROM {EV_COUNTS}, {EV_TOT}""")
def q_feature_drift_score(spark, sf):
    a, b = events_ab(spark, sf)
    return C.feature_drift_score(a, b, ["value"], ["event_type"])


@query("compare_distributions", "SELECT 'a' AS dataset, * FROM " + _hist_sql("events", "value", 30, "ts < TIMESTAMP '2024-01-16'")
       + " UNION ALL SELECT 'b', * FROM " + _hist_sql("events", "value", 30, "ts >= TIMESTAMP '2024-01-16'"))
def q_compare_distributions(spark, sf):
    a, b = events_ab(spark, sf)
    return C.compare_distributions(a, b, "value", 30)


# ------------------------------------------------------------------ models (L1-L7, X1, X2) — rows-only

@query("fit_logistic")
def q_fit_logistic(spark, sf):
    from cohort_spark.operators.models import fit_logistic, predict_batch

    train, test = model_split(spark, sf)
    return predict_batch(fit_logistic(train, "label", C=1.0), test, ["vec_id", "label"]).drop("probability")


@query("fit_random_forest")
def q_fit_random_forest(spark, sf):
    from cohort_spark.operators.models import fit_random_forest, predict_batch

    train, test = model_split(spark, sf)
    return predict_batch(fit_random_forest(train, "label", n_trees=20, max_depth=5), test, ["vec_id", "label"]).drop(
        "probability")


@query("fit_boosted_trees")
def q_fit_boosted_trees(spark, sf):
    from cohort_spark.operators.models import fit_boosted_trees, predict_batch

    train, test = model_split(spark, sf)
    return predict_batch(fit_boosted_trees(train, "label", max_depth=3, n_iter=10), test, ["vec_id", "label"])


@query("fit_softmax_trees")
def q_fit_softmax_trees(spark, sf):
    from cohort_spark.operators.boosting import fit_softmax_trees
    from cohort_spark.operators.models import predict_batch

    train, test = model_split(spark, sf)
    return predict_batch(fit_softmax_trees(train, "label", max_depth=3, step=0.3, n_iter=20), test, ["vec_id", "label"]).drop("probability")


@query("fit_svm")
def q_fit_svm(spark, sf):
    from cohort_spark.operators.models import fit_svm, predict_batch

    train, test = model_split(spark, sf)
    lin = predict_batch(fit_svm(train, "label", C=1.0, kernel="linear", max_iter=50), test, ["vec_id", "label"])
    rbf = predict_batch(fit_svm(train, "label", C=1.0, kernel="rbf", max_iter=50), test, ["vec_id", "label"])
    return (lin.select("vec_id", "label", F.col("prediction").alias("linear"))
            .join(rbf.select("vec_id", F.col("prediction").alias("rbf")), "vec_id"))


@query("grid_search")
def q_grid_search(spark, sf):
    from pyspark.ml.classification import LogisticRegression

    from cohort_spark.operators.models import grid_search

    train, test = model_split(spark, sf)
    est = LogisticRegression(labelCol="label", elasticNetParam=0.0, standardization=False, maxIter=50)
    cv = grid_search(est, {est.regParam: [0.001, 0.01, 0.1]}, train, "label", folds=3, stratify_key="vec_id")
    return cv.bestModel.transform(test).select("vec_id", "label", "prediction")


@query("param_sweep")
def q_param_sweep(spark, sf):
    from pyspark.ml.classification import RandomForestClassifier

    from cohort_spark.operators.models import param_sweep

    train, test = model_split(spark, sf)
    return param_sweep(lambda v: RandomForestClassifier(labelCol="label", numTrees=int(v), maxDepth=5, seed=42),
                       [5, 10, 20], train, test, "label", "n_trees")


@query("predict_batch")
def q_predict_batch(spark, sf):
    from pyspark.ml.functions import vector_to_array

    from cohort_spark.operators.models import fit_logistic, predict_batch

    train, test = model_split(spark, sf)
    out = predict_batch(fit_logistic(train, "label"), test, ["vec_id"])
    return out.withColumn("probability", vector_to_array("probability"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    from cohort_spark.operators.models import feature_importance, fit_random_forest

    train, _ = model_split(spark, sf)
    return feature_importance(fit_random_forest(train, "label", n_trees=20, max_depth=5), [f"e{i}" for i in range(64)])


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    from cohort_spark.operators.models import assemble, fit_logistic, permutation_importance

    e = tb(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = e.select("vec_id", (F.col("label") % 3).cast("double").alias("label"),
                    *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    model = fit_logistic(assemble(wide, names), "label")
    return permutation_importance(model, wide, names, "label", "vec_id")


@query("lda_embeddings")
def q_lda_embeddings(spark, sf):
    from cohort_spark.operators.encode import lda_project

    e = tb(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = e.select("vec_id", (F.col("label") % 3).alias("label"),
                    *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return lda_project(wide, names, "label")


# ------------------------------------------------------------------ flows W3, W4

def _feature_flow_sql():
    from cohort_spark.plans.q_basic import W1_SQL
    from cohort_spark.plans.q_stats import PRIORITIES

    prio_mode = ("(SELECT v FROM (SELECT o_orderpriority AS v, count(*) AS c FROM w1 WHERE o_orderpriority IS NOT NULL "
                 "GROUP BY o_orderpriority) ORDER BY c DESC, v LIMIT 1)")
    scaled = [f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END AS {c}"
              for c in ("c_acctbal", "c_nationkey", "o_totalprice")]
    hot = ([f"coalesce(CAST(CAST(n_regionkey AS DOUBLE) = {g}.0 AS DOUBLE), 0.0) AS \"n_regionkey_{g}.0\"" for g in range(5)]
           + [f"coalesce(CAST(o_orderpriority = '{v}' AS DOUBLE), 0.0) AS \"o_orderpriority_{v}\"" for v in PRIORITIES])
    return f"""WITH w1 AS ({W1_SQL}),
x AS (SELECT Participant_ID, c_acctbal, c_nationkey, n_name, n_regionkey, c_mktsegment,
 CASE WHEN (SELECT avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END) FROM w1) < 0.05
  THEN coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM w1)) ELSE o_totalprice END AS o_totalprice,
 CASE WHEN (SELECT avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) FROM w1) < 0.05
  THEN coalesce(o_orderpriority, {prio_mode}) ELSE o_orderpriority END AS o_orderpriority FROM w1)
SELECT {", ".join(scaled)}, {", ".join(hot)}, Participant_ID, n_name, c_mktsegment FROM x"""


@query("feature_flow", _feature_flow_sql())
def q_feature_flow(spark, sf):
    from cohort_spark.plans.q_basic import participant_flow_q, q_assessment_flow

    out, _ = flows.feature_flow(participant_flow_q(spark, sf), key="Participant_ID", label="c_mktsegment",
                                id_cols=["o_orderkey", "o_orderdate"], forms=q_assessment_flow(spark, sf))
    return out


#: One or two settings per classifier, given by this caller to end in minutes; the flow's default grids are the full ones.
SMALL_GRIDS = {"Logistic Regression": {"C": (0.1, 1.0), "max_iter": (50,)}, "Random Forest": {"trees": (20,), "depths": (5,), "min_leaf": (1,)},
               "XGBoost": {"depths": (3,), "steps": (0.1,), "iters": (5,), "subsamples": (1.0,)},
               "SVM": {"Cs": (1.0,), "kernels": ("linear",), "gammas": ("scale",), "max_iter": 10}}


@query("model_flow")
def q_model_flow(spark, sf):
    e = tb(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = e.select("vec_id", (F.col("label") % 3).alias("COHORT"),
                    *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)],
                    (F.col("vec_id") % 2 == 0).cast("double").alias("SEX_0.0"),
                    (F.col("vec_id") % 2 == 1).cast("double").alias("SEX_1.0"),
                    (40 + F.col("vec_id") % 45).cast("double").alias("ENROLL_AGE"))
    res = flows.model_flow(wide, key="vec_id", label="COHORT", features=names, sensitive=["SEX_0.0", "SEX_1.0"],
                           age="ENROLL_AGE", grids=SMALL_GRIDS, folds=2)
    return res["ranking"]


@query("score_records")
def q_score_records(spark, sf):
    """Text records from lineitem scored by a logistic model fitted on their parsed, scaled form."""
    from cohort_spark.functions.scalar import parse_feature_record
    from cohort_spark.operators.encode import apply_preprocessor, fit_preprocessor
    from cohort_spark.operators.models import assemble, fit_logistic
    from cohort_spark.session import scratch_path
    from cohort_spark.sources import load_preprocessor, save_preprocessor

    li = tb(spark, sf, "lineitem")
    names = ["quantity", "extendedprice", "discount", "tax"]
    rec = li.select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("double").alias("label"),
                    F.concat_ws(", ", "l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("record"))
    parsed = parse_feature_record(rec, "record", names)
    pre = fit_preprocessor(parsed, names, [])
    pre = load_preprocessor(spark, save_preprocessor(spark, pre, scratch_path(spark, "record_preprocessor")))
    model = fit_logistic(assemble(apply_preprocessor(parsed, pre, impute=False), names), "label", C=1.0, max_iter=20)
    return flows.score_records(rec, "record", names, pre, model, ["l_orderkey", "l_linenumber", "label"]).drop(
        "probability")
