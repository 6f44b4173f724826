"""Evaluation (V1-V8) over prediction tables.

Every metric is an aggregate over a table of (label, prediction[, score]) rows;
curves and areas use distinct-score counts and distributed running sums, so no
task sorts the whole prediction table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.operators.ordered import cumulative_sums
from cohort_spark.operators.stats import hit_rate

MAX_CLASSES = 1000


def accuracy(df: DataFrame, y: str, p: str) -> DataFrame:
    """V1: share of labelled rows with prediction equal to label (a missing prediction is a miss)."""
    return df.agg(hit_rate(y, p).alias("accuracy"))


def model_accuracies(preds: DataFrame, y: str, p: str, model: str = "model") -> DataFrame:
    """V2: accuracy per model of a stacked prediction table."""
    return preds.groupBy(qcol(model)).agg(hit_rate(y, p).alias("accuracy"))


def class_labels(df: DataFrame, y: str, p: str) -> list:
    """Sorted labels seen as truth or prediction (bounded)."""
    vals = (df.select(qcol(y).alias("v")).union(df.select(qcol(p).alias("v"))).where("v IS NOT NULL")
            .distinct().limit(MAX_CLASSES + 1).collect())
    if len(vals) > MAX_CLASSES:
        raise ValueError("too many classes")
    return sorted(r[0] for r in vals)


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence | None = None) -> DataFrame:
    """V3: ``(y_true, y_pred, count)`` for every pair of labels, zero cells included."""
    labels = list(labels) if labels is not None else class_labels(df, y, p)
    spark = df.sparkSession
    counts = df.groupBy(qcol(y).alias("y_true"), qcol(p).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], counts.schema[:2])  # classes² cells
    return (grid.join(counts, ["y_true", "y_pred"], "left")
            .select("y_true", "y_pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("count")))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """V4: per class precision, recall, F1 and support, then ``accuracy``, ``macro avg`` and
    ``weighted avg`` rows; an empty denominator gives 0."""
    per = (df.select(qcol(y).alias("t"), qcol(p).alias("q"))
           .select(F.explode(F.array(F.struct(F.col("t").alias("label"), F.lit(1).alias("is_true"), F.lit(0).alias("is_pred"),
                                              (F.col("t") == F.col("q")).cast("int").alias("hit")),
                                     F.struct(F.col("q").alias("label"), F.lit(0).alias("is_true"), F.lit(1).alias("is_pred"),
                                              F.lit(0).alias("hit")))).alias("s"))
           .select("s.*").where("label IS NOT NULL")
           .groupBy("label").agg(F.sum("is_true").alias("support"), F.sum("is_pred").alias("n_pred"),
                                 F.sum("hit").alias("tp")))
    per = per.select(
        F.col("label").cast("string").alias("label"),
        _safe_div(F.col("tp"), F.col("n_pred")).alias("precision"),
        _safe_div(F.col("tp"), F.col("support")).alias("recall"),
        F.col("support").cast("bigint").alias("support"), "tp")
    per = per.withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                 F.col("n").cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), (F.col("wp") / F.col("n")).alias("precision"),
                 (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                 F.col("n").cast("bigint").alias("support")))).alias("s")).select("s.*")
    return per.select("label", "precision", "recall", "f1", "support").unionByName(summary)


def f1_weighted(df: DataFrame, y: str, p: str) -> DataFrame:
    """V7: support-weighted F1."""
    rep = classification_report(df, y, p)
    return rep.where("label = 'weighted avg'").select(F.col("f1").alias("f1_weighted"))


def roc_curve(df: DataFrame, y: str, score: str, pos_label=1, drop_intermediate: bool = False) -> DataFrame:
    """V5: ``(threshold, fpr, tpr)`` at every distinct score (descending), starting at
    (+inf, 0, 0). ``drop_intermediate`` removes points collinear with their neighbours (equal
    positive and negative counts at the next threshold), as the usual ROC routine does by default;
    each row's neighbour comes with the running sums, not from a global window."""
    spark = df.sparkSession
    base = df.where(qcol(score).isNotNull()).select(
        qcol(score).cast("double").alias("threshold"), (qcol(y) == F.lit(pos_label)).cast("long").alias("pos"))
    per = base.groupBy("threshold").agg(F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg"))
    P, N = per.agg(F.sum("pos"), F.sum("neg")).collect()[0]
    cum = cumulative_sums(per, [], [F.col("threshold").desc()], ["pos", "neg"], lead=["pos", "neg"])
    if drop_intermediate:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        cum = cum.where(first | F.col("next_pos").isNull() | (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg")))
    pts = cum.select("threshold", (F.col("cum_neg") / F.lit(float(N))).alias("fpr") if N else F.lit(None).alias("fpr"),
                     (F.col("cum_pos") / F.lit(float(P))).alias("tpr") if P else F.lit(None).alias("tpr"))
    start = spark.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def roc_curves_ovr(df: DataFrame, y: str, scores: dict) -> DataFrame:
    """V5 per class: ``(class, threshold, fpr, tpr)`` one-vs-rest, each class scored by its own
    column (``scores`` maps class label -> score column); every distinct score of a class is a
    threshold, preceded by (+inf, 0, 0). Running sums per class are distributed."""
    spark = df.sparkSession
    parts = [df.select(F.lit(str(c)).alias("cls"), qcol(s).cast("double").alias("threshold"),
                       (qcol(y) == F.lit(c)).cast("long").alias("pos")) for c, s in scores.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    per = (long.where("threshold IS NOT NULL").groupBy("cls", "threshold")
           .agg(F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg")))
    cum = cumulative_sums(per, ["cls"], [F.col("threshold").desc()], ["pos", "neg"])
    tot = per.groupBy("cls").agg(F.sum("pos").alias("tot_pos"), F.sum("neg").alias("tot_neg"))
    pts = cum.join(F.broadcast(tot), "cls").select(  # one row per class
        
        F.col("cls").alias("class"), "threshold",
        F.when(F.col("tot_neg") > 0, F.col("cum_neg") / F.col("tot_neg")).alias("fpr"),
        F.when(F.col("tot_pos") > 0, F.col("cum_pos") / F.col("tot_pos")).alias("tpr"))
    start = spark.createDataFrame([(str(c), float("inf"), 0.0, 0.0) for c in scores],
                                  "class string, threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def roc_auc_ovr(df: DataFrame, y: str, scores: dict) -> DataFrame:
    """V6: area under the ROC curve per class (one-vs-rest) by the average-rank formula, plus
    a ``mean`` row. ``scores`` maps class label -> score column."""
    parts = [df.select(F.lit(str(c)).alias("cls"), qcol(s).cast("double").alias("score"),
                       (qcol(y) == F.lit(c)).cast("long").alias("pos")) for c, s in scores.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    per = (long.where("score IS NOT NULL").groupBy("cls", "score")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("npos")))
    cum = cumulative_sums(per, ["cls"], ["score"], ["n"])
    ranked = cum.withColumn("avg_rank", (F.col("cum_n") - F.col("n")) + (F.col("n") + 1) / 2.0)
    agg = ranked.groupBy("cls").agg(F.sum(F.col("npos") * F.col("avg_rank")).alias("rs"),
                                    F.sum("npos").alias("P"), F.sum(F.col("n") - F.col("npos")).alias("N"))
    auc = agg.select(F.col("cls").alias("class"),
                     F.when((F.col("P") > 0) & (F.col("N") > 0),
                            (F.col("rs") - F.col("P") * (F.col("P") + 1) / 2.0) / (F.col("P") * F.col("N")))
                     .alias("auc"))
    mean = auc.agg(F.lit("mean").alias("class"), F.avg("auc").alias("auc"))
    return auc.unionByName(mean)


def evaluate_model(model, df: DataFrame, label: str, features_col: str = "features") -> dict[str, DataFrame]:
    """V8: accuracy, confusion matrix, classification report and (when the model gives class
    probabilities) one-vs-rest AUC on a held-out table."""
    from pyspark.ml.functions import vector_to_array

    pred = model.transform(df.select(qcol(label), qcol(features_col)))  # plain names only reach the model
    out = {"accuracy": accuracy(pred, label, "prediction"),
           "confusion": confusion_matrix(pred, label, "prediction"),
           "report": classification_report(pred, label, "prediction")}
    if "probability" in pred.columns:
        classes = class_labels(pred, label, label)
        pa = pred.withColumn("_p", vector_to_array("probability"))
        pa = pa.select(label, *[F.col("_p")[int(c)].alias(f"_s{int(c)}") for c in classes])
        out["auc"] = roc_auc_ovr(pa, label, {c: f"_s{int(c)}" for c in classes})
    return out
