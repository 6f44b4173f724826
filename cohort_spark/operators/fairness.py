"""Group fairness, bias report and model ranking (B1-B6, A12 per slice).

All measures are grouped aggregates of a prediction table: selection rate,
true- and false-positive rates per sensitive group, then max − min across
groups. One table of counts by (model, feature, group, label, prediction) serves
every class at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.functions.scalar import model_family, slice_label
from cohort_spark.operators.stats import hit_rate


def _rates(df: DataFrame, keys: Sequence[str], y: str | Column, p: str | Column, group: str | Column) -> DataFrame:
    yc = qcol(y) if isinstance(y, str) else y
    pc = qcol(p) if isinstance(p, str) else p
    g = qcol(group) if isinstance(group, str) else group
    return (df.select(*keys, g.alias("_grp"), yc.cast("double").alias("_y"), pc.cast("double").alias("_p"))
            .groupBy(*keys, "_grp")
            .agg(F.avg("_p").alias("sel"),
                 F.coalesce(F.avg(F.when(F.col("_y") == 1, F.col("_p"))), F.lit(0.0)).alias("tpr"),
                 F.coalesce(F.avg(F.when(F.col("_y") == 0, F.col("_p"))), F.lit(0.0)).alias("fpr"),
                 F.avg(F.when(F.col("_y").isNotNull(), F.col("_y").eqNullSafe(F.col("_p")).cast("double"))).alias("acc")))


def _between(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rates.groupBy(*keys).agg(
        (F.max("sel") - F.min("sel")).alias("dp_diff"),
        F.greatest(F.max("tpr") - F.min("tpr"), F.max("fpr") - F.min("fpr")).alias("eo_diff"))


def demographic_parity_difference(df: DataFrame, p: str, group: str) -> DataFrame:
    """B1: max − min selection rate (mean of the 0/1 prediction) across groups."""
    r = _rates(df, [], F.lit(0), p, group)
    return r.agg((F.max("sel") - F.min("sel")).alias("dp_diff"))


def equalized_odds_difference(df: DataFrame, y: str, p: str, group: str) -> DataFrame:
    """B2: the larger of the TPR range and the FPR range across groups (a group without
    positives or negatives contributes a rate of 0)."""
    r = _rates(df, [], y, p, group)
    return r.agg(F.greatest(F.max("tpr") - F.min("tpr"), F.max("fpr") - F.min("fpr")).alias("eo_diff"))


def _classes(preds: DataFrame, y: str, limit: int = 1000) -> list:
    """Sorted class labels of the truth column (bounded)."""
    vals = [r[0] for r in preds.select(qcol(y)).where(qcol(y).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError("too many classes")
    return sorted(vals)


def _class_rates(preds: DataFrame, y: str, p: str, features: Sequence[str], model: str, classes: Sequence) -> DataFrame:
    """Rates per (model, cls, feature, group) from one table of counts: the rows are counted by model, feature,
    group, label and prediction (map-side combined), and only those counts are copied per class."""
    counts = (preds.select(qcol(model).alias("_m"), qcol(y).alias("_y"), qcol(p).alias("_p"),
                           F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), qcol(f).cast("string").alias("grp")) for f in features])).alias("s"))
              .groupBy("_m", F.col("s.feature").alias("feature"), F.col("s.grp").alias("_grp"), "_y", "_p").agg(F.count(F.lit(1)).alias("n")))
    b = (counts.withColumn("cls", F.explode(F.array(*[F.lit(c) for c in classes])))
         .withColumn("y", F.col("_y") == F.col("cls"))
         .withColumn("p", F.col("_p").eqNullSafe(F.col("cls"))))  # a missing prediction is in no class

    def share(hit: Column, of: Column) -> Column:
        return F.try_divide(F.sum(F.when(of & hit, F.col("n")).otherwise(0)), F.sum(F.when(of, F.col("n")).otherwise(0)))

    every = F.lit(True)
    return (b.groupBy("_m", "cls", "feature", "_grp")
            .agg(share(F.col("p"), every).alias("sel"), F.coalesce(share(F.col("p"), F.col("y")), F.lit(0.0)).alias("tpr"),
                 F.coalesce(share(F.col("p"), ~F.col("y")), F.lit(0.0)).alias("fpr"),
                 share(F.col("y") == F.col("p"), F.col("y").isNotNull()).alias("acc"))
            .withColumnRenamed("_m", model))


def fairness_by_group(preds: DataFrame, y: str, p: str, features: Sequence[str], model: str = "model",
                      classes: Sequence | None = None) -> DataFrame:
    """Per model, class (one-vs-rest) and sensitive feature: ``dp_diff``, ``eo_diff`` and the
    accuracy of each group ``(…, group, group_accuracy)``."""
    classes = list(classes) if classes is not None else _classes(preds, y)
    rates = _class_rates(preds, y, p, features, model, classes)
    diffs = _between(rates, [model, "cls", "feature"])
    return (rates.join(diffs, [model, "cls", "feature"])
            .select(model, F.col("cls").alias("class"), "feature", F.col("_grp").alias("group"),
                    "dp_diff", "eo_diff", F.col("acc").alias("group_accuracy")))


def bias_report(preds: DataFrame, y: str, p: str, features: Sequence[str], binned: str | None = None,
                model: str = "model", classes: Sequence | None = None, slice_prefix: str = "AGE_") -> DataFrame:
    """Per model × class × sensitive feature, ``dp_diff`` and ``eo_diff`` on one-vs-rest
    labels. ``accuracy`` is the model's overall (multi-class) accuracy in every row, as in the
    workflow; the binned feature yields one row per distinct bin (``slice = AGE_<bin>``) with the
    feature-level differences repeated. ``slice_accuracy`` adds the accuracy inside the slice
    (bin rows) or the overall accuracy (feature rows)."""
    classes = list(classes) if classes is not None else _classes(preds, y)
    feats = list(features) + ([binned] if binned else [])
    diffs = _between(_class_rates(preds, y, p, feats, model, classes), [model, "cls", "feature"])
    acc = preds.groupBy(model).agg(hit_rate(y, p).alias("accuracy"))
    plain = (diffs.where(F.col("feature") != F.lit(binned)) if binned else diffs).select(
        model, "cls", F.col("feature").alias("slice"), "dp_diff", "eo_diff").join(acc, model)
    plain = plain.withColumn("slice_accuracy", F.col("accuracy"))
    if not binned:
        out = plain
    else:
        bins = preds.groupBy(model, qcol(binned).cast("string").alias("_bin")).agg(
            hit_rate(y, p).alias("slice_accuracy"))
        rows = (diffs.where(F.col("feature") == F.lit(binned)).join(bins, model).join(acc, model)
                .select(model, "cls", slice_label(F.col("_bin"), slice_prefix).alias("slice"), "dp_diff", "eo_diff",
                        "accuracy", "slice_accuracy"))
        out = plain.unionByName(rows)
    return out.select(model, F.col("cls").alias("class"), "slice", "accuracy", "dp_diff", "eo_diff", "slice_accuracy")


def model_ranking(accuracies: DataFrame, report: DataFrame, model: str = "model", weight: float = 0.7) -> DataFrame:
    """score = accuracy − weight · mean(|dp_diff| + |eo_diff|) over the model's report rows
    (0 penalty without rows); family from the name; best first."""
    pen = report.groupBy(model).agg(F.avg(F.abs("dp_diff") + F.abs("eo_diff")).alias("penalty"))
    r = accuracies.join(pen, model, "left").withColumn("penalty", F.coalesce("penalty", F.lit(0.0)))
    return (r.select(F.col(model).alias("model_name"), "accuracy", "penalty",
                     (F.col("accuracy") - weight * F.col("penalty")).alias("score"),
                     model_family(F.col(model)).alias("model_type"))
            .orderBy(F.col("score").desc(), F.col("model_name")))


def select_best(ranking: DataFrame) -> DataFrame:
    """The top row of the ranking; an empty ranking is an error."""
    best = ranking.orderBy(F.col("score").desc(), F.col("model_name")).limit(1)
    if not best.take(1):
        raise ValueError("Model ranking is empty")
    return best
