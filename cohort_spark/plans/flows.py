"""End-to-end flows (W1-W5) as plain functions over DataFrames.

W1, W2 and W5 are lazy plans; W3 and W4 checkpoint their input and run jobs while they fit. The data
workflow's table boundaries become Parquet stages only where the caller asks for them
(:func:`cohort_spark.sources.stage_table`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_spark.functions.names import qcol
from cohort_spark.functions.scalar import parse_date
from cohort_spark.operators.columns import drop_repeated_columns, drop_strict, filter_eq, filter_isin, rename_key
from cohort_spark.operators.dedup import earliest_per_key
from cohort_spark.operators.joins import join_inner_suffix, join_left_dropkey, union_by_name


def participant_flow(status: DataFrame, demographics: DataFrame, visits: DataFrame, *,
                     key: str = "PATNO", new_key: str = "Participant_ID",
                     status_col: str = "ENROLL_STATUS", valid_status: Sequence[str] = ("Enrolled", "Complete", "Withdrew"),
                     status_drop: Sequence[str] = (), demo_drop: Sequence[str] = (), joined_drop: Sequence[str] = (),
                     visit_col: str = "CLINICAL_EVENT", visit_value: str | None = "BL", visit_ts: str = "RUNDATE",
                     visit_tie: Sequence[str] = (), visit_drop: Sequence[str] = (),
                     date_col: str | None = None, date_fmt: str = "MM/yyyy") -> DataFrame:
    """Status ⋈ demographics (J1), status filter (P4), earliest baseline visit per
    participant (P5, D1), left join (J2), projections (P1).

    Plan notes: the visit side is reduced to one row per key *before* the join
    (a map-side-combined aggregate), and the status filter is pushed to the
    scan by Catalyst; both joins are on the participant key, so the reduced
    visit table's hash partitioning is reused by the following join.
    """
    st = status
    if date_col:
        st = st.withColumn(date_col, parse_date(date_col, date_fmt))
    st = rename_key(st, key, new_key)
    if status_drop:
        st = drop_strict(st, status_drop)
    demo = drop_strict(demographics, demo_drop) if demo_drop else demographics
    combined = join_inner_suffix(st, demo, new_key, key, suffixes=("", "_drop"))
    combined = filter_isin(combined, status_col, valid_status)
    if joined_drop:
        combined = drop_strict(combined, joined_drop)
    v = filter_eq(visits, visit_col, visit_value) if visit_value is not None else visits
    v = earliest_per_key(v, key, visit_ts, visit_tie)
    if visit_drop:
        v = drop_strict(v, visit_drop)
    return join_left_dropkey(combined, v, new_key, key)


def assessment_flow(forms: Sequence[DataFrame], *, key: str = "PATNO", ts: str = "ORIG_ENTRY",
                    ts_fmt: str | None = "MM/yyyy", strict: bool = True, tie: Sequence[str] = (),
                    form_drop: Sequence[Sequence[str]] | None = None, final_drop: Sequence[str] = ()) -> DataFrame:
    """Per form drop columns (P1), parse the entry date strictly (F1), earliest row per key
    (D1) without the date, full outer fold on the key with ``_dup`` names (J3), repeated
    names removed (P9), final projection (P1).

    Plan: all forms are stacked once and reduced by one grouped aggregate on the
    key holding, per form, the ``min`` of a first-row struct. That is the
    earliest row of every form and the outer fold in a single shuffle, combined
    map-side, so a participant with a third of all rows never sits whole in one
    task.
    """
    from cohort_spark.operators.dedup import first_row_struct
    from cohort_spark.operators.joins import _fold_names

    prepared = []
    for i, f in enumerate(forms):
        d = drop_strict(f, form_drop[i]) if form_drop and form_drop[i] else f
        if ts_fmt is not None:
            d = d.withColumn(ts, parse_date(ts, ts_fmt, coerce=not strict))
        prepared.append(d)
    plan = _fold_names(prepared, key, "_dup", skip=[ts])
    slots, fields, types = [], [], []
    for i, d in enumerate(prepared):
        rest = [c for c in d.columns if c not in (key, ts) and c not in set(tie)]
        st, fmap = first_row_struct(d, [key], [ts, *tie, *rest])
        slots.append(st)
        fields.append(fmap)
        types.append(d.select(st.alias("x")).schema[0].dataType)
    parts = []
    for i, d in enumerate(prepared):
        parts.append(d.select(qcol(key).alias(key), *[
            (slots[j] if j == i else F.lit(None).cast(types[j])).alias(f"_f{j}") for j in range(len(prepared))]))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    grouped = stacked.groupBy(qcol(key).alias(key)).agg(*[F.min(f"_f{j}").alias(f"_f{j}") for j in range(len(prepared))])
    merged = grouped.select(qcol(key), *[F.col(f"_f{j}").getField(fields[j][c]).alias(n) for j, c, n in plan])
    return drop_strict(merged, final_drop) if final_drop else merged


def assessment_union_flow(forms: Sequence[DataFrame], *, form_drop: Sequence[Sequence[str]] | None = None,
                          out_path: str | None = None) -> DataFrame:
    """Per form drop columns (P1), stack rows by name (U1), repeated names removed (P9),
    optional write (S3)."""
    from cohort_spark.sources.tables import write_table

    parts = [drop_strict(f, form_drop[i]) if form_drop and form_drop[i] else f for i, f in enumerate(forms)]
    out = drop_repeated_columns(union_by_name(parts))
    if out_path:
        write_table(out, out_path)
    return out


def orders_as_visits(orders: DataFrame) -> DataFrame:
    """Test-data adapter: orders as visit records keyed by customer."""
    return orders.select(F.col("o_custkey").alias("PATNO"), "o_orderkey", "o_orderstatus", "o_totalprice",
                         "o_orderdate", "o_orderpriority")


def feature_flow(df: DataFrame, *, key: str, label: str, id_cols: Sequence[str] = (), sparse_t: float = 0.5,
                 cat_t: int = 9, low_t: float = 0.05, knn_k: int = 5, out_path: str | None = None,
                 forms: DataFrame | None = None, forms_key: str = "PATNO"):
    """Left join of the participant table with the merged assessment forms on the key,
    dropping the forms' key (J2, when ``forms`` is given), split off the label (P7), drop sparse columns (M1), classify columns (M2), fill
    low-missing columns (M3), drop id/date columns (M7), fit and apply the preprocessor
    — KNN filling of numeric categorical codes, one-hot, population scaling — (E5), re-attach
    the label on the key (P8), optional write (S3).

    Returns (feature table, fitted preprocessor). The participant key is kept so
    the label is joined, never re-attached by position.
    """
    from cohort_spark.operators.columns import attach_target, split_target
    from cohort_spark.operators.encode import apply_preprocessor, fit_preprocessor
    from cohort_spark.operators.missing import classify_columns, drop_id_columns, drop_sparse_columns, impute_low_missing
    from cohort_spark.operators.ordered import reliable
    from cohort_spark.sources.tables import write_table

    if forms is not None:
        df = join_left_dropkey(df, forms, key, forms_key)
    df = reliable(df)  # many statistics passes follow: materialise the input once, lineage cut
    x, y = split_target(df, label, key)
    x = drop_sparse_columns(x, sparse_t, [c for c in x.columns if c != key])
    cat, num = classify_columns(x, cat_t, exclude=[key])
    x = impute_low_missing(x, cat, num, low_t)
    x, num = drop_id_columns(x, list(id_cols), num)
    cat = [c for c in cat if c not in set(id_cols)]
    pre = fit_preprocessor(x, num, cat, knn_k)
    out = attach_target(apply_preprocessor(x, pre), y, key, label)
    if out_path:
        write_table(out, out_path)
    return out, pre


#: The grids of the workflow. A forest's smallest split has no counterpart in Spark ML, so that
#: axis (2 values of the workflow's 36 settings) is left out; the depth axis ends at 30, Spark's largest.
MODEL_GRIDS = {
    "Logistic Regression": {"C": (0.1, 1.0, 10.0), "max_iter": (100, 200)},
    "Random Forest": {"trees": (50, 100, 200), "depths": (10, 20, 30), "min_leaf": (1, 2)},
    "XGBoost": {"depths": (3, 6, 10), "steps": (0.01, 0.1, 0.3), "iters": (50, 100, 200), "subsamples": (0.8, 0.9, 1.0)},
    "SVM": {"Cs": (0.1, 1.0, 10.0), "kernels": ("linear", "rbf"), "gammas": ("scale", "auto")},
}


def model_flow(df: DataFrame, *, key: str, label: str, features: Sequence[str], sensitive: Sequence[str],
               age: str, expected: Sequence[str] = (), seed: int = 42, folds: int = 3, parallelism: int = 4,
               grids: dict | None = None, out_dir: str | None = None, run: str = "model_flow") -> dict:
    """Validate (Q1), encode the label (E4), 70/15/15 split (R2), tune four classifiers by
    cross-validated grid search (L1-L5), validation accuracies (V2) and bias report (B4) on the
    validation part, ranking (B5), best model (B6), and its full test evaluation (V8: accuracy,
    confusion matrix, report, and AUC where the model gives probabilities).

    ``grids`` overrides entries of :data:`MODEL_GRIDS`, the workflow's grids, which are the default. Boosted trees are
    one softmax model whose numbers of rounds share a fit. With ``out_dir`` the tuned models are saved there (S5), their accuracies
    are written to its metric log (S6), and the results of the two longest searches (boosting, SVM) as they end, from which a rerun goes on.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier

    from cohort_spark.functions.scalar import cut_equal_width
    from cohort_spark.operators import models as L
    from cohort_spark.operators.boosting import boosted_grid_search
    from cohort_spark.operators.encode import label_encode
    from cohort_spark.operators.fairness import bias_report, model_ranking, select_best
    from cohort_spark.operators.metrics import evaluate_model, model_accuracies
    from cohort_spark.operators.ordered import reliable
    from cohort_spark.operators.sample import train_val_test_split
    from cohort_spark.operators.stats import validate_table

    checks = validate_table(df, list(expected or [*features, label]), raise_error=True)
    enc = label_encode(df, label, "label_idx").withColumn("label_idx", F.col("label_idx").cast("double"))
    split = reliable(L.assemble(train_val_test_split(enc, key, seed), list(features)))
    train, val, test = (split.where(F.col("split") == s) for s in ("train", "val", "test"))
    n = train.count()
    use = {**MODEL_GRIDS, **(grids or {})}
    logistic = LogisticRegression(labelCol="label_idx", elasticNetParam=0.0, standardization=False)
    forest = RandomForestClassifier(labelCol="label_idx", seed=seed)
    tuned = {
        "Logistic Regression": (logistic, {logistic.regParam: [1.0 / (c * n) for c in use["Logistic Regression"]["C"]],
                                           logistic.maxIter: list(use["Logistic Regression"]["max_iter"])}),
        "Random Forest": (forest, {forest.numTrees: list(use["Random Forest"]["trees"]), forest.maxDepth: list(use["Random Forest"]["depths"]),
                                   forest.minInstancesPerNode: list(use["Random Forest"]["min_leaf"])}),
    }
    plain = train.select(qcol(key).alias("_key"), "label_idx", "features")  # Spark ML resolves columns by name: no dotted ones
    fitted = {name: L.grid_search(est, grid, plain, "label_idx", folds, "accuracy", parallelism, seed, stratify_key="_key").bestModel
              for name, (est, grid) in tuned.items()}
    log = f"{out_dir}/metrics" if out_dir else None  # both searches keep their results there and resume
    fitted["XGBoost"] = boosted_grid_search(plain, "label_idx", "_key", folds=folds, seed=seed, log=log, run=f"{run}-boosted", **use["XGBoost"])[0]
    fitted["SVM"] = L.svm_grid_search(plain, "label_idx", "_key", folds=folds, seed=seed, log=log, run=f"{run}-svm", **use["SVM"])[0]
    if out_dir:
        from cohort_spark.sources.tables import append_metrics, save_model

        for name, m in fitted.items():
            save_model(m, f"{out_dir}/{name.replace(' ', '_')}")
    keep = [key, "label_idx", *sensitive, age]
    safe = {c: f"_k{i}" for i, c in enumerate(keep)}  # Spark ML selects by name; dotted names would not resolve
    val_m = val.select(*[qcol(c).alias(safe[c]) for c in keep], "features")
    preds = None
    for name, m in fitted.items():
        p = m.transform(val_m).select(F.lit(name).alias("model"), *[F.col(safe[c]).alias(c) for c in keep],
                                      F.col("prediction"))
        preds = p if preds is None else preds.unionByName(p)
    preds = cut_equal_width(reliable(preds), age, 4, f"{age}_BINNED")
    acc = model_accuracies(preds, "label_idx", "prediction")
    report = bias_report(preds, "label_idx", "prediction", [*sensitive, age], binned=f"{age}_BINNED")
    ranking = model_ranking(acc, report)
    best = select_best(ranking)
    best_name = best.collect()[0]["model_name"]
    evaluation = evaluate_model(fitted[best_name], test, "label_idx")
    if out_dir:
        append_metrics(acc.select(F.lit(run).alias("run"), "model", F.lit("validation_accuracy").alias("metric"),
                                  F.col("accuracy").alias("value")), f"{out_dir}/metrics")
    return {"checks": checks, "accuracies": acc, "bias_report": report, "ranking": ranking, "best": best,
            "evaluation": evaluation, "test_report": evaluation["report"], "models": fitted}


def score_records(records: DataFrame, record_col: str, names: Sequence[str], pre, model,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Prediction entry re-aimed as a table job: parse text records such as ``"1.5, 2.3, 3.8"``
    into named features (P12), apply a fitted preprocessor (E5), assemble and predict (L7).
    Every record of the table is scored in one distributed pass."""
    from cohort_spark.functions.scalar import parse_feature_record
    from cohort_spark.operators.encode import apply_preprocessor
    from cohort_spark.operators.models import assemble, predict_batch

    parsed = parse_feature_record(records, record_col, names)
    prepared = apply_preprocessor(parsed, pre)
    return predict_batch(model, assemble(prepared, pre.feature_columns()), keep)
