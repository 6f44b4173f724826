"""Column expressions: every function takes and returns a ``Column`` (or adds columns)."""

from cohort_spark.functions.scalar import (binarize, cut_equal_width, cut_labels, fill_value, mask_replace,
                                           model_family, model_path, parse_date, parse_date_columns,
                                           parse_feature_record, slice_label, truncate_mean)

__all__ = ["parse_date", "parse_date_columns", "cut_labels", "cut_equal_width", "fill_value", "truncate_mean",
           "mask_replace", "binarize", "model_family", "slice_label", "model_path", "parse_feature_record"]
