"""Sources and sinks: tables, directories, staged tables, models and metric logs."""

from cohort_spark.sources.tables import (append_metrics, load_model, load_preprocessor, nan_to_null,
                                         read_dir, read_table, save_model, save_preprocessor, stage_table,
                                         write_table)

__all__ = ["read_table", "read_dir", "write_table", "stage_table", "save_model", "load_model",
           "append_metrics", "nan_to_null", "save_preprocessor", "load_preprocessor"]
