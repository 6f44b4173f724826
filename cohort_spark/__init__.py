"""cohort_spark: cohort table preparation, checking and modelling on Spark DataFrames.

Sub-packages
------------
sources    read / write / stage tables, persist models and metrics
functions  column expressions (dates, bins, masks, record parsing)
operators  DataFrame -> DataFrame operators (joins, de-duplication, statistics,
           missing values, outliers, encoding, sampling, models, evaluation,
           fairness, drift, data quality) plus the ordered helpers they share
plans      end-to-end flows and the registry of test-data queries
"""

from cohort_spark.session import get_spark

__all__ = ["get_spark"]
