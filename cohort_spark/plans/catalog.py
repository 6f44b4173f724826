"""Importing this module fills the registry with every query."""

from cohort_spark.plans import q_basic, q_model, q_stats  # noqa: F401
from cohort_spark.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
