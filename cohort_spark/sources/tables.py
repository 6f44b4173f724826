"""Reading and writing tables.

Every reader returns a lazy DataFrame; column pruning and filters written later
reach the Parquet scan. CSV input is read with an explicit schema when one is
given (inference costs a full extra pass over the files).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_spark.functions.names import qcol

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn floating NaN into NULL so that one notion of "missing" holds (pandas counts NaN as missing)."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(qcol(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(qcol(f.name))
    return df.select(*exprs)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read one table. CSV has a header and blanks are missing; NaN becomes NULL."""
    fmt = fmt or ("csv" if path.lower().endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    else:
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def list_dir(spark: SparkSession, directory: str) -> list[str]:
    """Entry names of a directory on any Hadoop-supported file system (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(path))


def read_dir(spark: SparkSession, directory: str, suffix: str = ".csv") -> list[tuple[str, DataFrame]]:
    """Every file with ``suffix`` in ``directory`` as (name, DataFrame), ordered by name."""
    names = [n for n in list_dir(spark, directory) if n.endswith(suffix)]
    return [(n[: -len(suffix)], read_table(spark, directory.rstrip("/") + "/" + n)) for n in names]


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), replace_partitions: bool = False) -> str:
    """S3: write without an index column (CSV with header, or Parquet). With ``replace_partitions`` only the
    partitions that ``df`` has rows for are replaced, so a day that is run again leaves the same table."""
    writer = df.write.mode(mode)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def stage_table(df: DataFrame, path: str, bucket_by: Sequence[str] = (), buckets: int | None = None,
                name: str | None = None) -> DataFrame:
    """Hand a table from one flow to the next through Parquet, never through the driver.

    With ``bucket_by`` the table is written bucketed (and sorted) by those columns as a catalog
    table ``name`` at ``path``; two tables staged with the same bucket count join on the key
    without a shuffle (co-located join), which pays off when a daily run re-reads them.
    """
    if not bucket_by:
        write_table(df, path, mode="overwrite")
        return df.sparkSession.read.parquet(path)
    spark = df.sparkSession
    name = name or "staged_" + os.path.basename(path.rstrip("/")).replace("-", "_")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(n, *bucket_by).sortBy(*bucket_by).saveAsTable(name))
    return spark.table(name)


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model or pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a fitted pipeline saved by :func:`save_model`."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.util import DefaultParamsReader

    meta = DefaultParamsReader.loadMetadata(path, __import__("pyspark").SparkContext.getOrCreate())
    cls_name = meta["class"]
    if cls_name.endswith("PipelineModel"):
        return PipelineModel.load(path)
    module, _, name = cls_name.replace("org.apache.spark", "pyspark").rpartition(".")
    mod = __import__(module, fromlist=[name])
    return getattr(mod, name).load(path)


METRIC_SCHEMA = "run string, model string, metric string, value double"


def append_metrics(df: DataFrame, path: str) -> DataFrame:
    """Add ``(run, model, metric, value)`` rows to a Parquet metric log. The log is keyed: the same run, model and metric
    written again (a rerun) replaces its earlier value."""
    out = df.select(F.col("run").cast("string"), F.col("model").cast("string"),
                    F.col("metric").cast("string"), F.col("value").cast("double"))
    write_table(out, path, partition_by=["run", "model", "metric"], replace_partitions=True)
    return df.sparkSession.read.schema(METRIC_SCHEMA).parquet(path).select("run", "model", "metric", "value")


def save_preprocessor(spark: SparkSession, pre, path: str) -> str:
    """Persist a fitted :class:`~cohort_spark.operators.encode.Preprocessor` (a small JSON
    document) through Spark, so the path may be on any shared file system."""
    spark.createDataFrame([(pre.to_json(),)], "doc string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_preprocessor(spark: SparkSession, path: str):
    """Load a preprocessor saved by :func:`save_preprocessor`."""
    from cohort_spark.operators.encode import Preprocessor

    return Preprocessor.from_json(spark.read.text(path).first()[0])
