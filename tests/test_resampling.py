"""Age bins and resampling on a literal table."""

from cohort_spark.functions.scalar import cut_labels
from cohort_spark.operators import sample as R
from fixed_values import AGES, rows


def frame(spark):
    return spark.createDataFrame(rows(AGES), "ENROLL_AGE long, OTHER_COLUMN string")


def test_groups(spark):
    df = frame(spark).withColumn("g", cut_labels("ENROLL_AGE", R.AGE_EDGES, R.AGE_LABELS))
    got = {r.ENROLL_AGE: r.g for r in df.collect()}
    assert got == {45: "Under 50", 55: "50-59", 65: "60-69", 75: "70-79", 85: "80 and above"}


def test_sizes(spark):
    df = frame(spark).withColumn("g", cut_labels("ENROLL_AGE", R.AGE_EDGES, R.AGE_LABELS))
    target = df.where("g = '70-79'").count()
    assert R.undersample(df, "g", "60-69", target, "OTHER_COLUMN").count() == target
    assert R.oversample(df, "g", "80 and above", target, "OTHER_COLUMN").count() == target
    bal = R.balance_groups(frame(spark), "ENROLL_AGE", "OTHER_COLUMN")
    counts = dict(bal.groupBy("Age_Group").count().collect())
    assert counts["60-69"] == target and counts["80 and above"] == target


def test_split_sizes_and_determinism(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    s1 = R.split_column(df, "k", 0.2, 42)
    assert s1.where("split = 'test'").count() == 201
    s2 = R.split_column(df.repartition(7), "k", 0.2, 42)
    a = sorted(r.k for r in s1.where("split = 'test'").collect())
    b = sorted(r.k for r in s2.where("split = 'test'").collect())
    assert a == b
    tvt = dict(R.train_val_test_split(df, "k").groupBy("split").count().collect())
    assert tvt == {"test": 151, "val": 150, "train": 700}
