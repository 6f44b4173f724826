"""Participant and assessment flows on the reference's small frames."""

from pyspark.sql import functions as F

from cohort_spark.functions.scalar import parse_date
from cohort_spark.operators import joins as J
from cohort_spark.operators.columns import drop_repeated_columns, drop_strict, rename_key
from cohort_spark.plans import flows


def test_status_clean(spark):
    st = spark.createDataFrame([(3001, "01/2011", "Enrolled"), (3002, "xx/2012", "Withdrew")],
                               "PATNO long, ENROLL_DATE string, ENROLL_STATUS string")
    out = rename_key(st.withColumn("ENROLL_DATE", parse_date("ENROLL_DATE", "%m/%Y")), "PATNO", "Participant_ID")
    got = {r.Participant_ID: r.ENROLL_DATE for r in out.collect()}
    assert str(got[3001])[:10] == "2011-01-01" and got[3002] is None


def test_status_join(spark):
    st = spark.createDataFrame([(1, "Enrolled"), (2, "Excluded")], "Participant_ID long, ENROLL_STATUS string")
    demo = spark.createDataFrame([(1, "M", 60), (2, "F", 70)], "PATNO long, SEX string, AGE long")
    out = J.join_inner_suffix(st, demo, "Participant_ID", "PATNO").where("ENROLL_STATUS IN ('Enrolled')")
    assert out.columns == ["Participant_ID", "ENROLL_STATUS", "PATNO", "SEX", "AGE"]
    assert out.count() == 1


def test_participant_flow(spark):
    st = spark.createDataFrame([(1, "Enrolled", "x"), (2, "Complete", "y"), (3, "Excluded", "z")],
                               "PATNO long, ENROLL_STATUS string, COHORT_DEFINITION string")
    demo = spark.createDataFrame([(1, "M"), (2, "F"), (3, "F")], "PATNO long, SEX string")
    bio = spark.createDataFrame([(1, "BL", "2020-02-01", 5.0), (1, "BL", "2020-01-01", 4.0), (1, "V04", "2019-01-01", 9.0),
                                 (2, "SC", "2020-01-01", 1.0)], "PATNO long, CLINICAL_EVENT string, RUNDATE string, SAA double")
    bio = bio.withColumn("RUNDATE", F.to_date("RUNDATE"))
    out = flows.participant_flow(st, demo, bio, status_drop=["COHORT_DEFINITION"], joined_drop=["ENROLL_STATUS"],
                                 visit_drop=["CLINICAL_EVENT", "RUNDATE"])
    got = {r.Participant_ID: r.SAA for r in out.collect()}
    assert got == {1: 4.0, 2: None}


def test_outer_join_names(spark):
    a = spark.createDataFrame([(1, 10, "BL")], "PATNO long, MDS_UPDRS long, EVENT_ID string")
    b = spark.createDataFrame([(1, 11, "V1"), (2, 12, "V2")], "PATNO long, MDS_UPDRS long, EVENT_ID string")
    c = spark.createDataFrame([(3, 13, "V3")], "PATNO long, MDS_UPDRS long, EVENT_ID string")
    out = drop_repeated_columns(J.outer_join_all([a, b, c], "PATNO"))
    assert out.columns == ["PATNO", "MDS_UPDRS", "EVENT_ID", "MDS_UPDRS_dup", "EVENT_ID_dup"]
    got = {r.PATNO: (r.MDS_UPDRS, r.MDS_UPDRS_dup) for r in out.collect()}
    assert got == {1: (10, 11), 2: (None, 12), 3: (None, None)}
    out2 = drop_strict(out, ["EVENT_ID", "EVENT_ID_dup"])
    assert out2.columns == ["PATNO", "MDS_UPDRS", "MDS_UPDRS_dup"]


def test_assessment_flow_strict_date(spark):
    f1 = spark.createDataFrame([(1, "02/2020", 5), (1, "01/2020", 4)], "PATNO long, ORIG_ENTRY string, MDS_UPDRS long")
    f2 = spark.createDataFrame([(1, "03/2020", 7)], "PATNO long, ORIG_ENTRY string, MDS_UPDRS long")
    out = flows.assessment_flow([f1, f2])
    assert [tuple(r) for r in out.collect()] == [(1, 4, 7)]
    bad = spark.createDataFrame([(1, "2020-01", 4)], "PATNO long, ORIG_ENTRY string, MDS_UPDRS long")
    import pytest

    with pytest.raises(Exception):
        flows.assessment_flow([bad]).collect()


def test_outer_join_unique_path_equals_join_path(spark):
    a = spark.createDataFrame([(1, 10, "BL"), (2, 20, "SC"), (None, 5, "X")], "PATNO long, MDS_UPDRS long, EVENT_ID string")
    b = spark.createDataFrame([(1, 11, "V1"), (3, 12, "V2")], "PATNO long, MDS_UPDRS long, EVENT_ID string")
    c = spark.createDataFrame([(3, 13, "V3"), (4, 14, None)], "PATNO long, MDS_UPDRS long, EVENT_ID string")
    j = J.outer_join_all([a, b, c], "PATNO")
    u = J.outer_join_all([a, b, c], "PATNO", unique_keys=True)
    assert j.columns == u.columns
    assert sorted(map(tuple, j.collect()), key=repr) == sorted(map(tuple, u.collect()), key=repr)
