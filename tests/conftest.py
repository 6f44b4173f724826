import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cohort_spark.session import get_spark

    s = get_spark("local[4]", app="cohort_spark_tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cohort-test-ckpt-"),
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cohort-test-warehouse-"), "spark.driver.memory": "8g"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
