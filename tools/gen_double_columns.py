"""Regenerate cohort_spark/plans/oracle_doubles.py: the DOUBLE output columns of every oracle query
(read from DuckDB's result types on the sf0.001 tables), used to round both sides to 6 decimals."""

import os
import pprint
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402

from oracle_check import TABLES  # noqa: E402


def main():
    from cohort_spark.plans.catalog import ORACLE

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    out = {}
    for name, sql in sorted(ORACLE.items()):
        rel = con.sql(sql)
        cols = [c for c, t in zip(rel.columns, rel.types) if str(t) in ("DOUBLE", "FLOAT")]
        if cols:
            out[name] = cols
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "cohort_spark", "plans",
                        "oracle_doubles.py")
    with open(path, "w") as f:
        f.write('"""Generated by tools/gen_double_columns.py: DOUBLE output columns of each oracle query."""\n\n')
        f.write("DOUBLE_COLUMNS = " + pprint.pformat(out, width=110, compact=True) + "\n")
    print(f"{len(out)} queries with double columns")


if __name__ == "__main__":
    main()
