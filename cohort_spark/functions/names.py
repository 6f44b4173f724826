"""Column references by exact name."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def qcol(name) -> Column:
    """Column by exact name: names such as ``SEX_0.0`` contain a dot, which ``F.col`` would
    read as a struct field. A ``Column`` passes through unchanged."""
    if isinstance(name, Column):
        return name
    return F.col("`" + str(name).replace("`", "``") + "`")
