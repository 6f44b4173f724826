"""Literal test tables whose numbers must stay as they are (see FIXTURES.md)."""

#: A table with gaps, column by column.
MISSING = {
    "AV133STDY": [1.0, None, 3.0, None, 5.0],
    "TAUSTDY": [None, 2.0, None, 4.0, 5.0],
    "GAITSTDY": [1.0, 2.0, 3.0, 4.0, None],
    "PISTDY": [None, None, None, None, None],
    "NP4DYSTN": [1.0, 2.0, None, 4.0, 5.0],
    "NP4TOT": [10.0, None, 30.0, None, 50.0],
}

#: A table with outliers, column by column.
OUTLIERS = {
    "NP3TOT": [20, 25, 22, 100, 24, 23, 21, 150, 26, 200],
    "NP2SPCH": [1, 2, 1, 15, 2, 1, 2, 20, 1, 2],
    "NP1DPRS": [2, 3, 2, 20, 3, 2, 3, 25, 2, 30],
    "ENROLL_AGE": [65, 70, 68, 150, 67, 71, 69, 25, 72, 200],
    "COHORT": [1, 1, 1, 1, 1, 1, 1, 1, 1, 1],
}

#: Ages to be binned and resampled, column by column.
AGES = {
    "ENROLL_AGE": [45, 55, 65, 75, 85, 65, 75, 85, 65, 75],
    "OTHER_COLUMN": ["A", "B", "C", "D", "E", "F", "G", "H", "I", "J"],
}


def rows(table: dict) -> list[tuple]:
    """The rows of a table given by columns."""
    return list(zip(*table.values()))
