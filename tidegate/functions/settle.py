"""Keep costly columns from being computed twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(rows: DataFrame, *names: str) -> DataFrame:
    """Same rows; filters on the named columns are not moved below this point.

    A filter is normally pushed through projections by repeating the definition of
    each column it reads. For a column derived from a parsed message over several
    steps that repeats the parsing many times over. Passing the columns through a
    one-row generator ends that, while filters on other columns still go through.
    """
    others = [name for name in rows.columns if name not in names]
    return rows.select(*others, F.inline(F.array(F.struct(*names))))
