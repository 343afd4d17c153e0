"""Work out expensive columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df.select(*columns)`` whose columns later filters and projections read, not repeat.

    The optimizer pushes a filter on a computed column below the projection and inlines the
    expression there, so a parsed document would be parsed again for each use. A generator's
    output stays where it is. Null columns must carry a type.
    """
    chosen = df.select(*columns)
    return chosen.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in chosen.columns]))))
