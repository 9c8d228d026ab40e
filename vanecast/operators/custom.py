"""User-defined transforms of whole groups, for groups of proven size only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.session import group_rows


def per_group(
    df: DataFrame, group: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, max_rows: int | None = None
) -> DataFrame:
    """Apply ``function`` to each group as a pandas frame.

    The groups are counted first; one that exceeds ``max_rows`` is an error,
    since a function of a whole group cannot be split without knowing it.
    """
    limit = group_rows(df.sparkSession) if max_rows is None else max_rows
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if largest > limit:
        raise ValueError(f"a group has {largest} rows, more than {limit}; aggregate it or use ordered windows")
    return df.groupBy(*group).applyInPandas(function, schema)
