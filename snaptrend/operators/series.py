"""Gap-free daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrend.functions.dates import DateWindow


def densify(
    df: DataFrame,
    keys: Sequence[str],
    window: DateWindow,
    zero_columns: Sequence[str],
    date_column: str = "run_date",
) -> DataFrame:
    """One row per key and day of the window; a day without a row gets zeros.

    Zeros are filled for absent days only, a null of a present day stays. Each key makes its own
    calendar, to which the data is joined: a key and day has at most one data row.
    """
    calendar = df.select(*keys).distinct().select(
        *keys,
        F.explode(
            F.sequence(F.lit(window.start), F.lit(window.end), F.expr("INTERVAL 1 DAY"))
        ).alias(date_column),
    )
    data = df.select(*keys, date_column, *zero_columns, F.lit(True).alias("_present"))
    joined = calendar.join(data, [*keys, date_column], "left")
    return joined.select(
        *keys,
        date_column,
        *[
            F.when(F.col("_present").isNull(), F.lit(0).cast(df.schema[c].dataType))
            .otherwise(F.col(c))
            .alias(c)
            for c in zero_columns
        ],
    )
