"""Share of total (``n / SUM(n) OVER ()``) on aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.functions.exact import percent


def with_share(df: DataFrame, count_col: str, out_col: str = "percent_share",
               digits: int = 2, few_groups: bool = False) -> DataFrame:
    """Append ROUND(100.0 * n / SUM(n) OVER (), digits) as DOUBLE.

    By default the total is a scalar subquery (one aggregate job whose single
    value is inlined), not a global window: ``OVER ()`` moves every group
    into one partition.  ``few_groups=True`` is for groupings over a small
    fixed domain (payment types): then the window over the aggregated rows
    is cheap and the input is aggregated only once.  ``digits=1`` gives the
    pie-chart labels of the reference.
    """
    if few_groups:
        total = F.sum(count_col).over(Window.partitionBy())
    else:
        total = df.agg(F.sum(count_col)).scalar()
    return df.withColumn(out_col, percent(F.col(count_col), total, digits))
