"""Scans along ordered series of any length: carried values, last values and running sums without a series in one task.

The rows of all series are put in one order and cut into cells of about equal size, wherever in a series the cuts fall. Of
each cell only its state is kept: the last row's values, the last values that are not null, sums. The states of a series, one row per cell, are scanned
apart; what has been carried up to a cell becomes a head row in front of the cell's rows. A window over (series, cell) then
gives what a window over the whole series would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opspark.session import cut_lineage

#: Rows of a group beyond which it is not left to one task.
CELL_ROWS = 1_000_000


def largest_group(df: DataFrame, by: Sequence[Column]) -> int:
    """Rows of the largest group, counted with partials."""
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def with_heads(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: Sequence[str] = (), latest: Sequence[str] = (),
               totals: Sequence[str] = (), cells: int | None = None):
    """The rows with heads, and the window to scan them by.

    The frame has the rows of ``df``, ``_cell`` and ``_head``: 1 for rows and 0 for the head in front of a cell, which
    holds in ``last`` columns the values of the row before the cell, in ``latest`` columns the last ones that are not null, in ``totals``
    columns the sums so far. So ``lag``, ``last(ignorenulls)`` and ``sum`` over the window are those of the whole series. Heads are to
    be dropped in the end. ``order`` should tell rows apart: equal rows stay together in one cell.
    """
    names = [*keys, *order]
    many = cells or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written down, so that rows and states see the same cuts whatever is computed again
    rows = cut_lineage(df.repartitionByRange(many, *names).withColumn("_cell", F.spark_partition_id()))
    at = F.struct(*order)
    state = rows.groupBy(*keys, "_cell").agg(
        *[F.max_by(F.struct(c), at).alias(f"_last_{c}") for c in last],
        *[F.max_by(F.when(F.col(c).isNotNull(), F.struct(c)), F.when(F.col(c).isNotNull(), at)).alias(f"_latest_{c}") for c in latest],
        *[F.sum(c).alias(f"_total_{c}") for c in totals], F.count("*").alias("_rows"))
    by_cell = W.partitionBy(*keys).orderBy("_cell")
    ahead = by_cell.rowsBetween(W.unboundedPreceding, -1)
    heads = state.select(
        *keys, "_cell", F.lit(0).alias("_head"), F.row_number().over(by_cell).alias("_place"),
        *[F.lag(f"_last_{c}").over(by_cell)[c].alias(c) for c in last],
        *[F.last(f"_latest_{c}", ignorenulls=True).over(ahead)[c].alias(c) for c in latest],
        *[F.sum(f"_total_{c}").over(ahead).alias(c) for c in totals]).where("_place > 1").drop("_place")
    both = rows.withColumn("_head", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return both, W.partitionBy(*keys, "_cell").orderBy("_head", *order)
