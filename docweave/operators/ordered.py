"""Running aggregates over ordered groups of any size.

A group is cut into blocks of its order column. Windows run inside one block, and
what earlier blocks contribute comes from one summary row per block. So no task sorts
a whole group, even when one group holds most of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How an aggregate over earlier blocks joins one over the current block.
MERGE: dict[str, Callable[[Column, Column], Column]] = {
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    "max": F.greatest,
    "min": F.least,
}
AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    keys: list[str],
    block: Column,
    order: list,
    values: dict[str, tuple[str, Column]],
    descending_blocks: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """Adds every ``name: (sum|max|min, expression)`` as its running value up to the row.

    ``block`` must grow with ``order`` inside each group (or fall, with
    ``descending_blocks``). Keys may be NULL. Without ``inclusive`` the row itself is left out.
    """
    rows = df.withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    by_block = F.col("_block").desc() if descending_blocks else F.col("_block").asc()
    before = Window.partitionBy(*keys).orderBy(by_block).rowsBetween(Window.unboundedPreceding, -1)

    totals = rows.groupBy(*keys, "_block").agg(*[AGGREGATE[fn](e).alias(n) for n, (fn, e) in values.items()])
    carry = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_b"),
        *[AGGREGATE[fn](n).over(before).alias(f"_in_{n}") for n, (fn, _) in values.items()],
    )
    scored = rows.select("*", *[AGGREGATE[fn](e).over(inside).alias(f"_at_{n}") for n, (fn, e) in values.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_block").eqNullSafe(F.col("_b"))]
    joined = scored.join(carry, same, "left")
    merged = {n: MERGE[fn](F.col(f"_in_{n}"), F.col(f"_at_{n}")) for n, (fn, _) in values.items()}
    return joined.select(*df.columns, *[c.alias(n) for n, c in merged.items()])
