"""Running sums and maxima over long orders, without one task for a whole order.

Rows are cut into blocks of BLOCK places of their order.  Each block is summed up, the blocks before give
a block its start, and rows are counted on within their block only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places of the order that one block spans.
BLOCK = 100_000
_HOW = {"sum": F.sum, "max": F.max}


def running(rows: DataFrame, keys: list[str], order: str, value: Column, name: str, how: str = "sum", inclusive: bool = False, ties: tuple[str, ...] = ()) -> DataFrame:
    """rows with the sum or maximum of a value over the rows before each, in whole numbers of `order`, by keys.

    Rows of equal order go by ties.  inclusive counts the row itself.  A sum over no rows is 0, a maximum is null.
    Rows without a key or an order are left out.
    """
    agg = _HOW[how]
    cut = rows.dropna(subset=[*keys, order]).withColumn("__value", value).withColumn("__block", F.floor(F.col(order) / BLOCK))
    by = [*keys, "__block"]
    tops = cut.groupBy(*by).agg(agg("__value").alias("__top"))
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    base = tops.withColumn("__base", agg("__top").over(before)).drop("__top")
    within = Window.partitionBy(*by).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    both = cut.join(base, by).withColumn("__within", agg("__value").over(within))
    total = F.coalesce("__base", F.lit(0)) + F.coalesce("__within", F.lit(0)) if how == "sum" else F.greatest("__base", "__within")
    return both.withColumn(name, total).drop("__value", "__block", "__base", "__within")


def within_budget(docs: DataFrame, budget: int, cost: Column, order: str) -> DataFrame:
    """The first documents in order whose costs together stay within a budget, with their costs before as spent.

    The first document that does not fit ends the run, so none after it is taken.  A null cost is none.
    """
    own = docs.withColumn("__cost", F.coalesce(cost, F.lit(0)).cast("long"))
    rest = [c for c in docs.columns if c != order]
    return running(own, [], order, F.col("__cost"), "spent", ties=tuple(rest)).where(F.col("spent") + F.col("__cost") <= budget).drop("__cost")
