"""Which ranges hold a height, for ranges of any length that may nest and overlap.

A range is cut into aligned cells whose lengths are powers of two, at most two per power. A height
lies in one cell per power, so both sides meet in an equi-join on power and cell. Heights are
spread only over powers that some range uses, a handful of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Powers a cell may have; heights are below 2^62.
POWERS = 62


def _shifted(value: Column, power: Column) -> Column:
    return F.call_function("shiftright", value, power)


def cells(ranges: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """`ranges` with ``power, cell``, a row for each cell of ``[first, last]``. Heights start at 0.

    At power p the cells that lie wholly inside run from ``ceil(first / 2^p)``; the outermost ones
    that have no whole parent inside are taken. Ranges that end before they begin give no row.
    """
    one = F.lit(1).cast("bigint")

    def at(power: Column) -> Column:
        width = F.call_function("shiftleft", one, power)
        low = _shifted(F.col(first) + width - 1, power)
        high = _shifted(F.col(last) + 1, power)  # the first cell that is not whole any more
        some = low < high
        left = F.when(some & (low % 2 == 1), F.struct(power.alias("power"), low.alias("cell")))
        right = F.when(some & (high % 2 == 1), F.struct(power.alias("power"), (high - 1).alias("cell")))
        return F.array(left, right)

    powers = F.sequence(F.lit(0), F.lit(POWERS - 1))
    listed = F.array_compact(F.flatten(F.transform(powers, at)))
    return ranges.where(F.col(last) >= F.col(first)).select("*", F.explode(listed).alias("_c")).select(*ranges.columns, "_c.*")


def covering(heights: DataFrame, ranges: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """Every row of `heights` (``height, …``) with every row of `ranges` that holds its height.

    Column names of both sides other than ``height`` must differ. Null heights meet nothing.
    """
    cut = cells(ranges.where(F.col(first) >= 0), first, last)
    used = sorted(r.power for r in cut.select("power").distinct().collect())
    spread = heights.where("height >= 0").withColumn("power", F.explode(F.array(*(F.lit(p) for p in used)).cast("array<int>")))
    keyed = spread.withColumn("cell", _shifted(F.col("height"), F.col("power")))
    return keyed.join(cut, ["power", "cell"]).drop("power", "cell")


def holders(heights: DataFrame, ranges: DataFrame) -> DataFrame:
    """``height, n`` for each distinct height that at least one of `ranges` holds."""
    return covering(heights.select("height").distinct(), ranges.select("first", "last")).groupBy("height").agg(
        F.count("*").alias("n")
    )
