"""Exact order statistics per group, without shuffling or sorting a whole group."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.session import settled

# Rank error of the sketch is n / ACCURACY; the bracket is twice that to either side.
ACCURACY = 10_000
MARGIN = 2 / ACCURACY


def index_quantiles(
    df: DataFrame, value: str, shares: dict[str, float], *groups: str
) -> DataFrame:
    """Per group: ``n``, ``mean`` and, for each named share, the element at position
    ``floor(n * share)`` of the sorted values. Nulls do not count.

    One group may hold most of the rows, so no group is gathered:

    1. a sketch per group brackets each wanted position between two values;
    2. a second scan counts the rows below and inside each bracket, which tells where
       the position really lies: inside, or, had the sketch failed, beside it;
    3. a third scan fetches only that region's values, counted by value, and a running
       sum finds the element.

    Steps 1 and 2 move one partial row per task and group. The result is exact however
    good the sketch is; its quality only sets how few rows step 3 sorts.
    """
    if not groups:
        whole = df.select(F.lit(0).alias("all_rows"), value)
        return index_quantiles(whole, value, shares, "all_rows").drop("all_rows")
    by = list(groups)
    rows = df.select(*by, F.col(value).alias("v")).where(F.col("v").isNotNull())
    edges = [
        edge
        for share in shares.values()
        for edge in (max(share - MARGIN, 0.0), min(share + MARGIN, 1.0))
    ]
    # Written tables of one row per group: Spark sees their size and broadcasts them
    # only while they are small.
    facts = settled(
        rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("v").alias("mean"),
            F.percentile_approx("v", edges, ACCURACY).alias("edges"),
        ),
        "facts",
    )
    brackets = {
        name: (F.get("edges", F.lit(2 * i)), F.get("edges", F.lit(2 * i + 1)))
        for i, name in enumerate(shares)
    }
    counts = [
        F.count_if(test).alias(f"{name}_{side}")
        for name, (low, high) in brackets.items()
        for side, test in (("below", F.col("v") < low), ("up_to", F.col("v") <= high))
    ]
    facts_of = [F.first(column).alias(column) for column in ("n", "mean", "edges")]
    wanted = F.array(*[_target(name, share, *brackets[name]) for name, share in shares.items()])
    targets = settled(
        _join_groups(rows, facts, by)
        .groupBy(*by)
        .agg(*facts_of, *counts)
        .select(*by, "n", "mean", F.explode(wanted).alias("t"))
        .select(*by, "n", "mean", "t.*"),
        "targets",
    )
    in_region = (
        F.when(F.col("region") == 0, F.col("v") < F.col("low"))
        .when(F.col("region") == 1, F.col("v").between(F.col("low"), F.col("high")))
        .otherwise(F.col("v") > F.col("high"))
    )
    running = F.sum("times").over(Window.partitionBy(*by, "name").orderBy("v"))
    return (
        _join_groups(rows, targets, by)
        .where(in_region)
        .groupBy(*by, "n", "mean", "name", "position", "before", "v")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("reached", F.col("before") + running)
        .where(F.col("reached") > F.col("position"))
        .groupBy(*by, "n", "mean")
        .agg(*[F.min(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in shares])
    )


def _join_groups(rows: DataFrame, per_group: DataFrame, by: list[str]) -> DataFrame:
    """Join on the group columns; a null group matches itself."""
    renamed = per_group.withColumnsRenamed({name: f"group_{name}" for name in by})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"group_{name}")) for name in by])
    return rows.join(renamed, same).drop(*[f"group_{name}" for name in by])


def _target(name: str, share: float, low: Column, high: Column) -> Column:
    """Where the share's element lies: its position, the region that holds it (0 below
    the bracket, 1 inside, 2 above) and the number of rows before that region."""
    position = F.floor(F.col("n") * F.lit(share)).cast("bigint")
    below, up_to = F.col(f"{name}_below"), F.col(f"{name}_up_to")
    region = F.when(position < below, 0).when(position < up_to, 1).otherwise(2)
    before = F.when(position < below, F.lit(0)).when(position < up_to, below).otherwise(up_to)
    return F.struct(
        F.lit(name).alias("name"),
        position.alias("position"),
        region.alias("region"),
        before.cast("bigint").alias("before"),
        low.alias("low"),
        high.alias("high"),
    )
