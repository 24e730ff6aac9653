"""Order statistics of large groups by counting instead of sorting.

A rank's value is found in counting passes. The first one cuts each group's range (on a logarithmic scale, so that
far-off values do not swallow the rest) into ``BUCKETS`` buckets and counts them; the running counts tell in which bucket every wanted rank
lies. The second one cuts only these buckets, linearly between their own smallest and largest value. What then shares a cell
with a wanted rank, usually a row or two, is counted by value. Every pass aggregates before it shuffles: at most buckets x groups rows
move in the first, buckets x wanted ranks in the second. All groups (features among them) and all ranks share the passes.

Bucket numbers never fall as values rise, whatever the rounding, so the result is exact at every distribution; NaN is the largest
value, as in the session's order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.plans.ordered import layout, null_safe_join
from pulsegrid.session import stored

BUCKETS = 4096


def _scaled(v: Column) -> Column:
    return F.signum(v) * F.log1p(F.abs(v))


def _bucket(v: Column, low: Column, high: Column) -> Column:
    """0 .. BUCKETS - 1 between ``low`` and ``high``; halves keep the width of the range finite."""
    width = high / 2 - low / 2
    place = F.floor((v / 2 - low / 2) * (F.lit(float(BUCKETS)) / width))
    return F.when(width > 0, F.least(F.greatest(place, F.lit(0)), F.lit(BUCKETS - 1))).otherwise(0).cast("int")


def _hit(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Buckets (``_b``) that hold wanted ranks, with the rows before them (``_base``) and these ranks (``_ranks``).

    ``counted`` has keys, _b, _n, _lo, _hi, _ranks and the rows before the keys' first bucket (_base): at most
    ``BUCKETS`` + 2 rows of a key, which one window may sort.
    """
    ahead = Window.partitionBy(*[F.col(k) for k in keys]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    based = counted.withColumn("_base", F.col("_base") + F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    inside = F.filter("_ranks", lambda r: (r >= F.col("_base")) & (r < F.col("_base") + F.col("_n")))
    return based.withColumn("_ranks", inside).where(F.size("_ranks") > 0)


def select_ranks(df: DataFrame, group: Sequence[str], value: str, ranks: Callable[[Column], Column]) -> DataFrame:
    """Rows (group, _rank, _value): the values at 0-based ranks of each group; nulls have no rank.

    ``ranks`` maps the size of a group to an array of ranks; ranks that it does not have are left out.
    """
    keys = list(group) or ["_whole"]
    rows = df.where(F.col(value).isNotNull()).select(*group, *([] if group else [F.lit(0).alias("_whole")]), F.col(value).alias("_value"))
    rows = stored(rows, "values")
    v = F.col("_value").cast("double")
    finite = F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
    facts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"), _scaled(F.min(finite)).alias("_from"), _scaled(F.max(finite)).alias("_upto"))
    facts = facts.withColumn("_ranks", F.array_distinct(F.transform(ranks(F.col("_all")), lambda r: r.cast("long"))))
    bucket = (
        F.when(F.isnan(v), BUCKETS + 1).when(v == float("inf"), BUCKETS).when(v == float("-inf"), -1).otherwise(_bucket(_scaled(v), F.col("_from"), F.col("_upto")))
    )
    first = null_safe_join(rows, facts.select(*keys, "_from", "_upto"), keys).withColumn("_b", bucket)
    sizes = [F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi")]
    counted = first.groupBy(*keys, "_b").agg(*sizes)
    counted = null_safe_join(counted, facts.select(*keys, "_ranks"), keys).withColumn("_base", F.lit(0).cast("long"))
    coarse = stored(_hit(counted, keys).withColumnRenamed("_b", "_b1"), "coarse-buckets")

    # second pass: rows of the buckets that were hit and hold different values
    open_coarse = coarse.where("_lo < _hi").select(*keys, "_b1", F.col("_lo").alias("_l1"), F.col("_hi").alias("_h1"))
    second = null_safe_join(first.drop("_from", "_upto").withColumnRenamed("_b", "_b1"), open_coarse, [*keys, "_b1"])
    second = second.withColumn("_b", _bucket(v, F.col("_l1").cast("double"), F.col("_h1").cast("double")))
    fine = second.groupBy(*keys, "_b1", "_b").agg(*sizes)
    fine = null_safe_join(fine, coarse.select(*keys, "_b1", "_ranks", "_base"), [*keys, "_b1"])
    fine = stored(_hit(fine, [*keys, "_b1"]).withColumnRenamed("_b", "_b2"), "fine-buckets")

    # what still shares a cell with a wanted rank is counted by value
    open_fine = fine.where("_lo < _hi").select(*keys, "_b1", "_b2", "_ranks", "_base")
    cells = [*keys, "_b1", "_b2"]
    last = null_safe_join(second.drop("_l1", "_h1").withColumnRenamed("_b", "_b2"), open_fine.select(*cells), cells)
    values = last.groupBy(*cells, "_value").agg(F.count(F.lit(1)).alias("_n"))
    running = layout(values, cells, ["_value"]).running({"_upto": "_n"})
    exact = null_safe_join(running, open_fine, cells)
    until = F.col("_base") + F.col("_upto")
    exact = exact.withColumn("_ranks", F.filter("_ranks", lambda r: (r >= until - F.col("_n")) & (r < until)))

    found = exact.select(*keys, "_value", "_ranks")
    for level in (coarse, fine):
        found = found.unionByName(level.where("NOT (_lo < _hi)").select(*keys, F.col("_lo").alias("_value"), "_ranks"))
    return found.select(*group, F.explode("_ranks").alias("_rank"), "_value")


def quantiles_by_counting(df: DataFrame, group: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles as rows (group, probability, quantile), like ``ordered.quantiles_long``."""
    wanted = [float(p) for p in probabilities]

    def ends(n: Column) -> Column:
        spots = [F.lit(p) * (n - 1) for p in wanted]
        return F.array(*[e for s in spots for e in (F.floor(s), F.ceil(s))])

    found = select_ranks(df, group, value, ends)
    sizes = df.where(F.col(value).isNotNull()).groupBy(*group).agg(F.count(F.lit(1)).alias("_all"))
    spots = sizes.withColumn("probability", F.explode(F.array(*[F.lit(p) for p in wanted])))
    spots = spots.withColumn("_spot", F.col("probability") * (F.col("_all") - 1))
    sides = spots.withColumn("_side", F.explode(F.array(F.struct(F.lit(0).alias("high"), F.floor("_spot").alias("_rank")), F.struct(F.lit(1).alias("high"), F.ceil("_spot").alias("_rank")))))
    sides = sides.select(*group, "probability", "_spot", "_side.*")
    met = null_safe_join(sides, found, [*group, "_rank"])
    at = lambda high: F.max(F.when(F.col("high") == high, F.col("_value")))
    pair = met.groupBy(*group, "probability").agg(at(0).alias("_lo"), at(1).alias("_hi"), F.max(F.col("_spot") - F.floor("_spot")).alias("_part"))
    return pair.select(*group, "probability", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")).alias("quantile"))
