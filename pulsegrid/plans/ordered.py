"""Ordered work inside groups (positions, prefix sums, previous row, exact quantiles).

A window function puts a whole group into one task. That is fine for groups of a checked
size; a group beyond ``spark.pulsegrid.maxGroupRows`` is cut instead: rows are range
partitioned on (group, order), which balances any skew, the sorted layout is checkpointed
so that its bounds are fixed, and each (group, partition) piece gets what the pieces before
it carry over from a summary of one row per piece.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.session import group_row_limit, materialise, ranked_row_limit

PIECE = "_piece"
SLOT = "_slot"
_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group; partial counts, one number to the driver."""
    if not group:
        return df.count()
    return df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys meet; the right copies of the keys are dropped."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_r_{key}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


@dataclass(frozen=True)
class Layout:
    """Rows of ``df`` ordered inside each group, whole or cut into pieces."""

    df: DataFrame
    group: tuple[str, ...]
    order: tuple[Column, ...]
    split: bool

    def _group_columns(self) -> list[Column]:
        return [F.col(name) for name in self.group] or [F.lit(0)]

    def _whole(self):
        return Window.partitionBy(*self._group_columns())

    def _rows(self):
        if self.split:
            return Window.partitionBy(*self.group, PIECE).orderBy(SLOT)
        return self._whole().orderBy(*self.order)

    def _with_summary(self, before: Mapping[str, Column]) -> DataFrame:
        keys = [*self.group, PIECE]
        summary = self.df.groupBy(*keys).agg(
            F.min(SLOT).alias("_first_slot"), *[c.alias(n) for n, c in before.items()]
        )
        return keys, summary

    def _done(self, df: DataFrame, *extra: str) -> DataFrame:
        return df.drop(PIECE, SLOT, "_first_slot", *extra)

    def ordinal(self, out: str) -> DataFrame:
        """Add the 0-based position of each row in its group."""
        if not self.split:
            return self.df.withColumn(out, (F.row_number().over(self._rows()) - 1).cast("long"))
        keys, summary = self._with_summary({"_n": F.count(F.lit(1))})
        ahead = self._whole().orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        summary = summary.withColumn("_base", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
        joined = null_safe_join(self.df, summary, keys)
        return self._done(
            joined.withColumn(out, F.col("_base") + F.col(SLOT) - F.col("_first_slot")), "_base"
        )

    def running(self, sums: Mapping[str, str], totals: Mapping[str, str] | None = None) -> DataFrame:
        """Add inclusive running sums and, on request, group totals: {new column: column}.

        As in SQL a sum is NULL until the first value that is not.
        """
        totals = dict(totals or {})
        inside = self._rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if not self.split:
            df = self.df
            for out, name in sums.items():
                df = df.withColumn(out, F.sum(name).over(inside))
            for out, name in totals.items():
                df = df.withColumn(out, F.sum(name).over(self._whole()))
            return df
        names = sorted({*sums.values(), *totals.values()})
        keys, summary = self._with_summary({f"_s_{n}": F.sum(n) for n in names})
        ahead = self._whole().orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        for n in names:
            summary = summary.withColumn(f"_b_{n}", F.sum(f"_s_{n}").over(ahead))
            summary = summary.withColumn(f"_t_{n}", F.sum(f"_s_{n}").over(self._whole()))
        df = null_safe_join(self.df, summary, keys)
        for out, name in sums.items():
            here, base = F.sum(name).over(inside), F.col(f"_b_{name}")
            df = df.withColumn(out, F.coalesce(here + base, here, base))
        for out, name in totals.items():
            df = df.withColumn(out, F.col(f"_t_{name}"))
        return self._done(df, *[f"_{k}_{n}" for k in "sbt" for n in names])

    def previous(self, values: Mapping[str, str], present: str | None = None) -> DataFrame:
        """Add the value of the row before (NULL on the first row): {new column: column}.

        ``present`` names a boolean column telling whether there is a row before.
        """
        inside = self._rows()
        df = self.df
        if not self.split:
            for out, name in values.items():
                df = df.withColumn(out, F.lag(name).over(inside))
            if present:
                df = df.withColumn(present, F.row_number().over(inside) > 1)
            return df
        last = F.struct(F.lit(True).alias("_seen"), *[F.col(n).alias(f"v_{o}") for o, n in values.items()])
        keys, summary = self._with_summary({"_last": F.max_by(last, SLOT)})
        pieces = self._whole().orderBy(PIECE)
        summary = summary.withColumn("_before", F.lag("_last").over(pieces)).drop("_last")
        df = null_safe_join(df, summary, keys)
        first = F.col(SLOT) == F.col("_first_slot")
        for out, name in values.items():
            df = df.withColumn(
                out, F.when(first, F.col(f"_before.v_{out}")).otherwise(F.lag(name).over(inside))
            )
        if present:
            df = df.withColumn(present, ~first | F.coalesce(F.col("_before._seen"), F.lit(False)))
        return self._done(df, "_before")


def layout(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    limit: int | None = None,
    bound: int | None = None,
) -> Layout:
    """Choose the plain window for groups of a checked size, the cut layout beyond it.

    ``bound`` is a known upper bound of the largest group; without it the groups are
    counted (group columns only).
    """
    limit = group_row_limit(df.sparkSession) if limit is None else limit
    columns = tuple(F.col(c) if isinstance(c, str) else c for c in order)
    if (largest_group(df, group) if bound is None else bound) <= limit:
        return Layout(df, tuple(group), columns, split=False)
    keys = [*[F.col(g) for g in group], *columns]
    laid = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(SLOT, F.monotonically_increasing_id())
        .withColumn(PIECE, F.shiftright(SLOT, _PARTITION_SHIFT))
    )
    return Layout(materialise(laid), tuple(group), columns, split=True)


def with_ordinal(df, group, order, out="ordinal", limit=None) -> DataFrame:
    """0-based position in the group; ``order`` should be total."""
    return layout(df, group, order, limit).ordinal(out)


def with_previous(df, group, order, values, present=None, limit=None) -> DataFrame:
    """Values of the row before in the group."""
    return layout(df, group, order, limit).previous(values, present)


def value_ranks(
    df: DataFrame, group: Sequence[str], value: str, limit: int | None = None, bound: int | None = None
) -> DataFrame:
    """Distinct values with their rank interval [_from, _upto) and the group size _all.

    Values are counted first, so repeated values shrink before the shuffle; no group is
    ever held as a list. ``bound`` is the size of the largest group, if it is known.
    """
    kept = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_value"))
    bound = largest_group(kept, group) if bound is None else bound
    counted = kept.groupBy(*group, "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranked = layout(counted, group, ["_value"], limit, bound).running({"_upto": "_n"}, {"_all": "_n"})
    return ranked.withColumn("_from", F.col("_upto") - F.col("_n"))


def order_statistic(
    df: DataFrame, group: Sequence[str], value: str, rank: Callable[[Column], Column], out: str, limit=None
) -> DataFrame:
    """The value at a 0-based rank given as a function of the group size (large groups: see ``selection``)."""
    bound = largest_group(df.where(F.col(value).isNotNull()), group)
    if bound > ranked_row_limit(df.sparkSession):
        from pulsegrid.plans.selection import select_ranks

        return select_ranks(df, group, value, lambda n: F.array(rank(n))).select(*group, F.col("_value").alias(out))
    ranked = value_ranks(df, group, value, limit, bound)
    k = rank(F.col("_all"))
    return ranked.where((k >= F.col("_from")) & (k < F.col("_upto"))).select(*group, F.col("_value").alias(out))


def quantiles_long(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    limit: int | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles as rows (group, probability, quantile) (large groups: see ``selection``)."""
    bound = largest_group(df.where(F.col(value).isNotNull()), group)
    if bound > ranked_row_limit(df.sparkSession):
        from pulsegrid.plans.selection import quantiles_by_counting

        return quantiles_by_counting(df, group, value, probabilities)
    ranked = value_ranks(df, group, value, limit, bound)

    def position(p: Column) -> Column:
        return p * (F.col("_all") - 1)

    hits = ranked.select(
        *group,
        "_value",
        "_from",
        "_upto",
        "_all",
        F.explode(
            F.filter(
                F.array(*[F.lit(float(p)) for p in probabilities]),
                lambda p: (F.ceil(position(p)) >= F.col("_from"))
                & (F.floor(position(p)) < F.col("_upto")),
            )
        ).alias("probability"),
    )
    spot = position(F.col("probability"))
    held = lambda rank: (rank >= F.col("_from")) & (rank < F.col("_upto"))
    ends = hits.groupBy(*group, "probability").agg(
        F.max(F.when(held(F.floor(spot)), F.col("_value"))).alias("_lo"),
        F.max(F.when(held(F.ceil(spot)), F.col("_value"))).alias("_hi"),
        F.max(spot - F.floor(spot)).alias("_part"),
    )
    return ends.select(
        *group,
        "probability",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")).alias("quantile"),
    )


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    limit: int | None = None,
) -> DataFrame:
    """Exact quantiles as one column per name in ``probabilities``."""
    long = quantiles_long(df, group, value, sorted(set(probabilities.values())), limit)
    return long.groupBy(*group).agg(
        *[
            F.max(F.when(F.col("probability") == F.lit(float(p)), F.col("quantile"))).alias(name)
            for name, p in probabilities.items()
        ]
    )
