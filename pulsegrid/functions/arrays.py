"""Expressions on window arrays.

A tensor is channel-major: ``array<array<double>>``, one inner array of steps per channel.
Everything stays inside the row, so no operator here shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.schema import FEATURE_WEIGHTS, FEATURES

EPS = 1e-8


def let(values: Sequence[Column], body) -> Column:
    """Bind expressions to lambda variables, so that inner lambdas do not evaluate them again."""
    bound = F.array(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)]))
    return F.element_at(F.transform(bound, lambda r: body(*[r[f"v{i}"] for i in range(len(values))])), 1)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def mean(x: Column) -> Column:
    return total(x) / F.size(x)


def moment(x: Column, centre: Column, power: int) -> Column:
    """Mean of (v - centre) ** power."""

    def term(acc, v):
        d = v - centre
        out = d
        for _ in range(power - 1):
            out = out * d
        return acc + out

    return F.aggregate(x, F.lit(0.0), term) / F.size(x)


def std(x: Column) -> Column:
    """Population standard deviation."""
    return let([x, mean(x)], lambda v, m: F.sqrt(moment(v, m, 2)))


def diff(x: Column) -> Column:
    """First differences, one shorter than the input."""
    n = F.size(x) - 1
    return F.zip_with(F.slice(x, 2, n), F.slice(x, 1, n), lambda b, a: b - a)


def percentile(sorted_x: Column, p: float) -> Column:
    """Linear-interpolated percentile of a sorted array."""
    spot = F.lit(float(p)) * (F.size(sorted_x) - 1)
    low = F.get(sorted_x, F.floor(spot).cast("int"))
    high = F.get(sorted_x, F.ceil(spot).cast("int"))
    return low + (high - low) * (spot - F.floor(spot))


def segments(x: Column, steps: int) -> Column:
    """Array cut into ``steps`` equal parts; a length that does not divide raises."""
    size = F.size(x)
    wrong = F.raise_error(F.concat(F.lit("array length not divisible by "), F.lit(str(steps))))
    checked = F.when(size % steps == 0, x).otherwise(wrong)
    part = F.floor(size / steps).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.slice(checked, i * part + 1, part))


def morphology_bins(x: Column, steps: int = 100) -> Column:
    """Feature tensor of a window: mean, std, min, max, range, slope, energy per bin."""
    parts = let([x], lambda v: segments(v, steps))
    with_mean = F.transform(parts, lambda s: F.struct(s.alias("s"), mean(s).alias("m")))
    cells = F.transform(
        with_mean,
        lambda b: F.array(
            b["m"],
            F.sqrt(moment(b["s"], b["m"], 2)),
            F.array_min(b["s"]),
            F.array_max(b["s"]),
            F.array_max(b["s"]) - F.array_min(b["s"]),
            F.element_at(b["s"], -1) - F.element_at(b["s"], 1),
            moment(b["s"], F.lit(0.0), 2),
        ),
    )
    return let([cells], lambda rows: transpose(rows, len(FEATURES)))


def transpose(rows: Column, width: int) -> Column:
    """Step-major array of arrays (a bound variable or a column) to channel-major."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda c: F.transform(rows, lambda r: F.get(r, c))
    )


def robust_scale(tensor: Column, lo: Sequence[float], hi: Sequence[float]) -> Column:
    """(F - lo) / (hi - lo + eps) per channel, clipped to [0, 1]."""
    bounds = F.array(*[F.struct(F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for a, b in zip(lo, hi, strict=True)])
    return F.zip_with(
        tensor,
        bounds,
        lambda ch, b: F.transform(
            ch, lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - b["lo"]) / (b["hi"] - b["lo"] + EPS)))
        ),
    )


def weights_for(tensor: Column, weights: Sequence[float] = FEATURE_WEIGHTS) -> Column:
    """Channel weights over their sum; equal weights for another number of channels."""
    s = sum(weights)
    given = F.array(*[F.lit(w / (s + EPS)) for w in weights])
    n = F.size(tensor)
    return F.when(n == len(weights), given).otherwise(F.array_repeat(F.lit(1.0) / (n + EPS), n))


def per_channel(x: Column, x_hat: Column, cell) -> Column:
    """Mean over steps of ``cell(a, b)`` for every channel."""
    return F.zip_with(x, x_hat, lambda a, b: mean(F.zip_with(a, b, cell)))


def channel_mse(x: Column, x_hat: Column) -> Column:
    return per_channel(x, x_hat, lambda a, b: (a - b) * (a - b))


def weighted(per: Column, tensor: Column, weights: Sequence[float] = FEATURE_WEIGHTS) -> Column:
    return total(F.zip_with(per, weights_for(tensor, weights), lambda v, w: v * w))


def weighted_mse(x: Column, x_hat: Column, weights: Sequence[float] = FEATURE_WEIGHTS) -> Column:
    """Reconstruction loss of a window: weighted sum of channel errors."""
    return weighted(channel_mse(x, x_hat), x, weights)


def mean_and_detail_loss(x: Column, x_hat: Column) -> tuple[Column, Column]:
    """Error of channel 0 and of all other channels (0 if there is none)."""
    per = channel_mse(x, x_hat)
    rest = F.slice(per, 2, F.size(per) - 1)
    return F.element_at(per, 1), F.when(F.size(per) > 1, mean(rest)).otherwise(F.lit(0.0))


def pattern_loss(x: Column, x_hat: Column, weights: Sequence[float] = FEATURE_WEIGHTS) -> Column:
    """Weighted mean absolute difference of first differences."""
    per = F.zip_with(x, x_hat, lambda a, b: mean(F.zip_with(diff(a), diff(b), lambda u, v: F.abs(u - v))))
    return weighted(per, x, weights)


def trend_loss(x: Column, x_hat: Column, weights: Sequence[float] = FEATURE_WEIGHTS) -> Column:
    """The same on second differences."""
    per = F.zip_with(x, x_hat, lambda a, b: mean(F.zip_with(diff(diff(a)), diff(diff(b)), lambda u, v: F.abs(u - v))))
    return weighted(per, x, weights)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda u, v: u * v))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two flat arrays, NULL when a norm vanishes."""

    def body(u, v):
        norm = F.sqrt(dot(u, u)) * F.sqrt(dot(v, v))
        return F.when(norm > 1e-12, dot(u, v) / norm)

    return let([a, b], body)


def pearson(a: Column, b: Column) -> Column:
    """Correlation of two flat arrays, NULL when one is constant."""

    def body(u, v, mu, mv):
        centred_u, centred_v = F.transform(u, lambda x: x - mu), F.transform(v, lambda x: x - mv)
        return cosine(centred_u, centred_v)

    return let([a, b, mean(a), mean(b)], body)


def block_mean(x: Column, block: int) -> Column:
    """Every value replaced by the mean of its block: a fixed reconstruction for checks."""
    def smooth(ch):
        n = F.floor(F.size(ch) / block).cast("int")
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), n - 1),
                lambda i: F.array_repeat(mean(F.slice(ch, i * block + 1, F.lit(block))), block),
            )
        )

    return F.transform(x, smooth)


def step_error(x: Column, x_hat: Column, weights: Sequence[float] = FEATURE_WEIGHTS) -> Column:
    """Weighted squared error per step."""
    w = weights_for(x, weights)
    steps = F.size(F.element_at(x, 1))
    squared = F.zip_with(x, x_hat, lambda a, b: F.zip_with(a, b, lambda u, v: (u - v) * (u - v)))
    return let(
        [squared, w, steps],
        lambda sq, ws, n: F.transform(
            F.sequence(F.lit(0), n - 1), lambda t: total(F.zip_with(sq, ws, lambda ch, wc: F.get(ch, t) * wc))
        ),
    )


def scale_by_max(values: Column) -> Column:
    """Values over their maximum."""
    return let([values, F.array_max(values)], lambda vs, top: F.transform(vs, lambda v: v / (top + EPS)))


SEQUENCE_FEATURES = (
    "mean", "var", "std", "min", "max", "range", "skew", "kurtosis", "reach_p20", "reach_p40", "reach_p60",
    "reach_p80", "diff_mean", "diff_max", "diff_std", "diff_iqr",
)


def finite_or_zero(v: Column) -> Column:
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v)


def sequence_features(x: Column) -> Column:
    """Sixteen values of one channel in a fixed order; non-finite ones become 0."""
    prepared = F.transform(
        F.array(x),
        lambda v: F.struct(
            v.alias("v"), F.array_sort(v).alias("s"), diff(v).alias("d"), F.array_sort(diff(v)).alias("ds"),
            mean(v).alias("m"),
        ),
    )

    def features(r):
        v, s, d, ds, m = r["v"], r["s"], r["d"], r["ds"], r["m"]
        var = moment(v, m, 2)
        last = F.greatest(F.size(v) - 1, F.lit(1))

        def reach(p):
            marks = let([v, percentile(s, p)], lambda vs, limit: F.transform(vs, lambda u: (u >= limit).cast("int")))
            return let(
                [F.array_position(marks, F.lit(1))],
                lambda at: F.when(at > 0, at - 1).otherwise(F.size(v).cast("long") - 1),
            ) / last

        low, high = F.array_min(v), F.array_max(v)
        cells = [
            m, var, F.sqrt(var), low, high, high - low,
            F.when(var > 0, moment(v, m, 3) / F.pow(var, F.lit(1.5))),
            F.when(var > 0, moment(v, m, 4) / (var * var) - 3.0),
            reach(0.2), reach(0.4), reach(0.6), reach(0.8),
            mean(d), F.array_max(d), std(d), percentile(ds, 0.75) - percentile(ds, 0.25),
        ]
        return F.array(*[finite_or_zero(c.cast("double")) for c in cells])

    return F.element_at(F.transform(prepared, features), 1)


def _uniform(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) fixed by the seed and the keys, the same on every retry."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    drawn = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double")
    return (drawn + 0.5) / float(1 << 48)


def gaussian(seed: int, *keys: Column) -> Column:
    """Standard normal number fixed by the seed and the keys."""
    u1, u2 = _uniform(seed, *keys), _uniform(seed + 1, *keys)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(u2 * (2.0 * 3.141592653589793))


def add_noise(tensor: Column, window: Column, deviation: float = 0.03, clip: float = 0.10, seed: int = 42) -> Column:
    """Clipped normal noise on every value, result clipped to [0, 1]."""
    return F.transform(
        tensor,
        lambda ch, c: F.transform(
            ch,
            lambda v, t: F.greatest(
                F.lit(0.0),
                F.least(
                    F.lit(1.0),
                    v + F.greatest(F.lit(-clip), F.least(F.lit(clip), gaussian(seed, window, c, t) * deviation)),
                ),
            ),
        ),
    )


def mask_steps(tensor: Column, window: Column, rate: float = 0.25, seed: int = 42) -> Column:
    """Drop whole steps over all channels and scale the kept ones by 1 / (1 - rate)."""
    if rate <= 0:
        return tensor
    return F.transform(
        tensor,
        lambda ch: F.transform(
            ch,
            lambda v, t: F.when(_uniform(seed, window, t) < rate, F.lit(0.0)).otherwise(v / (1.0 - rate)),
        ),
    )
