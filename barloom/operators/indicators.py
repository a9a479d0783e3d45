"""Technical indicators over price bars.

An indicator is a recipe with a look-back; ``add`` applies any number of them in one pass, so all of them share
the shuffle and sort of ``blocks.place``. Rolling indicators are window expressions, and so are exponential means, as sums of values
scaled by the product of their weights.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.blocks import BLOCK_ROWS, Placed, place

@dataclass(frozen=True)
class Ewm:
    """An exponential mean to be taken over ``source``: seeded with its first value, null before ``warmup`` values."""

    name: str
    source: str
    alpha: float
    warmup: int = 0
    minus: str | None = None  # when set, the source is the difference source - minus


def fading_rows(means: Sequence[Ewm]) -> int:
    """Rows after which the weight of all older rows, and so of where the means started, is below double precision.

    A row's weight falls by 1 - alpha with each later row; 37 is -ln of half a unit in the last place. The rows of a mean of other
    means add to theirs.
    """
    depth: dict[str, int] = {}
    for m in means:
        below = max(depth.get(m.source, 0), depth.get(m.minus or "", 0))
        depth[m.name] = below + (math.ceil(37 / -math.log1p(-m.alpha)) if m.alpha < 1 else 1) + m.warmup
    return max(depth.values(), default=0)


@dataclass(frozen=True)
class Indicator:
    """``before`` adds window columns, ``means`` are exponential means, ``after`` adds row-level columns."""

    lookback: int
    before: Callable[[Placed], Placed] | None = None
    means: tuple[Ewm, ...] = ()
    after: Callable[[DataFrame], DataFrame] | None = None
    scratch: tuple[str, ...] = ()
    prior: tuple[tuple[str, tuple[str, ...], float], ...] = ()  # previous row of a difference: (new column, terms, default)
    extra: int = 0  # rows needed on top of the indicators it builds on


def add(
    df: DataFrame,
    *indicators: Indicator,
    keys: Sequence[str] = ("ticker",),
    order: str = "date",
    block_rows: int = BLOCK_ROWS,
    chunk: Column | None = None,
    keep_state: bool = False,
) -> DataFrame:
    """Add every indicator to the bars of every series.

    ``keep_state`` also returns what :func:`barloom.operators.resume.advance` needs to go on from any row: ``state_n`` (rows before it) and the value of
    every exponential mean. A frame that holds columns of :data:`RESUME` goes on from such a row.
    """
    lookback = 0
    for i in indicators:
        lookback = lookback + i.extra if i.extra else max(lookback, i.lookback)
    means = [m for i in indicators for m in i.means]
    # a block that holds fewer rows than it borrows would copy every row several times
    placed = place(df, keys, order, lookback, max(block_rows, lookback), chunk)
    for i in indicators:
        if i.before:
            placed = i.before(placed)
    prior = [p for i in indicators for p in i.prior]
    if means:
        placed = placed.with_df(exponential(placed, means, prior, keep_state))
    elif keep_state:
        placed = placed.with_columns({"state_n": _seen_before(placed)})
    for i in indicators:
        if i.after:
            placed = placed.with_df(i.after(placed.df))
    return placed.finish(*[s for i in indicators for s in i.scratch], *resume_columns(df))


#: Columns of a resumed frame: whether a row lies at or after the row that means go on from, and rows of the series before the frame.
RESUME = ("_live", "_skipped")
#: Prefix of the columns with the means of the row to go on from, null on all other rows.
SEED = "_seed_"
#: Decay, in natural logarithms, over which scaled sums run at least and at most: a quarter of the first is below double precision, and the last with a quarter on top
#: can still be represented.
FADED, REPRESENTABLE = 160.0, 520.0


def resume_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in RESUME or c.startswith(SEED)]


def state_column(mean: str) -> str:
    return f"state_{mean.strip('_')}"


def _seen_before(placed: Placed) -> Column:
    skipped = F.col("_skipped") if "_skipped" in placed.df.columns else F.lit(0)
    return F.col("_pos") + skipped


def _spans(means: Sequence[Ewm]) -> dict[str, int]:
    """Rows after which each mean's scaled sums start anew. Means share a number where they can, and so a sort."""
    taken: list[int] = []
    found = {}
    for m in sorted((m for m in means if m.alpha < 1), key=lambda m: m.alpha):
        decay = -math.log1p(-m.alpha)
        fit = [n for n in taken if FADED <= n * decay <= REPRESENTABLE]
        if not fit:
            fit = [math.ceil(FADED / decay)]
            taken += fit
        found[m.name] = fit[0]
    return found


def _whole_rows(mean: Ewm) -> int:
    """Rows over which a mean's scaled sums can run without a new start."""
    return int(REPRESENTABLE / -math.log1p(-mean.alpha))


def _levels(means: Sequence[Ewm]) -> list[list[Ewm]]:
    """Means that build on columns or on means of the levels before."""
    depth: dict[str, int] = {}
    for m in means:
        depth[m.name] = max(depth.get(m.source, -1), depth.get(m.minus or "", -1)) + 1
    return [[m for m in means if depth[m.name] == d] for d in range(max(depth.values(), default=-1) + 1)]


def exponential(placed: Placed, means: list[Ewm], prior: list[tuple[str, tuple[str, ...], float]], keep_state: bool = False) -> DataFrame:
    """All exponential means as window expressions.

    A row maps the mean before it to a * mean + b * value, so the mean is P * sum(b * value / P) with P the product of the a so far. Means that do not build on each
    other share their windows, and all windows the sort of the block. Where a block has so many rows that P would leave the range of doubles,
    products and sums start anew after every span of rows: the last value of the span before enters with weight P, and what came before that weighs less than
    double precision. A missing value keeps the mean, and the next value weighs more, as its predecessor is further away.
    """
    spans = _spans([m for m in means if m.alpha < 1 and placed.rows > _whole_rows(m)])
    root: dict[str, str] = {}  # which values are missing: those of a column, or all before its first
    named = [*placed.keys, "_blk"]
    until = placed.window.rowsBetween(Window.unboundedPreceding, 0)
    earlier = placed.window.rowsBetween(Window.unboundedPreceding, -1)
    resumed = "_live" in placed.df.columns
    helpers = set()
    for level in _levels(means):
        values, known, counts, origins = {}, {}, {}, {}
        for m in level:
            origins[m.name] = root.get(m.source, m.source)
            root[m.name] = f"{origins[m.name].removesuffix('+')}+"  # a mean goes on over missing values
            value = F.col(m.source) if m.minus is None else F.col(m.source) - F.col(m.minus)
            if resumed:
                seed = SEED + m.name.strip("_")
                value = F.when(F.col("_live"), F.coalesce(seed, value) if seed in placed.df.columns else value)
            x, gap = f"_x{m.name}", f"_gap_{origins[m.name]}"
            values[x] = value.cast("double")
            if m.alpha >= 1:
                known[m.name] = F.last(x, ignorenulls=True).over(until)
                continue
            # what is averaged is the distance to the first value, so that a series which does not move has exact means
            known[f"_first{m.name}"] = F.first(x, ignorenulls=True).over(until)
            seen = F.col(x).isNotNull()
            if gap not in helpers:
                known[gap] = F.when(seen, F.col("_n") - F.last(F.when(seen, F.col("_n")), ignorenulls=True).over(earlier))
            helpers.add(gap)
            if m.name in spans:
                rows = spans[m.name]
                counts[f"_span{rows}_{origins[m.name]}"] = rows, F.sum(F.when(F.col(gap).isNotNull(), F.least(gap, F.lit(rows // 4))).otherwise(0)).over(until)
        placed = placed.with_columns(values).with_columns(known)
        counts = {n: c for n, c in counts.items() if n not in helpers}
        placed = placed.with_columns({n: c for n, (_, c) in counts.items()}).with_columns({n: F.expr(f"`{n}` div {rows}") for n, (rows, _) in counts.items()})
        helpers |= set(counts)
        fading = [m for m in level if m.alpha < 1]
        weights, products, parts, ends, found = {}, {}, {}, {}, {}
        for m in fading:
            span = f"_span{spans[m.name]}_{origins[m.name]}" if m.name in spans else None
            # the windows of a span sort by key, block, span and order, so one sort serves them
            inside = Window.partitionBy(*named, span).orderBy(placed.order).rowsBetween(Window.unboundedPreceding, 0) if span else until
            x, gap = F.col(f"_x{m.name}"), F.col(f"_gap_{origins[m.name]}")
            seen = x.isNotNull()
            fade = F.pow(F.lit(1 - m.alpha), F.least(gap, F.lit(spans[m.name] // 4)) if span else gap)
            opens, plain = seen & gap.isNull(), gap == 1
            weights[f"_keep{m.name}"] = F.when(~seen | opens, 1.0).when(plain, 1 - m.alpha).otherwise(fade / (fade + m.alpha))
            gain = F.when(~seen, 0.0).when(opens, 1.0).when(plain, m.alpha).otherwise(m.alpha / (fade + m.alpha))
            weights[f"_add{m.name}"] = gain * F.coalesce(x - F.col(f"_first{m.name}"), F.lit(0.0))
            products[f"_p{m.name}"] = F.product(f"_keep{m.name}").over(inside)
            parts[f"_part{m.name}"] = F.col(f"_p{m.name}") * F.sum(F.col(f"_add{m.name}") / F.col(f"_p{m.name}")).over(inside)
            mean = F.col(f"_first{m.name}") + F.col(f"_part{m.name}")
            if span:
                across = Window.partitionBy(*named).orderBy(span, placed.order)
                ends[f"_left{m.name}"] = F.when(F.lag(span).over(across) < F.col(span), F.lag(f"_part{m.name}").over(across))
                entered = F.last(f"_left{m.name}", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, 0))
                mean = mean + F.col(f"_p{m.name}") * F.coalesce(entered, F.lit(0.0))
            found[m.name] = mean
        placed = placed.with_columns(weights).with_columns(products).with_columns(parts).with_columns(ends).with_columns(found)
        placed = placed.with_df(placed.df.drop(*values, *[n for n in known if n.startswith("_first")], *weights, *products, *parts, *ends))
    df = placed.df.drop(*helpers)
    at = _seen_before(placed)
    if keep_state:
        df = df.withColumns({"state_n": at, **{state_column(m.name): F.col(m.name) for m in means}})
    df = df.withColumns({m.name: F.when(at >= m.warmup, F.col(m.name)) for m in means if m.warmup})
    for name, terms, default in prior:
        value = F.col(terms[0])
        for term in terms[1:]:
            value = value - F.col(term)
        df = df.withColumn(name, value).withColumn(name, F.coalesce(F.lag(name).over(placed.window), F.lit(default)))
    return df


def sma(rows: int, source: str = "close", name: str | None = None) -> Indicator:
    """Mean of the last ``rows`` rows; shorter frames count at the start."""
    return Indicator(rows, lambda p: p.with_columns({name or f"sma_{rows}": F.avg(source).over(p.last(rows))}))


def macd(mode: str = "ewm", fast: int = 12, slow: int = 26, signal: int = 9, source: str = "close") -> Indicator:
    """Difference of two means, its own mean, and the histogram.

    ``ewm`` uses exponential means, ``sma`` simple row means (which the indicator batch job labels as exponential).
    """
    if mode == "sma":

        def columns(p: Placed) -> Placed:
            p = p.with_columns({"_fast": F.avg(source).over(p.last(fast)), "_slow": F.avg(source).over(p.last(slow))})
            p = p.with_columns({"macd": F.col("_fast") - F.col("_slow")})
            p = p.with_columns({"macd_signal": F.avg("macd").over(p.last(signal))})
            p = p.with_columns({"macd_hist": F.col("macd") - F.col("macd_signal")})
            return p.with_df(p.df.withColumnsRenamed({"_fast": f"ema_{fast}", "_slow": f"ema_{slow}"}))

        return Indicator(slow + signal, columns)
    if mode != "ewm":
        raise ValueError(f"unknown mode {mode!r}")
    means = (
        Ewm("_fast", source, 2.0 / (fast + 1)),
        Ewm("_slow", source, 2.0 / (slow + 1)),
        Ewm("macd_signal", "_fast", 2.0 / (signal + 1), minus="_slow"),
    )
    return Indicator(
        fading_rows(means),
        means=means,
        after=lambda df: df.withColumn("macd", F.col("_fast") - F.col("_slow")).withColumn(
            "macd_hist", F.col("macd") - F.col("macd_signal")
        ),
        scratch=("_fast", "_slow"),
    )


def _change(p: Placed, source: str) -> Column:
    return F.col(source) - F.lag(source).over(p.window)


def _strength(gain: Column, loss: Column) -> Column:
    """100 - 100 / (1 + gain / loss), null where there was no loss."""
    return 100.0 - 100.0 / (1.0 + F.try_divide(gain, loss))


def rsi(mode: str = "sma", rows: int = 14, fill: float | None = None, source: str = "close") -> Indicator:
    """Relative strength: ``sma`` averages row windows, ``wilder`` exponentially with weight 1/rows.

    Without any loss in the window the ratio is null; ``fill`` replaces it. The Wilder form is undefined until ``rows``
    changes were seen, and there the neutral value 50 stands in, as it does for a window without loss.
    """
    if mode == "sma":

        def columns(p: Placed) -> Placed:
            p = p.with_columns({"_change": _change(p, source)})
            p = p.with_columns(
                {
                    "gain": F.when(F.col("_change") > 0, F.col("_change")).otherwise(0.0),
                    "loss": F.when(F.col("_change") < 0, -F.col("_change")).otherwise(0.0),
                }
            )
            p = p.with_columns({"avg_gain": F.avg("gain").over(p.last(rows)), "avg_loss": F.avg("loss").over(p.last(rows))})
            ratio = _strength(F.col("avg_gain"), F.col("avg_loss"))
            p = p.with_columns(
                {
                    "rs": F.try_divide("avg_gain", "avg_loss"),
                    "rsi": ratio if fill is None else F.coalesce(ratio, F.lit(fill)),
                }
            )
            return p.with_df(p.df.drop("_change"))

        return Indicator(rows + 1, columns)
    if mode != "wilder":
        raise ValueError(f"unknown mode {mode!r}")

    neutral = F.lit(50.0 if fill is None else fill)

    def moves(p: Placed) -> Placed:
        p = p.with_columns({"_change": _change(p, source)})
        return p.with_columns(
            {
                # greatest() skips nulls, and the first change must stay unknown
                "_up": F.when(F.col("_change").isNotNull(), F.greatest("_change", F.lit(0.0))),
                "_down": F.when(F.col("_change").isNotNull(), F.greatest(-F.col("_change"), F.lit(0.0))),
            }
        )

    means = (Ewm("_avg_up", "_up", 1.0 / rows, warmup=rows), Ewm("_avg_down", "_down", 1.0 / rows, warmup=rows))
    return Indicator(
        fading_rows(means) + 1,
        before=moves,
        means=means,
        after=lambda df: df.withColumn(
            "rsi",
            F.coalesce(_strength(F.col("_avg_up"), F.col("_avg_down")), neutral),
        ),
        scratch=("_change", "_up", "_down", "_avg_up", "_avg_down"),
    )


def bollinger(rows: int = 20, ddof: int = 1, fill: float | None = None, width: float = 2.0, source: str = "close") -> Indicator:
    """Mean and bands of ``width`` standard deviations; ``ddof`` 1 is the sample form (null on the first row), 0 the population form."""
    deviation = F.stddev_samp if ddof == 1 else F.stddev_pop

    def columns(p: Placed) -> Placed:
        spread = deviation(source).over(p.last(rows))
        p = p.with_columns(
            {
                "bb_mid": F.avg(source).over(p.last(rows)),
                "bb_std": spread if fill is None else F.coalesce(spread, F.lit(fill)),
            }
        )
        return p.with_columns(
            {
                "bb_upper": F.col("bb_mid") + width * F.col("bb_std"),
                "bb_lower": F.col("bb_mid") - width * F.col("bb_std"),
            }
        )

    return Indicator(rows, columns)
