"""Trading signals on top of indicator columns; each is an ``Indicator`` to pass to ``indicators.add``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.blocks import Placed, place
from barloom.operators.indicators import Indicator, bollinger, exponential, macd, resume_columns, rsi


def crossover() -> Indicator:
    """1 where the MACD line crosses its signal line upwards (buy) or downwards (sell), else 0. Follows ``macd(mode='sma')``."""

    def columns(p: Placed) -> Placed:
        p = p.with_columns({"_was": F.lag("macd").over(p.window), "_was_signal": F.lag("macd_signal").over(p.window)})
        up = (F.col("macd") > F.col("macd_signal")) & (F.col("_was") <= F.col("_was_signal"))
        down = (F.col("macd") < F.col("macd_signal")) & (F.col("_was") >= F.col("_was_signal"))
        p = p.with_columns({"buy": F.when(up, 1).otherwise(0), "sell": F.when(down, 1).otherwise(0)})
        return p.with_df(p.df.drop("_was", "_was_signal"))

    return Indicator(0, columns, extra=1)


HOLD = 5
#: Rows before a bar that the rolling indicators of ``batch_rule`` read.
BATCH_ROWS = 20


def batch_rule(df: DataFrame, hold: int = HOLD, keys: tuple[str, ...] = ("ticker",), order: str = "date", keep_state: bool = False) -> DataFrame:
    """Sample bands, simple-mean RSI and exponential MACD, with signals that stay on for ``hold`` rows.

    Buy needs all of: MACD under its signal line and under zero, RSI under 30, close at or under the lower band. Sell is the mirror
    image with RSI over 70. ``keep_state`` and resumed frames are as in ``indicators.add``.
    """
    line = macd()
    placed = place(df, keys, order, line.lookback + hold)
    for i in (bollinger(BATCH_ROWS, ddof=1, fill=0.0), rsi("sma", fill=50.0)):
        placed = i.before(placed)
    placed = placed.with_df(line.after(exponential(placed, list(line.means), [], keep_state)))
    buy = (
        (F.col("macd") < F.col("macd_signal"))
        & (F.col("macd") < 0)
        & (F.col("rsi") < 30)
        & (F.col("close") <= F.col("bb_lower"))
    )
    sell = (
        (F.col("macd") > F.col("macd_signal"))
        & (F.col("macd") > 0)
        & (F.col("rsi") > 70)
        & (F.col("close") >= F.col("bb_upper"))
    )
    frame = placed.last(hold)
    placed = placed.with_columns({"buy_signal": F.max(buy).over(frame), "sell_signal": F.max(sell).over(frame)})
    return placed.finish("_fast", "_slow", *resume_columns(df))


@dataclass(frozen=True)
class Rule:
    """Knobs of the mean-reversion rule."""

    bb_window: int = 20
    rsi_buy: float = 35.0
    rsi_sell: float = 70.0
    macd_hist_threshold: float = 0.0
    require_all: bool = True


def _votes(*conditions: Column) -> Column:
    votes = F.lit(0)
    for c in conditions:
        votes = votes + F.coalesce(c, F.lit(False)).cast("int")
    return votes


def mean_reversion(rule: Rule = Rule()) -> tuple[Indicator, ...]:
    """Population bands, Wilder RSI and exponential MACD, and the buy and sell flags built on them.

    ``require_all``: buy when the close is under the lower band, the RSI is low and the histogram rises through the
    threshold; sell on any one of the opposite signs. Otherwise two votes of three decide either side.
    """
    line = macd()

    def flags(df: DataFrame) -> DataFrame:
        hist, was, level = F.col("macd_hist"), F.col("_hist_was"), F.lit(rule.macd_hist_threshold)
        buys = (F.col("close") < F.col("bb_lower"), F.col("rsi") < rule.rsi_buy, (hist > level) & (was <= level))
        sells = (F.col("close") > F.col("bb_upper"), F.col("rsi") > rule.rsi_sell, hist < level)
        needed_buy, needed_sell = (3, 1) if rule.require_all else (2, 2)
        return df.withColumns({"buy_signal": _votes(*buys) >= needed_buy, "sell_signal": _votes(*sells) >= needed_sell})

    return (
        bollinger(rule.bb_window, ddof=0, fill=0.0),
        rsi("wilder"),
        line,
        Indicator(
            0,
            prior=(("_hist_was", ("_fast", "_slow", "macd_signal"), 0.0),),
            after=flags,
            scratch=("_hist_was",),
            extra=1,
        ),
    )
