"""The indicator batch job: raw bars to a table of indicators and crossover signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import indicators, signals
from barloom.sources.prices import read_prices
from barloom.sources.tables import stage, write_table

# Column names of the job's output table.
OUTPUT = {
    "date": "Date",
    "sma_20": "SMA20",
    "sma_50": "SMA50",
    "ema_12": "EMA12",
    "ema_26": "EMA26",
    "macd": "MACD",
    "macd_signal": "Signal",
    "macd_hist": "Histogram",
    "gain": "Gain",
    "loss": "Loss",
    "avg_gain": "AvgGain",
    "avg_loss": "AvgLoss",
    "rs": "RS",
    "rsi": "RSI",
    "bb_std": "StdDev20",
    "bb_upper": "UpperBand",
    "bb_lower": "LowerBand",
    "buy": "BuySignal",
    "sell": "SellSignal",
}


def compute(bars: DataFrame) -> DataFrame:
    out = indicators.add(
        bars.withColumn("close", F.col("close").cast("double")),
        indicators.sma(20),
        indicators.sma(50),
        indicators.macd("sma"),
        indicators.rsi("sma"),
        indicators.bollinger(20, ddof=1),
        signals.crossover(),
    )
    return out.drop("bb_mid").withColumnsRenamed(OUTPUT)


def from_snapshots(bars: DataFrame) -> DataFrame:
    """Indicators over bars whose snapshots were resolved. That took a shuffle and is read twice below, so its result is stored first."""
    return compute(stage(bars, "bars"))


def run(spark: SparkSession, source: str, target: str) -> None:
    write_table(from_snapshots(read_prices(spark, source)), target)
