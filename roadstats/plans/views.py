"""Presentation of results for the oracle comparison (not part of the operators).

Floating aggregates are quantized to multiples of 2**-20 (about 1e-6): ``round(x * 2**20) /
2**20``. Summation order differs between engines, so averages can differ in the last bits;
decimal rounding would still split exact decimal ties (e.g. an average over 32 two-decimal
values) differently, because one engine rounds the shortest decimal form and the other the
binary product. Scaling by a power of two is exact, so equal inputs always give equal outputs
in both engines. Event-time columns are shown as UTC wall clock (``TIMESTAMP_NTZ``),
independent of the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstats.functions.columns import to_utc_ntz


QUANTUM = float(2**20)


def quantized(col: str) -> Column:
    return F.round(F.col(col) * F.lit(QUANTUM)) / F.lit(QUANTUM)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[quantized(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[to_utc_ntz(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def stats_view(df: DataFrame) -> DataFrame:
    return rounded(df, "vspeed")


def windowed_view(df: DataFrame) -> DataFrame:
    return ntz(rounded(df, "vspeed_avg", "vspeed_min", "vspeed_max"), "window_start", "window_end")
