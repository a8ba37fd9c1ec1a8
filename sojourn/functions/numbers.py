"""Rounding and probability transforms on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOGIT_CLIP = 1e-6


def round_half_away(c: Column, digits: int) -> Column:
    """Round the binary value times 10^digits, the way column stores do (0.285 -> 0.28).

    Spark's round(x, 2) rounds the printed decimal instead (0.285 -> 0.29).
    """
    scale = F.lit(float(10**digits))
    return F.round(c.cast("double") * scale, 0) / scale


def logit(p: Column) -> Column:
    clipped = F.greatest(F.lit(LOGIT_CLIP), F.least(F.lit(1.0 - LOGIT_CLIP), p))
    return F.log(clipped / (F.lit(1.0) - clipped))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def recalibrated(p: Column, slope: float, intercept: float) -> Column:
    return sigmoid(F.lit(float(slope)) * logit(p) + F.lit(float(intercept)))
