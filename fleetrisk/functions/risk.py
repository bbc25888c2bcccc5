"""Risk buckets and the vehicle risk score."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(p: Column, low: str, medium: str, high: str) -> Column:
    """(0, .3], (.3, .7], (.7, 1]; anything else, 0 included, is null."""
    return (F.when((p > 0) & (p <= 0.3), low)
            .when((p > 0.3) & (p <= 0.7), medium)
            .when((p > 0.7) & (p <= 1), high))


def risk_bucket(p: Column) -> Column:
    return bucket(p, "Low Risk", "Medium Risk", "High Risk")


def risk_category(score: Column) -> Column:
    return bucket(score, "Low", "Medium", "High")


# Risk steps of the vehicle summary (column, [(test, edge, step)], else step).
RISK_STEPS = [
    ("engine_temperature_mean", [(">", 105.0, 0.8), (">", 100.0, 0.5), ("<", 85.0, 0.3)], 0.1),
    ("oil_pressure_mean", [("<", 30.0, 0.7), ("<", 35.0, 0.4), (">", 50.0, 0.5)], 0.1),
    ("battery_voltage_min", [("<", 11.8, 0.6), ("<", 12.2, 0.3)], 0.1),
    ("distance_km_sum", [(">", 5000.0, 0.4), (">", 3000.0, 0.2)], 0.1),
]


def risk_step(x: Column, steps, otherwise: float) -> Column:
    out = F.lit(otherwise)
    for test, edge, value in reversed(steps):
        out = F.when((x > edge) if test == ">" else (x < edge), F.lit(value)).otherwise(out)
    return out


def risk_score(columns: list[str], weights: dict[str, float] | None = None) -> Column:
    """Mean of the steps whose column exists, added left to right, within 0..1.

    With the plain mean the score cannot pass 0.625, so "High" needs ``weights``.
    """
    parts = [(c, risk_step(F.col(c), steps, other)) for c, steps, other in RISK_STEPS if c in columns]
    if not parts:
        return F.lit(0.0)
    if weights is None:
        score = reduce(add, [p for _, p in parts]) / float(len(parts))
    else:
        score = reduce(add, [p * float(weights.get(c, 0.0)) for c, p in parts])
    return F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))


def maintenance_priority(score: Column) -> Column:
    return (F.when(score > 0.8, "Immediate").when(score > 0.5, "Within 7 days")
            .when(score > 0.3, "Within 30 days").otherwise("Monitor"))
