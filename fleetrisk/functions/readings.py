"""Row-wise columns derived from one sensor reading (used by batch, stream and scoring alike)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetrisk.functions import fixed
from fleetrisk.functions.numbers import finite, ratio

_SMALL = 1e-5


def engine_stress() -> Column:
    return (F.col("engine_temperature") / 100.0) * (F.col("rpm") / 3000.0)


def oil_temp_ratio() -> Column:
    return ratio(F.col("oil_pressure"), F.col("engine_temperature") + _SMALL)


def fuel_efficiency() -> Column:
    return ratio(F.col("distance_km"), F.col("fuel_consumption") + _SMALL)


def battery_health() -> Column:
    v = finite(F.col("battery_voltage"))
    return F.when(v > 12.4, "Good").when(v > 12.0, "Fair").otherwise("Poor")


def temp_pressure_interaction() -> Column:
    return F.col("engine_temperature") * F.col("oil_pressure")


def speed_distance_interaction() -> Column:
    return F.col("max_speed_kmh") * F.col("distance_km")


def age_usage_interaction() -> Column:
    return F.col("vehicle_age_days") * F.col("total_distance") / 1000.0


def calendar(day: Column) -> dict[str, Column]:
    return {
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "quarter": F.quarter(day),
    }


def cyclic_day(day: Column) -> dict[str, Column]:
    angle = F.lit(2.0) * F.pi() * F.dayofyear(day) / F.lit(365.0)
    return {"day_sin": F.sin(angle), "day_cos": F.cos(angle)}


def calendar_extra(day: Column) -> dict[str, Column]:
    """Monday is day 0, as in the usual dataframe libraries."""
    return {
        "month": F.month(day),
        "day_of_week": F.weekday(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


def engineered() -> dict[str, tuple[list[str], Column]]:
    """{name: (needed inputs, expression)}; a feature is built only when its inputs exist."""
    return {
        "engine_stress": (["engine_temperature", "rpm"], engine_stress()),
        "battery_health": (["battery_voltage"], battery_health()),
        "oil_temp_ratio": (["oil_pressure", "engine_temperature"], oil_temp_ratio()),
        "fuel_efficiency": (["distance_km", "fuel_consumption"], fuel_efficiency()),
    }


def interactions() -> dict[str, tuple[list[str], Column]]:
    return {
        "temp_pressure_interaction": (["engine_temperature", "oil_pressure"], temp_pressure_interaction()),
        "speed_distance_interaction": (["max_speed_kmh", "distance_km"], speed_distance_interaction()),
        "age_usage_interaction": (["vehicle_age_days", "total_distance"], age_usage_interaction()),
    }


# -- scoring ------------------------------------------------------------------------------------

def scoring_flags() -> dict[str, Column]:
    return {
        "temp_high_violation": _flag(F.col("engine_temperature") > fixed.SCORING_TEMPERATURE_HIGH),
        "oil_low_violation": _flag(F.col("oil_pressure") < fixed.SCORING_OIL_LOW),
        "battery_low_violation": _flag(F.col("battery_voltage") < fixed.SCORING_BATTERY_LOW),
    }


def scoring_columns() -> dict[str, Column]:
    """The 15 model inputs of a single reading."""
    return {
        **{c: F.col(c) for c in fixed.SCORING_INPUTS},
        "engine_stress": engine_stress(),
        "oil_temp_ratio": oil_temp_ratio(),
        "daily_usage_intensity": F.col("distance_km") * F.col("max_speed_kmh") / 100.0,
        **scoring_flags(),
    }


def risk_level(p: Column) -> Column:
    out = F.lit(fixed.RISK_LEVEL_ELSE)
    for edge, label in reversed(fixed.RISK_LEVELS):
        out = F.when(p > edge, label).otherwise(out)
    return out


def recommended_action(level: Column) -> Column:
    """Advice of the level, followed by the list of issues seen in the reading."""
    flags = scoring_flags()
    issues = F.concat_ws(
        ", ",
        F.when(flags["temp_high_violation"] == 1, fixed.ISSUE_TEMPERATURE),
        F.when(flags["oil_low_violation"] == 1, fixed.ISSUE_OIL),
        F.when(flags["battery_low_violation"] == 1, fixed.ISSUE_BATTERY),
    )
    base = F.lit(fixed.ADVICE_ELSE)
    for label, text in fixed.LEVEL_ADVICE.items():
        base = F.when(level == label, text).otherwise(base)
    return F.when(issues == "", base).otherwise(
        F.concat(base, F.lit(" Specific issues to address: "), issues, F.lit(".")))


def confidence(p: Column) -> Column:
    """Small far from 0.5 and 1 at 0.5; see ``certainty`` for the opposite."""
    return F.least(p, 1.0 - p) * 2.0


def certainty(p: Column) -> Column:
    return 1.0 - confidence(p)


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)
