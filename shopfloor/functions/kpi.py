"""Column expressions of the plant KPIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the temperature conversion and the risk index.
KELVIN_OFFSET = 273.15
MAX_AGE_YEARS = 18
RISK_WEIGHTS = {"oee": 0.5, "age": 0.3, "fail_rate": 0.2}


def availability(run_time: Column, planned: Column) -> Column:
    return F.try_divide(run_time, planned)


def performance(ideal_sec: Column, total_units: Column, run_time: Column, strict: bool = False) -> Column:
    """Ideal over actual output time, at most 1.

    ``least`` skips NULL, so a run without an ideal cycle time counts as 1.0; ``strict`` keeps it NULL.
    """
    raw = F.try_divide(ideal_sec * total_units, run_time * F.lit(60.0))
    capped = F.least(raw, F.lit(1.0))
    return F.when(raw.isNotNull(), capped) if strict else capped


def quality(good_units: Column, total_units: Column) -> Column:
    return F.try_divide(good_units, total_units)


def failure_risk(oee: Column, age_years: Column, fail_rate: Column) -> Column:
    """Weighted risk index; NULL as soon as one of its inputs is NULL."""
    return (
        RISK_WEIGHTS["oee"] * (1 - oee)
        + RISK_WEIGHTS["age"] * (age_years / MAX_AGE_YEARS)
        + RISK_WEIGHTS["fail_rate"] * fail_rate
    )


def kelvin_to_celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(KELVIN_OFFSET)
