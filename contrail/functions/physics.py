"""Physical fuel / CO2 estimator and model features as Column expressions.

fuel = factor(engine) * MTOW * (K_CRUISE * hours + K_LTO) * noise
co2  = fuel * 3.16

The reference draws its lognormal noise from a seeded generator in row order,
which changes with partitioning.  Here the noise is a pure function of the
flight id (Box-Muller on two xxhash64 draws), so every executor produces the
same value for the same flight no matter how the data is split.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the physical model.
K_CRUISE = 0.030   # lb fuel per lb MTOW per cruise hour
K_LTO = 0.012      # lb fuel per lb MTOW per take-off/landing cycle
SIGMA_NOISE = 0.10
CO2_FACTOR = 3.16
SEED = 42
ENGINE_FACTOR = {
    "JET": 1.00, "TURBOFAN": 1.00, "TURBOJET": 1.00,
    "TURBOPROP": 0.45, "TURBOSHAFT": 0.55, "PISTON": 0.30,
    "UNKNOWN": 1.00,
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def engine_factor(engine) -> Column:
    """Factor by upper-cased engine type; unknown / null -> 1.0."""
    m = F.create_map(*[F.lit(x) for kv in ENGINE_FACTOR.items() for x in kv])
    key = F.upper(F.trim(_c(engine)))
    return F.coalesce(F.try_element_at(m, key), F.lit(1.0))


def _uniform(id_col: Column, salt: int) -> Column:
    """Deterministic U(0,1) from a hash of (id, seed, salt)."""
    h = F.xxhash64(id_col.cast("string"), F.lit(SEED), F.lit(salt))
    return (F.pmod(h, F.lit(1 << 53)).cast("double") + 0.5) / float(1 << 53)


def lognormal_noise(id_col, sigma: float = SIGMA_NOISE) -> Column:
    u1, u2 = _uniform(_c(id_col), 1), _uniform(_c(id_col), 2)
    z = F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2)
    return F.exp(z * sigma)


def fuel_estimate(mtow, minutes, engine, cancelled=None, sigma: float = 0.0,
                  id_col=None) -> Column:
    """Estimated fuel (lbs).  Null unless MTOW > 0 and minutes > 0; 0 when
    cancelled."""
    hours = _c(minutes) / 60.0
    fuel = engine_factor(engine) * _c(mtow) * (hours * K_CRUISE + K_LTO)
    if sigma > 0:
        if id_col is None:
            raise ValueError("sigma > 0 needs an id column for deterministic noise")
        fuel = fuel * lognormal_noise(id_col, sigma)
    valid = (_c(mtow) > 0) & (_c(minutes) > 0)
    out = F.when(valid, fuel)
    if cancelled is not None:
        out = F.when(_c(cancelled), F.lit(0.0)).otherwise(F.when(valid, fuel))
    return out


def co2_from_fuel(fuel) -> Column:
    return _c(fuel) * CO2_FACTOR


def add_features(df, minutes="minutes", engines="engines", miles="miles", mtow="mtow",
                 effort="effort", month="month"):
    """The six derived model features; zero divisors give 0 (weight per engine
    falls back to the weight itself), never an error or infinity."""
    t = F.nullif(_c(minutes).cast("double"), F.lit(0.0))
    e = F.nullif(_c(engines).cast("double"), F.lit(0.0))
    d = F.nullif(_c(miles).cast("double"), F.lit(0.0))
    return (df.withColumn("speed_mi_per_min", F.coalesce(_c(miles) / t, F.lit(0.0)))
              .withColumn("weight_per_engine", F.coalesce(_c(mtow) / e, _c(mtow).cast("double")))
              .withColumn("minutes_per_mile", F.coalesce(_c(minutes) / d, F.lit(0.0)))
              .withColumn("effort_per_minute", F.coalesce(_c(effort) / t, F.lit(0.0)))
              .withColumn("month_sin", F.sin(2 * math.pi * _c(month) / 12.0))
              .withColumn("month_cos", F.cos(2 * math.pi * _c(month) / 12.0)))


def effort(mtow, miles) -> Column:
    """Base effort feature: MTOW x distance."""
    return _c(mtow).cast("double") * _c(miles).cast("double")
