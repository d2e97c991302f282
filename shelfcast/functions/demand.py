"""Deterministic demand and price formulas of the retail simulator.

Thresholds and factors are fixed values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rain above this many millimetres keeps that share of the demand, wettest first.
RAIN_STEPS = ((10, 0.8), (5, 0.9))
# Months with the higher rain level, and both levels in millimetres.
WET_MONTHS = (12, 1, 2, 3, 4, 5)
WET_RAIN_MM, DRY_RAIN_MM = 5, 2
# Drinks sell more above this temperature, less otherwise.
DRINKS = "Bebidas"
WARM_DAY = 20
DRINKS_WARM, DRINKS_COOL = 1.2, 0.8
# Fixed value: half of a discount turns into extra units.
PROMOTION_LIFT = 0.5
# Yearly temperature curve, mean and amplitude in degrees.
TEMPERATURE_MEAN, TEMPERATURE_SWING = 10, 8


def promotion_flag(discount: Column) -> Column:
    return F.when(discount > 0, 1).otherwise(0)


def rain_factor(rain: Column) -> Column:
    (heavy, heavy_share), (light, light_share) = RAIN_STEPS
    return F.when(rain > heavy, heavy_share).when(rain > light, light_share).otherwise(1.0)


def promotion_factor(discount: Column) -> Column:
    return 1.0 + (discount / 100) * PROMOTION_LIFT


def temperature_factor(category: Column, temperature: Column) -> Column:
    drinks = F.when(temperature > WARM_DAY, DRINKS_WARM).otherwise(DRINKS_COOL)
    return F.when(category == DRINKS, drinks).otherwise(1.0)


def clamp_at_zero(value: Column) -> Column:
    return F.greatest(F.lit(0), value)


def expected_units(
    base: Column, rain: Column, discount: Column, category: Column, temperature: Column
) -> Column:
    """Base demand times its three factors, truncated to whole units and never negative."""
    product = (
        base
        * rain_factor(rain)
        * promotion_factor(discount)
        * temperature_factor(category, temperature)
    )
    return clamp_at_zero(product.cast("int"))


def discounted_price(price: Column, discount: Column) -> Column:
    return F.round(price * (1 - discount / 100), 2)


def seasonal_temperature(month: Column) -> Column:
    return TEMPERATURE_MEAN + TEMPERATURE_SWING * F.sin(F.lit(2 * math.pi) * (month - 1) / 12)


def seasonal_rain(month: Column) -> Column:
    return F.when(month.isin(*WET_MONTHS), WET_RAIN_MM).otherwise(DRY_RAIN_MM)
