"""Unit conversion and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed import HPA_TO_INHG, MPS_TO_MPH


def f_to_c(fahrenheit: Column) -> Column:
    return (fahrenheit - F.lit(32)) * F.lit(5 / 9)


def round_int(value: Column) -> Column:
    """Nearest whole number, halves away from zero."""
    return F.round(value).cast("int")


def to_int(value: Column, mode: str = "truncate") -> Column:
    """Whole number by truncation (the live path) or rounding (the training path)."""
    if mode == "truncate":
        return value.cast("int")
    if mode == "round":
        return round_int(value)
    raise ValueError(f"mode must be 'truncate' or 'round', not {mode!r}")


def hpa_to_inhg(hpa: Column, mode: str = "truncate") -> Column:
    return to_int(hpa * F.lit(HPA_TO_INHG), mode)


def mps_to_mph(mps: Column, mode: str = "truncate") -> Column:
    return to_int(mps * F.lit(MPS_TO_MPH), mode)


def boxcox(x: Column, lam: float) -> Column:
    """Power transform of a positive value."""
    if abs(lam) < 1e-12:
        return F.log(x)
    return (F.pow(x, F.lit(float(lam))) - 1) / F.lit(float(lam))
