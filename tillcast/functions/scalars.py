"""Column-level scalar functions (all JVM-side built-ins).

Each returns a ``Column`` so callers can place them in one projection and
keep them inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def year(d) -> Column:
    return F.year(_c(d))


def month(d) -> Column:
    return F.month(_c(d))


def iso_week(d) -> Column:
    """ISO-8601 week number (2021-01-03 is week 53)."""
    return F.weekofyear(_c(d))


def day_of_month(d) -> Column:
    return F.dayofmonth(_c(d))


def quarter(d) -> Column:
    return F.quarter(_c(d))


def iso_dow(d) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_c(d)) + 1).cast("int")


def is_weekend(d) -> Column:
    """1 on Saturday/Sunday, from the date itself."""
    return (F.weekday(_c(d)) >= 5).cast("int")


def is_weekend_from_dow(dow) -> Column:
    """Notebook variant: weekend from a 1..7 day-of-week column."""
    return _c(dow).isin(6, 7).cast("int")


def cyclical(x, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period; week 53 of period 52 wraps past a turn."""
    angle = F.lit(2 * math.pi) * _c(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def canonical(x, decimals: int = 12) -> Column:
    """A value rounded so that equal angles compare equal wherever they were computed: sin implementations
    differ in the last bit, which matters to quantiles and ties. "+ 0.0" joins the two zeros."""
    return F.round(_c(x), decimals) + F.lit(0.0)


def holiday_binary(h) -> Column:
    """'0' -> 0; anything else, NULL included, -> 1 (null-safe compare)."""
    return F.when(_c(h).eqNullSafe(F.lit("0")), F.lit(0)).otherwise(F.lit(1))


def date_to_epoch_days(d) -> Column:
    return F.unix_date(_c(d))


def date_to_epoch_seconds(d) -> Column:
    return F.unix_seconds(F.to_timestamp(_c(d)))


def clamp_min(x, lo: float = 0.0) -> Column:
    return F.greatest(F.lit(lo), _c(x))


def months_before(d, n: int) -> Column:
    """Subtract calendar months, clipped to month end (2023-05-31 - 3 = 2023-02-28)."""
    return F.add_months(_c(d), -n)


def valid_iso_date(s) -> Column:
    """Strict ``YYYY-MM-DD`` string check, also accepting unpadded month/day
    as strptime does (e.g. 2024-1-5)."""
    s = _c(s)
    return (s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
            & F.try_to_date(s, "yyyy-M-d").isNotNull())


# Coefficients of Acklam's rational approximation to the
# standard normal quantile (relative error below 1.2e-9), published values.
_ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
             1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
             6.680131188771972e+01, -1.328068155288572e+01)
_ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
             -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00)
_ACKLAM_LOW = 0.02425


def _horner(coefs, x):
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p) -> Column:
    """standard normal quantile of p in (0, 1), JVM-side (Acklam's
    approximation; central region rational in q = p - 0.5, tails in
    sqrt(-2 ln p))."""
    p = _c(p)
    q = p - F.lit(0.5)
    r = q * q
    central = _horner(_ACKLAM_A, r) * q / (_horner(_ACKLAM_B, r) * r + F.lit(1.0))
    ql = F.sqrt(F.lit(-2.0) * F.log(p))
    low = _horner(_ACKLAM_C, ql) / (_horner(_ACKLAM_D, ql) * ql + F.lit(1.0))
    qh = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    high = -_horner(_ACKLAM_C, qh) / (_horner(_ACKLAM_D, qh) * qh + F.lit(1.0))
    return (F.when(p < F.lit(_ACKLAM_LOW), low).when(p > F.lit(1 - _ACKLAM_LOW), high).otherwise(central))


def normal_quantile_sql(p: str) -> str:
    """The same expression as DuckDB SQL text (for oracle checks)."""
    def horner(coefs, x):
        out = repr(coefs[0])
        for c in coefs[1:]:
            out = f"(({out}) * ({x}) + {c!r})"
        return out
    q, r = f"(({p}) - 0.5)", f"((({p}) - 0.5) * (({p}) - 0.5))"
    central = f"({horner(_ACKLAM_A, r)} * {q} / ({horner(_ACKLAM_B, r)} * {r} + 1.0))"
    ql = f"sqrt(-2.0 * ln({p}))"
    qh = f"sqrt(-2.0 * ln(1.0 - ({p})))"
    low = f"({horner(_ACKLAM_C, ql)} / ({horner(_ACKLAM_D, ql)} * {ql} + 1.0))"
    high = f"(-{horner(_ACKLAM_C, qh)} / ({horner(_ACKLAM_D, qh)} * {qh} + 1.0))"
    return f"(CASE WHEN ({p}) < {_ACKLAM_LOW!r} THEN {low} WHEN ({p}) > {1 - _ACKLAM_LOW!r} THEN {high} ELSE {central} END)"
