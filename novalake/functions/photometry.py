"""Fluxes in microjansky, magnitudes and their errors.

Float inputs widen to double as soon as they meet a double literal, which is
also how the threshold ``1.4`` has to be compared (a float32 1.4 lies below it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: AB zero point in microjansky, 10^3.56 * 1e6. Catalyst folds it.
ZERO_POINT_EXPONENT = 3.56


def zero_point() -> Column:
    return F.pow(F.lit(10.0), F.lit(ZERO_POINT_EXPONENT)) * F.lit(1e6)


def _flux_error_factor() -> Column:
    return F.lit(0.4) * F.ln(F.lit(10.0))


def _mag_error_factor() -> Column:
    return F.lit(2.5) / F.ln(F.lit(10.0))


def flux(mag: Column) -> Column:
    return zero_point() * F.pow(F.lit(10.0), F.lit(-0.4) * mag)


def flux_error(mag_err: Column, flux_value: Column) -> Column:
    return _flux_error_factor() * mag_err * flux_value


def total_flux(reference_flux: Column, difference_flux: Column, is_positive: Column) -> Column:
    """Unknown sign counts as negative: WHEN NULL falls through to ELSE."""
    return F.when(is_positive, reference_flux + difference_flux).otherwise(
        reference_flux - difference_flux
    )


def quadrature(a: Column, b: Column) -> Column:
    return F.sqrt(F.pow(a, F.lit(2.0)) + F.pow(b, F.lit(2.0)))


def magnitude(total: Column) -> Column:
    return F.when(total > 0, F.lit(-2.5) * F.log10(total / zero_point()))


def magnitude_error(total_err: Column, total: Column) -> Column:
    return F.when(total > 0, _mag_error_factor() * total_err / total)


def signal_to_noise(flux_value: Column, flux_unc: Column) -> Column:
    """NULL for a zero uncertainty, as without ANSI mode."""
    return F.try_divide(flux_value.cast("double"), flux_unc.cast("double"))


def instrument_magnitude(zero_point_mag: Column, counts: Column) -> Column:
    """``log10(0)`` is NULL in Spark, so zero counts give no magnitude."""
    return zero_point_mag - F.lit(2.5) * F.log10(F.abs(counts))


def instrument_magnitude_error(counts_unc: Column, counts: Column) -> Column:
    size = F.abs(counts.cast("double"))
    return F.when(size > F.lit(1e-9), _mag_error_factor() * counts_unc / size)


def calibrated_flux(zero_point_mag: Column, counts: Column) -> Column:
    return flux(zero_point_mag) * counts
