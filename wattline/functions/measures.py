"""Numeric and categorical expressions over measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) of the intensity bands in gCO2/kWh.
INTENSITY_BANDS = (
    (100, "Very Low"),
    (200, "Low"),
    (300, "Moderate"),
    (400, "High"),
)
TOP_BAND = "Very High"
LOW_CARBON_LIMIT = 150

# Labels of the fuel codes known to the cleansing step.
FUEL_LABELS = {
    "COL": "Coal",
    "NG": "Natural Gas",
    "NUC": "Nuclear",
    "OIL": "Oil",
    "WAT": "Hydro",
    "WND": "Wind",
    "SUN": "Solar",
    "OTH": "Other",
    "UNK": "Unknown",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Lenient double: unreadable text and NaN both become NULL."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def at_least_zero(c: Column | str) -> Column:
    return F.greatest(F.lit(0.0), _col(c))


def first_nonzero(*candidates: Column) -> Column:
    """First candidate that is neither missing nor zero, else 0.0."""
    return F.coalesce(*[F.nullif(number(c), F.lit(0.0)) for c in candidates], F.lit(0.0))


def fuel_label(code: Column | str) -> Column:
    known = F.create_map(*[F.lit(text) for pair in FUEL_LABELS.items() for text in pair])
    return F.coalesce(known[_col(code)], _col(code))


def intensity_band(value: Column | str) -> Column:
    """A missing intensity falls through to the top band."""
    v = _col(value)
    band = None
    for limit, label in INTENSITY_BANDS:
        band = (F if band is None else band).when(v < limit, F.lit(label))
    return band.otherwise(F.lit(TOP_BAND))


def is_low_carbon(value: Column | str, limit: float = LOW_CARBON_LIMIT) -> Column:
    return F.coalesce(_col(value) < limit, F.lit(False))


def emissions_tonnes(mwh: Column | str, grams_per_kwh: Column | str) -> Column:
    """A fuel without a benchmark counts as zero."""
    return F.round(_col(mwh) * F.coalesce(_col(grams_per_kwh), F.lit(0.0)) / F.lit(1000.0), 2)


def z_score(value: Column | str, mean: Column | str, deviation: Column | str) -> Column:
    """NULL where the deviation is missing or zero."""
    return F.try_divide(_col(value) - _col(mean), _col(deviation))


def whole_number_text(value: Column | str) -> Column:
    """No decimals, ties to even."""
    return F.bround(_col(value), 0).cast("bigint").cast("string")
