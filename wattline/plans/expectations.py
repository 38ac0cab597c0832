"""What the staging and gold tables promise."""

from __future__ import annotations

from wattline.operators.quality import Relationship, TableChecks

CHECKS = {
    "stg_demand": TableChecks(
        not_null=("demand_key", "period_utc", "respondent", "demand_mwh"),
        unique=("demand_key",),
    ),
    "stg_generation": TableChecks(
        not_null=("generation_key", "period_utc", "respondent", "fuel_type", "generation_mwh"),
        unique=("generation_key",),
    ),
    "stg_carbon_intensity": TableChecks(
        not_null=("carbon_intensity_key", "period_from", "period_to", "intensity_gco2_kwh"),
        unique=("carbon_intensity_key",),
    ),
    "dim_date": TableChecks(
        not_null=("date_key", "date_day", "year", "month", "day_of_week"),
        unique=("date_key", "date_day"),
        accepted={"month": tuple(range(1, 13)), "day_of_week": tuple(range(1, 8))},
    ),
    "dim_region": TableChecks(
        not_null=("region_key", "respondent_code", "country"),
        unique=("region_key", "respondent_code"),
    ),
    "dim_fuel_type": TableChecks(
        not_null=("fuel_type_key", "fuel_type_code", "typical_co2_gco2_kwh"),
        unique=("fuel_type_key", "fuel_type_code"),
    ),
    "fact_demand": TableChecks(
        not_null=("demand_key", "date_key", "demand_mwh", "demand_mw"),
        unique=("demand_key",),
        relationships=(
            Relationship("date_key", "dim_date", "date_key"),
            Relationship("region_key", "dim_region", "region_key"),
        ),
    ),
    "fact_generation": TableChecks(
        not_null=("generation_key", "date_key", "generation_mwh"),
        unique=("generation_key",),
        relationships=(
            Relationship("date_key", "dim_date", "date_key"),
            Relationship("fuel_type_key", "dim_fuel_type", "fuel_type_key"),
        ),
    ),
    "fact_carbon_intensity": TableChecks(
        not_null=("carbon_intensity_key", "date_key", "intensity_gco2_kwh", "intensity_band"),
        unique=("carbon_intensity_key",),
        accepted={"intensity_band": ("Very Low", "Low", "Moderate", "High", "Very High")},
        relationships=(Relationship("date_key", "dim_date", "date_key"),),
    ),
}

# How old the newest landed row may be before a warning and an error.
FRESHNESS = {
    "eia_demand_raw": ("2 hours", "6 hours"),
    "eia_generation_raw": ("2 hours", "6 hours"),
    "carbon_intensity_raw": ("1 hour", "3 hours"),
    "weather_raw": ("2 hours", "6 hours"),
}
