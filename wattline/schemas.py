"""Explicit schemas of everything read from outside; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*specs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in specs])


_TEXT, _REAL, _WHOLE = T.StringType(), T.DoubleType(), T.IntegerType()

# ---- API payloads -------------------------------------------------------
# Both spellings of a header are listed; the reader folds them into one.
# Measures are taken as text, since feeds send numbers either bare or quoted;
# the contract gives them their type and rejects what is not a number.
EIA_DEMAND_ROW = _fields(
    ("period", _TEXT),
    ("respondent", _TEXT),
    ("respondent-name", _TEXT),
    ("respondent_name", _TEXT),
    ("type", _TEXT),
    ("type-name", _TEXT),
    ("type_name", _TEXT),
    ("value", _TEXT),
    ("value-units", _TEXT),
    ("value_units", _TEXT),
)
EIA_GENERATION_ROW = _fields(
    ("period", _TEXT),
    ("respondent", _TEXT),
    ("respondent-name", _TEXT),
    ("respondent_name", _TEXT),
    ("fueltype", _TEXT),
    ("fuel_type", _TEXT),
    ("fueltypeid", _TEXT),
    ("type-name", _TEXT),
    ("type_name", _TEXT),
    ("value", _TEXT),
    ("value-units", _TEXT),
    ("value_units", _TEXT),
)


def eia_page(row: T.StructType) -> T.StructType:
    return _fields(("response", _fields(("total", _TEXT), ("data", T.ArrayType(row)))))


CARBON_PAGE = _fields(
    (
        "data",
        T.ArrayType(
            _fields(
                ("from", _TEXT),
                ("to", _TEXT),
                ("intensity", _fields(("actual", _TEXT), ("forecast", _TEXT), ("index", _TEXT))),
            )
        ),
    )
)

WEATHER_PAGE = _fields(
    (
        "hourly",
        _fields(
            ("time", T.ArrayType(_TEXT)),
            ("temperature_2m", T.ArrayType(_TEXT)),
            ("wind_speed_10m", T.ArrayType(_TEXT)),
            ("precipitation", T.ArrayType(_TEXT)),
            ("weather_code", T.ArrayType(_TEXT)),
        ),
    )
)

# One JSON object per event, everything read as text so that the contract can
# tell a missing value from an unreadable one. Times come in two shapes.
GRID_EVENT_JSON = _fields(
    ("event_id", _TEXT),
    ("region", _TEXT),
    ("timestamp", _TEXT),
    ("demand_mw", _TEXT),
    ("generation_mw", _TEXT),
    ("carbon_intensity_gco2_kwh", _TEXT),
    ("source", _TEXT),
)

GRID_EVENT_COLUMNS = GRID_EVENT_JSON.fieldNames()

# ---- Landed tables ------------------------------------------------------
_AUDIT = (("_ingested_at", T.TimestampType()), ("load_date", T.DateType()))

BRONZE_DEMAND = _fields(
    ("period", _TEXT),
    ("respondent", _TEXT),
    ("respondent_name", _TEXT),
    ("type", _TEXT),
    ("type_name", _TEXT),
    ("value", _REAL),
    ("value_units", _TEXT),
    *_AUDIT,
)
BRONZE_GENERATION = _fields(
    ("period", _TEXT),
    ("respondent", _TEXT),
    ("fuel_type", _TEXT),
    ("fuel_type_description", _TEXT),
    ("value", _REAL),
    ("value_units", _TEXT),
    *_AUDIT,
)
BRONZE_CARBON = _fields(
    ("from", _TEXT),
    ("to", _TEXT),
    ("intensity_index", _TEXT),
    ("intensity_actual", _REAL),
    ("intensity_forecast", _REAL),
    *_AUDIT,
)
BRONZE_WEATHER = _fields(
    ("time", _TEXT),
    ("temperature_2m", _REAL),
    ("wind_speed_10m", _REAL),
    ("precipitation", _REAL),
    ("weather_code", _WHOLE),
    *_AUDIT,
)
WATERMARKS = _fields(("source", _TEXT), ("watermark", _TEXT), ("updated_at", T.TimestampType()))
