"""Row contracts of the inbound records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reason"


@dataclass(frozen=True)
class Field:
    """One column of a contract. ``default`` stands in for a missing value."""

    name: str
    kind: str = "string"
    required: bool = True
    default: object = None
    aliases: Sequence[str] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    fields: Sequence[Field] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


EIA_DEMAND = Contract(
    "eia_demand",
    (
        Field("period"),
        Field("respondent"),
        Field("respondent_name", required=False),
        Field("type"),
        Field("type_name", required=False),
        Field("value", "double"),
        Field("value_units", default="megawatthours"),
    ),
)
EIA_GENERATION = Contract(
    "eia_generation",
    (
        Field("period"),
        Field("respondent"),
        Field("fuel_type", aliases=("fueltype",)),
        Field("fuel_type_description", required=False, aliases=("fueltypeid",)),
        Field("value", "double"),
        Field("value_units", default="megawatthours"),
    ),
)
# The forecast default of 0.0 is applied by the parity reader, not here, so a
# missing forecast can stay missing in the tables.
CARBON = Contract(
    "carbon_intensity",
    (
        Field("from", aliases=("from_",)),
        Field("to"),
        Field("intensity_index", default=""),
        Field("intensity_actual", "double", required=False),
        Field("intensity_forecast", "double", required=False),
    ),
)
CARBON_STRICT = Contract(
    "carbon_intensity_strict",
    (*CARBON.fields[:-1], Field("intensity_forecast", "double")),
)
WEATHER = Contract(
    "weather",
    (
        Field("time"),
        Field("temperature_2m", "double"),
        Field("wind_speed_10m", "double"),
        Field("precipitation", "double"),
        Field("weather_code", "int", required=False),
    ),
)
GRID_EVENT = Contract(
    "grid_event",
    (
        Field("event_id"),
        Field("region"),
        Field("timestamp"),
        Field("demand_mw", "double"),
        Field("generation_mw", "double"),
        Field("carbon_intensity_gco2_kwh", "double"),
        Field("source", default="synthetic"),
    ),
)


def _raw(df: DataFrame, spec: Field) -> Column:
    """The column under its alias or its own name, whichever holds a value."""
    present = [c for c in (*spec.aliases, spec.name) if c in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.col(f"`{c}`") for c in present])


def _typed(raw: Column, spec: Field) -> Column:
    """NULL where the text cannot be read as the field's type; NaN counts as that."""
    if spec.kind == "string":
        value = raw.cast("string")
    elif spec.kind == "int":
        # Text like "3.0" is a whole number, "3.5" is not.
        wide = raw.try_cast("double")
        value = F.when(wide % 1 == 0, wide.try_cast("int"))
    else:
        value = F.nanvl(raw.try_cast(spec.kind), F.lit(None).cast(spec.kind))
    if spec.default is not None:
        value = F.coalesce(value, F.when(raw.isNull(), F.lit(spec.default)))
    return value


def _problem(raw: Column, value: Column, spec: Field) -> Column | None:
    unreadable = F.lit(f"{spec.name}: not a valid {spec.kind}")
    if spec.required and spec.default is None:
        missing = F.lit(f"{spec.name}: missing")
        if spec.kind == "string":
            return F.when(value.isNull(), missing)
        return F.when(value.isNull(), F.when(raw.isNull(), missing).otherwise(unreadable))
    if spec.kind == "string":
        return None
    return F.when(value.isNull() & raw.isNotNull(), unreadable)


def _parsed(df: DataFrame, contract: Contract) -> tuple[list[Column], list[Column]]:
    """Typed columns, and one expression per possible problem (NULL if none)."""
    values, problems = [], []
    for spec in contract.fields:
        raw = _raw(df, spec)
        value = _typed(raw, spec)
        values.append(value.alias(spec.name))
        problem = _problem(raw, value, spec)
        if problem is not None:
            problems.append(problem)
    return values, problems


def inspect(df: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Typed contract columns plus ``_reason``, which is NULL for a good row.

    Columns outside the contract are dropped unless listed in ``keep``.
    """
    values, problems = _parsed(df, contract)
    reason = F.nullif(F.concat_ws("; ", *problems), F.lit(""))
    return df.select(*values, *keep, reason.alias(REASON))


def validate(
    df: DataFrame, contract: Contract, mode: str = "fail", keep: Sequence[str] = ()
):
    """``fail``: a frame whose evaluation raises at the first bad record.

    The check is part of the plan, so a load is a single pass and, since a
    Spark write commits only as a whole, a failed load leaves nothing behind.

    ``split``: ``(valid, rejected)``; rejected rows carry their ``_reason``.
    """
    if mode == "split":
        checked = inspect(df, contract, keep)
        valid = checked.filter(F.col(REASON).isNull()).drop(REASON)
        return valid, checked.filter(F.col(REASON).isNotNull())
    if mode == "fail":
        values, problems = _parsed(df, contract)
        first = F.coalesce(*problems, F.lit(""))
        stop = F.raise_error(F.concat(F.lit(f"{contract.name} contract violated: "), first))
        passes = F.when(first == "", F.lit(True)).otherwise(stop.cast("boolean"))
        return df.filter(passes).select(*values, *keep)
    raise ValueError(f"unknown mode {mode!r}")
