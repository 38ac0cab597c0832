import json

import pytest

from wattline.operators import contracts
from wattline.operators.contracts import validate
from wattline.sources import events, payloads

DEMAND = [
    {"period": "2024-03-01T00", "respondent": "ERCO", "type": "D", "value": 45100, "value-units": "megawatthours"},
    {"period": "2024-03-01T01", "respondent": "ERCO", "type": "D", "value": "44250.5", "respondent-name": "Texas"},
]
GENERATION = [
    {"period": "2024-03-01T00", "respondent": "ERCO", "fueltype": "NG", "value": 21000},
    {"period": "2024-03-01T00", "respondent": "ERCO", "fueltype": "SUN", "value": 4000},
]


@pytest.fixture
def put(tmp_path):
    def write(name, *bodies):
        target = tmp_path / name
        target.mkdir(exist_ok=True)
        for i, body in enumerate(bodies):
            (target / f"page{i}.json").write_text(json.dumps(body, indent=1))
        return str(target)

    return write


def eia(rows, total=None):
    return {"response": {"total": len(rows) if total is None else total, "data": rows}}


def test_demand_pages(spark, put, rows):
    path = put("demand", eia(DEMAND[:1], 2), eia(DEMAND[1:], 2))
    df = payloads.read_eia(spark, path, "demand")
    assert rows(df, "period", "respondent", "value", "value_units", "respondent_name") == [
        ("2024-03-01T00", "ERCO", "45100", "megawatthours", None),
        ("2024-03-01T01", "ERCO", "44250.5", None, "Texas"),
    ]


def test_empty_page(spark, put):
    assert payloads.read_eia(spark, put("none", eia([])), "demand").count() == 0
    assert payloads.read_carbon(spark, put("no_slots", {"data": []})).count() == 0
    hourly = {"time": [], "temperature_2m": [], "wind_speed_10m": [], "precipitation": []}
    assert payloads.read_weather(spark, put("no_hours", {"hourly": hourly})).count() == 0


def test_declared_total_may_exceed_the_rows(spark, put):
    assert payloads.read_eia(spark, put("short", eia(DEMAND, 3)), "demand").count() == 2


def test_both_header_spellings(spark, put, rows):
    row = {**DEMAND[0], "respondent_name": "Texas", "type-name": "Demand"}
    df = payloads.read_eia(spark, put("mixed", eia([row])), "demand")
    assert rows(df, "respondent_name", "type_name") == [("Texas", "Demand")]


def test_fuel_alias(spark, put, rows):
    df = payloads.read_eia(spark, put("generation", eia(GENERATION)), "generation")
    typed = validate(df, contracts.EIA_GENERATION)
    assert rows(typed, "fuel_type", "value") == [("NG", 21000.0), ("SUN", 4000.0)]


def test_pages_one_per_line(spark, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps(eia([r])) for r in DEMAND))
    assert payloads.read_eia(spark, str(path), "demand", page_per_line=True).count() == 2


SLOTS = {
    "data": [
        {
            "from": "2024-03-01T00:00Z",
            "to": "2024-03-01T00:30Z",
            "intensity": {"actual": 120, "forecast": 130, "index": "low"},
        },
        {
            "from": "2024-03-01T00:30Z",
            "to": "2024-03-01T01:00Z",
            "intensity": {"actual": None, "forecast": None, "index": "low"},
        },
    ]
}


def test_carbon_slots_are_flattened(spark, put, rows):
    typed = validate(payloads.read_carbon(spark, put("carbon", SLOTS)), contracts.CARBON)
    assert rows(typed, "from", "intensity_actual", "intensity_forecast", "intensity_index") == [
        ("2024-03-01T00:00Z", 120.0, 130.0, "low"),
        ("2024-03-01T00:30Z", None, None, "low"),
    ]


def test_forecast_default_on_request(spark, put, rows):
    df = payloads.read_carbon(spark, put("carbon", SLOTS), forecast_default="0.0")
    typed = validate(df, contracts.CARBON_STRICT)
    assert rows(typed, "intensity_forecast") == [(0.0,), (130.0,)]


HOURS = {
    "hourly": {
        "time": ["2024-03-01T00:00", "2024-03-01T01:00"],
        "temperature_2m": [11.5, None],
        "wind_speed_10m": [2.5, None],
        "precipitation": [0.25, None],
        "weather_code": [3, None],
    }
}


def test_weather_arrays_become_rows(spark, put, rows):
    typed = validate(payloads.read_weather(spark, put("weather", HOURS)), contracts.WEATHER)
    assert rows(typed) == [
        ("2024-03-01T00:00", 11.5, 2.5, 0.25, 3),
        ("2024-03-01T01:00", 0.0, 0.0, 0.0, None),
    ]


def test_weather_gaps_can_stay(spark, put, rows):
    df = payloads.read_weather(spark, put("weather", HOURS), zero_fill=False)
    assert rows(df, "temperature_2m") == [("11.5",), (None,)]


def test_weather_without_codes_keeps_its_rows(spark, put, rows):
    hourly = {k: v for k, v in HOURS["hourly"].items() if k != "weather_code"}
    df = payloads.read_weather(spark, put("weather", {"hourly": hourly}))
    assert rows(df, "time", "weather_code") == [
        ("2024-03-01T00:00", None),
        ("2024-03-01T01:00", None),
    ]


def test_event_round_trip(spark, rows):
    df = spark.sql(
        """select 'e1' as event_id, 'GB' as region, timestamp'2024-03-01 10:00:00.5' as timestamp,
                  0D as demand_mw, 0D as generation_mw, 181.5D as carbon_intensity_gco2_kwh,
                  'carbonintensity.org.uk' as source"""
    )
    again = events.parse_event_json(events.events_to_json(df))
    assert rows(again) == rows(df)


GOOD_EVENT = {
    "event_id": "a", "region": "GB", "timestamp": "2024-03-01T10:00Z", "demand_mw": 1, "generation_mw": 2.5,
    "carbon_intensity_gco2_kwh": 0, "source": "meter",
}


def event_lines(spark, *changes):
    lines = [c if isinstance(c, str) else json.dumps({k: v for k, v in (GOOD_EVENT | c).items() if v != "drop"})
             for c in changes]
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_event_source_defaults_to_synthetic(spark, rows):
    lines = event_lines(spark, {"source": "drop"}, {"event_id": "b", "source": None})
    assert rows(events.parse_event_json(lines), "event_id", "source") == [("a", "synthetic"), ("b", "synthetic")]


@pytest.mark.parametrize(
    "change, reason",
    [
        ("not json at all", "not an event"),
        ("", "not an event"),
        ("[1, 2]", "not an event"),
        ({"timestamp": "yesterday"}, "timestamp: not a valid time"),
        ({"timestamp": "drop"}, "timestamp: missing"),
        ({"demand_mw": "many"}, "demand_mw: not a valid double"),
        ({"generation_mw": float("nan")}, "generation_mw: not a valid double"),
        ({"region": None, "demand_mw": None}, "region: missing; demand_mw: missing"),
    ],
)
def test_bad_event_lines_are_rejected_with_a_reason(spark, change, reason):
    checked = events.checked_events(event_lines(spark, change, {}))
    assert [r["_reason"] for r in events.rejected(checked).collect()] == [reason]
    assert [r["event_id"] for r in events.accepted(checked).collect()] == ["a"]


def test_a_number_in_quotes_is_a_number(spark, rows):
    lines = event_lines(spark, {"demand_mw": "12.5"})
    assert rows(events.parse_event_json(lines), "demand_mw") == [(12.5,)]


def test_newest_reading_becomes_an_event(spark, put, rows):
    typed = validate(payloads.read_carbon(spark, put("carbon", SLOTS)), contracts.CARBON)
    event = events.readings_to_events(events.newest_reading(typed))
    assert rows(event, "region", "demand_mw", "carbon_intensity_gco2_kwh", "source") == [
        ("GB", 0.0, 0.0, "carbonintensity.org.uk")
    ]


def test_broken_json_halts_the_load(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "page.json").write_text('{"response": {"data": [')
    with pytest.raises(Exception):
        payloads.read_eia(spark, str(path), "demand").count()


def test_payload_text_is_parsed_once(spark, rows):
    texts = spark.createDataFrame([(json.dumps(eia(DEMAND)),), (json.dumps(eia([])),)], "value string")
    df = payloads.unwrap_eia(payloads.parse_payload(texts.filter("value <> ''"), "value", "demand"))
    assert rows(df, "period") == [("2024-03-01T00",), ("2024-03-01T01",)]
    assert df._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
