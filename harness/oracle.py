"""The same questions in DuckDB SQL, written independently of the engine.

``CTES`` holds named sub-queries; ``sql`` puts together those a query needs.
"""

from __future__ import annotations

import re

from harness.lenses import AS_OF, FIRST_DAY

TS = f"TIMESTAMP '{AS_OF}'"

_KEY = (
    "cast(abs(case when {u} >= 9223372036854775808 then {u} - 18446744073709551616 "
    "else {u} end) as bigint)"
)


def _key(text: str) -> str:
    u = f"('0x' || right(md5({text}), 16))::ubigint::hugeint"
    return _KEY.format(u=u)


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


def _respondent(column: str) -> str:
    return (
        f"case {column} % 4 when 0 then 'ERCO' when 1 then 'MISO' when 2 then 'PJM' else 'XX' end"
    )


# Code, name, country, time zone, grid type.
REGION_ROWS = """
    ('CAISO', 'California Independent System Operator', 'United States', 'America/Los_Angeles', 'ISO'),
    ('ERCO', 'Electric Reliability Council of Texas', 'United States', 'America/Chicago', 'RTO'),
    ('GB', 'Great Britain National Grid', 'United Kingdom', 'Europe/London', 'TSO'),
    ('ISONE', 'ISO New England', 'United States', 'America/New_York', 'ISO'),
    ('MISO', 'Midcontinent Independent System Operator', 'United States', 'America/Chicago', 'RTO'),
    ('NYISO', 'New York Independent System Operator', 'United States', 'America/New_York', 'ISO'),
    ('PJM', 'PJM Interconnection', 'United States', 'America/New_York', 'RTO'),
    ('SPP', 'Southwest Power Pool', 'United States', 'America/Chicago', 'RTO'),
    ('SWPP', 'Southwest Power Pool (alt)', 'United States', 'America/Chicago', 'RTO')
"""

# Code, label, category, renewable, low-carbon, gCO2 per kWh.
FUEL_ROWS = """
    ('BIO', 'Biomass', 'Renewable', true, false, 230::double),
    ('COL', 'Coal', 'Thermal', false, false, 820::double),
    ('GEO', 'Geothermal', 'Renewable', true, true, 38::double),
    ('NG', 'Natural Gas', 'Thermal', false, false, 490::double),
    ('NUC', 'Nuclear', 'Low-Carbon', false, true, 12::double),
    ('OIL', 'Oil', 'Thermal', false, false, 650::double),
    ('OTH', 'Other', 'Other', false, false, 0::double),
    ('SUN', 'Solar', 'Renewable', true, true, 45::double),
    ('UNK', 'Unknown', 'Unknown', false, false, 0::double),
    ('WAT', 'Hydro', 'Renewable', true, true, 4::double),
    ('WND', 'Wind', 'Renewable', true, true, 11::double)
"""

# What the tables promise: table, check, column and what the check refers to.
PROMISES = """
    stg_demand not_null demand_key period_utc respondent demand_mwh
    stg_demand unique demand_key
    stg_generation not_null generation_key period_utc respondent fuel_type generation_mwh
    stg_generation unique generation_key
    stg_carbon_intensity not_null carbon_intensity_key period_from period_to intensity_gco2_kwh
    stg_carbon_intensity unique carbon_intensity_key
    dim_date not_null date_key date_day year month day_of_week
    dim_date unique date_key date_day
    dim_date month among 1,2,3,4,5,6,7,8,9,10,11,12
    dim_date day_of_week among 1,2,3,4,5,6,7
    dim_region not_null region_key respondent_code country
    dim_region unique region_key respondent_code
    dim_fuel_type not_null fuel_type_key fuel_type_code typical_co2_gco2_kwh
    dim_fuel_type unique fuel_type_key fuel_type_code
    fact_demand not_null demand_key date_key demand_mwh demand_mw
    fact_demand unique demand_key
    fact_demand date_key in dim_date
    fact_demand region_key in dim_region
    fact_generation not_null generation_key date_key generation_mwh
    fact_generation unique generation_key
    fact_generation date_key in dim_date
    fact_generation fuel_type_key in dim_fuel_type
    fact_carbon_intensity not_null carbon_intensity_key date_key intensity_gco2_kwh intensity_band
    fact_carbon_intensity unique carbon_intensity_key
    fact_carbon_intensity date_key in dim_date
    fact_carbon_intensity intensity_band among 'Very Low','Low','Moderate','High','Very High'
"""

# The same for the raw tables, which break some of them.
RAW_PROMISES = """
    bronze_demand not_null period value
    bronze_demand unique period _ingested_at
    bronze_demand respondent among 'ERCO','MISO','PJM'
    bronze_demand value_units among 'megawatthours'
    bronze_demand respondent in dim_region.respondent_code
    bronze_carbon not_null intensity_actual intensity_forecast
    bronze_carbon unique _ingested_at
"""

CTES = {
    "grid_events": """
        select cast(event_id as varchar) as event_id,
               case when event_type = 'view' then 'GB'
                    when user_id % 3 = 0 then 'ERCOT'
                    when user_id % 3 = 1 then 'CAISO' else 'MISO' end as region,
               ts as "timestamp",
               case when event_type = 'view' then 0.0::double
                    else 30000.0::double + floor(value * 100) end as demand_mw,
               case when event_type = 'view' then 0.0::double
                    else 30500.0::double + floor(value * 98) end as generation_mw,
               60.0::double + floor(value * 8) / 4 as carbon_intensity_gco2_kwh,
               case when event_type = 'view' then 'carbonintensity.org.uk'
                    else 'synthetic' end as source
        from events""",
    "rollup": """
        select region, source, time_bucket(interval 5 minute, "timestamp") as "timestamp",
               avg(demand_mw) as avg_demand_mw, max(demand_mw) as max_demand_mw,
               avg(carbon_intensity_gco2_kwh) as avg_carbon_intensity,
               max(carbon_intensity_gco2_kwh) as max_carbon_intensity,
               count(*) as event_count
        from grid_events group by all""",
    "bronze_demand_clean": f"""
        select strftime(o_orderdate, '%Y-%m-%d') || 'T0' || (o_orderkey % 2) as period,
               {_respondent('o_custkey')} as respondent,
               o_orderpriority as respondent_name, 'D' as type, 'Demand' as type_name,
               cast(cast(floor(o_totalprice) as bigint) as varchar) as value,
               'megawatthours' as value_units,
               timestamp '2024-01-01 00:00:00' + o_orderkey * interval 1 second as _ingested_at,
               o_orderstatus as load_group, o_custkey
        from orders""",
    "bronze_demand": """
        select case when o_custkey % 97 = 0 then 'no period' else period end as period,
               respondent, respondent_name, type, type_name,
               case when load_group = 'P' then 'n/a' else value end as value,
               value_units, _ingested_at, load_group
        from bronze_demand_clean""",
    "bronze_generation": f"""
        select strftime(l_shipdate, '%Y-%m-%d') || 'T0' || (l_linenumber % 2) as period,
               {_respondent('l_suppkey')} as respondent,
               case l_partkey % 12 when 0 then 'COL' when 1 then 'NG' when 2 then 'OIL'
                    when 3 then 'NUC' when 4 then 'WAT' when 5 then 'WND' when 6 then 'SUN'
                    when 7 then 'GEO' when 8 then 'BIO' when 9 then 'OTH' when 10 then 'UNK'
                    else 'ZZZ' end as fuel_type,
               cast(cast(l_quantity * 100 as bigint) as varchar) as value,
               'megawatthours' as value_units,
               timestamp '2024-01-01 00:00:00' + l_orderkey * interval 1 second as _ingested_at
        from lineitem""",
    "bronze_carbon": """
        select strftime(slot, '%Y-%m-%dT%H:%MZ') as "from",
               strftime(slot + interval 30 minute, '%Y-%m-%dT%H:%MZ') as "to",
               case when level < 100 then 'low' when level < 300 then 'moderate'
                    else 'high' end as intensity_index,
               case when event_id % 5 <> 0 then level end as intensity_actual,
               case when event_id % 50 <> 0 then level + 5 end as intensity_forecast,
               ts as _ingested_at
        from (select *, time_bucket(interval 30 minute, ts) as slot,
                     floor(value * 4) as level from events)""",
    "bronze_weather": """
        select strftime(l_shipdate, '%Y-%m-%d') || 'T0' || (l_linenumber % 2) || ':00' as time,
               l_quantity - 10 as temperature_2m, floor(l_discount * 100) as wind_speed_10m,
               floor(l_tax * 100) as precipitation, l_linenumber as weather_code,
               timestamp '2024-01-01 00:00:00' + l_orderkey * interval 1 second as _ingested_at,
               l_returnflag as load_group
        from lineitem""",
    "silver_demand": f"""
        select period_utc, respondent, respondent_name, demand_mwh, demand_mwh as demand_mw,
               _ingested_at, {TS} as _cleansed_at
        from (select *, row_number() over (partition by period_utc, respondent
                        order by _ingested_at desc) as rn
              from (select try_strptime(period, '%Y-%m-%dT%H') as period_utc, respondent,
                           respondent_name, try_cast(value as double) as demand_mwh, _ingested_at
                    from bronze_demand)
              where period_utc is not null and demand_mwh is not null)
        where rn = 1""",
    "silver_generation": f"""
        select period_utc, respondent, fuel_type, fuel_type_label, generation_mwh,
               _ingested_at, {TS} as _cleansed_at
        from (select *, row_number() over (partition by period_utc, respondent, fuel_type
                        order by _ingested_at desc, generation_mwh desc) as rn
              from (select strptime(period, '%Y-%m-%dT%H') as period_utc, respondent, fuel_type,
                           case fuel_type when 'COL' then 'Coal' when 'NG' then 'Natural Gas'
                                when 'NUC' then 'Nuclear' when 'OIL' then 'Oil'
                                when 'WAT' then 'Hydro' when 'WND' then 'Wind'
                                when 'SUN' then 'Solar' when 'OTH' then 'Other'
                                when 'UNK' then 'Unknown' else fuel_type end as fuel_type_label,
                           cast(value as double) as generation_mwh, _ingested_at
                    from bronze_generation))
        where rn = 1""",
    "silver_carbon": f"""
        select period_from, period_to, intensity_gco2_kwh, intensity_index, is_estimated,
               (epoch(period_to) - epoch(period_from)) / 60 as duration_minutes,
               _ingested_at, {TS} as _cleansed_at
        from (select *, row_number() over (partition by period_from, period_to
                        order by _ingested_at desc) as rn
              from (select strptime("from", '%Y-%m-%dT%H:%MZ') as period_from,
                           strptime("to", '%Y-%m-%dT%H:%MZ') as period_to,
                           coalesce(intensity_actual, intensity_forecast) as intensity_gco2_kwh,
                           intensity_index, intensity_actual is null as is_estimated,
                           _ingested_at
                    from bronze_carbon)
              where intensity_gco2_kwh is not null)
        where rn = 1""",
    "silver_weather": f"""
        select period_utc, temperature_2m as temperature_c, wind_speed_10m as wind_speed,
               precipitation as precipitation_mm, weather_code, _ingested_at,
               {TS} as _cleansed_at
        from (select *, strptime(time, '%Y-%m-%dT%H:%M') as period_utc,
                     row_number() over (partition by time order by _ingested_at desc,
                        temperature_2m desc, wind_speed_10m desc, precipitation desc,
                        weather_code desc) as rn
              from bronze_weather)
        where rn = 1""",
    "stg_demand": f"""
        select {_key(_iso('period_utc') + " || '|' || respondent")} as demand_key, period_utc,
               cast(period_utc as date) as period_date,
               cast(hour(period_utc) as integer) as period_hour,
               respondent, respondent_name, demand_mwh, demand_mw, _cleansed_at
        from silver_demand""",
    "stg_generation": f"""
        select {_key(_iso('period_utc') + " || '|' || respondent || '|' || fuel_type")}
                   as generation_key,
               period_utc, cast(period_utc as date) as period_date,
               cast(hour(period_utc) as integer) as period_hour,
               respondent, fuel_type, fuel_type_label, generation_mwh, _cleansed_at
        from silver_generation""",
    "stg_carbon_intensity": f"""
        select {_key(_iso('period_from') + " || '|' || " + _iso('period_to'))}
                   as carbon_intensity_key,
               period_from, period_to, cast(period_from as date) as period_date,
               intensity_gco2_kwh, intensity_index, is_estimated,
               cast(duration_minutes as integer) as duration_minutes, _cleansed_at
        from silver_carbon""",
    "spine": f"""
        select cast(unnest(generate_series(timestamp '{FIRST_DAY}',
                    {TS} + interval 365 day, interval 1 day)) as date) as date_day""",
    "dim_date": f"""
        select cast(strftime(date_day, '%Y%m%d') as integer) as date_key, date_day,
               cast(year(date_day) as integer) as year, cast(month(date_day) as integer) as month,
               cast(day(date_day) as integer) as day_of_month,
               cast(quarter(date_day) as integer) as quarter,
               cast(floor((dayofyear(date_day)
                    + dayofweek(cast(date_trunc('year', date_day) as date)) - 1) / 7) + 1
                    as integer) as week_of_year,
               cast(dayofweek(date_day) + 1 as integer) as day_of_week,
               dayname(date_day) as day_name, monthname(date_day) as month_name,
               strftime(date_day, '%Y-%m') as year_month,
               dayofweek(date_day) in (0, 6) as is_weekend,
               date_day = cast({TS} as date) as is_today
        from spine""",
    "dim_region": f"""
        select cast(row_number() over (order by respondent_code) as integer) as region_key, *
        from (values {REGION_ROWS})
             as r(respondent_code, region_name, country, timezone_name, grid_type)""",
    "dim_fuel_type": f"""
        select cast(row_number() over (order by fuel_type_code) as integer) as fuel_type_key, *
        from (values {FUEL_ROWS})
             as f(fuel_type_code, fuel_type_label, fuel_category, is_renewable, is_low_carbon,
                  typical_co2_gco2_kwh)""",
    "fact_demand": f"""
        select demand_key, date_key, region_key, period_utc, period_hour, respondent,
               demand_mwh, demand_mw, {TS} as _loaded_at
        from stg_demand s
        left join dim_date d on cast(s.period_utc as date) = d.date_day
        left join dim_region r on s.respondent = r.respondent_code""",
    "fact_generation": f"""
        select generation_key, date_key, region_key, fuel_type_key, period_utc, period_hour,
               respondent, fuel_type, s.fuel_type_label, generation_mwh,
               round(generation_mwh * coalesce(typical_co2_gco2_kwh, 0) / 1000.0, 2)
                   as estimated_co2_tonnes,
               coalesce(is_renewable, false) as is_renewable, {TS} as _loaded_at
        from stg_generation s
        left join dim_date d on cast(s.period_utc as date) = d.date_day
        left join dim_region r on s.respondent = r.respondent_code
        left join dim_fuel_type f on s.fuel_type = f.fuel_type_code""",
    "fact_carbon_intensity": f"""
        select carbon_intensity_key, date_key, period_from, period_to, period_date,
               cast(hour(period_from) as integer) as period_hour, intensity_gco2_kwh,
               intensity_index, is_estimated, duration_minutes,
               case when intensity_gco2_kwh < 100 then 'Very Low'
                    when intensity_gco2_kwh < 200 then 'Low'
                    when intensity_gco2_kwh < 300 then 'Moderate'
                    when intensity_gco2_kwh < 400 then 'High' else 'Very High' end
                   as intensity_band,
               coalesce(intensity_gco2_kwh < 150, false) as is_low_carbon_window,
               {TS} as _loaded_at
        from stg_carbon_intensity s left join dim_date d on s.period_date = d.date_day""",
    "fact_weather": f"""
        select date_key, period_utc, cast(hour(period_utc) as integer) as period_hour,
               temperature_c, wind_speed, precipitation_mm, weather_code, {TS} as _loaded_at
        from silver_weather s left join dim_date d on cast(s.period_utc as date) = d.date_day""",
    "demand_weather": """
        select period_utc, d.demand_mwh, temperature_c, wind_speed, precipitation_mm
        from (select period_utc, sum(demand_mwh) as demand_mwh from fact_demand group by 1) d
        join fact_weather w using (period_utc)""",
    "generation_by_category": """
        select g.*, coalesce(f.fuel_category, 'Unknown') as fuel_category
        from fact_generation g left join dim_fuel_type f using (fuel_type_key)""",
    "readings": """
        select event_id, region, source, "timestamp", demand_mw, carbon_intensity_gco2_kwh,
               lag(demand_mw) over w as previous_demand,
               lag(carbon_intensity_gco2_kwh) over w as previous_intensity
        from grid_events
        window w as (partition by region, source order by "timestamp", event_id)""",
    "demand_spikes": """
        select 'ERCOT Demand Spike' as rule, event_id, region, source, "timestamp",
               demand_mw as value,
               'ALERT: ERCOT demand spike — ' || cast(cast(demand_mw as bigint) as varchar)
                   || ' MW' as subject,
               previous_demand as previous, {spike} as threshold
        from readings where region = 'ERCOT' and source = 'synthetic' and demand_mw > {spike}""",
    "high_intensity": """
        select 'GB High Carbon Intensity' as rule, event_id, region, source, "timestamp",
               carbon_intensity_gco2_kwh as value,
               'ALERT: GB carbon intensity high — '
                   || cast(cast(round_even(carbon_intensity_gco2_kwh, 0) as bigint) as varchar)
                   || ' gCO₂/kWh' as subject,
               previous_intensity as previous, {high} as threshold
        from readings
        where source = 'carbonintensity.org.uk' and carbon_intensity_gco2_kwh > {high}""",
    "alerts": "select * from demand_spikes union all select * from high_intensity",
}


def sql(final: str, **values) -> str:
    """``final`` preceded by the sub-queries it refers to, directly or not."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                visit(body)
                needed[name] = body

    visit(final)
    for key, value in values.items():
        needed = {n: b.replace("{" + key + "}", str(value)) for n, b in needed.items()}
        final = final.replace("{" + key + "}", str(value))
    if not needed:
        return final
    ctes = ",\n".join(f"{name} as ({body})" for name, body in needed.items())
    return f"with {ctes}\n{final}"


def _check(table: str, check: str, column: str, count: str) -> str:
    return (
        f"select '{table}' as \"table\", '{check}' as \"check\", '{column}' as \"column\", "
        f"cast(({count}) as bigint) as failing_rows"
    )


def _counted(table: str, check: str, column: str, rest: str) -> str:
    """The statement that counts what breaks one promise."""
    if check == "not_null":
        return f"select count(*) from {table} where {column} is null"
    if check == "unique":
        return (
            f"select count(*) from (select {column} from {table} where {column} is not null "
            f"group by 1 having count(*) > 1)"
        )
    if check == "accepted_values":
        return f"select count(*) from {table} where {column} not in ({rest})"
    parent, _, key = rest.partition(".")
    return (
        f"select count(*) from {table} where {column} is not null and "
        f"{column} not in (select {key or column} from {parent})"
    )


def checks_sql(promises: str = PROMISES) -> str:
    """Every promise as one row of a union."""
    parts = []
    for line in promises.strip().splitlines():
        table, first, *others = line.split(maxsplit=3)
        if first in ("not_null", "unique"):
            columns = " ".join(others).split()
            parts += [_check(table, first, c, _counted(table, first, c, "")) for c in columns]
        else:
            check = "accepted_values" if others[0] == "among" else "relationships"
            parts.append(_check(table, check, first, _counted(table, check, first, others[1])))
    union = "\nunion all\n".join(parts)
    return sql(
        f"select *, case when failing_rows > 0 then 'fail' else 'pass' end as status "
        f"from ({union})"
    )
