"""DuckDB SQL giving the expected result of every query, over the same Parquet tables.

Written against flat columns and independent of the Spark code: the telemetry recipe
first, then the gate of each row, then one statement per query.
"""

from __future__ import annotations

AS_OF = 1706659199000
HOUR = 3600000
DAY = 24 * HOUR
WIDE = 720 * HOUR
MID_MONTH = 1705708800000

TELEMETRY = """
b as (
  select event_id eid, user_id u, event_type et, value v, epoch_us(ts)//1000 ms,
         cast(json_extract_string(props,'$.k') as bigint) k
  from events
), c as (
  select *, case when et='signup' and k%10=0 then 'EMPTY'
                 when et='error'  and k%10=1 then 'PARTIAL' else 'FULL' end rk from b
), t as (
  select
    eid, u, eid % 89 as fault,
    case when eid%97=0 then null else concat('e', cast(eid as varchar)) end as event_id,
    concat('dev-', cast(u as varchar)) as device_id,
    case u%4 when 0 then 'temperature_sensor' when 1 then 'pressure_sensor'
             when 2 then 'vibration_sensor' else 'energy_meter' end as device_type,
    ms as ts_ms, rk,
    case when rk='FULL' then concat('Building-', cast(u%5+1 as varchar)) end as building,
    case when rk='FULL' then cast(u%10+1 as int) end as floor,
    case when rk='FULL' then case u%3 when 0 then 'A' when 1 then 'B' else 'C' end end as zone,
    case when u%2=0 then '1.0.0' else '2.1.0' end as firmware_version,
    cast(50+(u%3)*15+k%10 as int) as signal_strength,
    case when u%4=3 then null else cast(15+(u*7+k)%85 as int) end as battery_level,
    case when k%50=3 then 'true' end as anomaly_detected,
    case when k%50=3 then case when et='view' then 'spike' else 'drop' end end as anomaly_type,
    case when rk='EMPTY' then 'reconnected' end as status,
    case when rk='PARTIAL' then 'sensor_failure' end as error,
    case when rk='EMPTY' then 0 when rk='PARTIAL' then 1 when u%4 in (2,3) then 4 else 2 end
      as reading_count,
    case when rk='FULL' then case when u%40=8 then 18e0 when u%4=0 then 17e0+k*0.09e0
         when u%4=1 then 15e0+k*0.2e0 when u%4=2 then 20e0+k*0.2e0 end end as temperature,
    case when rk='FULL' and u%4=0 then case when u%40=8 then 30e0 else 30e0+v/10e0 end end
      as humidity,
    case when rk='FULL' and u%4=1 then 999e0+k*0.22e0 end as pressure,
    case when rk='FULL' and u%4=2 then (k-50)/23e0 end as vibration_x,
    case when rk='FULL' and u%4=2 then v/100e0 end as vibration_y,
    case when rk='FULL' and u%4=2 then (50-k)/50e0 end as vibration_z,
    case when rk='FULL' and u%4=3 then 219e0+k*0.22e0 end as voltage,
    case when rk='FULL' and u%4=3 then v/10e0 end as "current",
    case when rk='FULL' and u%4=3 then v*20e0 end as power,
    case when rk='FULL' and u%4=3 then 0.76e0+(u%5)*0.05e0+k*0.0005e0 end as power_factor
  from c
)"""

OUT_OF_RANGE = """(
  (device_type='temperature_sensor'
    and (temperature<18 or temperature>25 or humidity<30 or humidity>60))
  or (device_type='pressure_sensor' and (pressure<1000 or pressure>1020))
  or (device_type='vibration_sensor'
    and (abs(vibration_x)>2 or abs(vibration_y)>2 or abs(vibration_z)>2))
  or (device_type='energy_meter' and (voltage<220 or voltage>240 or power>7000)))"""


def _anomalous(max_age: int) -> str:
    return f"({OUT_OF_RANGE} or ts_ms > {AS_OF + HOUR} or ts_ms < {AS_OF - max_age})"


def _gated(max_age: int = 40 * DAY) -> str:
    return f"""with {TELEMETRY}, j as (
  select *, {_anomalous(max_age)} as anomalous from t
), g as (
  select *, case when event_id is null then 'SCHEMA' when anomalous is null then 'INDETERMINATE'
                 when anomalous then 'ANOMALY' else 'PASSED' end as gate
  from j
), v as (
  select *, 'PASSED' as quality_status, 0e0 as anomaly_score, 'SPARK_RULES' as validation_method
  from g where gate='PASSED'
), a as (
  select *, 'ANOMALY_DETECTED' as quality_status,
         case when anomaly_detected='true' then 1e0 else 0.8e0 end as anomaly_score,
         'SPARK_RULES' as validation_method
  from g where gate='ANOMALY'
)
"""


METRICS = [
    "temperature", "humidity", "pressure", "vibration_x", "vibration_y", "vibration_z",
    "voltage", '"current"', "power", "power_factor",
]
ROUNDED = ", ".join(f"round({m},6) as {m}" for m in METRICS)
FLAT = (
    "event_id, device_id, device_type, ts_ms, building, floor, zone, firmware_version, "
    "signal_strength, battery_level, anomaly_detected, anomaly_type, status, error, "
    f"cast(reading_count as int) as reading_count, {ROUNDED}"
)
NEWEST = "row_number() over (partition by device_id order by ts_ms desc, event_id desc nulls last)"


def _time(ms: str) -> str:
    return f"make_timestamp(({ms})//1000*1000000)"


def _hour(ms: str) -> str:
    return f"date_trunc('hour', {_time(ms)})"


NOW = _time(str(AS_OF))


def _health(window: int) -> str:
    since = AS_OF - window
    ladder = """case when m.min_battery_level<20 then {0} when n.n>10 then {1}
      when m.avg_signal_strength<60 then {2} when n.n>5 then {3}
      when m.min_battery_level<50 then {4} else {5} end"""
    return f"""{_gated()}, l as (
  select *, {NEWEST} rn from v where ts_ms>={since}
), m as (
  select device_id, device_type, count(*) total_readings_24h,
         avg(cast(signal_strength as double)) avg_signal_strength,
         avg(cast(battery_level as double)) avg_battery_level,
         min(battery_level) min_battery_level, max(ts_ms) last_ms
  from v where ts_ms>={since} group by 1,2
), n as (
  select device_id, count(*) n, max(anomaly_score) s from a where ts_ms>={since} group by 1
)
select l.device_id, l.device_type, l.building, l.floor, l.zone, l.firmware_version,
  m.total_readings_24h, round(m.avg_signal_strength,6) avg_signal_strength,
  round(m.avg_battery_level,6) avg_battery_level, m.min_battery_level,
  coalesce(n.n,0) anomaly_count_24h, coalesce(n.s,0e0) max_anomaly_score,
  cast({ladder.format(0, 20, 40, 60, 80, 100)} as int) health_score,
  {ladder.format("'URGENT: Replace battery'", "'URGENT: Device malfunction'",
                 "'Check connectivity'", "'Schedule inspection'",
                 "'Plan battery replacement'", "'Healthy'")} maintenance_recommendation,
  {_time('m.last_ms')} last_seen, {NOW} updated_at
from l join m on l.device_id=m.device_id left join n on l.device_id=n.device_id where l.rn=1"""


def _meters(window: int) -> str:
    return f"""{_gated()}, e as (
  select building, floor, zone, device_id, avg(power) p, avg(voltage) vo, avg(power_factor) pf
  from v where device_type='energy_meter' and ts_ms>={AS_OF - window} group by 1,2,3,4
)"""


def _building(window: int, zero: bool = False) -> str:
    midnight = AS_OF - AS_OF % DAY
    n = "coalesce(n.n,0)" if zero else "n.n"
    return f"""{_meters(window)}, d as (
  select building, count(distinct device_id) meter_count, sum(p)/1000 kw, avg(vo) avo,
         avg(pf) apf, sum(p)*24/1000 kwh, sum(p)*24*30/1000*0.12e0 usd
  from e group by 1
), n as (
  select building, count(*) n from a
  where device_type='energy_meter' and ts_ms>={midnight} group by 1
)
select d.building, meter_count, round(kw,6) total_current_power_kw, round(avo,6) avg_voltage,
  round(apf,6) avg_power_factor, round(kwh,6) estimated_daily_kwh,
  round(usd,6) estimated_monthly_cost_usd, coalesce(n.n,0) energy_anomalies_today,
  cast(case when apf>=0.95 and {n}=0 then 100 when apf>=0.90 and {n}<=2 then 80
       when apf>=0.85 and {n}<=5 then 60 else 40 end as int) efficiency_score,
  case when apf<0.85 then 'Install power factor correction equipment'
       when {n}>5 then 'Investigate voltage irregularities'
       when kw>500 then 'Consider load balancing' else 'Operating normally' end recommendation,
  {NOW} dashboard_updated_at
from d left join n on d.building=n.building"""


def _top_devices(window: int) -> str:
    return f"""{_gated()}
select device_id, device_type, count(*) anomaly_count, round(avg(anomaly_score),6) avg_anomaly_score,
  max(anomaly_score) max_anomaly_score,
  array_to_string(list_sort(list(distinct coalesce(anomaly_type,'NULL'))), ',') anomaly_types
from a where ts_ms>={AS_OF - window} group by 1,2
order by anomaly_count desc, device_id, device_type limit 10"""


def _heatmap(window: int) -> str:
    return f"""{_gated()}
select building, floor, round(avg(temperature),6) avg_temperature,
  round(min(temperature),6) min_temperature, round(max(temperature),6) max_temperature,
  count(distinct device_id) sensor_count
from v where device_type in ('temperature_sensor','pressure_sensor','vibration_sensor')
  and ts_ms>={AS_OF - window} and temperature is not null
group by 1,2"""


def _energy_trend(window: int) -> str:
    return f"""{_gated()}, h as (
  select {_hour('ts_ms')} as hour, building, sum(power)/1000 kw
  from v where device_type='energy_meter' and ts_ms>={AS_OF - window} group by 1,2
)
select hour, building, round(kw,6) total_power_kw,
  round(sum(kw) over (partition by building order by hour),6) cumulative_kwh from h"""


def _silent(silence: int, latest: bool = False) -> str:
    if latest:
        known = f"select * from (select *, {NEWEST} rn from v) where rn=1"
    else:
        known = """select distinct device_id, device_type, building, floor, zone, rk,
          firmware_version, signal_strength, battery_level, anomaly_detected, anomaly_type,
          status, error from v"""
    return f"""{_gated()}, l as (select device_id, max(ts_ms) ms from g group by 1), k as ({known})
select l.device_id, k.device_type, k.building, k.floor, {_time('l.ms')} last_seen,
  {AS_OF} - l.ms as silence_duration_ms
from l join k on l.device_id=k.device_id where l.ms < {AS_OF - silence}"""


def _vibration(window: int, signed: bool = False) -> str:
    change = "arg_max(m,hour)-arg_min(m,hour)" if signed else "max(m)-min(m)"
    reported = "abs(inc)" if signed else "inc"
    return f"""{_gated()}, h as (
  select device_id, {_hour('ts_ms')} as hour,
    avg(sqrt(power(vibration_x,2)+power(vibration_y,2)+power(vibration_z,2))) m
  from v where device_type='vibration_sensor' and ts_ms>={AS_OF - window} group by 1,2
), d as (select device_id, min(m) lo, max(m) hi, {change} inc from h group by 1)
select device_id, round(lo,6) min_vibration, round(hi,6) max_vibration,
  round(inc,6) vibration_increase,
  case when inc>0.5 then 'INCREASING' when inc < -0.5 then 'DECREASING' else 'STABLE' end trend
from d where {reported} > 0.3"""


def _quality(window: int, source: str = "v", key: str = "quality_status") -> str:
    score = "anomaly_score" if source == "v" else (
        "case gate when 'PASSED' then 0e0 when 'ANOMALY' then "
        "case when anomaly_detected='true' then 1e0 else 0.8e0 end end"
    )
    return f"""{_gated()}
select {key}, count(*) record_count, count(distinct device_id) device_count,
  round(avg({score}),6) avg_anomaly_score, {_time('min(ts_ms)')} first_occurrence,
  {_time('max(ts_ms)')} last_occurrence
from {source} where ts_ms>={AS_OF - window} group by 1"""


def _faulty() -> str:
    """Rows as the faulty producers send them: what each field of the message holds."""
    return f"""with {TELEMETRY}, j as (select *, {_anomalous(40 * DAY)} as anomalous from t), f as (
  select *,
    case when fault in (0,3) or event_id is null then 'SCHEMA'
         when fault in (1,2) or anomalous is null then 'INDETERMINATE'
         when anomalous then 'ANOMALY' else 'PASSED' end as gate,
    case when fault in (0,3) or event_id is null then 'event_id missing or message unreadable'
         when fault=1 then 'event time missing'
         when fault=2 then 'readings missing'
         when rk='EMPTY' then 'readings empty'
         else 'required metric missing or null' end as reason
  from j)
"""


def _contract() -> str:
    metrics = {
        "temperature_sensor": ["temperature", "humidity"],
        "pressure_sensor": ["pressure", "temperature"],
        "vibration_sensor": ["vibration_x", "vibration_y", "vibration_z", "temperature"],
        "energy_meter": ["voltage", "current", "power", "power_factor"],
    }
    parts = [
        "select null as device_type, '$' as field, 'unreadable' as violation from f where fault=0",
        "select case when fault<>3 then device_type end, 'event_id', 'missing' from f "
        "where fault=3 or (fault<>0 and event_id is null)",
        "select null, 'device_type', 'missing' from f where fault=3",
        "select device_type, 'timestamp', 'mistyped' from f where fault=1",
        "select device_type, 'readings', 'mistyped' from f where fault=1",
        "select device_type, 'readings', 'missing' from f where fault=2",
        "select device_type, 'metadata.location', 'mistyped' from f where fault=4",
        "select device_type, 'metadata.battery_level', 'mistyped' from f where fault=4",
        "select device_type, 'metadata.anomaly_detected', 'mistyped' from f where fault=4",
    ]
    for kind, names in metrics.items():
        for i, name in enumerate(names):
            gone = "'missing'" if i else "case when fault in (1,2) or rk='EMPTY' then 'missing' else 'null' end"
            parts.append(
                f"select device_type, 'readings.{name}', {gone} from f where fault not in (0,3) "
                f"and device_type='{kind}' and (fault in (1,2) or rk<>'FULL')"
            )
    union = "\n union all ".join(parts)
    return f"""{_faulty()}
select device_type, field, violation, count(*) message_count from ({union}) x group by 1,2,3"""


def _versions() -> str:
    count = lambda test: f"(select count(*) from f where {test})"
    meter = count(
        "device_type='energy_meter' and fault not in (0,3) and (fault in (1,2) or rk<>'FULL')"
    )
    changes = [
        ("device_type", None, "values widened", 0, 1, count("fault=3"), count("fault=3")),
        ("metadata.firmware_version", None, "made required", 1, 0, "0", count("fault in (1,2,3,4)")),
        ("metadata.battery_level", None, "types widened", 0, 1, count("fault=4"), count("fault=4")),
        ("metadata.error", None, "removed", 0, 0, "0", "0"),
        ("readings.power_factor", "energy_meter", "removed", 0, 1, meter, "0"),
        ("readings.humidity", "pressure_sensor", "added", 1, 0, "0",
         count("device_type='pressure_sensor' and fault not in (0,3)")),
    ]
    rows = " union all ".join(
        f"select '{field}' as field, {repr(kind) if kind else 'cast(null as varchar)'} as kind, "
        f"'{change}' as change, {backward}=1 as breaks_backward, {forward}=1 as breaks_forward, "
        f"{old} as old_violations, {new} as new_violations"
        for field, kind, change, backward, forward, old, new in changes
    )
    return f"{_faulty()} {rows}"


DECLARED = [
    ("temperature_sensor", "temperature", 18, 25), ("temperature_sensor", "humidity", 30, 60),
    ("pressure_sensor", "pressure", 1000, 1020), ("pressure_sensor", "temperature", 15, 30),
    ("vibration_sensor", "vibration_x", -2, 2), ("vibration_sensor", "vibration_y", -2, 2),
    ("vibration_sensor", "vibration_z", -2, 2), ("vibration_sensor", "temperature", 20, 40),
    ("energy_meter", "voltage", 220, 240), ("energy_meter", "current", 0, 30),
    ("energy_meter", "power", 0, 7000), ("energy_meter", "power_factor", 0.85, 0.99),
]


def _range_rules() -> str:
    parts = [
        f"select device_type, '{m}' as metric from g where event_id is not null "
        f"and device_type='{d}' and (\"{m}\"<{lo} or \"{m}\">{hi})"
        for d, m, lo, hi in DECLARED
    ]
    union = "\n union all ".join(parts)
    return f"{_gated()} select device_type, metric, count(*) breach_count from ({union}) x group by 1,2"


def _by_metric(source: str = "v") -> str:
    return "\n union all ".join(
        f"select device_id, device_type, ts_ms, '{m.strip(chr(34))}' as metric, {m} as value "
        f"from {source} where {m} is not null"
        for m in METRICS
    )


def _stuck() -> str:
    return f"""{_gated()}
select device_id, device_type, metric, round(min(value),6) stuck_value, count(*) reading_count,
  {_time('min(ts_ms)')} first_seen, {_time('max(ts_ms)')} last_seen
from ({_by_metric()}) x where ts_ms>={AS_OF - WIDE}
group by 1,2,3 having min(value)=max(value) and count(*)>=5"""


def _hourly(where: str) -> str:
    return f"""{_gated()}, x as ({_by_metric()})
select device_id, device_type, metric, {_hour('ts_ms')} as hour, count(*) reading_count,
  round(avg(value),6) avg_value, round(min(value),6) min_value, round(max(value),6) max_value
from x where {where} group by 1,2,3,4"""


def _table_routes() -> str:
    kind = "case when fault not in (0,3) then device_type end"
    return f"""{_faulty()}
select 'raw_telemetry' table_name, {kind} kind, count(*) row_count from f group by 2
union all select 'validated_telemetry', {kind}, count(*) from f where gate='PASSED' group by 2
union all select 'anomaly_alerts', {kind}, count(*) from f where gate='ANOMALY' group by 2
union all select 'dead_letter_queue', gate, count(*) from f
  where gate in ('SCHEMA','INDETERMINATE') group by 2"""


def _models(found: dict[str, str]) -> str:
    """Rows and a sum of each model, from the statements of the models themselves."""
    counts = {
        "device_summary_simple": ("q_device_summary", "total_readings"),
        "device_metrics_latest": ("q_device_metrics_latest", "battery_level"),
        "device_health_summary": ("q_device_health_24h", "health_score"),
        "building_energy_dashboard": ("q_building_energy_1h", "meter_count"),
        "hourly_sensor_aggregates": ("q_hourly_sensor_aggregates", "reading_count"),
    }
    return " union all ".join(
        f"select '{model}' as model, count(*) as row_count, cast(sum({column}) as bigint) as total "
        f"from ({found[query]}) {query}"
        for model, (query, column) in counts.items()
    )


def _map_extract() -> str:
    columns = ", ".join(
        f"count({m}) as n_{m.strip(chr(34))}, round(sum({m}),6) as sum_{m.strip(chr(34))}"
        for m in METRICS
    )
    return f"{_gated()} select device_type, {columns} from g group by 1"


def oracle_sql() -> dict[str, str]:
    base = _gated()
    routes = "select gate, count(*) as row_count from g group by 1"
    found = {
        "q_envelope_parse": f"""{base} select {FLAT}, device_id as kafka_key,
          'iot-telemetry' as topic, cast(u%3 as int) as partition, eid as "offset",
          ts_ms as kafka_ms from g""",
        "q_encode_roundtrip": f"""{base} select device_type, count(*) message_count,
          count(*) equal_count, count(*) keyed_count,
          cast(sum(reading_count) as bigint) reading_count from g group by 1""",
        "q_route_counts": base + routes,
        "q_route_counts_7d": _gated(7 * DAY) + routes,
        "q_gate_schema": f"""{base} select device_type, count(event_id) valid_count,
          count(*)-count(event_id) invalid_count from g group by 1""",
        "q_gate_anomaly": f"""{base} select device_type,
          coalesce(cast(anomalous as varchar),'unknown') anomalous, count(*) row_count
          from g where event_id is not null group by 1,2""",
        "q_gate_time_bounds": f"""{base} select device_type,
          count(*) filter (where ts_ms>{MID_MONTH + HOUR}) future_count,
          count(*) filter (where ts_ms<{MID_MONTH - 7 * DAY}) stale_count,
          count(*) filter (where ts_ms between {MID_MONTH - 7 * DAY} and {MID_MONTH + HOUR})
            timely_count
          from g group by 1""",
        "q_validated": f"{base} select {FLAT}, quality_status, anomaly_score, validation_method from v",
        "q_anomalies": f"{base} select {FLAT}, quality_status, anomaly_score, validation_method from a",
        "q_anomaly_score": f"""{base} select gate, case gate when 'PASSED' then 0e0
          when 'ANOMALY' then case when anomaly_detected='true' then 1e0 else 0.8e0 end end
          anomaly_score, count(*) row_count from g group by 1,2""",
        "q_raw_audit": f"{base} select {FLAT} from g",
        "q_dead_letter": f"""{_faulty()} select device_id as kafka_key, 'iot-telemetry' as topic,
          cast(u%3 as int) as partition, eid as "offset", ts_ms as kafka_ms, gate, reason,
          true as has_value from f where gate in ('SCHEMA','INDETERMINATE')""",
        "q_contract_violations": _contract(),
        "q_contract_versions": _versions(),
        "q_map_extract": _map_extract(),
        "q_trailing_window": f"""{base} select device_type, """
        + ", ".join(
            f"count(*) filter (where ts_ms>={AS_OF - h * HOUR}) last_{h}h"
            for h in (1, 24, 168, 720)
        )
        + f" from v where ts_ms>={AS_OF - WIDE} group by 1",
        "q_distinct_struct": f"""{base} select device_id, count(*) variant_count from (
          select distinct device_id, device_type, building, floor, zone, firmware_version,
            signal_strength, battery_level, anomaly_detected, anomaly_type, status, error from v
          ) x group by 1""",
        "q_sql_views": f"""{base} select v.building, count(*) reading_count,
          round(avg(v.voltage),6) avg_voltage, max(n.n) anomaly_count
          from v left join (select building, count(*) n from a group by 1) n
            on v.building=n.building
          where v.device_type='energy_meter' group by 1""",
        "q_device_summary": f"""{base} select device_id, device_type, count(*) total_readings,
          min(ts_ms) first_seen, max(ts_ms) last_seen,
          count(distinct cast({_time('ts_ms')} as date)) active_days from v group by 1,2""",
        "q_device_metrics_latest": f"""{base}, l as (select *, {NEWEST} rn from v)
          select device_id, device_type, building, floor, zone, ts_ms last_reading_timestamp,
            {_time('ts_ms')} last_reading_time,
            case device_type
              when 'temperature_sensor' then 'Temp: ' || cast(temperature as varchar)
                || '°C, Humidity: ' || cast(humidity as varchar) || '%'
              when 'pressure_sensor' then 'Pressure: ' || cast(pressure as varchar) || ' hPa'
              when 'energy_meter' then 'Power: ' || cast(power as varchar) || ' W, Voltage: '
                || cast(voltage as varchar) || ' V'
              when 'vibration_sensor' then 'Vibration X: ' || cast(vibration_x as varchar)
              else 'N/A' end latest_readings,
            battery_level, signal_strength
          from l where rn=1""",
        "q_device_health": _health(WIDE),
        "q_device_health_24h": _health(DAY),
        "q_building_energy": _building(WIDE),
        "q_building_energy_1h": _building(HOUR),
        "q_building_energy_zero": _building(WIDE, zero=True),
        "q_floor_breakdown": f"""{_meters(WIDE)} select building, floor,
          count(distinct device_id) meter_count, round(sum(p),6) floor_power_w,
          round(sum(p)/1000,6) floor_power_kw from e group by 1,2""",
        "q_status_overview": f"""{base} select device_id, device_type, building, floor, zone,
          quality_status, {_time('ts_ms')} last_reading_time, {ROUNDED}
          from (select * from v where ts_ms>={AS_OF - WIDE}
                order by ts_ms desc, event_id desc limit 20) x""",
        "q_anomaly_top_devices": _top_devices(WIDE),
        "q_anomaly_top_devices_24h": _top_devices(DAY),
        "q_temperature_heatmap": _heatmap(WIDE),
        "q_temperature_heatmap_1h": _heatmap(HOUR),
        "q_energy_trend": _energy_trend(WIDE),
        "q_energy_trend_24h": _energy_trend(DAY),
        "q_silent_devices": _silent(DAY),
        "q_silent_devices_1h": _silent(HOUR),
        "q_silent_devices_latest": _silent(DAY, latest=True),
        "q_vibration_trend": _vibration(WIDE),
        "q_vibration_trend_24h": _vibration(DAY),
        "q_vibration_trend_signed": _vibration(WIDE, signed=True),
        "q_data_quality": _quality(WIDE),
        "q_data_quality_24h": _quality(DAY),
        "q_data_quality_all": _quality(WIDE, "g", "gate"),
        "q_battery_alert": f"""{base} select device_id, device_type, building, floor, zone,
          battery_level current_battery_level, {_time('ts_ms')} reading_time
          from (select * from v where battery_level<30 and ts_ms>={AS_OF - WIDE}
                order by battery_level, ts_ms desc, event_id desc limit 20) x""",
        "q_range_rules": _range_rules(),
        "q_stuck_sensors": _stuck(),
        "q_hourly_sensor_aggregates": _hourly("true"),
        "q_stream_route_counts": f"""{_faulty()} select gate,
          case when gate in ('SCHEMA','INDETERMINATE') then reason end as reason,
          count(*) row_count from f group by 1,2""",
        "q_published_dates": f"""{_faulty()} select
          cast(cast({_time(f"case when fault in (0,1) then {AS_OF} else ts_ms end")} as date)
            as varchar) event_date,
          gate, count(*) row_count from f group by 1,2""",
        "q_stream_hourly_aggregates": _hourly("true"),
        "q_table_sink_routes": _table_routes(),
        "q_batch_report": f"""{_faulty()} select count(*) row_count,
          count(*) filter (where gate='PASSED') passed,
          count(*) filter (where gate='ANOMALY') anomaly,
          count(*) filter (where gate='INDETERMINATE') indeterminate,
          count(*) filter (where gate='SCHEMA') "schema",
          min(case when fault not in (0,1) then ts_ms end) first_ms,
          max(case when fault not in (0,1) then ts_ms end) last_ms from f""",
    }
    return found | {
        "q_materialised_models": _models(found),
        "q_incremental_summary": found["q_device_summary"],
        "q_incremental_latest": found["q_device_metrics_latest"],
    }
