"""SQL for DuckDB that states each registered query on the same test tables."""

from __future__ import annotations

from skylattice.registry import (
    FINE,
    LARGE,
    OBSERVATION_COLUMNS,
    RUN_DATE,
    RUN_DATES,
    WIDE_GAP,
)

_GAP = 1800

# Every event, and every tenth once more half a minute later.
_BRONZE = """
copies as (
  select e.*, d.delay from events e, (values (0), (30)) d(delay)
  where d.delay = 0 or e.event_id % 10 = 0
),
bronze as (
  select
    cast(floor(epoch(ts)) as bigint) + delay as "time",
    case when event_id % 97 <> 0 then concat('u', user_id) end as icao24,
    case
      when delay = 30 and user_id % 26 = 0 then ' BUI9 '
      when user_id % 13 = 0 then null
      when user_id % 17 = 0 then '   '
      else concat(' ', ['aut', 'BUI', 'Fur', 'HOU', 'MAC', 'ZZZ'][user_id % 6 + 1],
                  event_id % 1000, ' ')
    end as callsign,
    'Brazil' as origin_country,
    cast(null as bigint) as time_position,
    cast(floor(epoch(ts)) as bigint) - event_id % 5 as last_contact,
    cast(-47.5 + (event_id % 200) * 0.0078125 as double) as longitude,
    cast(-24.3 + (user_id % 100) * 0.015625 as double) as latitude,
    case when event_type <> 'signup' then value end as baro_altitude,
    case when event_type <> 'purchase' then event_type = 'error' end as on_ground,
    case when event_type <> 'click'
         then cast(json_extract_string(props, '$.k') as double) end as velocity,
    cast(null as double) as true_track,
    cast(null as double) as vertical_rate,
    cast(null as double) as geo_altitude,
    false as spi,
    cast(0 as integer) as position_source,
    cast(null as integer) as category,
    event_id
  from copies
)"""

_UNIQUE = """
uniq as (
  select * exclude (copy) from (
    select *, row_number() over (
      partition by icao24, last_contact order by "time", event_id) as copy
    from bronze)
  where copy = 1
)"""

_AIRLINES = """
airlines as (
  select * exclude (pick) from (
    select
      cast(c_custkey as varchar) as "Airline ID", c_name as "Nome",
      cast(null as varchar) as "Alias", cast(null as varchar) as "IATA",
      upper(substr(c_mktsegment, 1, 3)) as "ICAO",
      cast(null as varchar) as "Indicativo", cast(null as varchar) as "País",
      case when c_acctbal > 9000 then 'y' else 'N' end as "Active",
      row_number() over (
        partition by upper(substr(c_mktsegment, 1, 3))
        order by case when c_acctbal > 9000 then 0 else 1 end, c_custkey) as pick
    from customer)
  where pick = 1
)"""

_SILVER = """
silver as (
  select
    u.* replace (make_timestamp(u."time" * 1000000) as "time"), a.*,
    cast(year(make_timestamp(u."time" * 1000000)) as integer) as "year",
    cast(month(make_timestamp(u."time" * 1000000)) as integer) as "month",
    cast(day(make_timestamp(u."time" * 1000000)) as integer) as "day"
  from uniq u left join airlines a on upper(substr(trim(u.callsign), 1, 3)) = a."ICAO"
  where u.callsign is not null
)"""

_GOLD = """
gold as (
  select * exclude ("year", "month", "day"),
    cast("time" as date) as "date", cast(hour("time") as integer) as "hour"
  from silver where icao24 is not null
)"""


def _ymd(date: str = '"date"') -> str:
    parts = ("year", "month", "day")
    return ", ".join(f'cast({part}({date}) as integer) as "{part}"' for part in parts)


def _with(*parts: str, final: str) -> str:
    return "with " + ",".join(parts) + "\n" + final


def _bronze(final: str) -> str:
    return _with(_BRONZE, final=final)


def _unique(final: str) -> str:
    return _with(_BRONZE, _UNIQUE, final=final)


def _silver(final: str) -> str:
    return _with(_BRONZE, _UNIQUE, _AIRLINES, _SILVER, final=final)


def _gold(final: str, *more: str) -> str:
    return _with(_BRONZE, _UNIQUE, _AIRLINES, _SILVER, _GOLD, *more, final=final)


def _observed(gap: int, stale_tail: bool, where: str = "true") -> str:
    """Row-level session columns, over the plain per-aircraft ordering."""
    stale = f"or (next_time is null and epoch(dataset_end) - epoch(\"time\") > {gap})"
    return f"""
neighbours as (
  select *,
    lag("time") over w as previous_time,
    lead("time") over w as next_time,
    max("time") over () as dataset_end
  from gold where {where}
  window w as (partition by icao24 order by "time", event_id)
),
observed as (
  select *,
    sum(new_session) over (partition by icao24 order by "time", event_id
                           rows unbounded preceding)::bigint as session_id
  from (
    select *,
      cast(case when previous_time is null or epoch("time") - epoch(previous_time) > {gap}
           then 1 else 0 end as integer) as new_session,
      cast(case when epoch(next_time) - epoch("time") > {gap} {stale if stale_tail else ''}
           then 1 else 0 end as integer) as session_closes
    from neighbours)
)"""


_SESSIONS = f"""
sessions as (
  select *,
    cast(epoch(exit_ts) - epoch(entry_ts) as bigint) as duration_seconds,
    cast(entry_ts as date) as "date", {_ymd('entry_ts')}
  from (
    select icao24, session_id, min("time") as entry_ts, max("time") as exit_ts,
      max(session_closes) as has_exit,
      arg_min("Nome", "time") filter (where "Nome" is not null) as airline_name,
      arg_min("ICAO", "time") filter (where "ICAO" is not null) as airline_icao
    from observed group by icao24, session_id)
)"""


def _session(final: str, gap: int = _GAP, stale_tail: bool = True, where: str = "true") -> str:
    return _gold(final, _observed(gap, stale_tail, where), _SESSIONS)


def _exact_mean(x: str) -> str:
    """Mean of non-negative millionths, rounded half-up to two places."""
    count = f"nullif(count({x}), 0)"
    total = f"sum(cast(round({x} * 1000000) as bigint))"
    return f"cast((2 * {total} + {count} * 10000) // (2 * {count} * 10000) as bigint) / 100.0"


def _altitude_speed(velocity: str) -> str:
    return _gold(f"""
select "date", "hour", {_ymd()},
  {_exact_mean('baro_altitude')} as avg_altitude,
  {velocity} as avg_velocity,
  count(baro_altitude) as altitude_observations,
  count(velocity) as velocity_observations
from gold group by "date", "hour" """)


def _extremes() -> str:
    """Sums of whole numbers, of which the means are then taken."""
    def special(hour: int, rest: int) -> str:
        return f'"hour" % 6 = {hour} and event_id % 7 = {rest}'

    nan, plus, minus = (
        f"coalesce(bool_or({condition}), false)"
        for condition in (
            special(1, 0),
            f"{special(2, 1)} or {special(3, 1)}",
            f"{special(3, 2)} or {special(4, 2)}",
        )
    )
    none = " or ".join(special(h, r) for h, r in ((1, 0), (2, 1), (3, 1), (3, 2), (4, 2)))
    return _gold(f"""
select "date", "hour",
  round(cast(sum({FINE}) filter (where event_id % 11 <> 0) as double) / 16777216
    / nullif(count(*) filter (where event_id % 11 <> 0), 0), 2) as avg_altitude,
  count(*) filter (where event_id % 11 <> 0) as altitude_observations,
  count(*) filter (where event_id % 13 <> 0 or {none}) as velocity_observations,
  case when not ({nan} or {plus} or {minus}) then
    cast(sum({LARGE}) filter (where event_id % 13 <> 0) as double)
      / nullif(count(*) filter (where event_id % 13 <> 0), 0) * 1099511627776 end as avg_velocity,
  case when {nan} or ({plus} and {minus}) then 'NaN' when {plus} then 'Infinity'
    when {minus} then '-Infinity' when count(*) filter (where event_id % 13 <> 0) = 0 then 'none'
    else 'finite' end as velocity_kind
from gold group by "date", "hour" """)


def _activity(where: str) -> str:
    return _gold(f"""
select "date", "hour", {_ymd()}, count(distinct icao24) as active_aircraft_count
from gold where {where} group by "date", "hour" """)


def _airline_counts(name: str, code: str, no_name: str, no_code: str) -> str:
    return _gold(f"""
select "date", {_ymd()}, airline_icao, airline_name, count(distinct icao24) as aircraft_count
from (
  select "date", icao24,
    coalesce(nullif(trim({name}), ''), '{no_name}') as airline_name,
    coalesce(nullif(trim({code}), ''), '{no_code}') as airline_icao
  from gold)
group by "date", airline_icao, airline_name""")


_DURATION = f"""
select "date", {_ymd()},
  cast((200 * sum(duration_seconds) + count(*)) // (2 * count(*)) as bigint) / 100.0
    as avg_area_duration_seconds,
  count(*) as sessions_used
from sessions where has_exit = 1 and duration_seconds > 0 {{extra}}
group by "date" """

_BASIC_COUNTERS = """
  count(*) as sessions_total,
  count(*) filter (where has_exit = 1) as sessions_closed,
  count(*) filter (where has_exit = 0) as sessions_open"""

_SESSION_COLUMNS = """icao24, session_id, entry_ts, exit_ts, has_exit, airline_name,
  airline_icao, duration_seconds, "date", "year", "month", "day" """

_DEDUP_COLUMNS = 'event_id, "time", icao24, last_contact, callsign'


def oracle_sql() -> dict[str, str]:
    activity = _activity("on_ground = false")
    airline_counts = _airline_counts('"Nome"', '"ICAO"', "Desconhecida", "N/A")
    altitude_speed = _altitude_speed(_exact_mean("velocity"))
    raw_mean = (
        "cast(sum(cast(round(velocity * 1000000) as bigint)) as double) / 1000000.0"
        " / nullif(count(velocity), 0)"
    )
    observation_columns = ", ".join(OBSERVATION_COLUMNS)
    observations = f'select event_id, icao24, "time", {observation_columns} from observed'
    bronze = _bronze("select * exclude (event_id) from bronze")
    silver = _silver("select * exclude (event_id) from silver")
    airlines = _with(_AIRLINES, final="select * from airlines")
    all_sessions = f"select {_SESSION_COLUMNS} from sessions"
    run_date = f"date '{RUN_DATE}'"
    closed = _session(
        "select icao24, entry_ts, exit_ts, has_exit, airline_name, airline_icao, "
        'duration_seconds, "date", "year", "month", "day" from sessions where has_exit = 1'
    )
    box = _bronze(
        'select event_id, "time", icao24, latitude, longitude from bronze '
        "where latitude between -24.10 and -23.20 and longitude between -47.20 and -46.20"
    )
    rejects = """
select * from (
  select
    case event_id % 5
      when 0 then concat('{"time": ', event_id, ', "states": []}')
      when 1 then concat('broken ', event_id)
      when 2 then concat('{"time": ', event_id, '}') end as "value",
    case event_id % 5
      when 0 then 'no states' when 1 then 'no envelope' when 2 then 'no states'
      when 4 then 'no value' end as reason
  from events)
where reason is not null"""
    quality = _session(
            f"select {_BASIC_COUNTERS}, count(*) filter (where has_exit = 1 and "
            "duration_seconds <= 0) as sessions_discarded_non_positive from sessions"
        )
    return {
        "altitude_speed_extremes": _extremes(),
        "envelope_roundtrip": bronze,
        "envelope_rejects": rejects,
        "stream_bronze_rejects": rejects,
        "bbox_filter": box,
        "bbox_stored": box,
        "airline_dim_clean": airlines,
        "airline_csv_roundtrip": airlines,
        "silver_dedup": _unique(f"select {_DEDUP_COLUMNS} from uniq"),
        "silver_dropna": _unique(
            f"select {_DEDUP_COLUMNS} from uniq where callsign is not null"
        ),
        "silver_enrich": _silver("select * from silver"),
        "row_delta": _silver(
            "select (select count(*) from bronze) as rows_before, "
            "(select count(*) from silver) as rows_after, "
            "(select count(*) from bronze) - (select count(*) from silver) as rows_removed"
        ),
        "silver_run_date": _silver(
            'select event_id, "time", icao24, callsign, "Nome", "year", "month", "day" '
            f'from silver where icao24 is not null and cast("time" as date) = {run_date}'
        ),
        "aircraft_activity": activity,
        "aircraft_activity_all": _activity("true"),
        "altitude_speed": altitude_speed,
        "altitude_speed_raw": _altitude_speed(raw_mean),
        "airline_counts": airline_counts,
        "airline_counts_custom_cols": _airline_counts(
            "callsign", '"Airline ID"', "no call sign", "none"
        ),
        "session_observations": _gold(observations, _observed(_GAP, True)),
        "session_observations_short_cells": _gold(observations, _observed(_GAP, True)),
        "aircraft_by_month": _gold(
            'select cast(year("date") as integer) as "year", '
            'cast(month("date") as integer) as "month", '
            "count(distinct icao24) as aircraft, true as within_bound "
            "from gold where on_ground = false group by 1, 2"
        ),
        "session_observations_wide": _gold(observations, _observed(WIDE_GAP, False)),
        "sessions": _session(all_sessions),
        "sessions_wide": _session(all_sessions, WIDE_GAP),
        "sessions_open_tail": _session(all_sessions, WIDE_GAP, stale_tail=False),
        "area_duration": _session(_DURATION.format(extra="")),
        "area_duration_wide": _session(_DURATION.format(extra=""), WIDE_GAP),
        "area_duration_run_date": _session(
            _DURATION.format(extra=f'and "date" = {run_date}'), WIDE_GAP
        ),
        "area_duration_prefiltered": _session(
            _DURATION.format(extra=""), WIDE_GAP, where=f'"date" = {run_date}'
        ),
        "session_quality": quality,
        "all_reports_quality": quality,
        "session_quality_basic": _session(f"select {_BASIC_COUNTERS} from sessions", WIDE_GAP),
        "session_detail": _session(
            "select icao24, airline_icao, airline_name, entry_ts, exit_ts, duration_seconds "
            "from sessions where has_exit = 1 and duration_seconds > 0",
            WIDE_GAP,
        ),
        "rollup_aircraft_activity": activity,
        "rollup_airline_counts": airline_counts,
        "rollup_altitude_speed": altitude_speed,
        "rollup_sessions": _session(all_sessions, WIDE_GAP),
        "mart_roundtrip": airline_counts,
        "mart_dynamic_overwrite": airline_counts,
        "all_reports_activity": activity,
        "job_aircraft_activity": activity,
        "job_airline_counts": airline_counts,
        "job_altitude_speed": altitude_speed,
        "job_area_duration": _session(_DURATION.format(extra=""), WIDE_GAP),
        "job_area_duration_day": _session(
            _DURATION.format(extra=f'and "date" = {run_date}'), WIDE_GAP
        ),
        "job_area_duration_days": _session(
            _DURATION.format(
                extra=f"""and "date" between date '{RUN_DATES[0]}' and date '{RUN_DATES[1]}'"""
            ),
            WIDE_GAP,
        ),
        "silver_rebuild": silver,
        "stream_bronze": bronze,
        "stream_silver": silver,
        "stream_silver_compacted": silver,
        "stream_silver_shuffled": silver,
        "stream_sessions_shuffled": closed,
        "stream_sessions": closed,
        "stream_sessions_backlog": closed,
        "all_reports_airlines": airline_counts,
        "all_reports_altitude_speed": altitude_speed,
        "all_reports_area_duration": _session(_DURATION.format(extra="")),
    }
