"""The same queries in plain SQL (DuckDB dialect), for checking results.

Written from the definitions of the marts and reports, as straight joins and
distinct counts over the derived transit views.
"""

from __future__ import annotations

import re

from headway.schemas import STAGING

_LINES = "list_value('TML','TCL','KTL','TWL','ISL','EAL','AEL','SIL','TKL','DRL')"
_DEPARTURE = """case when l_partkey % 97 = 0 then null else
  concat(lpad(cast((o_custkey % 12) * 2 + l_linenumber % 4 as varchar), 2, '0'), ':',
         lpad(cast(l_partkey % 60 as varchar), 2, '0'), ':',
         lpad(cast((l_partkey + l_suppkey) % 60 as varchar), 2, '0')) end"""


def _day(*priorities: str) -> str:
    listed = ", ".join(f"'{p}'" for p in priorities)
    return f"cast(case when service_id in ({listed}) then 1 else 0 end as bigint)"


_WEEKDAY = _day("1-URGENT", "2-HIGH")
_WEEKEND = _day("1-URGENT", "3-MEDIUM")
_MODE = """case route_type when 0 then 'Tram' when 1 then 'MTR' when 3 then 'Bus'
  when 4 then 'Ferry' else 'Unknown' end"""
# Line codes and the names shown for them.
_LINE_NAMES = {
    "AEL": "Airport Express",
    "TCL": "Tung Chung Line",
    "TML": "Tuen Ma Line",
    "KTL": "Kwun Tong Line",
    "TWL": "Tsuen Wan Line",
    "ISL": "Island Line",
    "EAL": "East Rail Line",
    "SIL": "South Island Line",
    "TKL": "Tseung Kwan O Line",
    "DRL": "Disneyland Resort Line",
}
# The same lines' short names.
_SHORT_LINE_NAMES = {
    "AEL": "Airport Express",
    "TCL": "Tung Chung",
    "TML": "Tuen Ma",
    "KTL": "Kwun Tong",
    "TWL": "Tsuen Wan",
    "ISL": "Island",
    "EAL": "East Rail",
    "SIL": "South Island",
    "TKL": "Tseung Kwan O",
    "DRL": "Disneyland",
}


def _line_name(column: str) -> str:
    cases = " ".join(f"when '{code}' then '{name}'" for code, name in _LINE_NAMES.items())
    return f"(case {column} {cases} else {column} end)"


def _short_line_name(column: str) -> str:
    cases = " ".join(f"when '{code}' then '{name}'" for code, name in _SHORT_LINE_NAMES.items())
    return f"(case {column} {cases} else {column} end)"


def _display(column: str) -> str:
    hour = f"cast(split_part({column}, ':', 1) as bigint)"
    minute = f"split_part({column}, ':', 2)"
    return (
        f"case when {hour} >= 24 then"
        f" concat(lpad(cast({hour} - 24 as varchar), 2, '0'), ':', {minute}, ' (+1day)')"
        f" else concat(lpad(cast({hour} as varchar), 2, '0'), ':', {minute}) end"
    )


def _cell(column: str) -> str:
    return (
        f"cast(trunc({column} / 0.02::double) as bigint) * 0.02::double + 0.01::double"
    )


# Views, in order of use.
VIEWS: dict[str, str] = {
    "stg_routes": """select cast(c_custkey as varchar) route_id,
  concat('R', cast(c_custkey % 120 as varchar)) route_short_name,
  concat(c_mktsegment, ' line') route_long_name,
  cast(case c_nationkey % 10 when 0 then 0 when 1 then 4 when 2 then 7 else 3 end as bigint)
    route_type
  from customer""",
    "stg_stops": """select cast(s_suppkey as varchar) stop_id, s_name stop_name,
  case when s_suppkey % 50 = 7 then null
       else cast(22300 + (s_suppkey * 37) % 60 as double) / 1000.0::double end latitude,
  cast(114100 + (s_suppkey * 53) % 55 as double) / 1000.0::double longitude
  from supplier""",
    "stg_trips": """select cast(o_orderkey as varchar) trip_id, cast(o_custkey as varchar) route_id,
  o_orderpriority service_id from orders""",
    "stg_calendar": f"""select service_id, {_WEEKDAY} monday, {_WEEKDAY} tuesday,
  {_WEEKDAY} wednesday, {_WEEKDAY} thursday, {_WEEKDAY} friday, {_WEEKEND} saturday,
  {_WEEKEND} sunday, '20240101' start_date, '20241231' end_date,
  5 * {_WEEKDAY} weekday_count, 2 * {_WEEKEND} weekend_count
  from (select distinct o_orderpriority service_id from orders
        where o_orderpriority <> '5-LOW')""",
    "stg_stop_times": f"""select cast(l_orderkey as varchar) trip_id,
  cast(l_suppkey as varchar) stop_id, cast(l_linenumber as bigint) stop_sequence,
  {_DEPARTURE} arrival_time, {_DEPARTURE} departure_time
  from lineitem join orders on l_orderkey = o_orderkey""",
    "visits": """select st.*, t.service_id, r.* from stg_stop_times st
  join stg_trips t on st.trip_id = t.trip_id
  join stg_routes r on t.route_id = r.route_id""",
    "timed": r"""select * from visits where departure_time is not null
  and regexp_matches(departure_time, '^\d+:\d{2}:\d{2}$')""",
    "stops_ranked": """select s.stop_id, s.stop_name, s.latitude, s.longitude,
  count(v.trip_id) total_departures, min(v.route_type) route_type
  from visits v join stg_stops s on v.stop_id = s.stop_id
  group by s.stop_id, s.stop_name, s.latitude, s.longitude""",
    "trips_per_route": """select route_short_name, route_long_name, count(trip_id) total_trips
  from stg_trips t join stg_routes r on t.route_id = r.route_id
  group by route_short_name, route_long_name""",
    "peak_hours": """select cast(split_part(departure_time, ':', 1) as bigint) hour_of_day,
  count(trip_id) total_trips from stg_stop_times where departure_time is not null
  group by hour_of_day""",
    "service_hours": """select route_short_name, route_long_name, route_type,
  min(departure_time) first_departure, max(departure_time) last_departure,
  count(distinct trip_id) total_trips, count(distinct stop_id) total_stops
  from timed group by route_short_name, route_long_name, route_type""",
    "service_frequency": """select route_short_name, route_type,
  cast(split_part(departure_time, ':', 1) as bigint) hour_of_day,
  count(distinct trip_id) trips_per_hour from timed
  where cast(split_part(departure_time, ':', 1) as bigint) between 0 and 23
  group by route_short_name, route_type, hour_of_day""",
    "all_hubs": """select s.stop_id, s.stop_name, s.latitude, s.longitude,
  count(distinct v.route_id) route_count, count(distinct v.route_type) transport_modes,
  array_to_string(list_sort(list(distinct v.route_short_name))[1:10], ',') routes_serving
  from visits v join stg_stops s on v.stop_id = s.stop_id
  where s.latitude is not null and s.longitude is not null
  group by s.stop_id, s.stop_name, s.latitude, s.longitude""",
    "transfer_hubs": "select * from all_hubs where route_count >= 3",
    "weekday_vs_weekend": """select case when weekday_count > 0 and weekend_count > 0 then 'Both'
  when weekday_count > 0 then 'Weekday Only' when weekend_count > 0 then 'Weekend Only'
  else 'Unknown' end service_type, count(distinct t.trip_id) total_trips
  from stg_trips t join stg_calendar c on t.service_id = c.service_id group by 1""",
    "route_lengths": """select route_short_name, route_long_name, route_type,
  count(distinct stop_id) unique_stops, count(distinct trip_id) total_trips,
  max(stop_sequence) max_stop_sequence
  from visits group by route_short_name, route_long_name, route_type""",
    "longest_routes": """select * from route_lengths
  order by unique_stops desc, route_short_name, route_long_name, route_type limit 20""",
    "spans": """select route_short_name, route_long_name, route_type, first_departure,
  last_departure, cast(split_part(first_departure, ':', 1) as bigint) first_hour,
  cast(split_part(last_departure, ':', 1) as bigint) last_hour from service_hours""",
    "early_night_routes": """select *, first_hour < 6 is_early_bird, last_hour >= 23 is_night_owl
  from spans where first_hour < 6 or last_hour >= 23""",
    "trip_trajectories": """select t.trip_id, t.route_short_name, t.route_long_name,
  t.stop_sequence, s.stop_name, s.latitude, s.longitude, t.departure_time,
  (1704067200 + cast(split_part(departure_time, ':', 1) as bigint) * 3600
   + cast(split_part(departure_time, ':', 2) as bigint) * 60
   + cast(split_part(departure_time, ':', 3) as bigint)) * 1000 departure_timestamp_ms
  from timed t join stg_stops s on t.stop_id = s.stop_id
  where s.latitude is not null and s.longitude is not null""",
    "trip_rollup": r"""select trip_id, min(departure) first_departure,
  max(departure) last_departure,
  cast(bit_or(case when hr between 0 and 23 then cast(1 as bigint) << cast(hr as int) end)
    as bigint) as "hours",
  max(stop_sequence) max_stop_sequence
  from (select *, cast(split_part(departure, ':', 1) as bigint) hr from
        (select *, case when regexp_matches(departure_time, '^\d+:\d{2}:\d{2}$')
                   then departure_time end departure from stg_stop_times))
  group by trip_id""",
    "route_stop_rollup": r"""select route_id, stop_id, count(*) visits,
  count(*) filter (where regexp_matches(departure_time, '^\d+:\d{2}:\d{2}$')) timed_visits
  from stg_stop_times st join stg_trips t on st.trip_id = t.trip_id
  group by route_id, stop_id""",
    "route_trips": """select trip_id, route_id, count(*) trip_copies from stg_trips
  where trip_id in (select trip_id from stg_stop_times) group by trip_id, route_id""",
    "hours_of_visits": r"""select route_id, stop_id,
  coalesce(regexp_matches(departure_time, '^\d+:\d{2}:\d{2}$'), false) timed,
  case when timed and cast(split_part(departure_time, ':', 1) as bigint) between 0 and 23
       then cast(split_part(departure_time, ':', 1) as bigint) end hour_of_day
  from stg_stop_times st join stg_trips t on st.trip_id = t.trip_id""",
    "visit_rollup": """select route_id, stop_id, hour_of_day, timed, count(*) visits
  from hours_of_visits group by route_id, stop_id, hour_of_day, timed""",
    "route_hours": """select route_id, hour_of_day, count(*) visits from hours_of_visits
  where hour_of_day is not null group by route_id, hour_of_day""",
    "points": f"""select *, {_MODE} transport_type from
  (select stop_id, stop_name, latitude, longitude, total_departures,
          coalesce(route_type, 3) route_type
   from stops_ranked where latitude is not null and longitude is not null)""",
    "top_routes": f"""select *, {_MODE} transport_type from
  (select route_short_name, route_long_name, route_type, count(trip_id) total_trips
   from stg_trips t join stg_routes r on t.route_id = r.route_id
   group by route_short_name, route_long_name, route_type
   order by total_trips desc, route_short_name, route_long_name, route_type limit 20)""",
    "zones": f"""select {_cell('latitude')} latitude, {_cell('longitude')} longitude,
  count(stop_id) stop_count, cast(sum(total_departures) as bigint) total_departures
  from points group by trunc(points.latitude / 0.02::double),
                       trunc(points.longitude / 0.02::double),
                       {_cell('points.latitude')}, {_cell('points.longitude')}""",
    "hourly_frequency": """select route_short_name, hour_of_day,
  cast(sum(trips_per_hour) as bigint) trips_per_hour from service_frequency
  where route_short_name in (select route_short_name from service_hours
    order by total_trips desc, route_short_name, route_long_name, route_type limit 10)
  group by route_short_name, hour_of_day""",
    "rail_events": f"""select event_id, 'mtr_schedule' event_type,
  list_extract({_LINES}, cast(user_id % 10 + 1 as int)) line,
  concat('S', cast(user_id % 7 as varchar)) station,
  case when event_id % 2 = 0 then 'UP' else 'DOWN' end direction,
  case when event_type = 'view' then null
       else concat('D', cast(user_id % 13 as varchar)) end destination,
  cast(user_id % 4 + 1 as varchar) platform,
  strftime(ts, '%Y-%m-%d %H:%M:%S') arrival_time,
  cast(event_id % 15 as varchar) minutes_away,
  event_type = 'error' is_delayed, ts as "timestamp" from events""",
    "bus_events": """select 'bus_eta' event_type,
  concat('B', cast(o_custkey % 50 as varchar)) stop_id,
  cast(o_custkey % 120 as varchar) route,
  case when o_orderkey % 2 = 0 then 'O' else 'I' end direction,
  cast(o_orderkey % 3 as varchar) service_type, o_orderpriority destination_en,
  cast(null as varchar) destination_tc, o_orderkey % 4 eta_seq,
  strftime(o_orderdate, '%Y-%m-%d') eta, o_orderdate as "timestamp" from orders""",
    "answers": """select *, event_id % 101 = 0 broken, event_id % 11 = 0 refused
  from rail_events""",
    "trains": """select * exclude (n), n from answers cross join (values (1), (2)) as x(n)
  where not broken and not refused and (n = 1 or event_id % 3 <> 0)""",
    "rail_lines": f"""select case when c_custkey % 41 = 0 then null
    when c_custkey % 5 = 0
    then concat(list_extract({_LINES}, cast(c_nationkey % 10 + 1 as int)), ' ')
    else list_extract({_LINES}, cast(c_nationkey % 10 + 1 as int)) end line_code,
  case when c_custkey % 43 = 0 then null
       else concat('S', cast(c_custkey % 97 as varchar)) end station_code,
  concat('Station ', cast(c_custkey % 97 as varchar)) name_en,
  concat('站', cast(c_custkey % 97 as varchar)) name_zh from customer""",
    "rail_stations": """select trim(line_code) line_code, station_code from rail_lines
  where line_code is not null and station_code is not null""",
    "fares": f"""select case when l_suppkey % 37 = 5 then null
    else list_extract({_LINES}, cast(l_suppkey % 10 + 1 as int)) end line,
  concat('Station ', cast(l_suppkey % 97 as varchar)) src,
  concat('Station ', cast(l_partkey % 97 as varchar)) dest,
  l_partkey % 300 as base from lineitem""",
    "light_rail": """select case when l_orderkey % 31 = 0 then null
    else cast(l_orderkey % 12 + 500 as varchar) end route_id,
  concat('Route ', cast(l_orderkey % 12 + 500 as varchar)) route_name_en,
  case when l_linenumber % 2 = 0 then '1' else '2' end direction,
  cast(l_linenumber as varchar) stop_sequence, cast(l_suppkey as varchar) station_id,
  concat('Stop ', cast(l_suppkey as varchar)) station_name_en,
  case when l_suppkey % 50 = 7 then null
       else cast(22300 + (l_suppkey * 37) % 60 as double) / 1000.0::double end lat,
  cast(114100 + (l_suppkey * 53) % 55 as double) / 1000.0::double lon from lineitem""",
}

_GROUP = "route_short_name, route_long_name, route_type"
_KPI = """select
  (select count(*) from stops_ranked where latitude is not null) total_stops,
  (select cast(sum(total_departures) as bigint) from stops_ranked) total_departures,
  (select count(distinct route_short_name) from stg_routes) total_routes,
  (select stop_name from stops_ranked
   order by total_departures desc, stop_name, stop_id limit 1) top_stop,
  (select route_short_name from trips_per_route
   order by total_trips desc, route_short_name, route_long_name limit 1) busiest_route,
  (select total_trips from trips_per_route
   order by total_trips desc, route_short_name, route_long_name limit 1) busiest_route_trips,
  (select hour_of_day from peak_hours order by total_trips desc, hour_of_day limit 1) peak_hour"""
_EVENT_COLUMNS = """event_type, line, station, direction, destination, platform, arrival_time,
  minutes_away, is_delayed, "timestamp\""""


def _service_top(where: str = "") -> str:
    return f"""select route_short_name, {_display('first_departure')} first_service,
  {_display('last_departure')} last_service, total_trips, total_stops, {_MODE} transport_type
  from (select * from service_hours {where} order by total_trips desc, {_GROUP} limit 20)"""


def _longest(where: str = "") -> str:
    return f"""select *, {_MODE} transport_type from longest_routes {where}
  order by unique_stops desc, {_GROUP} limit 15"""


def _busiest(where: str = "") -> str:
    order = "total_departures desc, stop_name, stop_id"
    return f"""select cast(row_number() over (order by {order}) as integer) as rank,
  stop_name, total_departures, transport_type
  from (select * from points {where} order by {order} limit 10)"""


def _hour_columns() -> str:
    return ", ".join(
        f"cast(coalesce(sum(trips_per_hour) filter (where hour_of_day = {h}), 0) as bigint)"
        f" h{h:02d}"
        for h in range(24)
    )


def _fare(offset: int) -> str:
    return f"printf('HK$ %.1f', (base + {offset}) / 10.0::double)"


_SAVED_COUNTS = {
    "stg_routes": "stg_routes",
    "stg_stops": "stg_stops",
    "stg_trips": "stg_trips",
    "stg_stop_times": "stg_stop_times",
    "stg_calendar": "stg_calendar",
    "route_trips": "route_trips",
    "visit_rollup": "visit_rollup",
    "route_stop_rollup": "route_stop_rollup",
    "route_hours": "route_hours",
    "mart_stops_ranked": "stops_ranked",
    "mart_trips_per_route": "trips_per_route",
    "mart_peak_hour_analysis": "peak_hours",
    "mart_route_service_hours": "service_hours",
    "mart_service_frequency": "service_frequency",
    "mart_transfer_hubs": "transfer_hubs",
    "mart_weekday_vs_weekend": "weekday_vs_weekend",
    "mart_longest_routes": "longest_routes",
    "mart_early_night_routes": "early_night_routes",
    "mart_trip_trajectories": "trip_trajectories",
}

SELECTS: dict[str, str] = {
    "staging_routes": "select * from stg_routes",
    "staging_stops": "select * from stg_stops",
    "staging_trips": "select * from stg_trips",
    "staging_stop_times": "select * from stg_stop_times",
    "staging_calendar": "select * from stg_calendar",
    **{
        name: f"select * from {name}"
        for name in (
            "trip_rollup",
            "route_stop_rollup",
            "stops_ranked",
            "trips_per_route",
            "peak_hours",
            "service_hours",
            "service_frequency",
            "transfer_hubs",
            "weekday_vs_weekend",
            "route_lengths",
            "longest_routes",
            "early_night_routes",
            "trip_trajectories",
            "top_routes",
            "hourly_frequency",
        )
    },
    "transfer_hubs_500": "select * from all_hubs where route_count >= 500",
    "network_kpis": _KPI,
    "network_kpi_texts": f"""select format('{{:,}}', total_stops) total_stops,
  format('{{:,}}', total_departures) total_departures,
  format('{{:,}}', total_routes) total_routes, top_stop, busiest_route,
  format('{{:,}}', busiest_route_trips) busiest_route_trips,
  concat(lpad(cast(peak_hour as varchar), 2, '0'), ':00') peak_hour from ({_KPI})""",
    "stop_points": "select * from points",
    "stop_points_ferry": "select * from points where route_type = 4",
    "top_routes_bus": "select * from top_routes where route_type = 3",
    "hourly": "select * from peak_hours where hour_of_day between 0 and 23 order by hour_of_day",
    "hourly_by_type": """select cast(split_part(departure_time, ':', 1) as bigint) hour_of_day,
  count(*) total_trips from timed where route_type = 3
  and cast(split_part(departure_time, ':', 1) as bigint) between 0 and 23 group by 1""",
    "busiest_stops": _busiest(),
    "busiest_stops_tram": _busiest("where route_type = 0"),
    "trips_by_mode": """select transport_type, cast(sum(total_trips) as bigint) total_trips
  from top_routes group by transport_type""",
    "service_hours_top": _service_top(),
    "service_hours_top_tram": _service_top("where route_type = 0"),
    "frequency_heatmap": f"""select route_short_name, {_hour_columns()}
  from hourly_frequency group by route_short_name""",
    "hubs_top": """select stop_name, route_count, transport_modes, routes_serving
  from transfer_hubs order by route_count desc, stop_name, stop_id limit 15""",
    "longest_top": _longest(),
    "longest_top_bus": _longest("where route_type = 3"),
    "early_birds": f"""select route_short_name, {_display('first_departure')} first_service,
  {_MODE} transport_type from early_night_routes where is_early_bird""",
    "night_owls": f"""select route_short_name, {_display('last_departure')} last_service,
  {_MODE} transport_type from early_night_routes where is_night_owl""",
    "night_owls_ferry": f"""select route_short_name, {_display('last_departure')} last_service,
  {_MODE} transport_type from early_night_routes where is_night_owl and route_type = 4""",
    "underserved_stops": """select * from points
  where total_departures < (select median(total_departures) from points)""",
    "underserved_counts": """select count(*) total_stops,
  count(*) filter (where total_departures >= m) well_served,
  count(*) filter (where total_departures < m) low_service
  from points, (select median(total_departures) m from points)""",
    "zone_coverage": "select * from zones",
    "zone_counts": """select count(*) total_zones,
  count(*) filter (where stop_count >= 3) well_served,
  count(*) filter (where stop_count < 3) underserved from zones""",
    "route_names": """select distinct trim(route_short_name) route_short_name from top_routes
  where trim(route_short_name) <> ''""",
    "route_compare": f"""select * from (
  select 'A' side, route_short_name, route_long_name, total_trips, total_stops,
    first_departure, last_departure, {_MODE} transport_type
  from (select * from service_hours where route_short_name = 'R1'
        order by route_long_name, route_type limit 1)
  union all
  select 'B' side, route_short_name, route_long_name, total_trips, total_stops,
    first_departure, last_departure, {_MODE} transport_type
  from (select * from service_hours where route_short_name = 'R20'
        order by route_long_name, route_type limit 1))""",
    "rail_stations_per_line": f"""select line_code, {_line_name('line_code')} line_name,
  count(distinct station_code) stations from rail_stations group by line_code""",
    "rail_kpis": f"""select (select count(distinct line_code) from rail_stations) as lines,
  (select count(distinct station_code) from rail_stations) stations,
  (select {_line_name('line_code')} from rail_stations group by line_code
   order by count(distinct station_code) desc, line_code limit 1) largest_line""",
    "rail_network_size": """select count(distinct line_code) as lines,
  count(distinct station_code) stations from rail_lines""",
    "rail_mean_fares": f"""select line line_code, {_line_name('line')} line_name,
  round_even(avg((base + 40) / 10.0::double) * 100, 0) / 100 mean_fare
  from fares where line is not null group by line""",
    "light_rail_kpis": """select count(distinct route_id) routes,
  count(distinct station_id) stops, cast(null as bigint) stop_records from light_rail""",
    "light_rail_routes": """select route_id route, count(distinct station_id) stops
  from light_rail where route_id is not null group by route_id""",
    "light_rail_points": """select station_id stop_id, min(station_name_en) as name,
  min(lat) latitude, min(lon) longitude from light_rail
  where lat is not null and lon is not null group by station_id""",
    "line_picker": f"""select distinct line_code,
  concat({_line_name('line_code')}, ' (', line_code, ')') label
  from rail_lines where line_code is not null""",
    "station_picker": """select station_code,
  concat(min(name_en), ' ', min(name_zh), ' (', station_code, ')') label
  from rail_lines where line_code = 'KTL' and station_code is not null
  group by station_code""",
    "fare_origins": "select distinct src station from fares where src is not null",
    "fare_destinations": """select distinct src station from fares
  where src is not null and src <> 'Station 5'""",
    "fare_lookup": f"""select {_fare(40)} card_adult, {_fare(20)} card_child_elderly,
  {_fare(10)} card_disabled, {_fare(5)} card_sixty, {_fare(50)} single_adult,
  {_fare(25)} single_child_elderly from fares where src = 'Station 5' and dest = 'Station 9'
  order by cast((base + 40) / 10.0::double as varchar),
    cast((base + 20) / 10.0::double as varchar) limit 1""",
    "rail_raw_names": """select route_id, route_name_en, direction, stop_sequence, station_id,
  station_name_en, cast(lat as varchar) latitude, cast(lon as varchar) longitude
  from light_rail""",
    "schedule_flatten": f"select {_EVENT_COLUMNS} from trains",
    "eta_flatten": """select event_type, stop_id, route, direction, service_type,
  destination_en, destination_tc, cast(1 as bigint) eta_seq, eta, "timestamp"
  from bus_events""",
    "broken_answers": """select "timestamp" observed_at, arrival_time curr_time,
  concat(line, '-', station) line_station from answers where broken""",
    "stamped_schedule": """select event_type, line, station, direction, destination, platform,
  arrival_time, minutes_away, is_delayed, true stamped_in_run from trains""",
    "stamped_eta": """select event_type, stop_id, route, direction, service_type, destination_en,
  destination_tc, cast(1 as bigint) eta_seq, eta, true stamped_in_run from bus_events""",
    "exported_stops": f"""select cast(rank as varchar) rank, stop_name,
  cast(total_departures as varchar) total_departures, transport_type from ({_busiest()})""",
    "loaded_preview": """select route_id, route_short_name, route_long_name,
  cast(route_type as varchar) route_type from stg_routes
  order by cast(route_id as bigint) desc limit 30""",
    **{
        f"sketched_trips_per_{name}": f"""select {column}, count(distinct trip_id) trips, true "close" from (
  select trip_id, stop_id, r.route_id, cast(split_part(departure_time, ':', 1) as bigint) hour_of_day
  from stg_stop_times st join stg_trips r using (trip_id) where departure_time is not null) group by 1"""
        for name, column in (("route", "route_id"), ("hour", "hour_of_day"), ("stop", "stop_id"))
    },
    "sketched_median_departures": """select cast(split_part(departure_time, ':', 1) as bigint) hour_of_day,
  count(*) visits, true "close" from stg_stop_times join stg_trips using (trip_id)
  where departure_time is not null group by 1""",
    "next_trains": """select direction, cast(n as varchar) seq, destination, platform,
  arrival_time, minutes_away from trains where line = 'KTL' and station = 'S2'
  and "timestamp" = (select max("timestamp") from answers
    where not broken and line = 'KTL' and station = 'S2')""",
    "schedule_status": """select ok, ok and is_delayed is_delayed,
  case when not ok and not broken and event_id % 22 = 0 then 'refused'
       when not ok then 'Unknown error' end as error,
  count(*) answers
  from (select *, not broken and not refused ok from answers) group by 1, 2, 3""",
    "stream_kpis": """select count(*) total_events, count(distinct line) lines_tracked,
  count(distinct station) stations_tracked,
  count(*) filter (where is_delayed) delayed_events, max("timestamp") last_updated
  from rail_events""",
    "events_per_line": f"""select line, count(*) events,
  count(*) filter (where is_delayed) delays, {_short_line_name('line')} line_name
  from rail_events group by line""",
    "events_per_minute": """select date_trunc('minute', "timestamp") as minute,
  count(*) events from rail_events group by 1""",
    "direction_split": "select direction, count(*) events from rail_events group by direction",
    "top_destinations": """select destination, count(*) events from rail_events
  where destination is not null group by destination
  order by events desc, destination limit 10""",
    "latest_events": """select "timestamp", line, station, direction, destination, platform,
  minutes_away, is_delayed from rail_events order by "timestamp" desc, line, station,
  direction, destination nulls first, platform, minutes_away limit 20""",
    "message_keys": """select topic, "key", count(*) messages, count(v) with_value from (
  select 'hk-mtr-schedule' topic, concat(line, '-', station) as "key", 1 v from rail_events
  union all select 'hk-bus-eta', stop_id, 1 from bus_events
  union all select 'hk-mtr-schedule', concat(line, '-', station), 1 from rail_events
    where event_id % 50 = 0
  union all select 'hk-mtr-schedule', concat(line, '-', station), null from rail_events
    where event_id % 80 = 0
  union all select 'other', concat(line, '-', station), 1 from rail_events
    where event_id % 70 = 0) group by topic, "key\"""",
    "message_decode": f"select {_EVENT_COLUMNS} from rail_events",
    "message_quarantine": """select "key", count(*) messages, count(v) with_value from (
  select concat(line, '-', station) as "key", 1 v from rail_events where event_id % 50 = 0
  union all select concat(line, '-', station), null from rail_events
    where event_id % 80 = 0) group by "key\"""",
    "stream_ingest_counts": """
  select 'mtr_schedule_raw' table_name, 'ok' status, count(*) row_count from rail_events
  union all select 'bus_eta_raw', 'ok', count(*) from bus_events
  union all select 'mtr_schedule_raw', 'bad',
    count(*) filter (where event_id % 50 = 0) + count(*) filter (where event_id % 80 = 0)
    from rail_events""",
    "stream_ingest_rail": f"select {_EVENT_COLUMNS} from rail_events",
    "stream_ingest_bus": "select * from bus_events",
    "compacted_events": f"select {_EVENT_COLUMNS} from rail_events",
    "live_per_minute": """select date_trunc('minute', "timestamp") as minute, count(*) events
  from rail_events group by 1""",
    "live_per_line": f"""select line, count(*) events,
  count(*) filter (where is_delayed) delays, {_short_line_name('line')} line_name
  from rail_events group by line""",
    "live_directions": "select direction, count(*) events from rail_events group by direction",
    "live_top_destinations": """select destination, count(*) events from rail_events
  where destination is not null group by destination
  order by events desc, destination limit 10""",
    "live_kpis": """select count(*) total_events, count(distinct line) lines_tracked,
  count(distinct station) stations_tracked,
  count(*) filter (where is_delayed) delayed_events, max("timestamp") last_updated
  from rail_events""",
    "stored_twice": """select 'between' reader, * from stg_trips where cast(trip_id as bigint) % 2 = 0
  union all select 'after', * from stg_trips""",
    "reject_counts": """
  select table_name, unnest(map_entries(counts)).key problem, unnest(map_entries(counts)).value row_count
  from (
    select 'stg_routes' table_name, map {'(read)': count(*),
      '(rejected)': count(*) filter (where id % 37 = 0 or id % 101 = 0),
      'route_id': count(*) filter (where id % 101 = 0), 'route_short_name': 0, 'route_long_name': 0,
      'route_type': count(*) filter (where id % 37 = 0)} counts
    from (select cast(route_id as bigint) id from stg_routes)
    union all select 'stg_stops', map {'(read)': count(*), '(rejected)': count(*) filter (where id % 23 = 0),
      'stop_id': count(*) filter (where id % 23 = 0), 'stop_name': 0, 'stop_lat': 0, 'stop_lon': 0}
    from (select cast(stop_id as bigint) id from stg_stops)
    union all select 'stg_trips', map {'(read)': count(*), '(rejected)': count(*) filter (where id % 61 = 0),
      'trip_id': count(*) filter (where id % 61 = 0), 'route_id': 0, 'service_id': 0}
    from (select cast(trip_id as bigint) id from stg_trips)
    union all select 'stg_stop_times', map {'(read)': count(*),
      '(rejected)': count(*) filter (where id % 43 = 0 or stop % 29 = 0), 'trip_id': 0, 'stop_id': 0,
      'stop_sequence': count(*) filter (where id % 43 = 0), 'arrival_time': 0,
      'departure_time': count(*) filter (where stop % 29 = 0)}
    from (select cast(trip_id as bigint) id, cast(stop_id as bigint) stop from stg_stop_times)
    union all select 'stg_calendar', map {'(read)': count(*),
      '(rejected)': count(*) filter (where service_id = '2-HIGH'), 'service_id': 0,
      'monday': count(*) filter (where service_id = '2-HIGH'), 'tuesday': 0, 'wednesday': 0, 'thursday': 0,
      'friday': 0, 'saturday': 0, 'sunday': 0, 'start_date': 0, 'end_date': 0}
    from stg_calendar)""",
    "rejected_stop_times": """select concat_ws(' ', case when id % 43 = 0 then 'stop_sequence' end,
    case when stop % 29 = 0 then 'departure_time' end) problems, trip_id, stop_id,
    case when id % 43 = 0 then '1st' else cast(stop_sequence as varchar) end stop_sequence,
    case when stop % 29 = 0 then 'noon' else departure_time end departure_time
  from (select *, cast(trip_id as bigint) id, cast(stop_id as bigint) stop from stg_stop_times)
  where id % 43 = 0 or stop % 29 = 0""",
    "kept_routes": """select * from stg_routes where cast(route_id as bigint) % 37 <> 0
  and cast(route_id as bigint) % 101 <> 0""",
    "kept_calendar": "select * from stg_calendar where service_id <> '2-HIGH'",
    "kept_peak_hours": """select cast(split_part(departure_time, ':', 1) as bigint) hour_of_day,
  count(trip_id) total_trips from stg_stop_times where departure_time is not null
  and cast(trip_id as bigint) % 43 <> 0 and cast(stop_id as bigint) % 29 <> 0 group by 1""",
    "feed_files": " union all ".join(
        f"select '{table}' table_name, concat_ws('|', "
        + ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in schema.names)
        + f") row_values from {table}"
        for table, schema in STAGING.items()
    ),
    "stored_tables": " union all ".join(
        f"select '{table}' table_name, count(*) row_count from {view}"
        for table, view in _SAVED_COUNTS.items()
    ),
    "stored_event_days": """select cast("timestamp" as date) event_date, line,
  count(*) events from rail_events
  where "timestamp" >= timestamp '2024-01-10 06:00:00'
    and "timestamp" < timestamp '2024-02-10 06:00:00' group by 1, 2""",
    "loaded_bus_stops": """select route_id, route_name_en, direction,
  stop_sequence as "STOP_SEQUENCE", station_id, station_name_en as "STATION_NAMEE",
  cast(lat as varchar) latitude, cast(lon as varchar) longitude from light_rail""",
    "stored_route_stop_rollup": "select * from route_stop_rollup",
    "colocated_visit_rollup": "select * from visit_rollup",
}
# Stored tables and loaded files give what the plain queries give.
SELECTS |= {
    f"stored_{mart.removeprefix('mart_')}": SELECTS[view]
    for mart, view in _SAVED_COUNTS.items()
    if mart.startswith("mart_")
}
SELECTS["stored_hourly_by_type"] = SELECTS["hourly_by_type"]
SELECTS["stored_frequency_heatmap"] = SELECTS["frequency_heatmap"]
SELECTS["colocated_trip_rollup"] = SELECTS["trip_rollup"]
SELECTS["colocated_trajectories"] = SELECTS["trip_trajectories"]
SELECTS |= {
    f"state_{name}": SELECTS[f"live_{name}"]
    for name in ("per_minute", "per_line", "directions", "top_destinations", "kpis")
}
SELECTS |= {
    f"loaded_{report.removeprefix('rail_')}": SELECTS[report]
    for report in (
        "rail_stations_per_line rail_network_size station_picker rail_mean_fares fare_lookup"
        " light_rail_points"
    ).split()
}


def _needed(sql: str, found: list[str]) -> list[str]:
    """The views a query names, directly or through other views, in order."""
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(VIEWS[name], found)
            found.append(name)
    return found


def all_sql() -> dict[str, str]:
    texts = {}
    for name, sql in SELECTS.items():
        views = [f"{view} as ({VIEWS[view]})" for view in _needed(sql, [])]
        texts[name] = "with " + ",\n".join(views) + "\n" + sql
    return texts
