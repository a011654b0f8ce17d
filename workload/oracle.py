"""SQL that states each registered query independently, for DuckDB."""

from __future__ import annotations

from lanewatch.functions.colours import CSS_COLOURS, POLLUTION_SCALE, TRAFFIC_SCALE
from lanewatch.places import PLACES
from lanewatch.schemas import POLLUTANTS
from workload.feed import BASE_MS, BASE_TS_US, PACKETS_PER_FILE

_LINE = "l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity, l_extendedprice, l_discount"
_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"

_LOC = "loc(idx, name, lat, lon) as (values " + ", ".join(
    f"({i}, '{name}', {lat!r}::double, {lon!r}::double)"
    for i, (name, lat, lon) in enumerate(PLACES)) + ")"

_FEED = f"""{_LOC},
feed as (
  select event_id, event_type, value, 'veh' || user_id as id,
    {BASE_MS} + (epoch_us(ts) - {BASE_TS_US}) // 720000 as ms,
    coalesce(loc.lat, 43.30::double)
      + ((event_id*7919) % 1001 - 500)::double * 0.000005::double as y,
    coalesce(loc.lon, 21.85::double)
      + ((event_id*104729) % 1009 - 504)::double * 0.000005::double as x,
    case when event_id % 5 <> 0 then (event_id % 7)::double end as slope,
    case when event_id % 11 <> 0 then value*10 end as co2,
    value as co, value/100 as hc,
    case when event_id % 17 <> 0 then value/10 end as nox,
    value/1000 as pmx, 50 + (event_id % 300)::double/10 as noise
  from events left join loc on event_id % 10 = loc.idx)"""


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371000 * asin(least(1, sqrt(pow(sin(radians({lat2} - {lat1})/2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1})/2), 2))))")


def _iso(ms: str) -> str:
    return f"strftime(make_timestamp(({ms})*1000), '%Y-%m-%dT%H:%M:%SZ')"


_MATCHED = f"""{_FEED},
matched as (
  select feed.*, loc.lat as lat, loc.lon as lon from feed join loc
  on {_distance('feed.y', 'feed.x', 'loc.lat', 'loc.lon')} <= 200)"""


def _windows(sliding: bool, streamed: bool) -> str:
    """Rows per window: start and end in milliseconds, 60 s long."""
    if sliding:
        starts = ("select matched.*, ms - ms % 10000 - k*10000 as w from matched,"
                  " (select unnest(range(6)) as k)")
    else:
        starts = "select matched.*, ms - ms % 60000 as w from matched"
    closed = " where w + 60000 <= (select max(ms) from feed) - 30000" if streamed else ""
    return f"{_MATCHED},\nwindowed as (select * from ({starts}){closed})"


_FRAME = (f"{_iso('w')} as window_start, {_iso('w + 60000')} as window_end,"
          " round(lat, 6) as location_x, round(lon, 6) as location_y")


def _traffic(sliding: bool = False, streamed: bool = False) -> str:
    return (f"with {_windows(sliding, streamed)} select {_FRAME},"
            " count(distinct id) as distinct_cars_count, 'traffic' as analysis_type"
            " from windowed group by w, lat, lon")


def _pollution_measures(as_zero: bool, rounded: bool) -> str:
    def shown(expr: str, p: str) -> str:
        return f"round({expr}, { {'hc': 10, 'pmx': 11}.get(p, 9) })" if rounded else expr

    mean = "coalesce(sum({p}), 0)/count(*)" if as_zero else "avg({p})"
    parts = [f"{shown(mean.format(p=p), p)} as avg_{p}" for p in POLLUTANTS]
    parts += [f"{shown(f'max({p})', p)} as max_{p}" for p in POLLUTANTS]
    return ", ".join(parts)


def _pollution(sliding: bool = False, streamed: bool = False, as_zero: bool = False) -> str:
    return (f"with {_windows(sliding, streamed)} select {_FRAME},"
            f" {_pollution_measures(as_zero, True)}, 'pollution' as analysis_type"
            " from windowed group by w, lat, lon")


_NO_MEASURES = ", ".join(
    f"null::double as {part}_{p}" for part in ("avg", "max") for p in POLLUTANTS)


def _results(streamed: bool = False, rounded: bool = False) -> str:
    """CTEs up to ``results``, the union of both analyses."""
    return f"""{_windows(False, streamed)},
results as (
  select {_FRAME}, count(distinct id) as distinct_cars_count, {_NO_MEASURES},
    'traffic' as analysis_type from windowed group by w, lat, lon
  union all
  select {_FRAME}, null::bigint, {_pollution_measures(False, rounded)}, 'pollution'
  from windowed group by w, lat, lon)"""


def _profile(columns: list[str]) -> str:
    stats = {"count": "count({c})", "min": "min({c})", "max": "max({c})", "mean": "avg({c})",
             "median": "median({c})", "std": "stddev_samp({c})", "var": "var_samp({c})",
             "sum": "coalesce(sum({c}), 0)"}
    whole = {"count"}
    return ", ".join(
        (f.format(c=c) if s in whole else f"round({f.format(c=c)}, 4)") + f" as {c}_{s}"
        for c in columns for s, f in stats.items())


_TCP_FLAGS = " || ".join(
    f"case when (event_id >> {i}) & 1 = 1 then '{letter}' else '' end"
    for i, letter in enumerate("FSRPAUECN"))

_PACKETS = f"""pk as (
  select event_id, event_type, event_id // {PACKETS_PER_FILE} as part, user_id,
    epoch_us(ts) as us, (event_id % 50)::int as body,
    case event_type when 'click' then 'TCP' when 'view' then 'UDP' when 'signup' then 'ICMP'
      when 'purchase' then 'ARP' else 'OTHER' end as protocol from events),
packets as (
  select (case when part % 3 = 0 then 'benign' else 'scan' end) || '-sub' || (part % 5)
      || '-' || part || '.pcap' as file_name,
    case when part % 3 = 0 then 'benign' else 'scan' end as category,
    'sub' || (part % 5) as sub_category,
    case when part % 3 = 0 then 'benign' else 'attack' end as label,
    event_id % {PACKETS_PER_FILE} + 1 as packet_no,
    round(us / 1000000, 6) as timestamp,
    strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S')
      || case when us % 1000000 = 0 then '' else '.' || printf('%06d', us % 1000000) end
      as datetime,
    printf('02:00:00:%02x:%02x:%02x', user_id//65536 % 256, user_id//256 % 256, user_id % 256)
      as src_mac,
    printf('02:00:01:%02x:%02x:%02x', event_id//65536 % 256, event_id//256 % 256,
      event_id % 256) as dst_mac,
    case when protocol <> 'OTHER' then '10.' || (user_id//65536 % 256) || '.'
      || (user_id//256 % 256) || '.' || (user_id % 256) end as src_ip,
    case when protocol <> 'OTHER' then '192.168.' || (event_id % 7) || '.' || (event_id % 251)
      end as dst_ip,
    case when protocol in ('TCP', 'UDP') then (1024 + user_id % 50000)::int end as src_port,
    case when protocol in ('TCP', 'UDP') then case when event_id % 2 = 0 then 443 else 80 end
      end as dst_port,
    protocol,
    (14 + case protocol when 'TCP' then 40 + body when 'UDP' then 28 + body
      when 'ICMP' then 28 + body when 'ARP' then 28 else body end)::int as length,
    case when protocol = 'TCP' then {_TCP_FLAGS} end as tcp_flags,
    case when protocol in ('TCP', 'UDP', 'ICMP') then (32 + event_id % 200)::int end as ttl,
    case when protocol = 'TCP' then (event_id % 65536)::int end as window_size,
    case when protocol in ('TCP', 'UDP') then body else 0 end as payload_len
  from pk)"""

_XML_MS = f"{BASE_MS} + (ms - {BASE_MS})//1000*1000"

_FCD_FIELDS = """round(x, 6) as x, round(y, 6) as y, (event_id % 360)::double as angle,
  event_type as type, round(value/10, 6) as speed, (event_id % 97)::double as pos,
  'lane_' || (event_id % 13) as lane, slope"""

_EMISSION_FIELDS = """'HBEFA3/' || event_type as eclass, round(co2, 6) as co2,
  round(co, 6) as co, round(hc, 6) as hc, round(nox, 6) as nox, round(pmx, 6) as pmx,
  round(value*3, 6) as fuel, 0::double as electricity, round(noise, 6) as noise,
  'route_' || (event_id % 19) as route, event_type as type,
  (event_id % 30)::double as waiting, 'lane_' || (event_id % 13) as lane,
  (event_id % 97)::double as pos, round(value/10, 6) as speed,
  (event_id % 360)::double as angle, round(x, 6) as x, round(y, 6) as y"""


def _record(ms: str) -> str:
    return f"{ms} as timestep, id, id as key, {ms} as timestamp, id as \"vehicleId\""


_BROKEN = (f"with {_FEED}, sent as (select *, event_id % 29 <> 0 and event_id % 13 <> 0"
           " and event_id % 7 <> 0 as whole from feed)")


def _bounds(kind: str, value: str) -> str:
    picked = f"case when analysis_type = '{kind}' then {value} end"
    low, high = f"min({picked})", f"max({picked})"
    return (f"coalesce({low}, 0)::double as {kind}_low, (case when {low} is null then 1"
            f" when {low} = {high} then {low} + 1 else {high} end)::double as {kind}_high")


_BOUNDS = f"select {_bounds('traffic', 'distinct_cars_count')}, {_bounds('pollution', 'avg_co2')} from results"


def _channel(scale: tuple[str, ...], k: int) -> str:
    a, b, c = (CSS_COLOURS[name][k] / 255.0 for name in scale)
    level = (f"case when p > 0.5 then (1 - (p*2 - 1))*{b!r}::double + (p*2 - 1)*{c!r}::double"
             f" when p > 0 then (1 - p*2)*{a!r}::double + p*2*{b!r}::double"
             f" else {a!r}::double end")
    return f"printf('%02x', floor(({level}) * 255.9999::double)::int)"


def _colour(scale: tuple[str, ...]) -> str:
    return "'#' || " + " || ".join(_channel(scale, k) for k in range(3)) + " || 'ff'"


_COLOURED = f"""with {_results()}, bounds as ({_BOUNDS}),
scaled as (select results.*, greatest(0, least(1, case when analysis_type = 'traffic'
    then (coalesce(distinct_cars_count, 0)::double - traffic_low)/(traffic_high - traffic_low)
    else (coalesce(avg_co2, 0) - pollution_low)/(pollution_high - pollution_low) end)) as p
  from results, bounds),
coloured as (select *, case when analysis_type = 'traffic' then {_colour(TRAFFIC_SCALE)}
  else {_colour(POLLUTION_SCALE)} end as colour from scaled)"""


def _label(part: str, name: str, digits: int) -> str:
    text = f"coalesce(printf('%.{digits}f', {part}_{name}), 'N/A')"
    unit = " || ' dB'" if name == "noise" else ""
    return (f"case when analysis_type = 'pollution' then {text}{unit} end"
            f" as label_{part}_{name}")


_LABELS = ", ".join(
    _label(part, name, digits) for part in ("avg", "max")
    for name, digits in zip(POLLUTANTS, (2, 2, 4, 4, 4, 2)))

_NAMED = "left join loc on round(loc.lat, 6) = location_x and round(loc.lon, 6) = location_y"

_ARC = "(200.0::double/6371000.0::double)"
_SIN_LAT = f"(sin(la)*cos({_ARC}) + cos(la)*sin({_ARC})*cos(b))"

_APPROX_FRAME = f"with {_windows(False, False)} select {_FRAME}, true as close_to_exact from windowed group by w, lat, lon"


def oracle_sql() -> dict[str, str]:
    return {
        "filter_eq_ci": f"select {_LINE} from lineitem where lower(l_returnflag) = 'a'",
        "filter_eq_integer": f"select {_LINE} from lineitem where l_linenumber = 3",
        "filter_eq_missing":
            "select l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'N') as l_returnflag,"
            " l_quantity, l_extendedprice, l_discount from lineitem"
            " where lower(coalesce(nullif(l_returnflag, 'N'), 'nan')) = 'nan'",
        "filter_gt": f"select {_LINE} from lineitem where l_quantity > 30",
        "filter_gt_text":
            "select l_orderkey, l_linenumber, l_quantity as quantity_text from lineitem"
            " where l_linenumber % 3 <> 0 and l_quantity > 30.5",
        "filter_lt": f"select {_ORDER} from orders where o_totalprice < 100000",
        "filter_conjunction":
            f"select {_LINE} from lineitem where l_returnflag = 'R' and l_quantity > 10"
            " and l_discount < 0.05::double",
        "sort_multi":
            f"select {_ORDER} from orders order by o_orderstatus, o_totalprice desc nulls last",
        "count_rows":
            "select count(*) as count from lineitem where l_quantity > 10 and l_linestatus = 'O'",
        "group_profile":
            f"select l_returnflag, l_linestatus, {_profile(['l_quantity', 'l_extendedprice'])}"
            " from lineitem group by all",
        "group_profile_single_pass":
            f"select l_returnflag, l_linestatus, {_profile(['l_quantity', 'l_extendedprice'])}"
            " from lineitem group by all",
        "group_profile_null_keys":
            f"select flag, {_profile(['discounted', 'nothing'])} from (select"
            " nullif(l_returnflag, 'N') as flag,"
            " case when l_discount > 0.05::double then l_quantity end as discounted,"
            " case when l_returnflag = 'R' then l_tax end as nothing from lineitem)"
            " where flag is not null group by all",
        "group_profile_many_groups":
            f"select l_suppkey, {_profile(['l_quantity', 'l_linenumber'])} from lineitem"
            " group by all",
        "group_profile_one_group":
            f"select 1 as everything, {_profile(['l_extendedprice'])} from lineitem",
        "group_median_approx":
            "select l_returnflag, l_linestatus, count(l_extendedprice) as l_extendedprice_count,"
            " true as median_close from lineitem group by all",
        "group_median_sketch":
            "select l_returnflag, l_linestatus, count(l_extendedprice) as values,"
            " count(l_extendedprice) as rows, true as median_close from lineitem group by all",
        "numeric_validation":
            "select * from (values"
            " ('c_name', (select count(c_name) from customer), 0, 'empty'),"
            " ('c_acctbal', (select count(c_acctbal) from customer),"
            " (select count(c_acctbal) from customer), 'ok'),"
            " ('c_nationkey', (select count(c_nationkey) from customer),"
            " (select count(c_nationkey) from customer), 'ok'),"
            " ('c_mktsegment', (select count(c_mktsegment) from customer), 0, 'empty'),"
            " ('mixed', (select count(*) from customer),"
            " (select count(c_acctbal) from customer where c_custkey % 2 = 0), 'mixed'))"
            " as t(\"column\", non_null, numeric, status)",
        "run_metrics":
            "select count(*) as rows_read, count(*) filter (where not keep) as rows_filtered,"
            " count(*) filter (where keep) as rows_written from"
            " (select l_returnflag = 'A' and l_quantity > 20 as keep from lineitem)",
        "csv_round_trip":
            "select l_orderkey, l_linenumber, l_partkey, nullif(l_returnflag, 'N') as l_returnflag,"
            " l_quantity, l_extendedprice, l_discount from lineitem",

        "packet_decode": f"with {_PACKETS} select * from packets",
        "packet_labels":
            f"with {_PACKETS} select category, sub_category, label, count(*) as packets,"
            " sum(length)::bigint as bytes from packets group by all",
        "packet_sequence":
            f"with {_PACKETS} select file_name, packet_no, 24 + packet_no*100 as \"offset\""
            " from packets",
        "packet_capture_scan":
            f"with {_PACKETS} select file_name, packet_no, timestamp, protocol, length, src_port,"
            " payload_len from packets",
        "packet_block_capture_scan":
            f"with {_PACKETS} select file_name, packet_no, timestamp, protocol, length, src_port,"
            " payload_len from packets",
        "packet_layers": f"""with {_PACKETS},
            wrapped as (select *, case when packet_no % 8 = 1 then 'tags'
              when packet_no % 8 = 7 then 'bridge'
              when protocol in ('ARP', 'OTHER') then 'plain'
              when packet_no % 8 = 3 then 'labels' when packet_no % 8 = 5 then 'extended'
              else 'plain' end as wrap,
              case when protocol = 'ARP' then '/ARP' when protocol <> 'OTHER' then '/IPv4/' || protocol
                when length > 14 then '/Raw' else '' end as tail from packets),
            named as (select *, case wrap when 'tags' then 'Ethernet/802.1Q/802.1Q'
              when 'bridge' then 'Ethernet/IPv4/GRE/Ethernet' when 'labels' then 'Ethernet/MPLS/MPLS'
              when 'extended' then 'Ethernet/IPv6/HopByHop' else 'Ethernet' end || tail as layers
              from wrapped)
            select file_name, packet_no, layers, regexp_extract(layers, '[^/]*$') as last_layer,
              case when protocol <> 'OTHER' then protocol when wrap = 'bridge' then 'IP'
                else regexp_extract(layers, '[^/]*$') end as protocol,
              case when wrap = 'bridge' and protocol <> 'ARP' then '1.2.3.4' else src_ip end as src_ip,
              case when wrap = 'bridge' and protocol <> 'ARP' then '5.6.7.8' else dst_ip end as dst_ip,
              case when wrap = 'bridge' then 64 else ttl end as ttl, dst_port, tcp_flags, payload_len,
              length + case wrap when 'tags' then 8 when 'labels' then 8 when 'extended' then 48
                when 'bridge' then 42 else 0 end as length from named""",
        "packet_filter_sort":
            f"with {_PACKETS} select file_name, packet_no, src_ip, dst_ip, dst_port, length,"
            " tcp_flags from packets where protocol = 'TCP' and length > 80 and dst_port = 443"
            " order by src_ip, length desc",
        "packet_profile":
            f"with {_PACKETS} select label, protocol,"
            f" {_profile(['length', 'payload_len', 'ttl'])} from packets group by all",

        "fcd_xml_ingest": f"with {_FEED} select {_record(_XML_MS)}, {_FCD_FIELDS} from feed",
        "emission_xml_ingest":
            f"with {_FEED} select {_record(_XML_MS)}, {_EMISSION_FIELDS} from feed",
        "timestep_counts":
            f"with {_FEED} select {_XML_MS} as timestep, count(*) as records from feed group by 1",
        "record_total": "select count(*) as count from events",
        "json_decode_route": f"with {_FEED} select {_record('ms')}, {_EMISSION_FIELDS} from feed",
        "route_topics":
            f"with {_FEED} select 'FCD' as topic, id as key, count(*) as records from feed"
            " group by id",
        "publish_records":
            f"with {_FEED} select id as key, 'FCD' as topic, ms as timestamp, id as \"vehicleId\","
            " round(x, 6) as x, round(y, 6) as y, slope, 'lane_' || (event_id % 13) as lane,"
            " true as has_slope from feed",
        "required_fields":
            f"{_BROKEN} select id as vehicle_id, round(y, 6) as vehicle_lat,"
            " round(x, 6) as vehicle_lon, ms as event_time from sent where whole",
        "malformed_records":
            f"{_BROKEN} select count(*) as records, count(*) filter (where not whole) as malformed"
            " from sent",

        "haversine_pairs":
            f"with {_FEED} select event_id,"
            f" round({_distance('y', 'x', 'p.lat', 'p.lon')}, 4) as distance_m"
            " from feed join loc p on event_id % 8 = p.idx",
        "radius_join":
            f"with {_FEED} select event_id, p.name,"
            f" round({_distance('y', 'x', 'p.lat', 'p.lon')}, 4) as distance_m from feed"
            f" join loc p on {_distance('y', 'x', 'p.lat', 'p.lon')} <= 200",
        "radius_join_grid":
            f"with {_FEED}, spots as (select c_custkey,"
            " 43.30::double + (c_custkey*37 % 1000)::double*0.00005::double as lat,"
            " 21.85::double + (c_custkey*91 % 1000)::double*0.0001::double as lon from customer)"
            " select event_id, c_custkey,"
            f" round({_distance('y', 'x', 'p.lat', 'p.lon')}, 4) as distance_m from feed"
            " join spots p on p.lat between y - 0.01 and y + 0.01"
            f" and {_distance('y', 'x', 'p.lat', 'p.lon')} <= 200",

        "traffic_tumbling": _traffic(),
        "traffic_sliding": _traffic(sliding=True),
        "traffic_approx": _APPROX_FRAME,
        "traffic_sketch_windows": _traffic(sliding=True).replace(
            " from windowed", ", true as sketch_close from windowed"),
        "traffic_sketch_days":
            f"with {_windows(False, False)} select strftime(make_timestamp(ms*1000), '%Y-%m-%d')"
            " as period, round(lat, 9) as location_x, round(lon, 9) as location_y,"
            " count(distinct id) as distinct_cars_count, true as sketch_close"
            " from windowed group by all",
        "pollution_tumbling": _pollution(),
        "pollution_sliding": _pollution(sliding=True),
        "pollution_null_as_zero": _pollution(as_zero=True),
        "result_messages": f"with {_results(rounded=True)} select * from results",
        "result_message_keys":
            f"with {_results()} select analysis_type || '/' || window_start || '/' || window_end"
            " || '/' || location_x || '/' || location_y as key from results",

        "stream_traffic": _traffic(streamed=True),
        "stream_traffic_sliding": _traffic(sliding=True, streamed=True),
        "stream_pollution": _pollution(streamed=True),
        "stream_union": f"with {_results(streamed=True, rounded=True)} select * from results",

        "usable_results":
            f"with {_results(rounded=True)} select window_start, location_x, location_y,"
            " distinct_cars_count, avg_co2, analysis_type from results",
        "scale_bounds":
            f"with {_results()} select round(traffic_low, 6) as traffic_low,"
            " round(traffic_high, 6) as traffic_high, round(pollution_low, 6) as pollution_low,"
            f" round(pollution_high, 6) as pollution_high from ({_BOUNDS})",
        "map_centre":
            f"with {_results()} select round(avg(location_x), 6) as centre_lat,"
            " round(avg(location_y), 6) as centre_lon from results",
        "place_names":
            f"with {_results()}, moved as (select * replace (case when"
            " substr(window_start, 15, 2)::int % 2 = 1 then round(location_x + 0.001::double, 6)"
            " else location_x end as location_x) from results)"
            " select coalesce(name, location_x || ', ' || location_y) as place_name,"
            f" count(*) as results from moved {_NAMED} group by 1",
        "circle_rings":
            f"with {_results()}, spots as (select distinct location_x, location_y,"
            " radians(location_x) as la, radians(location_y) as lo from results),"
            " rays as (select spots.*, i, 2*pi()*(i % 64)/64 as b from spots,"
            " (select unnest(range(65))::int as i))"
            " select location_x, location_y, i, round(degrees(lo + atan2("
            f"sin(b)*sin({_ARC})*cos(la), cos({_ARC}) - sin(la)*{_SIN_LAT})), 9) as lon,"
            f" round(degrees(asin({_SIN_LAT})), 9) as lat from rays",
        "feature_colours":
            f"{_COLOURED} select analysis_type, window_start, location_x, location_y, colour"
            " from coloured",
        "feature_labels":
            f"with {_results()} select name as place_name, window_start, window_end, location_x,"
            " location_y, case analysis_type when 'traffic' then 'Traffic' else 'Pollution' end"
            " as label_kind, distinct_cars_count::varchar as label_distinct_cars,"
            f" {_LABELS} from results {_NAMED}",
        "feature_frames":
            f"{_COLOURED} select window_start as frame, 'FeatureCollection' as type,"
            f" count(*) as features, true as sound from coloured {_NAMED} group by all",
        "malformed_timesteps":
            "select ['no_time', 'bad_time', 'not_xml', 'unclosed', 'no_opening']"
            "[event_id // 16 % 10 + 1] as kind, count(distinct event_id // 16) as timesteps,"
            " count(*) as vehicles, count(distinct event_id // 16) as placed"
            " from events where event_id // 16 % 10 < 5 group by all",
        "features":
            f"{_COLOURED} select analysis_type, window_start as time, location_x, location_y,"
            " name as place_name, colour, 'Polygon' as shape, 65 as ring_points,"
            " window_start as feature_time, colour as fill,"
            " case analysis_type when 'traffic' then 5 else 1 end as weight,"
            " case analysis_type when 'traffic' then 0.08::double else 0.35::double end"
            f" as fill_opacity from coloured {_NAMED}",
    }
