"""For each registered query the same result as plain SQL over the given tables."""

from __future__ import annotations

import re

from kerbside.plans import inputs
from kerbside.plans.queries import ARRIVAL, AS_OF, RANGE

TIME = inputs.DUCKDB["FMT"]


def _folded(rows: str) -> str:
    """Running means by folding each device-minute's ordered list."""
    step = "cast(trunc(cast((x + y) / 2 as float) * cast(100 as float)) / 100 as float)"
    return f"""
        select device_id, minute, first_ts, list_reduce(s, lambda x, y: {step}) as speed,
          list_reduce(l, lambda x, y: {step}) as length
        from (select device_id, date_trunc('minute', pass_ts) as minute, min(pass_ts) as first_ts,
                list(speed order by pass_ts, event_id) as s, list(length order by pass_ts, event_id) as l
              from {rows} group by all)"""


# Views used by the checks alone.
CHECK_VIEWS = {
    "watchlist": "select plate, max_by(bkxxbh, seq) as bkxxbh, max_by(bkjb, seq) as bkjb from prey group by plate",
    "gates": "select cast(id as varchar) as id, max_by(speedlimit, seq) as speedlimit from gate group by id",
    "limited": """
        select p.*, g.speedlimit,
          try_cast(case when contains(g.speedlimit, ',') then split_part(g.speedlimit, ',', p.vehicle_type + 1)
                   else g.speedlimit end as float) as lim, g.id is not null as known
        from passes p left join gates g on p.device_id = g.id""",
    "alerts": f"""
        select {TIME} || p.plate || device_id as row_key, bkxxbh as BKXXBH, bkjb as BKJB, alarm_type as BKLX,
          plate_color as HPYS, plate_type as HPZL, vehicle_logo as CLPP1, vehicle_color as CSYS,
          vehicle_type as CLLX, p.plate || {TIME} as CLXXBH, device_id as KKBH, {TIME} as GCSJ, speed as CLSD,
          device_id || {TIME} as BJBH, p.plate
        from passes p join watchlist w on p.plate = w.plate""",
    "alerts_by_message": f"""
        select {TIME} || p.plate || device_id as row_key, bkxxbh as BKXXBH, bkjb as BKJB, alarm_type as BKLX,
          plate_color as HPYS, plate_type as HPZL, vehicle_logo as CLPP1, vehicle_color as CSYS,
          vehicle_type as CLLX, p.plate || {TIME} as CLXXBH, device_id as KKBH, {TIME} as GCSJ, speed as CLSD,
          device_id || {TIME} as BJBH, p.plate, event_id % 4 as batch
        from passes p join watchlist w on p.plate = w.plate
        where event_id % 4 < 2 or p.plate not like '%0'""",
    "alerts_refreshed": f"""
        select {TIME} || p.plate || device_id as row_key, bkxxbh as BKXXBH, bkjb as BKJB, alarm_type as BKLX,
          plate_color as HPYS, plate_type as HPZL, vehicle_logo as CLPP1, vehicle_color as CSYS,
          vehicle_type as CLLX, p.plate || {TIME} as CLXXBH, device_id as KKBH, {TIME} as GCSJ, speed as CLSD,
          device_id || {TIME} as BJBH, p.plate
        from passes p join watchlist w on p.plate = w.plate
        where event_id % 2 = 0 or p.plate not like '%0'""",
    "violations": f"""
        select {TIME} || '_' || plate || '_' || device_id as row_key, device_id as KKBH,
          cast(chan_index as varchar) as CLBH, cast(dir as varchar) as FXBH, plate as HPHM, plate_type as HPZL,
          site_id as WFDD, {TIME} as WFSJ, cast(illegal_type as varchar) as WFXW, cast(speed as varchar) as CLSD,
          cast(vehicle_type as varchar) as CLLX, '' as TZTX, '' as QJTX,
          cast(cast(round_even(cast(cast((speed - lim) / lim as float) as double), 2) as float) as varchar) as CSB,
          '' as SFCL
        from limited where speed > lim""",
    "hits": """
        select * from passes where vehicle_brand = '别克' and plate_color = '黄' and dir = 1 and not tag
          and not paper and not sun and not "drop" and not second_belt and not crash and not danger
          and pass_ts between timestamp '{0}' and timestamp '{1}'""".format(*RANGE),
    "plates": f"""
        select * from passes where regexp_full_match(plate, '粤.{{5}}2')
          and pass_ts between timestamp '2024-01-01 00:00:00' and timestamp '{ARRIVAL}'""",
    "counts": """
        select device_id, 'minute' as grain, date_trunc('minute', pass_ts) as bucket, vehicle_type, count(*) as n
        from passes group by all
        union all
        select device_id, 'hour', date_trunc('hour', pass_ts), vehicle_type, count(*) from passes group by all
        union all
        select device_id, 'day', date_trunc('day', pass_ts), vehicle_type, count(*) from passes group by all""",
    "folded_long": "select device_id, minute, speed, length from (" + _folded("passes_long") + ")",
    "folded": "select device_id, minute, speed, length from (" + _folded("passes") + ")",
    "folded_asof": _folded(f"(select * from passes where pass_ts <= timestamp '{AS_OF}')"),
    "archived": f"""
        select md5(concat_ws('|', plate, device_id, {TIME}, cast(event_id as varchar))) as row_key, *
        from passes""",
    "raw": f"""
        select event_id, case when kind = 1 then substr(body, 1, 60) else body end as payload
        from (select event_id, event_id % 50 as kind, cast(json_object(
            'Id', device_id, 'IllegalSubType', illegal_sub_type, 'MonitoringSiteID', site_id,
            'PlateInfo', json_object('PlateType', plate_type, 'Color', plate_color,
              'License', case when event_id % 50 <> 0 then plate end),
            'VehicleInfo', json_object('VehicleType', vehicle_type, 'Speed', speed, 'Length', length,
              'VehicleLogoRecog', vehicle_logo),
            'Time', case event_id % 50 when 2 then 'bad' when 3 then {TIME} || '.123' else {TIME} end,
            'PicInfo', list_transform(range(1, 1 + event_id % 3), lambda i: json_object('PicRecogMode', i + 10))
          ) as varchar) as body from passes)""",
    "outcome": """
        select event_id, case when not json_valid(payload) then 'unreadable'
            when json_extract_string(payload, '$.PlateInfo.License') is null then 'missing field'
            else 'valid' end as outcome, case when json_valid(payload) then payload else '{}' end as doc
        from raw""",
}

CHECK_VIEWS["alerts_large"] = CHECK_VIEWS["alerts"].replace("join watchlist w", "join prey_large w")
# The alarms in four batches.
CHECK_VIEWS["alerts_dealt"] = CHECK_VIEWS["alerts"].replace("as BJBH, p.plate", "as BJBH, p.plate, event_id % 4 as batch")

HIT = "event_id, pass_ts, plate, task_id"


def _flow(grain: str) -> str:
    return (
        f"select device_id, vehicle_type, date_trunc('{grain}', pass_ts) as bucket, count(*) as n "
        "from passes group by all"
    )


def _newest(view: str, columns: list[str], first: str = "") -> str:
    """One row per row key; equal keys are settled by ``first``, then by content."""
    order = first + ", ".join(f"{c} desc" for c in columns)
    return (
        f"select row_key, {', '.join(columns)} from {view} "
        f"qualify row_number() over (partition by row_key order by {order}) = 1"
    )


# Stored columns, written out so that a wrong mapping in the library shows. The stored names.
META_COLUMNS = f"""
      cast(device_id as varchar) as SBBH,
      cast(drive_chan as varchar) as DriveChan,
      {TIME} as Time,
      cast(alarm_type as varchar) as AlarmDataType,
      cast(copilot_safebelt as varchar) as CopilotSafebelt,
      cast(copilot_sub_visor as varchar) as CopilotSubVisor,
      cast(detect_type as varchar) as DetectType,
      cast(dir as varchar) as Dir,
      cast(illegal_type as varchar) as IllegalType,
      cast(illegal_sub_type as varchar) as IllegalSubType,
      cast(site_id as varchar) as MonitoringSiteID,
      cast(pic_num as varchar) as PicNum,
      cast(pilot_safebelt as varchar) as PilotSafebelt,
      cast(pilot_sub_visor as varchar) as PilotSubVisor,
      cast(speed_limit as varchar) as SpeedLimit,
      cast(chan_index as varchar) as Vehicle_ChanIndex,
      cast(vehicle_color as varchar) as Vehicle_Color,
      cast(color_depth as varchar) as Vehicle_Depth,
      cast(length as varchar) as Vehicle_Length,
      cast(speed as varchar) as Vehicle_Speed,
      cast(vehicle_attribute as varchar) as Vehicle_Attribute,
      cast(vehicle_logo as varchar) as Vehicle_VehicleLogoRecog,
      cast(vehicle_type as varchar) as Vehicle_Type,
      cast(plate_believe as varchar) as Plate_Believe,
      cast(plate_bright as varchar) as Plate_Bright,
      cast(plate_color as varchar) as Plate_Color,
      cast(plate_country as varchar) as Plate_Country,
      cast(plate as varchar) as Plate_License,
      cast(plate_type as varchar) as Plate_PlateType"""
INDEX_COLUMNS = f"""
      cast(device_id as varchar) as SBBH,
      cast(drive_chan as varchar) as DriveChan,
      cast(dir as varchar) as Dir,
      cast(vehicle_color as varchar) as Vehicle_Color,
      cast(chan_index as varchar) as Vehicle_ChanIndex,
      cast(vehicle_type as varchar) as Vehicle_Type,
      cast(illegal_type as varchar) as IllegalType,
      cast(speed as varchar) as Vehicle_Speed,
      cast(plate as varchar) as Plate_License,
      cast(plate_type as varchar) as Plate_PlateType,
      cast(plate_color as varchar) as Plate_Color,
      {TIME} as Time"""

ALARM = ["BKXXBH", "BKJB", "BKLX", "HPYS", "HPZL", "CLPP1", "CSYS", "CLLX", "CLXXBH", "KKBH", "GCSJ", "CLSD", "BJBH"]
VIOLATION = [
    "KKBH", "CLBH", "FXBH", "HPHM", "HPZL", "WFDD", "WFSJ", "WFXW", "CLSD", "CLLX", "TZTX", "QJTX", "CSB", "SFCL",
]

_MEAN = (
    "select device_id, date_trunc('minute', pass_ts) as minute, avg(speed) as speed, avg(length) as length "
    "from passes group by all"
)
_MINUTE_OF_DAY = "cast(date_part('hour', {0}) * 60 + date_part('minute', {0}) as int)"

# Later attributes win: task, then camera, then data source.
_DIMS = """
    select event_id, key, max_by(value, rank) as value from (
      select event_id, rank, key, json_extract_string(doc, '$.' || key) as value
      from (select event_id, rank, doc, unnest(json_keys(doc)) as key from (
        select event_id, 1 as rank, doc from plates join task using (task_id)
        union all select event_id, 2, doc from plates join camera using (camera_id)
        union all select event_id, 3, doc from plates join data_source using (data_source_id))))
    group by all"""

_DIMS_LARGE = _DIMS.replace("plates join task ", "hits_large join task_large ").replace(
    "plates join camera ", "hits_large join camera_large ").replace("plates join data_source ", "hits_large join data_source_large ")

BODIES: dict[str, str] = {
    "flow_minute": _flow("minute"),
    "flow_hour": _flow("hour"),
    "flow_day": _flow("day"),
    "flow_all_grains": "select device_id, grain, bucket, vehicle_type, n from counts",
    "speed_length_mean": _MEAN,
    "speed_length_fold": "select device_id, minute, speed, length from folded",
    "speed_length_fold_long": "select device_id, minute, speed, length from folded_long",
    "gate_snapshot": """
        select g.id, g.speedlimit, n from gates g left join
          (select device_id, count(*) as n from passes group by device_id) p on p.device_id = g.id""",
    "interval_summary": """
        select device_id as Id, strftime(date_trunc('hour', pass_ts), '%Y-%m-%d %H:%M:%S') as Time,
          count(*) as TotalVehicle, count(*) filter (vehicle_type = 2) as LargeVehicle,
          count(*) filter (vehicle_type = 1) as MediumVehicle, count(*) filter (vehicle_type = 0) as SmallVehicle,
          count(*) filter (vehicle_type not in (0, 1, 2)) as OtherVehicle, max(drive_chan) as DriveChan,
          cast(avg(speed) as float) as AverageSpeed
        from passes group by device_id, date_trunc('hour', pass_ts)""",
    "watchlist_snapshot": "select plate, bkxxbh, bkjb from watchlist",
    "watchlist_alerts": f"select row_key, {', '.join(ALARM)} from alerts",
    "watchlist_large": f"select row_key, {', '.join(ALARM)} from alerts_large",
    "alarm_messages": """
        select row_key as key, BJBH as Id, CLXXBH as VehicleId, BKXXBH as PreyInfoId,
          cast(BKJB as bigint) as Priority, KKBH as DeviceId, GCSJ as Time, cast(BKLX as bigint) as Type,
          plate as PlateLicense, HPYS as PlateColor, HPZL as PlateType, CLPP1 as VehicleLogoRecog,
          CLLX as VehicleType, CLSD as VehicleSpeed
        from alerts""",
    "alarm_outbox": """
        select row_key as key, BJBH as Id, CLXXBH as VehicleId, BKXXBH as PreyInfoId,
          cast(BKJB as bigint) as Priority, KKBH as DeviceId, GCSJ as Time, cast(BKLX as bigint) as Type,
          plate as PlateLicense, HPYS as PlateColor, HPZL as PlateType, CLPP1 as VehicleLogoRecog,
          CLLX as VehicleType, CLSD as VehicleSpeed
        from alerts""",
    "overspeed": f"select row_key, {', '.join(VIOLATION)} from violations",
    "unknown_gates": "select event_id, device_id, vehicle_type, speed from limited where not known",
    "unusable_limits": """
        select event_id, device_id, vehicle_type,
          case when device_id = '2' then 'zero limit' when vehicle_type > 2 then 'type past the list'
            else 'not a number' end as reason
        from passes where device_id = '2' or (device_id = '1' and vehicle_type >= 2)""",
    "overspeed_counters": 'select count(*) as "all", count(*) filter (speed > lim) as illegal from limited',
    "attr_search": f"select {HIT} from hits",
    "attr_search_bitmap": f"select {HIT} from hits",
    "attr_count_bitmap": "select count(*) as total from hits",
    "attr_search_some_terms": f"""
        select {HIT} from passes where vehicle_brand = '宝马' and crash and pass_ts >= timestamp '{RANGE[0]}'""",
    "attr_search_paged": f"""
        select {HIT}, (row_number() over (order by pass_ts, event_id) - 1) // 50 + 1 as page from hits""",
    "attr_search_next_page": f"""
        select {HIT} from passes where pass_ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'
          and (pass_ts, event_id) > (timestamp '2024-01-01 12:00:00', 0)
        order by pass_ts, event_id limit 50""",
    "time_range": f"""
        select {HIT} from passes where pass_ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'""",
    "time_count": f"""
        select count(*) as total from passes
        where pass_ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'""",
    "plate_search": f"select {HIT} from plates",
    "plate_search_grams": f"select {HIT} from plates",
    "plate_search_paged": f"""
        select {HIT}, (row_number() over (order by pass_ts, event_id) - 1) // 100 + 1 as page from plates""",
    "plate_search_pattern": f"""
        select {HIT} from passes where regexp_full_match(plate, '[粤云].{{5}}[1-3]')
          and pass_ts between timestamp '2024-01-01 12:00:00' and timestamp '2024-01-03 00:00:00'""",
    "result_lookup": """
        select p.event_id as result_id, license, r.plate_type, r.plate_color, confidence, license_attribution,
          image_url, car_color, result_time, direction, frame_index, vehicle_kind, r.vehicle_brand, vehicle_style,
          location_left, license as HP
        from passes p left join result r on p.event_id = r.result_id""",
    "enrich_result": """
        select event_id as result_id, h.task_id, 'HP' as key, license as value
        from hits h join result r on h.event_id = r.result_id
        union all
        select event_id, task_id, key, json_extract_string(doc, '$.' || key)
        from (select event_id, task_id, doc, unnest(json_keys(doc)) as key from hits join task using (task_id))""",
    "enrich_dims": f"select event_id, key, value from ({_DIMS})",
    "enrich_dims_large": f"select event_id, key, value from ({_DIMS_LARGE})",
    "enrich_dims_task": f"""
        select p.event_id, any_value(json_extract_string(t.doc, '$.name')) as task_name,
          cast(count(d.key) as int) as attributes
        from plates p left join task t using (task_id) left join ({_DIMS}) d on p.event_id = d.event_id
        group by p.event_id""",
    "dim_attributes": """
        select event_id, task_id, key, json_extract_string(doc, '$.' || key) as value
        from (select event_id, task_id, doc, unnest(json_keys(doc)) as key from passes join task using (task_id))""",
    "traffic_meta": f"select row_key, {META_COLUMNS} from archived",
    "traffic_index": f"select {INDEX_COLUMNS}, row_key as RowKey from archived",
    "traffic_image": """
        select row_key, event_id || '_' || (event_id % 3) as Data, cast(event_id % 3 + 10 as varchar) as RecogMode,
          cast(event_id % 3 * 5 as varchar) as RedLightTime
        from archived where event_id % 3 > 0""",
    "traffic_image_all": """
        select row_key, cast(i - 1 as int) as pos, event_id || '_' || i as Data, cast(i + 10 as varchar) as RecogMode,
          cast(i * 5 as varchar) as RedLightTime
        from (select row_key, event_id, unnest(range(1, 1 + event_id % 3)) as i from archived)""",
    "row_keys": f"""
        select event_id, (ascii(right(device_id, 1)) % 3) || '|' || device_id || '_'
            || strftime(pass_ts, '%Y-%m-%d') as flow,
          row_key as archive, {TIME} || plate || device_id as alarm, device_id || {TIME} as alarm_id,
          plate || {TIME} as vehicle_id, {TIME} || '_' || plate || '_' || device_id as violation
        from archived""",
    "device_day_maps": """
        select device_id, cast(bucket as date) as day, grain || ':' || vehicle_type || '|' || left(
            strftime(bucket, '%Y-%m-%d %H:%M'), case grain when 'day' then 10 when 'hour' then 13 else 16 end) as entry,
          cast(n as varchar) as value
        from counts
        union all
        select device_id, cast(minute as date), 'speed:' || strftime(minute, '%Y-%m-%d %H:%M'), cast(speed as varchar)
        from folded
        union all
        select device_id, cast(minute as date), 'length:' || strftime(minute, '%Y-%m-%d %H:%M'), cast(length as varchar)
        from folded""",
    "flow_wide": f"""
        select (ascii(right(device_id, 1)) % 3) || '|' || device_id || '_' || strftime(day, '%Y-%m-%d') as row_key,
          cell, value
        from (
          select device_id, cast(bucket as date) as day,
            case grain when 'day' then 'D' when 'hour' then date_part('hour', bucket) || 'h'
              else cast({_MINUTE_OF_DAY.format('bucket')} as varchar) end as cell,
            string_agg(vehicle_type || ':' || n || '|', '' order by vehicle_type) as value
          from counts group by all
          union all
          select device_id, cast(minute as date), {_MINUTE_OF_DAY.format('minute')} || 'S', cast(speed as varchar)
          from folded
          union all
          select device_id, cast(minute as date), {_MINUTE_OF_DAY.format('minute')} || 'L', cast(length as varchar)
          from folded)""",
    "flow_live_asof": f"""
        with seen as (select * from passes where pass_ts <= timestamp '{AS_OF}'),
        gone as (select device_id, max(pass_ts) as last from passes
                 where pass_ts <= timestamp '{AS_OF}' - interval 600 seconds group by device_id)
        select device_id, grain, bucket, vehicle_type, n from (
          select device_id, 'minute' as grain, date_trunc('minute', pass_ts) as bucket, vehicle_type, count(*) as n,
            min(pass_ts) > timestamp '{AS_OF}' - interval 600 seconds as live
          from seen group by device_id, bucket, vehicle_type
          union all
          select device_id, 'hour', date_trunc('hour', pass_ts) as bucket, vehicle_type, count(*),
            bucket >= date_trunc('hour', any_value(last)) or any_value(last) is null
          from seen left join gone using (device_id) group by device_id, bucket, vehicle_type
          union all
          select device_id, 'day', date_trunc('day', pass_ts) as bucket, vehicle_type, count(*),
            bucket >= date_trunc('day', any_value(last)) or any_value(last) is null
          from seen left join gone using (device_id) group by device_id, bucket, vehicle_type)
        where live""",
    "stream_flow_live": """
        with clocks as (select i, max(pass_ts) as t from passes_dealt, (select unnest(range(4)) as i) r where batch <= i group by i),
        seen as (select i, t, p.* from passes_dealt p join clocks on batch <= i),
        gone as (select i, device_id, max(pass_ts) as last from seen where pass_ts <= t - interval 600 seconds group by all)
        select cast(i as int) as batch, device_id, grain, bucket, vehicle_type, n from (
          select i, device_id, 'minute' as grain, date_trunc('minute', pass_ts) as bucket, vehicle_type, count(*) as n,
            min(pass_ts) > any_value(t) - interval 600 seconds as live
          from seen group by i, device_id, bucket, vehicle_type
          union all
          select i, device_id, 'hour', date_trunc('hour', pass_ts) as bucket, vehicle_type, count(*),
            bucket >= date_trunc('hour', any_value(last)) or any_value(last) is null
          from seen left join gone using (i, device_id) group by i, device_id, bucket, vehicle_type
          union all
          select i, device_id, 'day', date_trunc('day', pass_ts) as bucket, vehicle_type, count(*),
            bucket >= date_trunc('day', any_value(last)) or any_value(last) is null
          from seen left join gone using (i, device_id) group by i, device_id, bucket, vehicle_type)
        where live""",
    "speed_live_asof": f"""
        select device_id, minute, speed, length from folded_asof
        where first_ts > timestamp '{AS_OF}' - interval 600 seconds""",
    "speed_live_asof_mean": f"""
        select device_id, date_trunc('minute', pass_ts) as minute, avg(speed) as speed, avg(length) as length
        from passes where pass_ts <= timestamp '{AS_OF}'
        group by all having min(pass_ts) > timestamp '{AS_OF}' - interval 600 seconds""",
    "result_index_search": f"""
        select {TIME} as ResultTime, cast(event_id as varchar) as resultId, task_id as taskId
        from passes where vehicle_brand = '别克' and plate_color = '黄' and dir = 1 and not tag
          and not paper and not sun and not "drop" and not second_belt and not crash and not danger
          and date_trunc('second', pass_ts) between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'""",
    "payload_decode": f"""
        select event_id,
          coalesce(try_strptime(substr(json_extract_string(doc, '$.Time'), 1, 19), '%Y-%m-%d %H:%M:%S'),
            timestamp '{ARRIVAL}') as pass_ts,
          json_extract_string(doc, '$.Id') as device_id,
          json_extract_string(doc, '$.PlateInfo.License') as plate,
          json_extract_string(doc, '$.PlateInfo.Color') as plate_color,
          json_extract_string(doc, '$.PlateInfo.PlateType') as plate_type,
          cast(json_extract_string(doc, '$.VehicleInfo.Speed') as float) as speed,
          cast(json_extract_string(doc, '$.VehicleInfo.Length') as float) as length,
          cast(json_extract_string(doc, '$.VehicleInfo.VehicleType') as int) as vehicle_type,
          json_extract_string(doc, '$.VehicleInfo.VehicleLogoRecog') as vehicle_logo,
          json_extract_string(doc, '$.MonitoringSiteID') as site_id,
          json_extract_string(doc, '$.IllegalSubType') as illegal_sub_type,
          json_extract_string(doc, '$.Time') as time_text,
          cast(json_array_length(doc, '$.PicInfo') as int) as pics,
          cast(json_extract_string(doc, '$.PicInfo[#-1].PicRecogMode') as int) as last_recog_mode
        from outcome where outcome = 'valid'""",
    "payload_quarantine": """
        select event_id, outcome as reason,
          case outcome when 'missing field' then 'PlateInfo.License' else '' end as missing
        from outcome where outcome <> 'valid'""",
    "event_time_parse": f"""
        select event_id,
          case event_id % 50 when 2 then timestamp '{ARRIVAL}' when 4 then timestamp '2024-01-02 03:04:05'
            when 5 then timestamp '{ARRIVAL}' else date_trunc('second', pass_ts) end as pass_ts,
          case event_id % 50 when 2 then timestamp '{ARRIVAL}' when 4 then timestamp '2024-01-02 03:04:05'
            when 5 then timestamp '2025-02-14 10:00:00' else date_trunc('second', pass_ts) end as rolled_ts
        from passes""",
    "stream_flow_minute": _flow("minute"),
    "stream_flow_hour": _flow("hour"),
    "stream_flow_day": _flow("day"),
    "stream_speed_length": _MEAN,
    "stream_speed_length_fold": "select device_id, minute, speed, length from folded",
    "stream_speed_fold_late": "select device_id, minute, speed, length from folded",
    "stream_flow_compacted": "select device_id, grain, bucket, vehicle_type, n from counts",
    "stream_flow_late": """
        select device_id, g as grain, date_trunc(g, pass_ts) as bucket, vehicle_type, count(*) as n
        from passes_late, (select unnest(['minute', 'hour', 'day']) as g) gs group by all""",
    "stream_unknown_gates": f"""
        select device_id, vehicle_type, {TIME} as WFSJ, count(*) as n from limited where not known group by all""",
    "stream_overspeed_counters": """
        select count(*) as "all", count(*) filter (speed > lim) as illegal from limited""",
    "stream_alarm_rejects": f"""
        select row_key as key, plate as PlateLicense, KKBH as DeviceId, GCSJ as Time, 'Priority' as missing, count(*) as n
        from alerts where BKJB = '9' group by all""",
    "stream_archive_search": f"""
        select row_key, device_id as SBBH, {TIME} as Time, plate as Plate_License
        from archived where {TIME} between '{RANGE[0]}' and '{RANGE[1]}'""",
    "stream_alerts_refresh": _newest("alerts_refreshed", ALARM),
    "stream_refresh_by_message": _newest("alerts_by_message", ALARM, "batch desc, "),
    "stream_alerts": _newest("alerts", ALARM),
    "stream_overspeed": _newest("violations", VIOLATION),
    "stream_alarms_bucketed": _newest("alerts_dealt", ALARM, "batch desc, "),
    "scroll_pinned": f"""
        select {HIT}, (row_number() over (order by pass_ts, event_id) - 1) // 50 as page
        from hits where event_id % 3 < 2""",
    "stream_fan_out": f"""
        select row_key, device_id as SBBH, {TIME} as Time, plate as Plate_License,
          case when event_id % 3 > 0 then event_id || '_' || (event_id % 3) end as Data
        from archived""",
    "stream_results": f"""
        select {TIME} as ResultTime, plate_color as PlateColor, dir as Direction, vehicle_brand as vehicleBrand,
          cast(tag as int) as tag, cast("drop" as int) as "drop", cast(second_belt as int) as secondBelt,
          pilot_call as call, cast(crash as int) as crash, cast(danger as int) as danger, cast(paper as int) as paper,
          cast(sun as int) as sun, cast(event_id as varchar) as resultId, task_id as taskId, camera_id as cameraId,
          data_source_id as dataSourceId, plate as License, plate_type as PlateType, cast(null as varchar) as fileName
        from passes""",
    "stream_decode": "select event_id, outcome from outcome",
}

_VIEWS = {
    **{name: inputs.view_sql(name, inputs.DUCKDB) for name in inputs.VIEWS},
    **CHECK_VIEWS,
}


def _with_views(body: str) -> str:
    """Puts the views that ``body`` reads before it, in an order where each comes after its inputs."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"(?:from|join)\s+(\w+)", sql):
            if name in _VIEWS and name not in needed:
                visit(_VIEWS[name])
                needed.append(name)

    visit(body)
    ctes = [f"{name} as ({_VIEWS[name]})" for name in needed]
    return "with " + ",\n".join(ctes) + f"\nselect * from (\n{body}\n)"


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(body) for name, body in BODIES.items()}
