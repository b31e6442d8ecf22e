"""The same queries as SQL over the given tables, written for DuckDB."""

from __future__ import annotations

from fleetwatt.schemas import PORT_SENSORS

TELEMETRY = """
    select 'wg' || (user_id // 5) as vehicle, event_id, ts, date_trunc('hour', ts) as h,
           event_type, value, props, json_extract_string(props, '$.k') as k
    from events"""

MEANS = f"""
    t as ({TELEMETRY}),
    s as (select distinct vehicle, h from t where event_type = 'error' and value > 0.2),
    m as (select vehicle, event_type, h, avg(value) as v from t group by all),
    f as (select s.vehicle, s.h, u.v as usage, g.v as solar, b.v as battery
          from s
          left join m u on u.vehicle = s.vehicle and u.h = s.h and u.event_type = 'view'
          left join m g on g.vehicle = s.vehicle and g.h = s.h and g.event_type = 'click'
          left join m b on b.vehicle = s.vehicle and b.h = s.h and b.event_type = 'purchase')"""

FLOWS = f"""
with {MEANS}
select vehicle, h as sample_hour, round(usage, 6) as total_usage, round(solar, 6) as solar_gain,
       round(battery, 6) as battery
from f"""

DEFAULT_DAYS = """
    select vehicle, coalesce(max(ts::date) filter (ts::date = date '2024-01-15'), max(ts::date)) as default_day
    from t group by vehicle"""

PIVOT_COLUMNS = ",\n".join(
    f"coalesce(sum(value::decimal(18,4)) filter (event_type = '{name}'), 0)::double as {column}"
    for name, column in [*[(n, n) for n in ("click", "error", "purchase", "signup")], ("view", "other")]
)

SENSORS = ", ".join(f"({slot}, {port}, '{sensor}')" for slot, port, sensor in PORT_SENSORS)

PORT_ROWS = f"""
    s(slot, port, sensor) as (values {SENSORS}),
    p as (select l_returnflag as vehicle, l_shipdate as "timestamp", l_linenumber as domain, l_suppkey as slot, l_partkey as port,
                 l_quantity as avg_power_w, l_extendedprice as avg_voltage_v, l_discount as avg_current_a, l_linenumber as port_status
          from lineitem where l_suppkey <> 0 or l_partkey <> 0
          union all
          select l_returnflag, l_shipdate, l_linenumber, l_linenumber, 1, l_tax, null, null, null from lineitem)"""

# The last value of each record after the three files of the stream.
LAST_VALUES = """
    select event_id, ts, event_type, value + case when event_id % 3 = 0 and event_id % 7 = 0 then 1 else 0 end as value,
           case when event_id % 3 > 0 then event_id % 3 when event_id % 7 < 2 then 2 when event_id % 2 = 0 then 1 else 0 end as batch
    from events"""

DAILY_FILES = """
    select 'wg' || (user_id % 2) as vehicle, case when event_type = 'click' then 'amps-solar' else 'amps' end as product,
           strftime(ts, '%Y-%m-%d') as day, count(*) filter (day(ts) % 7 > 0) as n
    from events group by 1, 2, 3"""

ROW_COUNTS = "\nunion all ".join(
    f"select '{name}' as tbl, count(*)::bigint as n from {name}"
    for name in (
        "region nation customer supplier part orders lineitem events "
        "documents embeddings pages benchmark labels conversations"
    ).split()
)

ORACLES = {
    "q_hourly_total": f"""
        select vehicle, h as "timestamp", sum(value::decimal(18,4))::double as total_value
        from ({TELEMETRY}) group by all""",
    "q_hourly_total_per_port": f"""
        select vehicle, h as "timestamp", round(sum(v), 6) as total_value
        from (select vehicle, h, event_type, avg(value) as v from ({TELEMETRY}) group by all) group by vehicle, h""",
    "q_hourly_mean": f"""
        select vehicle, event_type as component, h as sample_hour, round(avg(value), 6) as mean_value
        from ({TELEMETRY}) group by all""",
    "q_positive_sum": """
        select l_returnflag as vehicle, l_shipdate as ts, sum(l_discount::decimal(18,4))::double as positive_sum
        from lineitem where l_discount > 0 group by all""",
    "q_component_pivot": f"""
        select vehicle, h as sample_hour, {PIVOT_COLUMNS}
        from ({TELEMETRY}) where value > 0.2 group by vehicle, h""",
    "q_component_hours": f"""
        select vehicle, h as sample_hour, event_type as component, sum(value::decimal(18,4))::double as power_w
        from ({TELEMETRY}) where value > 0.2 group by all""",
    "q_port_hours": f"""
        select vehicle, h as sample_hour, event_type as component, sum(value::decimal(18,4))::double as total_w,
               (sum(value::decimal(18,4)) filter (value > 10))::double as power_w
        from ({TELEMETRY}) group by all""",
    "q_spine_join": FLOWS,
    "q_hourly_flows": FLOWS,
    "q_flows_of_rows": FLOWS,
    "q_daily_energy": f"""
        with {MEANS}
        select vehicle, h::date as day, round(sum(coalesce(usage, 0)), 6) as used_wh,
               round(sum(coalesce(solar, 0)), 6) as gained_wh
        from f group by all""",
    "q_first_last_delta": f"""
        with t as ({TELEMETRY}),
        d as (select distinct vehicle, ts::date as day from t),
        b as (select vehicle, ts::date as day, arg_min(value, ts) as s, arg_max(value, ts) as e
              from t where event_type = 'purchase' group by all)
        select d.vehicle, d.day, coalesce(s, 0.0)::double as battery_start, coalesce(e, 0.0)::double as battery_end,
               round(coalesce(e - s, 0.0), 6)::double as delta
        from d left join b on b.vehicle = d.vehicle and b.day = d.day""",
    "q_days": f"""
        select vehicle, day, (row_number() over (partition by vehicle order by day) - 1)::bigint as day_index
        from (select distinct vehicle, ts::date as day from ({TELEMETRY}))""",
    "q_default_day": f"with t as ({TELEMETRY}) {DEFAULT_DAYS}",
    "q_day_summary": f"""
        with {MEANS},
        e as (select vehicle, h::date as day, sum(coalesce(usage, 0)) as used, sum(coalesce(solar, 0)) as gained
              from f group by all),
        b as (select vehicle, ts::date as day, arg_min(value, ts) as bs, arg_max(value, ts) as be
              from t where event_type = 'purchase' group by all)
        select e.vehicle, e.day, round(used, 6) as used_wh, round(gained, 6) as gained_wh,
               coalesce(bs, 0.0)::double as battery_start, coalesce(be, 0.0)::double as battery_end,
               round(coalesce(be - bs, 0.0), 6)::double as delta,
               e.day::timestamp as day_start, (e.day + interval 1 day)::timestamp as day_end,
               strftime(e.day, '%Y-%m-%d') as day_label
        from e left join b on b.vehicle = e.vehicle and b.day = e.day""",
    "q_day_window_flag": f"""
        with t as ({TELEMETRY}), d as ({DEFAULT_DAYS})
        select event_id, (ts >= default_day and ts < default_day + interval 1 day) as in_selected_day
        from t join d on d.vehicle = t.vehicle""",
    "q_trace_index": f"""
        with t as ({TELEMETRY}),
        d as (select vehicle, day, row_number() over (partition by vehicle order by day) - 1 as i
              from (select distinct vehicle, ts::date as day from t)),
        c as (select vehicle, count(distinct event_type) + 3 as width from t group by vehicle)
        select vehicle, day, k::bigint as k, (2 + i * width + k)::bigint as trace_index
        from (select d.vehicle, d.day, d.i, c.width, unnest(range(c.width)) as k from d join c on c.vehicle = d.vehicle)""",
    "q_series_long": f"""
        with {MEANS}
        select vehicle, h::date as day, 'bars' as panel, event_type as series, h as x,
               round(sum(value::decimal(18,4))::double, 6) as y
        from t where value > 0.2 group by vehicle, h, event_type
        union all select vehicle, h::date, 'flows', 'usage', h, round(usage, 6) from f where usage is not null
        union all select vehicle, h::date, 'flows', 'solar', h, round(solar, 6) from f where solar is not null
        union all select vehicle, h::date, 'battery', 'battery', h, round(battery, 6) from f where battery is not null
        union all select vehicle, ts::date, 'mission', 'battery', ts, round(value, 6) from t where event_type = 'purchase'
        union all select vehicle, ts::date, 'availability', 'k', ts, round(try_cast(k as double), 6)
        from t where try_cast(k as double) is not null""",
    "q_port_unpivot": """
        select l_orderkey, l_linenumber, 1 as place, l_linenumber as port, 5 as module, l_quantity as reading from lineitem
        union all select l_orderkey, l_linenumber, 2, case when l_returnflag = 'N' then 0 else 2 end,
            case when l_linestatus = 'O' then 0 else 5 end, l_extendedprice
        from lineitem where not (l_returnflag = 'N' and l_linestatus = 'O')
        union all select l_orderkey, l_linenumber, 3, 0, l_linenumber - 1, l_discount from lineitem where l_linenumber <> 1
        union all select l_orderkey, l_linenumber, 4, null, 7, l_tax from lineitem where l_tax > 0""",
    "q_port_label": r"""
        select coalesce(nullif(regexp_replace(coalesce(d.name, ''), '^\s+|\s+$', '', 'g'), ''),
                        concat('D', l_linenumber, '-S', l_returnflag, '-P', l_linestatus)) as component,
               count(*)::bigint as n
        from lineitem left join (values ('N','O',' open '), ('R','F','returned'), ('A','F','  ')) d(rf, ls, name)
          on l_returnflag = d.rf and l_linestatus = d.ls
        group by 1""",
    "q_port_table": f"""
        with {PORT_ROWS}
        select vehicle, "timestamp", date_trunc('hour', "timestamp") as sample_hour, domain, p.slot, p.port, sensor,
               avg_power_w, avg_voltage_v, avg_current_a, port_status
        from p left join s on p.slot = s.slot and p.port = s.port""",
    "q_port_order": f"with {PORT_ROWS} select vehicle, count(*)::bigint as n, 0::bigint as out_of_order from p group by 1",
    "q_availability_order": f"""
        select vehicle, sensor, case sensor when 'Vaisala' then 3 else 6 end as rank_no, count(*)::bigint as n,
               min(ts) as first_time, max(ts) as last_time
        from (select vehicle, ts, 'Vaisala' as sensor, value from ({TELEMETRY})
              union all select vehicle, ts, 'pCO2', try_cast(k as double) from ({TELEMETRY}))
        where value is not null group by 1, 2""",
    "q_target_choice": f"""
        select vehicle, h as "timestamp", sum(value::decimal(18,4))::double as total_value, target
        from ({TELEMETRY}), (values ('wg1'), ('both')) as c(target)
        where vehicle = target or target = 'both' group by 1, 2, 4""",
    "q_day_titles": f"""
        with {MEANS}
        select vehicle, h::date as day, case vehicle when 'wg0' then 'Alpha' else upper(vehicle) end as label,
               strftime(h::date, '%Y-%m-%d') as day_text, true as shows_gained_wh, true as shows_used_wh,
               true as shows_battery_start, true as shows_battery_end, true as shows_delta
        from f group by all""",
    "q_top20": """
        select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice
        from lineitem order by all limit 20""",
    "q_port_power": """
        with p as (
            select l_returnflag as vehicle, l_shipdate as ts, l_quantity as w,
                   case l_linenumber when 1 then 'SPN1 Heater' when 2 then 'SPN1' when 3 then 'Vaisala WXT530 Heater'
                       when 4 then 'Vaisala WXT530' when 5 then 'RBR CTD' when 6 then 'Gill R3-50'
                       else 'D' || l_linenumber || '-S5-P' || l_linenumber end as component
            from lineitem
            union all
            select l_returnflag, l_shipdate, l_discount * 10,
                   case when l_linestatus = 'O' then 'VMC' else 'D' || l_linenumber || '-S32-P9' end from lineitem
            union all
            select l_returnflag, l_shipdate, l_tax * 10, 'D' || l_linenumber || '-S32-P107' from lineitem)
        select vehicle, date_trunc('hour', ts) as sample_hour, component, sum(w::decimal(18,4))::double as power_w
        from p where w > 0.2 group by all""",
    "q_solar_power": """
        with p as (
            select l_returnflag as vehicle, l_shipdate as ts, l_discount as w from lineitem
            union all
            select l_returnflag, l_shipdate, case when l_linestatus = 'O' then -l_tax else l_tax end from lineitem)
        select vehicle, ts, sum(w::decimal(18,4))::double as solar_power_w from p where w > 0 group by all""",
    "q_dedup_last": f"""
        select vehicle, h as key_hour, event_id, value from ({TELEMETRY})
        qualify row_number() over (partition by vehicle, h order by ts desc, event_id desc) = 1""",
    "q_numeric_coerce": f"""
        select event_id, nullif(try_cast(case event_type when 'view' then '  ' || k || ' ' when 'error' then 'NaN'
            when 'signup' then k || 'd' when 'purchase' then k || 'e1' else k end as double), 'nan'::double) as k
        from ({TELEMETRY})""",
    "q_time_coerce": """
        select event_id, case event_type when 'click' then date_trunc('second', ts)
            when 'purchase' then ts - interval 2 hour else ts end as ts2
        from events where event_type <> 'error'""",
    "q_sentinel_null": """
        select l_linenumber, count(*)::bigint as n, count(nullif(nullif(l_quantity, 1.0), 50.0))::bigint as n_valid,
               round(avg(nullif(nullif(l_quantity, 1.0), 50.0)), 6) as mean_valid
        from lineitem group by 1""",
    "q_unit_convert": """
        select event_id, value as wind_speed_kt, round(value * 0.514444, 8) as wind_speed_ms from events""",
    "q_milli_to_unit": f"""
        select vehicle, ts as "timestamp", try_cast(k as double) / 1000.0 as k_unit
        from ({TELEMETRY}) where try_cast(k as double) is not null""",
    "q_schema_guard": """
        select column_name from (values ('k'), ('gliderTimeStamp'), ('totalBatteryPower')) r(column_name)
        where not exists (select 1 from events where json_exists(props, '$.' || column_name))""",
    "q_weather": """
        select o_orderstatus as vehicle, o_orderdate as ts, o_custkey::double as latitude,
               try_cast(o_orderpriority as double) as air_temperature, o_totalprice as wind_speed_kt,
               round(o_totalprice * 0.514444, 6) as wind_speed_ms
        from orders qualify row_number() over (partition by o_orderstatus, o_orderdate order by o_orderkey desc) = 1""",
    "q_waves": """
        select l_returnflag as vehicle, l_shipdate as ts, l_extendedprice as latitude,
               nullif(nullif(l_quantity, 1.0), 50.0) as significant_wave_height_m,
               case when l_linenumber < 7 then l_linenumber::double end as n_samples
        from lineitem qualify row_number() over (partition by l_returnflag, l_shipdate
            order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1""",
    "q_availability": f"""
        with t as ({TELEMETRY})
        select vehicle, ts as "timestamp", 'value' as sensor, value from t where value is not null
        union all select vehicle, ts, 'props_k', try_cast(k as double) from t where try_cast(k as double) is not null
        union all select o_orderstatus, o_orderdate, 'priority', try_cast(o_orderpriority as double) from orders
            where try_cast(o_orderpriority as double) is not null
        union all select o_orderstatus, o_orderdate, 'order', o_totalprice from orders where o_totalprice is not null
        union all select l_returnflag, l_shipdate, 'ship', l_quantity from lineitem
            where l_quantity is not null and l_shipdate is not null""",
    "q_sensor_order": """
        select sensor, rank_no::bigint as rank_no
        from (values ('view', 0), ('click', 1), ('signup', 2), ('purchase', 3)) o(sensor, rank_no)
        union all select 'error', 4 where exists (select 1 from events where event_type = 'error')""",
    "q_component_colour": """
        select vehicle, component, ((row_number() over (partition by vehicle order by component) - 1) % 14)::bigint
            as colour_index
        from (select distinct p_brand as vehicle, p_name as component from part)""",
    "q_vehicle_union": f"""
        select coalesce(l.label, upper(t.vehicle)) as vehicle, ts::date as day, sum(value::decimal(18,4))::double as total
        from ({TELEMETRY}) t left join (values ('wg0', 'Alpha'), ('wg1', 'Beta')) l(vehicle, label)
          on l.vehicle = t.vehicle
        group by 1, 2""",
    "q_file_census": """
        select o_orderkey, count(l_orderkey)::bigint as n from orders left join lineitem on l_orderkey = o_orderkey
        group by 1""",
    "q_row_counts": ROW_COUNTS,
    "q_json_scan": """
        select 'both' as loader, event_id, user_id, event_type, value from events
        union all select 'both', event_id, user_id, event_type, value from events where event_type = 'purchase'
        union all select 'list', event_id, user_id, event_type, value from events where event_type in ('error', 'click')""",
    "q_payload_census": """
        select (count(*) + count(*) filter (event_type = 'purchase'))::bigint as n from events""",
    "q_csv_roundtrip": "select event_type, event_id, ts, value, props from events",
    "q_daily_files": f"select vehicle, day, n::bigint as n from ({DAILY_FILES}) where product = 'amps'",
    "q_source_files": f"select product as source, count(*)::bigint as n_files from ({DAILY_FILES}) group by 1",
    "q_empty_content": f"""
        select vehicle, count(*)::bigint as empty_files from ({DAILY_FILES}) where product = 'amps' and n = 0 group by 1""",
    "q_stream_hourly": f"""
        select event_type, date_trunc('hour', ts) as sample_hour, sum(value::decimal(18,4))::double as total,
               sum(value::decimal(18,4))::double / count(*) as mean_value, count(*)::bigint as n
        from ({LAST_VALUES}) group by 1, 2""",
    "q_stream_late": f"""
        with v as ({LAST_VALUES}),
        m as (select batch, max(ts) as newest from v group by 1),
        b as (select m.batch, max(e.newest) as seen from m left join m e on e.batch < m.batch group by 1)
        select v.batch::bigint as batch, count(*)::bigint as n,
               count(*) filter (ts < seen - interval 48 hour)::bigint as n_late
        from v join b on v.batch = b.batch group by 1""",
    "q_stream_dedup": "select event_id, ts, value from events",
    "q_restate_days": """
        select ts::date as day, sum((value + case when ts::date >= last_day - 1 and event_id % 5 > 0 then 1 else 0 end)::decimal(18,4))::double
            as total
        from events, (select max(ts::date) as last_day from events) group by 1""",
    "q_title_text": """
        select l_orderkey, l_linenumber,
               l_returnflag || ': Average Power Usage (Watts) with Total Usage and Solar Gain<br>Date: ' || strftime(l_shipdate, '%Y-%m-%d')
                   || format(' | Daily gained: {:.1f} Wh | Daily used: {:.1f} Wh', l_quantity / 8, l_extendedprice / 64) as title,
               format('Total Battery Power | Start: {:.1f} W | End: {:.1f} W | Daily gain/loss: {:+.1f} W',
                   l_discount - 0.05::double, l_quantity / 20, (l_tax - 0.04::double) * l_quantity / 4) as battery_title
        from lineitem""",
    "q_interval_membership": f"""
        with t as ({TELEMETRY}),
        i as (select vehicle, event_id as interval_id, ts as "start", ts + case event_id % 7 when 0 then interval 5 minute
                  when 1 then interval 1 hour when 2 then interval 6 hour when 3 then interval 1 day when 4 then interval 3 day
                  when 5 then interval 14 day else interval 45 day end as stop
              from t where event_type = 'signup')
        select interval_id, count(*)::bigint as n, sum(value::decimal(18,4))::double as total
        from t join i on i.vehicle = t.vehicle and t.ts >= i.start and t.ts < i.stop group by 1""",
    "q_partial_states": """
        with v as (select event_type, ts, value + case when event_id % 11 = 0 then 2 else 0 end as value from events)
        select event_type, date_trunc('hour', ts) as sample_hour, sum(value::decimal(18,4))::double as total,
               sum(value::decimal(18,4))::double / count(value) as mean_value, count(value)::bigint as n,
               first(value order by ts, value) as first_value, last(value order by ts, value) as last_value
        from v where value is not null group by 1, 2""",
    "q_global_order": "select count(*)::bigint as n, 0::bigint as out_of_order from lineitem",
    "q_bucketed_join": FLOWS,
    "q_stream_moved": """
        with v as (select event_type, ts + case when event_id % 5 = 0 and event_id % 10 > 0 then interval 30 hour else interval 0 hour end as ts,
                          value + case when event_id % 10 = 0 then 1 else 0 end as value from events)
        select event_type, ts::date as day, sum(value::decimal(18,4))::double as total, count(*)::bigint as n from v group by 1, 2""",
    "q_refetched_files": """
        with e as (select 'wg' || (user_id % 2) as vehicle, ts::date as day, event_id, value from events),
        b as (select min(day) as first_day, max(day) as last_day from e)
        select vehicle, day, sum((value + case when vehicle = 'wg0' and day = first_day then 1 else 0 end)::decimal(18,4))::double as total,
               count(*)::bigint as n
        from e, b where not (vehicle = 'wg1' and day = last_day and event_id % 2 = 1) group by 1, 2""",
}
ORACLES["q_refresh_job"] = ORACLES["q_day_summary"]
