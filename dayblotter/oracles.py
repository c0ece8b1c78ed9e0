"""The bound queries in DuckDB SQL, for checking results on the same Parquet tables."""

from __future__ import annotations

from dayblotter.fixed_values import CALENDAR_BEGIN, CALENDAR_END, HOLIDAYS

_HOLIDAY_ROWS = ", ".join(
    "('{}', '{}')".format(name.replace("'", "''"), date) for name, date in HOLIDAYS
)


def _calendar(span: str) -> str:
    """CTE `cal` over the days of `span`, a query for first_day and last_day."""
    return f"""
    span as ({span}),
    hol as (select name as holiday_name, strptime(d, '%A, %B %-d, %Y')::date as hday
            from (values {_HOLIDAY_ROWS}) t(name, d)),
    days as (select unnest(generate_series(first_day::timestamp, last_day::timestamp,
                                           interval 1 day))::date as "date" from span),
    cal as (select "date", day("date")::int as "day", month("date")::int as "month",
                   monthname("date") as month_name, year("date")::int as "year",
                   (isodow("date") - 1)::int as day_of_week, dayname("date") as day_of_week_name,
                   holiday_name
            from days left join hol on days."date" = hol.hday)"""


_FIXED = _calendar(f"select date '{CALENDAR_BEGIN}' as first_day, date '{CALENDAR_END}' as last_day")
_ORDERS = _calendar(
    "select min(o_orderdate)::date as first_day, max(o_orderdate)::date as last_day from orders"
)
_BOTH = _calendar(
    "select min(t)::date as first_day, max(t)::date as last_day from "
    "(select o_orderdate as t from orders union all select ts from events)"
)

_EVENT_INCIDENTS = """select event_id as crime_id, ts as date_of_occurrence,
    event_type as primary_description, user_id as beat from events"""

_STATIONS = """select n_nationkey::varchar as district, n_name as district_name,
    'STATION ' || n_nationkey as address, 60600 + n_nationkey as zip,
    '555-01' || lpad(n_nationkey::varchar, 2, '0') as phone from nation"""

_WARD_COUNTS = """select c_nationkey as ward, o_orderpriority as kind, count(o_orderkey) as n
    from orders join customer on o_custkey = c_custkey group by 1, 2"""

_BUCKET = """case when hour({0}) < 6 then 'night' when hour({0}) < 12 then 'morning'
    when hour({0}) < 18 then 'afternoon' when hour({0}) < 24 then 'evening' else 'unknown' end"""


def _points(n: str, d: str) -> str:
    """Basis points rounded half away from zero."""
    return f"(sign({n})::bigint * ((20000 * abs({n}) + {d}) // (2 * {d})))::bigint"


def _percent(points: str) -> str:
    return f"""case when {points} is null then null
        when abs({points}) < 100000 then printf('%7.2f', {points} / 100.0) || '%'
        when {points} < 0 then '-###.##%' else ' ###.##%' end"""


def _feed(event: str, corrected: bool) -> str:
    """The twenty incident columns as they come out of the reshaped feed."""
    changed = f"({event}.event_type = 'error' and {'true' if corrected else 'false'})"
    ms = "date_trunc('millisecond', {})"
    return f"""
    'row-' || event_id as crime_id,
    {ms.format('ts')} as created_at,
    {ms.format(f"case when {changed} then ts + interval 60 day else ts + interval 1 hour end")} as updated_at,
    'rv-' || event_id as version,
    'EV' || event_id as "case",
    {ms.format('ts')} as date_of_occurrence,
    user_id || 'XX STREET' as block,
    json_extract_string(props, '$.k') as iucr,
    event_type as primary_description,
    upper(event_type) as secondary_description,
    'STREET' as location_description,
    case when {changed} then 'Y' else 'N' end as arrest,
    'N' as domestic,
    user_id::int as beat,
    (user_id % 50 + 1)::int as ward,
    '14' as fbi_cd,
    user_id::int as x_coordinate,
    user_id::int as y_coordinate,
    value as latitude,
    value as longitude"""


_CSV = """select c_custkey as cust_key, c_name || chr(10) || '"of", ' || c_mktsegment as full_name,
    c_nationkey as nation_key, c_acctbal as acct_bal,
    nullif(c_mktsegment, 'MACHINERY') as mkt_segment from customer"""

_CHANGES = """
    select o_orderkey, o_custkey, 'F' as o_orderstatus, o_totalprice,
           o_orderdate + interval 2 day as o_orderdate, o_orderpriority
    from orders where o_orderstatus = 'P'
    union all
    select -o_orderkey - 1, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority
    from orders where o_orderstatus = 'F'"""

_YEARLY = """select year(o_orderdate)::int as order_year, o_orderpriority, count(o_orderkey) as n
    from orders group by 1, 2"""

ORACLES: dict[str, str] = {
    "ward_summary": f"""
        with counts as ({_WARD_COUNTS}),
        placed as (select *, row_number() over (partition by ward order by n desc, kind) as p from counts),
        tops as (select ward, max(kind) filter (p = 1) as k1, max(kind) filter (p = 2) as k2,
                        sum(n)::bigint as total from placed group by ward)
        select n_nationkey as ward, n_name as alderman, k1 as dist_most_popular_crime,
               k2 as dist_second_most_popular_crime, total as dist_total_crimes,
               dense_rank() over (order by total desc) as dist_total_crimes_rank
        from tops join nation on n_nationkey = ward order by ward""",
    "station_rank": f"""
        with st as ({_STATIONS}),
        arrests as (select district, count(o_orderkey) as total_arrests from st join orders
                    on district = (o_custkey // 100)::varchar where o_orderstatus = 'F' group by 1),
        crimes as (select district, count(o_orderkey) as total_crimes from st join orders
                   on district = (o_custkey // 100)::varchar group by 1)
        select st.*, total_arrests, total_crimes,
               {_percent(_points('total_arrests', 'total_crimes'))} as arrest_percentage,
               dense_rank() over (order by 10000 * total_arrests // total_crimes desc) as arrest_ratio_rank,
               dense_rank() over (order by total_arrests) as arrest_total_rank,
               dense_rank() over (order by total_crimes) as total_crimes_rank
        from st join arrests using (district) join crimes using (district)""",
    "monthly_growth": f"""
        with {_ORDERS},
        months as (select "month" as calendar_month, "year" as calendar_year,
                          count(o_orderkey) as crime_amount
                   from orders join cal on o_orderdate::date = cal."date" group by 1, 2),
        lagged as (select *, lag(crime_amount) over (order by calendar_year, calendar_month) as p from months)
        select calendar_month, calendar_year, crime_amount, p as prev_month_crime_amount,
               crime_amount - p as diff,
               {_percent(_points('(crime_amount - p)', 'p'))} as crime_growth,
               {_points('(crime_amount - p)', 'p')} / 100.0::double as crime_growth_percent
        from lagged order by calendar_year, calendar_month""",
    "holiday_mean": f"""
        with {_FIXED},
        per_day as (select cal."date", case when holiday_name is not null then 'Y' else 'N' end as holiday,
                           count(event_id) as n
                    from events join cal on ts::date = cal."date" group by 1, 2)
        select ((200 * sum(n) + count(*)) // (2 * count(*)))::bigint / 100.0::double as average_crimes_count, holiday
        from per_day group by holiday""",
    "holiday_mean_all_days": f"""
        with {_FIXED},
        per_day as (select cal."date", case when holiday_name is not null then 'Y' else 'N' end as holiday,
                           count(event_id) as n
                    from cal left join events on ts::date = cal."date" group by 1, 2)
        select ((200 * sum(n) + count(*)) // (2 * count(*)))::bigint / 100.0::double as average_crimes_count, holiday
        from per_day group by holiday""",
    "time_of_day": f"""
        select *, {_BUCKET.format('date_of_occurrence')} as time_of_day from ({_EVENT_INCIDENTS})""",
    "incident_calendar": f"""
        with {_FIXED}, inc as ({_EVENT_INCIDENTS})
        select inc.*, "year", "day", "month", day_of_week_name, month_name, day_of_week, holiday_name
        from inc left join cal on date_of_occurrence::date = cal."date" """,
    "incident_calendar_older_shape": f"""
        with {_FIXED}, inc as ({_EVENT_INCIDENTS})
        select inc.*, "year", "day", "month", day_of_week_name as month_name, day_of_week, holiday_name
        from inc left join cal on date_of_occurrence::date = cal."date" """,
    "view_registry": """
        select o_orderpriority as primary_description, count(*) as crimes,
               count(*) filter (o_orderstatus = 'F') as arrests,
               dense_rank() over (order by count(*) filter (o_orderstatus = 'F') desc) as arrests_rank
        from orders group by 1""",
    "q_weekday": f"""
        with {_ORDERS}
        select day_of_week, day_of_week_name, count(o_orderkey) as crimes
        from orders left join cal on o_orderdate::date = cal."date" group by 1, 2
        order by crimes desc, day_of_week""",
    "q_month": f"""
        with {_ORDERS}
        select "month", month_name, count(o_orderkey) as crimes
        from orders left join cal on o_orderdate::date = cal."date" group by 1, 2
        order by crimes desc, "month" """,
    "q_time_of_day": f"""
        select {_BUCKET.format('ts')} as time_of_day, count(event_id) as crimes from events group by 1
        order by crimes desc, time_of_day""",
    "q_holiday": f"""
        with {_FIXED}
        select holiday_name, count(event_id) as crimes from events join cal on ts::date = cal."date"
        where holiday_name is not null group by 1 order by crimes desc, holiday_name""",
    "q_beat": """
        select user_id as beat, count(event_id) as crimes from events
        where event_type in ('error', 'purchase') group by 1 order by crimes desc, beat""",
    "q_district_type": f"""
        with st as ({_STATIONS})
        select district, district_name, o_orderpriority as primary_description, count(o_orderkey) as crimes
        from st join orders on district = (o_custkey // 100)::varchar group by 1, 2, 3
        order by crimes desc, district, primary_description""",
    "calendar_dim": f"""with {_BOTH} select * from cal""",
    "time_windows": """
        with ends as (select min(ts) as a, max(ts) as b from events),
        pieces as (select a, b, unnest(generate_series(a, b, interval 7 day)) as start_time from ends),
        cut as (select (row_number() over (order by start_time) - 1)::int as piece, start_time,
                       case when start_time + interval 7 day >= b then b
                            else start_time + interval 7 day - interval 1 millisecond end as end_time,
                       case when start_time + interval 7 day >= b then null
                            else start_time + interval 7 day end as next_start
                from pieces where start_time < b)
        select *, strftime(start_time, '%Y-%m-%dT%H:%M:%S.%g') as start_text,
               strftime(end_time, '%Y-%m-%dT%H:%M:%S.%g') as end_text from cut""",
    "backfill_windows": """
        with ends as (select min(ts) as a, max(ts) as b from events),
        pieces as (select b, unnest(generate_series(a, b, interval 7 day)) as s from ends),
        cut as (select s, s + interval 7 day as e, b, (row_number() over (order by s) - 1)::int as piece
                from pieces where s < b)
        select piece, count(event_id) as n, min(ts) as first_ts, max(ts) as last_ts
        from events join cut on ts >= s and (ts < e or (e = b and ts = b)) group by 1""",
    "window_scan": """
        select event_id, ts, event_type from events
        where ts between timestamp '2024-01-08 00:00:00' and timestamp '2024-01-14 23:59:59.999'""",
    "date_parts": """
        select o_orderkey, day(o_orderdate)::int as "day", month(o_orderdate)::int as "month",
               year(o_orderdate)::int as "year", monthname(o_orderdate) as month_name,
               (isodow(o_orderdate) - 1)::int as day_of_week, dayname(o_orderdate) as day_of_week_name,
               strftime(o_orderdate, '%A, %B %-d, %Y') as long_text, o_orderdate::date as parsed
        from orders""",
    "time_text": """
        with cut as (select event_id, ts, date_trunc('millisecond', ts) as ms from events)
        select event_id, hour(ts)::int as "hour", strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') as ms_text,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') as without_zone, ms as wall_clock, ms as utc,
               strftime(ms + interval 1 millisecond, '%Y-%m-%dT%H:%M:%S.%g') as next_ms_text
        from cut""",
    "percent_text": f"""
        with p as (select o_orderkey, o_custkey,
                          {_points('(o_orderkey - o_custkey)', '(o_custkey + 1)')} as bp from orders)
        select o_orderkey, {_percent('bp')} as change_text, bp / 100.0::double as change_percent,
               10000 * o_custkey // (o_orderkey + 1) as share from p""",
    "district_key": """
        select (o_custkey // 100)::varchar as district, count(o_orderkey) as n from orders group by 1""",
    "lag_growth": """
        with months as (select year(o_orderdate)::int as y, month(o_orderdate)::int as m,
                               count(o_orderkey) as n from orders group by 1, 2)
        select *, lag(n) over (order by y, m) as prev_n, n - lag(n) over (order by y, m) as diff from months""",
    "dense_rank_dir": f"""
        select *, dense_rank() over (order by n desc) as rank_most, dense_rank() over (order by n) as rank_fewest
        from ({_YEARLY})""",
    "first_nth_value": f"""
        select distinct order_year,
               first_value(o_orderpriority) over w as first_label,
               nth_value(o_orderpriority, 2) over w as second_label
        from ({_YEARLY})
        window w as (partition by order_year order by n desc, o_orderpriority
                     rows between unbounded preceding and unbounded following)""",
    "top_two_types": """
        with counts as (select user_id, event_type, count(event_id) as n from events group by 1, 2)
        select distinct user_id, first_value(event_type) over w as first_label,
               nth_value(event_type, 2) over w as second_label
        from counts
        window w as (partition by user_id order by n desc, event_type
                     rows between unbounded preceding and unbounded following)""",
    "feed_bounds": """
        select min(ts) as min_occurred, max(ts) as max_occurred, max(ts) + interval 1 hour as max_updated
        from events""",
    "paged_scan": """
        select event_id, event_type, (row_number() over (order by event_id) - 1) // 1000 as page from events""",
    "feed_reshape": f"select {_feed('events', False)} from events",
    "feed_pages": f"select {_feed('events', False)} from events",
    "json_flatten": """
        select event_id, json_extract_string(props, '$.k')::int as props_k, null::varchar as props_absent
        from events""",
    "page_read": """
        with placed as (select event_id, event_type, row_number() over (order by event_id) - 1 as place from events),
        middle as (select count(*) // 1000 // 2 as page from events)
        select event_id, event_type from placed, middle where place // 1000 = page""",
    "order_ranks": """
        select o_orderkey, o_orderdate::date as "day", o_totalprice as price,
               dense_rank() over (order by o_totalprice desc) as price_rank,
               dense_rank() over (order by o_orderdate::date) as day_rank,
               dense_rank() over (order by o_orderdate::date desc) as day_rank_back
        from orders""",
    "event_change": """
        select event_id, event_type, value, lag(event_type) over (order by event_id) as prev_event_type,
               lag(value) over (order by event_id) as prev_value, value - lag(value) over (order by event_id) as diff
        from events""",
    "csv_large": """
        select l_orderkey as order_key, l_linenumber as line_number, l_shipdate as ship_date,
               l_extendedprice as extended_price,
               'by "' || l_returnflag || '",' || chr(10) || 'to ' || l_linestatus as note
        from lineitem""",
    "csv_headers": _CSV,
    "csv_union": _CSV,
    "missing_to_null": """
        select event_id, case when event_type = 'error' then null else value end as value from events""",
    "merge_latest": f"""
        select * from orders where o_orderstatus <> 'P' union all {_CHANGES}""",
    "merge_replace": f"""
        select o_orderkey, o_custkey, case when o_orderstatus = 'O' then 'X' else o_orderstatus end as o_orderstatus,
               o_totalprice, case when o_orderstatus = 'O' then o_orderdate - interval 1 day else o_orderdate end
               as o_orderdate, o_orderpriority from orders where o_orderstatus <> 'P' union all {_CHANGES}""",
    "upsert_latest": f"""
        select * from orders where o_orderstatus <> 'P' union all {_CHANGES}""",
    "incremental_since": """
        select event_id, ts, event_type from events
        where ts > (select max(ts) from events where ts < timestamp '2024-01-21 00:00:00')""",
    "store_refresh": f"select {_feed('events', True)} from events",
    "store_window": f"""
        select * from (select {_feed('events', True)} from events)
        where date_of_occurrence between timestamp '2024-01-15 00:00:00' and timestamp '2024-01-21 23:59:59.999'""",
    "stream_upsert": """
        select event_id, ts, user_id, event_type, value, props from
        (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as p
         from events) where p = 1""",
    "load_once": "select * from customer",
    "audit_next_run": "select coalesce(max(o_orderkey), 0) + 1 as next_run_id from orders",
    "view_registry_all": f"""
        with {_ORDERS},
        inc as (select o_orderkey as crime_id, o_orderdate as ts, o_orderpriority as kind,
                       o_orderstatus = 'F' as arrested, o_custkey as beat, o_custkey % 25 as ward from orders),
        joined as (select * from inc left join cal on ts::date = cal."date"),
        st as ({_STATIONS}),
        months as (select "year" * 100 + "month" as ym, count(*) as n from joined where "date" is not null group by 1),
        grown as (select *, lag(n) over (order by ym) as p from months),
        per_day as (select "date", holiday_name, count(*) as n from joined where "date" is not null group by 1, 2),
        ranks as (select district, district_name, count(*) filter (arrested) as a, count(*) as c
                  from st join inc on district = (beat // 100)::varchar group by all having a > 0),
        counts as (select ward, kind, count(*) as n from inc group by all),
        placed as (select *, row_number() over (partition by ward order by n desc, kind) as place from counts),
        tops as (select ward, max(kind) filter (place = 1) as k1, max(kind) filter (place = 2) as k2, sum(n)::bigint as n
                 from placed group by ward)
        select 'crime_data_with_calendar_days_holidays' as view, crime_id as row_key,
               ("year" * 10000 + "month" * 100 + "day")::bigint as number,
               concat_ws(' ', month_name, day_of_week_name, day_of_week, holiday_name) as shown from joined
        union all select 'crime_data_with_time_of_day', crime_id, beat, {_BUCKET.format('ts')} from inc
        union all select 'crime_growth_by_month', ym::bigint, n, {_percent(_points('(n - p)', 'p'))} from grown
        union all select 'holiday_vs_non_holiday_crimes', 0::bigint,
               ((200 * sum(n) + count(*)) // (2 * count(*)))::bigint, case when holiday_name is null then 'N' else 'Y' end
               from per_day group by 4
        union all select 'police_rank_by_arrest', district::bigint,
               a * 1000 + dense_rank() over (order by a),
               concat_ws(' ', district_name, dense_rank() over (order by 10000 * a // c desc),
                         dense_rank() over (order by c), {_percent(_points('a', 'c'))}) from ranks
        union all select 'ward_crimes_summary', tops.ward, n * 1000 + dense_rank() over (order by n desc),
               concat_ws(' ', n_name, k1, k2) from tops join nation on n_nationkey = tops.ward""",
    "feed_scan": f"""
        select * from (select {_feed('events', True)} from events)
        where updated_at <= timestamp '2024-01-21 00:00:00'""",
    "run_audit": """
        with runs as (select (c_custkey + 1)::int as run_id, c_acctbal < 0 as failed, c_name from customer)
        select run_id, 'start' as status, 'customers' as pipeline_name, '{"days": 7}' as config, null::varchar as logs,
               true as has_time from runs
        union all
        select run_id, case when failed then 'fail' else 'success' end, 'customers', '{"days": 7}',
               case when failed then c_name end, true from runs""",
}
