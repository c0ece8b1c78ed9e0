"""Every query, bound to the generated test tables.

Orders and events stand in for incidents, nations for wards and stations. Each query reads whole
tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayblotter import fixed_values
from dayblotter.functions import columns, dates, numbers
from dayblotter.operators import global_windows, incremental, paging, ranking, timeranges, upsert
from dayblotter.operators.calendar import calendar, calendar_for, days_between, known_holidays
from dayblotter.operators.reshape import incidents_from_feed
from dayblotter.plans import questions, registry, views
from dayblotter.schemas import (
    CALENDAR_TABLE,
    INCIDENT_TABLE,
    RAW_FEED,
    STATION_TABLE,
    WARD_TABLE,
    TableSpec,
    struct,
)
from dayblotter.session import new_folder, stored_bytes
from dayblotter.sinks.audit import RunLog
from dayblotter.sinks.declare import declare_table
from dayblotter.sinks.keyed import KeyedTable, buckets_for
from dayblotter.sources.feed import LandedFeed
from dayblotter.sources.files import read_csv, read_pages
from dayblotter.streaming.runs import IncidentStore
from dayblotter.streaming.upserts import stream_upserts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SQL_FOLDER = Path(__file__).parent / "plans" / "sql"
SPLIT_TIME = "2024-01-21 00:00:00"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- frames ------------------------------------------------------------------------------------


def keyed_spec(
    spark: SparkSession, sf_dir: str, name: str, keys: tuple[str, ...], newest: tuple[str, ...]
) -> TableSpec:
    """A keyed table of the rows of a test table, with buckets to suit its size."""
    buckets = buckets_for(stored_bytes(spark, f"{sf_dir}/{name}.parquet"))
    return TableSpec(name, table(spark, sf_dir, name).schema, keys, newest, buckets)


def event_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("crime_id"),
        F.col("ts").alias("date_of_occurrence"),
        F.col("event_type").alias("primary_description"),
        F.col("user_id").alias("beat"),
    )


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("crime_id"),
        F.col("o_orderdate").alias("date_of_occurrence"),
        F.col("o_orderpriority").alias("primary_description"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("arrest"),
        F.col("o_custkey").alias("beat"),
    )


def ward_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted by nation of the customer and by priority.

    Counted per customer first: the join then meets a handful of rows per customer, even if one
    customer placed a third of all orders.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("ward"))
    per_customer = ranking.count_by(
        order_incidents(spark, sf_dir), ["beat", "primary_description"], "crime_id"
    )
    return (
        per_customer.join(customers, F.col("beat") == F.col("c_custkey"))
        .groupBy("ward", "primary_description")
        .agg(F.sum("n").alias("n"))
    )


def nation_wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ward"), F.col("n_name").alias("alderman")
    )


def nation_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.cast("string").alias("district"),
        F.col("n_name").alias("district_name"),
        F.concat(F.lit("STATION "), key).alias("address"),
        (F.lit(60600) + key).alias("zip"),
        F.concat(F.lit("555-01"), F.lpad(key.cast("string"), 2, "0")).alias("phone"),
    )


def order_calendar(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """From the first to the last order.

    The span is that of the counts by day, which the queries on this calendar make anyway: orders are
    scanned and shuffled once for both. For Spark to see that they are the same, the counts have to be
    used here, and a query that leaves out orders without a date has to ask for `dated`.
    """
    days = views.daily_counts(order_incidents(spark, sf_dir)).where("n > 0")
    if dated:
        days = days.where("date is not null")
    ends = days.agg(F.min("date").alias("begin"), F.max("date").alias("end"))
    return calendar(days_between(ends, "begin", "end"), known_holidays(spark))


def holiday_calendar(spark: SparkSession) -> DataFrame:
    return calendar_for(
        spark, fixed_values.CALENDAR_BEGIN, fixed_values.CALENDAR_END, known_holidays(spark)
    )


def raw_feed(events: DataFrame, corrected: bool) -> DataFrame:
    """Events as the feed would send them. `corrected` sends errors changed, 60 days later."""
    is_correction = (F.col("event_type") == "error") & F.lit(corrected)
    day, hour = F.expr("INTERVAL 60 DAYS"), F.expr("INTERVAL 1 HOUR")
    texts = {
        "occurred": dates.millisecond_text(F.col("ts")),
        "updated": dates.millisecond_text(F.col("ts") + F.when(is_correction, day).otherwise(hour)),
        "arrested": F.when(is_correction, "Y").otherwise("N"),
    }
    user = "cast(user_id as string)"
    coordinate = "cast(value as string)"
    sent = {
        ":id": "concat('row-', event_id)",
        ":created_at": "concat(occurred, 'Z')",
        ":updated_at": "concat(updated, 'Z')",
        ":version": "concat('rv-', event_id)",
        "case_": "concat('EV', event_id)",
        "date_of_occurrence": "occurred",
        "block": "concat(user_id, 'XX STREET')",
        "_iucr": "get_json_object(props, '$.k')",
        "_primary_decsription": "event_type",
        "_secondary_description": "upper(event_type)",
        "_location_description": "'STREET'",
        "arrest": "arrested",
        "domestic": "'N'",
        "ward": "cast(pmod(user_id, 50) + 1 as string)",
        "fbi_cd": "'14'",
        "latitude": coordinate,
        "longitude": coordinate,
        "location": f"struct({coordinate} as latitude, {coordinate} as longitude, 'none' as human_address)",
    }
    return events.withColumns(texts).selectExpr(
        *[f"{sent.get(name, user)} as `{name}`" for name in RAW_FEED.names]
    )


def with_utc_stamps(incidents: DataFrame) -> DataFrame:
    return incidents.withColumns(
        {name: dates.utc_wall_clock(F.col(name)) for name in ("created_at", "updated_at")}
    )


# --- the six views -----------------------------------------------------------------------------


@query
def ward_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.summarise_wards(ward_counts(spark, sf_dir), nation_wards(spark, sf_dir))


@query
def station_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.station_rank(order_incidents(spark, sf_dir), nation_stations(spark, sf_dir))


@query
def monthly_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.monthly_growth(order_incidents(spark, sf_dir), order_calendar(spark, sf_dir, dated=True))


@query
def holiday_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.holiday_mean(event_incidents(spark, sf_dir), holiday_calendar(spark))


@query
def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.incident_time_of_day(event_incidents(spark, sf_dir))


@query
def incident_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.incident_calendar(event_incidents(spark, sf_dir), holiday_calendar(spark))


@query
def incident_calendar_older_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.incident_calendar(
        event_incidents(spark, sf_dir), holiday_calendar(spark), weekday_as_month_name=True
    )


@query
def holiday_mean_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.holiday_mean(
        event_incidents(spark, sf_dir), holiday_calendar(spark), include_zero_days=True
    )


@query
def view_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views by name, and a user's SQL text on top; customers are dealt out over the wards."""
    registry.register_views(
        order_incidents(spark, sf_dir).withColumn("ward", F.pmod("beat", F.lit(25))),
        order_calendar(spark, sf_dir),
        nation_stations(spark, sf_dir),
        nation_wards(spark, sf_dir),
    )
    registry.register_sql_folder(spark, SQL_FOLDER)
    return spark.table("arrests_by_type")


@query
def view_registry_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six views read from the catalog, over tables that are declared there."""
    folder = new_folder(spark, "catalog")
    frames = [
        (CALENDAR_TABLE, order_calendar(spark, sf_dir)),
        (STATION_TABLE, nation_stations(spark, sf_dir)),
        (WARD_TABLE, nation_wards(spark, sf_dir)),
    ]
    for spec, frame in frames:
        columns.conform(frame, spec.schema).write.parquet(f"{folder}/{spec.name}")
        declare_table(spark, spec, f"{folder}/{spec.name}", replace=True)
    incidents = order_incidents(spark, sf_dir).withColumn("ward", F.pmod("beat", F.lit(25)).cast("int"))
    spec = replace(INCIDENT_TABLE, name="crime_data", schema=incidents.schema, newest=())
    incidents.write.parquet(f"{folder}/crime_data")
    declare_table(spark, spec, f"{folder}/crime_data", replace=True)
    registry.create_catalog_views(spark)
    shown = {
        "crime_data_with_calendar_days_holidays": (
            "crime_id", "year * 10000 + month * 100 + day",
            "concat_ws(' ', month_name, day_of_week_name, day_of_week, holiday_name)",
        ),
        "crime_data_with_time_of_day": ("crime_id", "beat", "time_of_day"),
        "crime_growth_by_month": ("calendar_year * 100 + calendar_month", "crime_amount", "crime_growth"),
        "holiday_vs_non_holiday_crimes": ("0", "round(100 * average_crimes_count)", "holiday"),
        "police_rank_by_arrest": (
            "district", "total_arrests * 1000 + arrest_total_rank", "concat_ws(' ', district_name, arrest_ratio_rank, total_crimes_rank, arrest_percentage)",
        ),
        "ward_crimes_summary": (
            "ward", "dist_total_crimes * 1000 + dist_total_crimes_rank",
            "concat_ws(' ', alderman, dist_most_popular_crime, dist_second_most_popular_crime)",
        ),
    }
    rows = [
        spark.table(name).selectExpr(
            f"'{name}' as view", f"cast({key} as bigint) as row_key", f"cast({number} as bigint) as number", f"{text} as shown"
        )
        for name, (key, number, text) in shown.items()
    ]
    return reduce(DataFrame.unionAll, rows)


# --- questions ---------------------------------------------------------------------------------


@query
def q_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.busiest_weekday(order_incidents(spark, sf_dir), order_calendar(spark, sf_dir))


@query
def q_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.busiest_month(order_incidents(spark, sf_dir), order_calendar(spark, sf_dir))


@query
def q_time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.busiest_time_of_day(event_incidents(spark, sf_dir))


@query
def q_holiday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.holidays_by_count(event_incidents(spark, sf_dir), holiday_calendar(spark))


@query
def q_beat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.beats_by_type(event_incidents(spark, sf_dir), ["error", "purchase"])


@query
def q_district_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.districts_by_type(order_incidents(spark, sf_dir), nation_stations(spark, sf_dir))


# --- calendar and time -------------------------------------------------------------------------


@query
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first order to the last event."""
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("ts"))
    ends = days.union(table(spark, sf_dir, "events").select("ts")).agg(
        F.min("ts").alias("begin"), F.max("ts").alias("end")
    )
    return calendar(days_between(ends, "begin", "end"), known_holidays(spark))


@query
def time_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    pieces = timeranges.split_span(ends, "first", "last", fixed_values.BACKFILL_DAYS)
    return pieces.withColumns(
        {
            "start_text": dates.millisecond_text(F.col("start_time")),
            "end_text": dates.millisecond_text(F.col("end_time")),
        }
    )


@query
def backfill_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every window of a backfill would load."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts")).scalar(), events.agg(F.max("ts")).scalar()
    piece = timeranges.piece_number(F.col("ts"), first, last, fixed_values.BACKFILL_DAYS)
    return events.groupBy(piece.alias("piece")).agg(
        F.count("event_id").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query
def window_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    inside = timeranges.within(
        F.col("ts"),
        F.lit("2024-01-08 00:00:00").cast("timestamp_ntz"),
        F.lit("2024-01-14 23:59:59.999").cast("timestamp_ntz"),
    )
    return events.where(inside).select("event_id", "ts", "event_type")


@query
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and numbers of each order's day, and its long text read back."""
    day = F.to_date("o_orderdate")
    text = dates.long_date_text(day)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        dates.month_label(day).alias("month_name"),
        dates.weekday_number(day).alias("day_of_week"),
        dates.weekday_label(day).alias("day_of_week_name"),
        text.alias("long_text"),
        dates.parse_long_date(text).alias("parsed"),
    )


@query
def time_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Millisecond text of each event, read back as wall clock and as instant."""
    ts = F.col("ts")
    text = dates.millisecond_text(ts)
    zoned = F.concat(text, F.lit("Z"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.hour(ts).alias("hour"),
        text.alias("ms_text"),
        F.left(zoned, F.length(zoned) - 1).alias("without_zone"),
        dates.parse_wall_clock(text).alias("wall_clock"),
        dates.utc_wall_clock(dates.parse_instant(zoned)).alias("utc"),
        dates.millisecond_text(dates.parse_wall_clock(text) + F.expr("INTERVAL '0.001' SECOND")).alias(
            "next_ms_text"
        ),
    )


# --- numbers and ranks -------------------------------------------------------------------------


@query
def percent_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = numbers.basis_points(F.col("o_orderkey") - F.col("o_custkey"), F.col("o_custkey") + 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        numbers.percent_text(points).alias("change_text"),
        numbers.hundredths(points).cast("double").alias("change_percent"),
        numbers.truncated_quotient(F.lit(10000) * F.col("o_custkey"), F.col("o_orderkey") + 1).alias("share"),
    )


@query
def district_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    district = views.district_of(F.col("o_custkey")).alias("district")
    return ranking.count_by(table(spark, sf_dir, "orders"), [district], "o_orderkey")


def yearly_priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.count_by(
        table(spark, sf_dir, "orders"),
        [F.year("o_orderdate").alias("order_year"), "o_orderpriority"],
        "o_orderkey",
    )


@query
def lag_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = ranking.count_by(
        table(spark, sf_dir, "orders"),
        [F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")],
        "o_orderkey",
    )
    return ranking.lag_change(months, ["y", "m"], "n")


@query
def dense_rank_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    return yearly_priorities(spark, sf_dir).withColumns(
        {
            "rank_most": ranking.dense_rank_by(n.desc()),
            "rank_fewest": ranking.dense_rank_by(n.asc()),
        }
    )


@query
def first_nth_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_and_second_value(
        yearly_priorities(spark, sf_dir), "order_year", "o_orderpriority", "n"
    )


@query
def top_two_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two commonest kinds of event of every user."""
    counts = ranking.count_by(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id")
    return ranking.top_two(counts, "user_id", "event_type", "n")


@query
def order_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's rank by price, dearest first, and by day, both ways."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price")
    )
    priced = global_windows.dense_rank_rows(orders, "price", descending="price_rank")
    return global_windows.dense_rank_rows(priced, "day", ascending="day_rank", descending="day_rank_back")


@query
def event_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event beside the one before it, and the difference of their values."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    both = global_windows.previous_rows(events, "event_id", ["event_type", "value"])
    return both.withColumn("diff", F.col("value") - F.col("prev_value"))


# --- sources -----------------------------------------------------------------------------------


@query
def feed_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("updated_at", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return incremental.bounds(events, "ts", "updated_at")


@query
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return paging.assign_pages(events, "event_id", fixed_values.PAGE_ROWS)


@query
def page_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page in the middle of the events, by an index of pages that is stored and read again."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    folder = new_folder(spark, "page-index")
    paging.PageIndex.of(events, "event_id").store(events, "event_id", folder)
    index = paging.PageIndex.load(spark, folder)
    return index.page(events, "event_id", fixed_values.PAGE_ROWS, index.rows // fixed_values.PAGE_ROWS // 2)


@query
def feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON pages and read back up to a ceiling; later changes are left for the next read."""
    folder = new_folder(spark, "pages")
    raw_feed(table(spark, sf_dir, "events"), corrected=True).write.option("maxRecordsPerFile", 100000).json(folder)
    feed = LandedFeed.landed(spark, folder, arrays=False)
    start, end = feed.bounds("date_of_occurrence")
    rows = feed.between("date_of_occurrence", start, end, f"{SPLIT_TIME.replace(' ', 'T')}.000")
    return with_utc_stamps(incidents_from_feed(rows))


@query
def feed_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = raw_feed(table(spark, sf_dir, "events"), corrected=False)
    return with_utc_stamps(incidents_from_feed(feed))


@query
def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed landed as JSON and read back under its declared schema."""
    folder = new_folder(spark, "pages")
    feed = raw_feed(table(spark, sf_dir, "events"), corrected=False)
    feed.write.option("maxRecordsPerFile", 100000).json(folder)
    return with_utc_stamps(incidents_from_feed(read_pages(spark, folder, RAW_FEED, arrays=False)))


@query
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int, absent string").alias("props")
    )
    return columns.flatten_structs(events, separator="_")


CUSTOMER_FILE = struct(
    "cust_key bigint, full_name string, nation_key int, acct_bal double, mkt_segment string"
)


def write_customer_files(customers: DataFrame, folder: str, backwards: bool = False) -> None:
    """Headers with capitals and spaces; names with line breaks, quotes and commas."""
    named = customers.select(
        F.col("c_custkey").alias("CUST KEY"),
        F.concat("c_name", F.lit('\n"of", '), "c_mktsegment").alias("Full Name"),
        F.col("c_nationkey").alias("NATION KEY"),
        F.col("c_acctbal").alias("ACCT BAL"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "N/A").otherwise(F.col("c_mktsegment")).alias("MKT SEGMENT"),
    )
    order = named.columns[::-1] if backwards else named.columns
    named.select(*order).write.option("header", True).option("escape", '"').csv(folder)


@query
def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "csv")
    write_customer_files(table(spark, sf_dir, "customer"), folder)
    return read_csv(spark, folder, CUSTOMER_FILE)


@query
def csv_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns come in another order, stacked by name."""
    customers = table(spark, sf_dir, "customer")
    folders = [new_folder(spark, "csv") for _ in range(2)]
    write_customer_files(customers.where("c_acctbal < 0"), folders[0])
    write_customer_files(customers.where("c_acctbal >= 0"), folders[1], backwards=True)
    return read_csv(spark, folders, CUSTOMER_FILE)


LINE_FILE = struct(
    "order_key bigint, line_number int, ship_date timestamp_ntz, extended_price double, note string"
)
LINE_RANGE = 1 << 20


@query
def csv_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in CSV files of many ranges, with line breaks within quotes."""
    folder = new_folder(spark, "csv")
    table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ORDER KEY"),
        F.col("l_linenumber").alias("LINE NUMBER"),
        F.col("l_shipdate").alias("SHIP DATE"),
        F.col("l_extendedprice").alias("EXTENDED PRICE"),
        F.concat(F.lit('by "'), "l_returnflag", F.lit('",\nto '), "l_linestatus").alias("NOTE"),
    ).write.option("header", True).option("escape", '"').csv(folder)
    return read_csv(spark, folder, LINE_FILE, range_bytes=LINE_RANGE)


# --- sinks and increments ----------------------------------------------------------------------


@query
def missing_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return columns.missing_to_null(
        table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    )


def order_changes(orders: DataFrame) -> DataFrame:
    """Pending orders finished two days later, sent twice; one new order for each finished one.

    Open orders come with an older date, which must not replace what is stored.
    """
    pending = orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F"))
    open_orders = orders.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("X"))
    new = orders.where("o_orderstatus = 'F'").withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit("N")}
    )

    def moved(df: DataFrame, days: int) -> DataFrame:
        return df.withColumn("o_orderdate", F.col("o_orderdate") + F.make_dt_interval(F.lit(days)))

    first = moved(pending, 1).withColumn("o_totalprice", F.lit(0.0))
    return first.union(moved(pending, 2)).union(moved(open_orders, -1)).union(new)


@query
def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return upsert.merge_latest(orders, order_changes(orders), ["o_orderkey"], ["o_orderdate"])


@query
def merge_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the merge above, but a change wins over what is stored even when it is older."""
    orders = table(spark, sf_dir, "orders")
    return upsert.merge_latest(
        orders, order_changes(orders), ["o_orderkey"], ["o_orderdate"], stale="replace"
    )


@query
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge on a stored table."""
    orders = table(spark, sf_dir, "orders")
    spec = keyed_spec(spark, sf_dir, "orders", ("o_orderkey",), ("o_orderdate",))
    stored = KeyedTable(spark, new_folder(spark, "orders"), spec).create()
    stored.upsert(orders)
    stored.upsert(order_changes(orders))
    return stored.read()


@query
def incremental_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    stored = events.where(F.col("ts") < F.lit(SPLIT_TIME).cast("timestamp_ntz"))
    mark = incremental.high_water(stored, "ts")
    return incremental.changed_since(events, "ts", mark).select("event_id", "ts", "event_type")


@query
def store_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill, then a later run that brings in new and corrected incidents."""
    events = table(spark, sf_dir, "events")
    buckets = buckets_for(stored_bytes(spark, f"{sf_dir}/events.parquet"))
    store = IncidentStore(spark, new_folder(spark, "store"), replace(INCIDENT_TABLE, buckets=buckets))
    earlier = events.where(F.col("ts") < F.lit(SPLIT_TIME).cast("timestamp_ntz"))
    store.refresh(LandedFeed(raw_feed(earlier, corrected=False)))
    store.refresh(LandedFeed(raw_feed(events, corrected=True)))
    return with_utc_stamps(store.incidents.read())


@query
def store_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One week of the incidents of a store that has changes beside its backfill."""
    events = table(spark, sf_dir, "events")
    buckets = buckets_for(stored_bytes(spark, f"{sf_dir}/events.parquet"))
    stored = KeyedTable(spark, new_folder(spark, "store"), replace(INCIDENT_TABLE, buckets=buckets), compact_share=1.0).create()
    earlier = events.where(F.col("ts") < F.lit(SPLIT_TIME).cast("timestamp_ntz"))
    stored.upsert(incidents_from_feed(raw_feed(earlier, corrected=False)))
    changed = raw_feed(events.where("event_type = 'error'"), corrected=True)
    stored.upsert(incidents_from_feed(changed.unionByName(raw_feed(events.where(F.col("ts") >= F.lit(SPLIT_TIME).cast("timestamp_ntz")), corrected=False))))
    start, end = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-15 00:00:00", "2024-01-21 23:59:59.999"))
    return with_utc_stamps(stored.read_window(start, end))


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of event files keeps the newest event of every user and kind."""
    spec = keyed_spec(spark, sf_dir, "events", ("user_id", "event_type"), ("ts", "event_id"))
    folder = new_folder(spark, "stream")
    newest = KeyedTable(spark, f"{folder}/events", spec)
    # As a glob the path may name one file as well as a folder of files.
    files = f"{sf_dir}/events.parque[t]"
    changes = spark.readStream.schema(spec.schema).option("maxFilesPerTrigger", 1000).parquet(files)
    stream_upserts(changes, newest, f"{folder}/checkpoint", interval=None).awaitTermination()
    return newest.read()


@query
def load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that is there is not loaded again."""
    customers = table(spark, sf_dir, "customer")
    spec = TableSpec("customer", customers.schema, ("c_custkey",))
    store = IncidentStore(spark, new_folder(spark, "store"))
    store.load_once(spec, lambda: customers)
    return store.load_once(spec, lambda: customers.withColumn("c_name", F.lit("again")))


@query
def audit_next_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as past runs."""
    return incremental.next_number(table(spark, sf_dir, "orders"), "o_orderkey", "next_run_id")


@query
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as runs, those in debt as failed ones: what was recorded, all but the times."""
    log = RunLog(spark, f"{new_folder(spark, 'store')}/logs", "customers", {"days": fixed_values.BACKFILL_DAYS})
    runs = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).cast("int").alias("run_id"), "c_acctbal", "c_name")
    failed = F.col("c_acctbal") < 0
    log.record_all(runs.select("run_id", F.lit("start").alias("status")))
    log.record_all(
        runs.select(
            "run_id",
            F.when(failed, "fail").otherwise("success").alias("status"),
            F.when(failed, F.col("c_name")).alias("logs"),
        )
    )
    return log.read().withColumn("has_time", F.col("timestamp").isNotNull()).drop("timestamp")
