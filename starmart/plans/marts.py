"""Aggregate facts and data marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import activity_segment, date_from_key, key_of, month_key, percentage, ratio
from starmart.operators.ordered import rank_within
from starmart.operators.parts import Measures, distinct_count
from starmart.plans.analytics import by_date, by_minute, completed, since
from starmart.session import stage
from starmart.sources.writers import replace_partitions, write_sorted

RECENT_DAYS = 30
# Defaults of the segmentation mart.
NO_ROUTE, NEVER_DAYS = "N/A", 9999

ROUTE_COLUMNS = ["route_id", "route_number", "route_name", "transport_type"]


def _avg_minutes() -> Column:
    return ratio(F.sum("duration_minutes"), F.count("duration_minutes"))


def _recent(fact: DataFrame, as_of: dt.date, days: int = RECENT_DAYS) -> DataFrame:
    return since(fact, as_of - dt.timedelta(days=days))


def popular_routes(fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, as_of: dt.date) -> DataFrame:
    """Recent completed trips per route.

    Grouped by route_id over all its versions; names come from the current one,
    so a tariff change inside the window does not split a route.
    """
    ids = dim_route.select("route_key", "route_id")
    names = dim_route.where("is_current").select(*ROUTE_COLUMNS)
    return (
        by_date(_recent(fact.where(completed()), as_of), dim_date.select("date_key"))
        .join(ids, "route_key")
        .groupBy("route_id")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.count_distinct("user_key").alias("unique_passengers"),
            F.sum("actual_fare").alias("total_revenue"),
            _avg_minutes().alias("avg_duration_minutes"),
            ratio(F.sum("distance_km"), F.count("distance_km")).alias("avg_distance_km"),
        )
        .join(names, "route_id")
        .orderBy(F.col("total_trips").desc(), "route_id")
    )


def route_hourly_stats(fact: DataFrame, dim_time: DataFrame, first_date_key: int, last_date_key: int) -> DataFrame:
    """Aggregate fact route x date x hour for a range of days."""
    days = F.col("start_date_key").between(first_date_key, last_date_key)
    return (
        by_minute(fact.where(completed() & days), dim_time.select("time_key", "hour"))
        .groupBy("route_key", F.col("start_date_key").alias("date_key"), "hour")
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.count_distinct("user_key").alias("total_passengers"),
            F.sum("distance_km").alias("total_distance_km"),
            F.sum("actual_fare").alias("total_revenue"),
            _avg_minutes().alias("avg_trip_duration_minutes"),
        )
    )


def refresh_route_hourly(stats: DataFrame, path: str) -> None:
    """Upsert on the grain: whole recomputed days replace the stored ones."""
    replace_partitions(stats.withColumn("month_key", month_key("date_key")), path, ["month_key", "date_key"], ["route_key", "hour"])


def route_hour_vehicle_stats(pings: DataFrame, occupancy: DataFrame) -> DataFrame:
    """Speed, occupancy level and active vehicles per route and hour."""
    levels = occupancy.select(F.col("occupancy_code").alias("occupancy"), "occupancy_level")
    return (
        pings.join(F.broadcast(levels), "occupancy", "left")  # 7 rows
        .groupBy("route_id", F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour"))
        .agg(
            ratio(F.sum("speed"), F.count("speed")).alias("avg_speed"),
            ratio(F.sum("occupancy_level"), F.count("occupancy_level")).alias("avg_occupancy_level"),
            F.count_distinct("vehicle_id").alias("active_vehicles_count"),
        )
    )


def user_daily_stats(fact: DataFrame) -> DataFrame:
    return (
        fact.where(completed())
        .groupBy("user_key", F.col("start_date_key").alias("date_key"))
        .agg(
            F.count(F.lit(1)).alias("trips_count"),
            F.sum("distance_km").alias("total_distance_km"),
            F.sum("actual_fare").alias("total_spent"),
            F.count_distinct("route_key").alias("unique_routes_count"),
            _avg_minutes().alias("avg_trip_duration_minutes"),
        )
    )


#: Grain and measures of the route-hour mart when it is kept in parts.
ROUTE_HOUR = Measures(
    keys=(*ROUTE_COLUMNS, "date", "hour"),
    sums={
        "total_trips": "count(1)",
        "total_distance_km": "sum(distance_km)",
        "minutes": "sum(duration_minutes)",
        "timed_trips": "count(duration_minutes)",
        "total_revenue": "sum(actual_fare)",
        "priced_trips": "count(actual_fare)",
    },
    distinct={"passengers": "user_key"},
)


def route_hour_rows(
    fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, dim_time: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Completed trips with route, date and hour; with ``as_of`` the recent ones only."""
    done = fact.where(completed())
    if as_of:
        done = _recent(done, as_of)
    dated = by_minute(by_date(done, dim_date.select("date_key", "date")), dim_time.select("time_key", "hour"))
    return dated.join(dim_route.select("route_key", *ROUTE_COLUMNS), "route_key")


def route_hourly(
    fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, dim_time: DataFrame, as_of: dt.date
) -> DataFrame:
    return route_hour_rows(fact, dim_route, dim_date, dim_time, as_of).groupBy(*ROUTE_HOUR.keys).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.count_distinct("user_key").alias("unique_passengers"),
        F.sum("distance_km").alias("total_distance_km"),
        _avg_minutes().alias("avg_trip_duration_minutes"),
        F.sum("actual_fare").alias("total_revenue"),
        ratio(F.sum("actual_fare"), F.count("actual_fare")).alias("avg_fare"),
    )


def route_hourly_from_parts(parts: DataFrame) -> DataFrame:
    """The route-hour mart from merged parts; distinct passengers within the sketches' error."""
    return parts.select(
        *ROUTE_HOUR.keys,
        "total_trips",
        distinct_count("passengers").alias("unique_passengers"),
        "total_distance_km",
        ratio(F.col("minutes"), F.col("timed_trips")).alias("avg_trip_duration_minutes"),
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("priced_trips")).alias("avg_fare"),
    )


def station_popularity(
    fact: DataFrame, dim_station: DataFrame, dim_date: DataFrame, as_of: dt.date, how: str = "left"
) -> DataFrame:
    """Departures against arrivals per station and day.

    ``how="left"`` reports days with departures only, ``"full_outer"`` also days
    with arrivals alone.  ``unique_users`` is the larger of both sides' distinct
    users; ``unique_users_exact`` counts users of either side once.
    """
    trips = by_date(_recent(fact.where(completed()), as_of), dim_date.select("date_key", "date"))
    # Both roles of a trip in one pass, then one row per (station, day, user).
    ends = trips.select(
        "date",
        "user_key",
        F.inline(
            F.array(
                F.struct(F.col("start_station_key").alias("station_key"), F.lit(1).alias("dep"), F.lit(0).alias("arr")),
                F.struct(F.col("end_station_key").alias("station_key"), F.lit(0).alias("dep"), F.lit(1).alias("arr")),
            )
        ),
    ).where(F.col("station_key").isNotNull())
    per_user = ends.groupBy("station_key", "date", "user_key").agg(F.sum("dep").alias("dep"), F.sum("arr").alias("arr"))
    per_day = per_user.groupBy("station_key", "date").agg(
        F.sum("dep").alias("departures_count"),
        F.sum("arr").alias("arrivals_count"),
        F.greatest(F.count_if(F.col("dep") > 0), F.count_if(F.col("arr") > 0)).alias("unique_users"),
        F.count(F.lit(1)).alias("unique_users_exact"),
    )
    if how == "left":
        per_day = per_day.where(F.col("departures_count") > 0)
    elif how != "full_outer":
        raise ValueError(f"unsupported how {how}")
    names = dim_station.select("station_key", "station_id", "station_name", "station_type", "district")
    return per_day.join(names, "station_key").select(
        "station_id", "station_name", "station_type", "district", "date", "departures_count", "arrivals_count",
        (F.col("departures_count") + F.col("arrivals_count")).alias("total_traffic"), "unique_users",
        "unique_users_exact",
    )


#: Grain and measures of the flow mart when it is kept in parts.
FLOW = Measures(
    keys=("date", "hour", "day_of_week", "is_weekend", "is_rush_hour"),
    sums={
        **{f"{kind}_trips": f"count_if(transport_type = '{kind}')" for kind in ("bus", "tram", "metro")},
        "total_trips": "count(1)",
        "total_revenue": "sum(actual_fare)",
        "priced_trips": "count(actual_fare)",
    },
    distinct={"passengers": "user_key"},
)

#: The same in rows for each passenger, whose number is then exact.
FLOW_BY_PASSENGER = Measures(keys=(*FLOW.keys, "user_key"), sums=FLOW.sums, distinct={})


def _flow_rows(fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "date", "day_of_week", "is_weekend")
    minutes = dim_time.select("time_key", "hour", "is_rush_hour")
    rows = by_minute(by_date(fact.where(completed()), days), minutes)
    return rows.join(dim_route.select("route_key", "transport_type"), "route_key")


def _flow(measured: DataFrame) -> DataFrame:
    average = ratio(F.col("total_revenue"), F.col("priced_trips"))
    flags = {c: F.col(c).cast("int") for c in ("is_weekend", "is_rush_hour")}
    kinds = ["bus_trips", "tram_trips", "metro_trips", "total_trips", "total_revenue"]
    return measured.select(*FLOW.keys, *kinds, average.alias("avg_revenue_per_trip"), "unique_passengers").withColumns(flags)


def passenger_flow_by_hour(
    fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, dim_time: DataFrame, as_of: dt.date
) -> DataFrame:
    """Recent trips per date and hour, with exact distinct passengers."""
    rows = _flow_rows(_recent(fact, as_of), dim_route, dim_date, dim_time)
    sums = [F.expr(a).alias(c) for c, a in FLOW.sums.items()]
    return _flow(rows.groupBy(*FLOW.keys).agg(*sums, F.count_distinct("user_key").alias("unique_passengers")))


def flow_parts(
    fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, dim_time: DataFrame, part: Column | None = None, exact: bool = False
) -> DataFrame:
    """Flow rows of all days in mergeable parts; ``part`` names the load that a trip came with.

    With ``exact`` a part has a row for each passenger of an hour instead of a sketch of them.
    """
    rows = _flow_rows(fact, dim_route, dim_date, dim_time)
    flow = FLOW_BY_PASSENGER if exact else FLOW
    if part is None:
        return flow.partial(rows)
    by_part = Measures(("part", *flow.keys), flow.sums, flow.distinct)
    return by_part.partial(rows.withColumn("part", part)).drop("part")


def collapse_flow(parts: DataFrame) -> DataFrame:
    """Summing merge of flow rows loaded in parts: additive columns are summed per (date, hour),
    the average derived again.  Distinct passengers are exact if the parts have a row for each;
    if they have sketches, those are united: within 1.6 % (one standard error), and exact for
    the small counts of most hours.
    """
    if "user_key" in parts.columns:
        once = FLOW_BY_PASSENGER.merge(parts)
        sums = [F.sum(c).cast(once.schema[c].dataType).alias(c) for c in FLOW.sums]
        return _flow(once.groupBy(*FLOW.keys).agg(*sums, F.count("user_key").alias("unique_passengers")))
    return _flow(FLOW.merge(parts).withColumn("unique_passengers", distinct_count("passengers")))


def user_segmentation(fact: DataFrame, dim_user: DataFrame, dim_route: DataFrame, as_of: dt.date) -> DataFrame:
    """Activity segment, lifetime measures and favourite route of every user.

    Trips are reduced to (user, route) once; the favourite is the maximum of
    those rows (ties: smallest route id), so no window holds a user's routes.
    """
    recent = F.col("start_date_key") >= key_of(as_of - dt.timedelta(days=RECENT_DAYS))
    zero = F.lit(0).cast("decimal(10,2)")
    per_route = (
        fact.where(completed())
        .join(dim_route.select("route_key", "route_id"), "route_key", "left")
        .groupBy("user_key", "route_id")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("actual_fare").alias("spent"),
            F.count_if(recent).alias("trips_30"),
            F.sum(F.when(recent, F.col("actual_fare")).otherwise(zero)).alias("spent_30"),
            F.max("start_date_key").alias("last_day"),
        )
    )
    # One row for each number of trips first: of routes used equally often the smallest id, whatever its type.
    known = F.col("route_id").isNotNull()
    by_trips = per_route.groupBy("user_key", "trips", known.alias("known")).agg(
        F.min("route_id").alias("route_id"),
        *[F.sum(c).alias(c) for c in ("spent", "trips_30", "spent_30")],
        F.max("last_day").alias("last_day"),
        F.count(F.lit(1)).alias("routes"),
    )
    favourite = F.when(F.col("known"), F.struct(F.col("trips").alias("n"), F.col("route_id").alias("r")))
    per_user = by_trips.groupBy("user_key").agg(
        F.sum("trips_30").alias("trips_last_30d"),
        F.sum("spent_30").alias("total_spent_last_30d"),
        F.sum(F.col("trips") * F.col("routes")).alias("trips_total"),
        F.sum("spent").alias("total_spent_total"),
        date_from_key(F.max("last_day")).alias("last_trip_date"),
        F.max(favourite).alias("fav"),
    )
    out = dim_user.select("user_key", "user_id", "username", "registration_date").join(per_user, "user_key", "left")
    trips_30 = F.coalesce("trips_last_30d", F.lit(0))
    return out.select(
        "user_id",
        "username",
        "registration_date",
        activity_segment(trips_30).alias("user_segment"),
        trips_30.alias("trips_last_30d"),
        F.coalesce("total_spent_last_30d", zero).alias("total_spent_last_30d"),
        (trips_30 / F.lit(4)).cast("decimal(6,2)").alias("avg_trips_per_week"),
        F.coalesce("trips_total", F.lit(0)).alias("trips_total"),
        "total_spent_total",
        F.coalesce(F.col("fav")["r"].cast("string"), F.lit(NO_ROUTE)).alias("favorite_route_id"),
        F.coalesce(F.col("fav")["n"], F.lit(0)).alias("favorite_route_trips"),
        "last_trip_date",
        F.coalesce(F.datediff(F.lit(as_of), "last_trip_date"), F.lit(NEVER_DAYS)).alias("days_since_last_trip"),
    )


def route_performance(
    fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, as_of: dt.date
) -> DataFrame:
    """Daily route KPIs over trips of all statuses, with a popularity rank per day."""
    status = F.col("trip_status")
    metrics = (
        by_date(_recent(fact, as_of), dim_date.select("date_key", "date"))
        .join(dim_route.select("route_key", *ROUTE_COLUMNS), "route_key")
        .groupBy(*ROUTE_COLUMNS, "date")
        .agg(
            F.sum("actual_fare").alias("total_revenue"),
            F.count(F.lit(1)).alias("total_trips"),
            F.sum("distance_km").alias("total_distance_km"),
            _avg_minutes().alias("avg_trip_duration_minutes"),
            F.count_distinct("vehicle_key").alias("active_vehicles_count"),
            F.count_if(status == "completed").alias("_done"),
            F.count_if(status == "cancelled").alias("_cancelled"),
        )
    )

    def guarded(amount: Column, by: Column) -> Column:
        return F.when(by > 0, ratio(amount, by)).otherwise(F.lit(0.0))

    revenue, trips = F.col("total_revenue"), F.col("total_trips")
    kpis = metrics.select(
        *ROUTE_COLUMNS,
        "date",
        "total_revenue",
        guarded(revenue, F.col("total_distance_km")).alias("revenue_per_km"),
        guarded(revenue, F.col("active_vehicles_count")).alias("revenue_per_vehicle"),
        "total_trips",
        "total_distance_km",
        "avg_trip_duration_minutes",
        "active_vehicles_count",
        percentage(F.col("_done"), trips).alias("completion_rate"),
        percentage(F.col("_cancelled"), trips).alias("cancellation_rate"),
    )
    return rank_within(kpis, ["date"], [trips.desc(), F.col("route_id")], "popularity_rank")


def speed_analysis(pings: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Speed statistics per route, date and hour with an exact median.

    Readings are counted per distinct speed first: speeds have two digits, so a
    group holds at most its value range, and the weighted median is exact.
    """
    keys = ["route_id", "date", "hour"]
    counted = pings.groupBy("route_id", F.col("ts").cast("date").alias("date"), F.hour("ts").alias("hour"), "speed").agg(
        F.count(F.lit(1)).alias("n")
    )
    stats = counted.groupBy(*keys).agg(
        ratio(F.sum(F.col("speed") * F.col("n")), F.sum("n")).alias("avg_speed"),
        F.max("speed").alias("max_speed"),
        F.min("speed").alias("min_speed"),
        F.round(F.percentile("speed", 0.5, F.col("n")), 6).alias("median_speed"),
        F.sum("n").alias("measurements_count"),
    )
    names = dim_route.where("is_current").select("route_id", "route_number", "transport_type")
    return stats.join(names, "route_id", "left")


def mart_top_revenue(mart: DataFrame, as_of: dt.date, days: int = 30, k: int = 10) -> DataFrame:
    return (
        mart.where(F.col("date") >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy("route_number", "route_name")
        .agg(F.sum("total_revenue").alias("revenue"), F.sum("total_trips").alias("trips"))
        .orderBy(F.col("revenue").desc(), "route_number", "route_name")
        .limit(k)
    )


def mart_hourly_averages(mart: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    def mean(c: str) -> Column:
        return ratio(F.sum(c), F.count(c))

    return (
        mart.where(F.col("date") >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy("hour")
        .agg(
            mean("total_trips").alias("avg_trips"),
            mean("total_revenue").alias("avg_revenue"),
            mean("unique_passengers").alias("avg_passengers"),
        )
        .orderBy("hour")
    )


def mart_segment_profile(mart: DataFrame) -> DataFrame:
    def mean(c: str) -> Column:
        return ratio(F.sum(c), F.count(c))

    return (
        mart.groupBy("user_segment")
        .agg(
            F.count(F.lit(1)).alias("users_count"),
            mean("trips_last_30d").alias("avg_trips"),
            mean("total_spent_last_30d").alias("avg_spent"),
            mean("days_since_last_trip").alias("avg_days_inactive"),
        )
        .orderBy(F.col("users_count").desc(), "user_segment")
    )


# Storage layout of each mart: (partition columns, sort columns).
LAYOUT = {
    "mart_route_hourly_stats": (["month_key"], ["route_id", "date", "hour"]),
    "mart_station_popularity": (["month_key"], ["date", "total_traffic"]),
    "mart_passenger_flow_by_hour": (["month_key"], ["date", "hour"]),
    "mart_user_segmentation": ([], ["user_id"]),
    "mart_route_performance": (["month_key"], ["date", "total_revenue"]),
}


def write_mart(df: DataFrame, name: str, out_dir: str, updated_at: dt.datetime) -> None:
    """Full refresh of one mart as one distributed write, stamped with the time of the load."""
    partition_by, sort_by = LAYOUT[name]
    df = df.withColumn("updated_at", F.lit(updated_at).cast("timestamp_ntz"))
    if "month_key" in partition_by:
        df = df.withColumn("month_key", F.year("date") * 100 + F.month("date"))
    if partition_by:
        write_sorted(df, f"{out_dir}/{name}", partition_by, sort_by)
    else:
        df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write.mode("overwrite").parquet(f"{out_dir}/{name}")


#: What the marts need of a trip fact.
_MEASURED = [
    "user_key", "route_key", "vehicle_key", "start_date_key", "start_minute_key", "start_station_key", "end_station_key",
    "distance_km", "duration_minutes", "actual_fare", "trip_status",
]


def build_all(
    fact: DataFrame,
    dim_user: DataFrame,
    dim_route: DataFrame,
    dim_station: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
    as_of: dt.date,
    out_dir: str,
    updated_at: dt.datetime,
) -> None:
    """All marts.  The fact is scanned (or computed) once: its columns that marts need are written
    in its own order, so its days stay together and the recent ones are found by min and max.
    """
    star = stage(fact.select(*_MEASURED), "measured-trips")
    for name, mart in {
        "mart_route_hourly_stats": route_hourly(star, dim_route, dim_date, dim_time, as_of),
        "mart_station_popularity": station_popularity(star, dim_station, dim_date, as_of),
        "mart_passenger_flow_by_hour": passenger_flow_by_hour(star, dim_route, dim_date, dim_time, as_of),
        "mart_user_segmentation": user_segmentation(star, dim_user, dim_route, as_of),
        "mart_route_performance": route_performance(star, dim_route, dim_date, as_of),
    }.items():
        write_mart(mart, name, out_dir, updated_at)
