"""Analytic queries over the star.

Facts come in as the trip or transaction fact, dimensions as their tables.
Calendar tables are bounded by the calendar, so they are broadcast; all other
dimensions are left to Spark's size-based choice.  Plain sums and counts are
reduced on the fact's key before the dimension is joined.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import date_from_key, key_of, percentage, ratio
from starmart.operators.ordered import ntile, number_rows

# Report labels.
WEEKEND, WEEKDAY = "Выходные", "Будни"
RUSH, NO_RUSH = "Час пик", "Обычное время"


def completed() -> Column:
    return F.col("trip_status") == "completed"


def totals(*extra: Column) -> list[Column]:
    """Re-aggregable trip totals; ``summed`` adds them up again."""
    return [
        F.count(F.lit(1)).alias("trips"),
        F.sum("actual_fare").alias("fare"),
        F.sum("duration_minutes").alias("minutes"),
        F.count("duration_minutes").alias("timed"),
        F.sum("distance_km").alias("km"),
        F.count("distance_km").alias("measured"),
        *extra,
    ]


def summed() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("trips", "fare", "minutes", "timed", "km", "measured")]


def avg_minutes() -> Column:
    return ratio(F.col("minutes"), F.col("timed"))


def avg_km() -> Column:
    return ratio(F.col("km"), F.col("measured"))


def by_date(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return fact.join(F.broadcast(dim_date), F.col("start_date_key") == F.col("date_key"))


def since(fact: DataFrame, day: dt.date) -> DataFrame:
    """Recent part of a fact, by its own key: unlike a filter on the joined calendar
    this reaches the scan and its partitions."""
    return fact.where(F.col("start_date_key") >= key_of(day))


def by_minute(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    return fact.join(F.broadcast(dim_time), F.col("start_minute_key") == F.col("time_key"))


def top_routes(fact: DataFrame, dim_route: DataFrame, k: int = 10) -> DataFrame:
    per_key = fact.where(completed()).groupBy("route_key").agg(*totals())
    names = ["route_number", "route_name", "transport_type"]
    current = dim_route.where("is_current").select("route_key", *names)
    return (
        per_key.join(current, "route_key")
        .groupBy(*names)
        .agg(*summed())
        .select(*names, F.col("trips").alias("total_trips"), F.col("fare").alias("total_revenue"),
                avg_minutes().alias("avg_duration"))
        .orderBy(F.col("total_trips").desc(), *names)
        .limit(k)
    )


def transport_type_share(fact: DataFrame, dim_route: DataFrame) -> DataFrame:
    per_key = fact.where(completed()).groupBy("route_key").agg(*totals())
    per_type = (
        per_key.join(dim_route.select("route_key", "transport_type"), "route_key").groupBy("transport_type").agg(*summed())
    )
    # One row per transport type, so the whole-set window is a handful of rows.
    whole = Window.partitionBy(F.lit(0))
    return per_type.select(
        "transport_type",
        F.col("trips").alias("trips_count"),
        percentage(F.col("trips"), F.sum("trips").over(whole)).alias("percentage"),
        F.col("fare").alias("revenue"),
    ).orderBy(F.col("trips_count").desc(), "transport_type")


def trips_by_hour(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    per_minute = fact.where(completed()).groupBy("start_minute_key").agg(*totals())
    return (
        by_minute(per_minute, dim_time)
        .groupBy(F.col("hour").alias("hour_of_day"), "time_period", "is_rush_hour")
        .agg(*summed())
        .select("hour_of_day", "time_period", "is_rush_hour", F.col("trips").alias("trips_count"),
                avg_minutes().alias("avg_duration"), F.col("fare").alias("revenue"))
        .orderBy("hour_of_day")
    )


def weekday_weekend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fact.where(completed()).groupBy("start_date_key").agg(*totals())
    return (
        by_date(per_day, dim_date)
        .groupBy("is_weekend")
        .agg(*summed())
        .select(
            F.when(F.col("is_weekend"), WEEKEND).otherwise(WEEKDAY).alias("day_type"),
            F.col("trips").alias("trips_count"),
            avg_minutes().alias("avg_duration"),
            avg_km().alias("avg_distance"),
            F.col("fare").alias("total_revenue"),
        )
        .orderBy("day_type")
    )


def rush_hour_compare(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    return (
        by_minute(fact.where(completed()), dim_time)
        .groupBy("is_rush_hour", "rush_hour_type")
        .agg(
            F.count(F.lit(1)).alias("trips_count"),
            ratio(F.sum("duration_minutes"), F.count("duration_minutes")).alias("avg_duration"),
            F.count_distinct("user_key").alias("unique_passengers"),
        )
        .select(
            F.when(F.col("is_rush_hour"), RUSH).otherwise(NO_RUSH).alias("period_type"),
            "rush_hour_type", "trips_count", "avg_duration", "unique_passengers",
        )
        .orderBy(F.col("trips_count").desc(), F.col("rush_hour_type").asc_nulls_last())
    )


def user_segments(dim_user: DataFrame) -> DataFrame:
    return (
        dim_user.where(F.col("current_status") == "active")
        .groupBy("age_group", "user_segment")
        .agg(
            F.count(F.lit(1)).alias("users_count"),
            ratio(F.sum("current_balance"), F.count("current_balance")).alias("avg_balance"),
        )
        .orderBy("age_group", F.col("users_count").desc(), "user_segment")
    )


def top_users(fact: DataFrame, dim_user: DataFrame, k: int = 10) -> DataFrame:
    # user_id decides ties, so the k rows can be cut before the names are joined.
    best = (
        fact.where(completed())
        .groupBy("user_key")
        .agg(*totals())
        .join(dim_user.select("user_key", "user_id", "username", "user_segment"), "user_key")
        .orderBy(F.col("trips").desc(), "user_id")
        .limit(k)
    )
    return best.select(
        "username", "user_segment", F.col("trips").alias("trips_count"), F.col("fare").alias("total_spent"),
        avg_minutes().alias("avg_trip_duration"),
    )


def payment_methods(fact_transactions: DataFrame, dim_payment_method: DataFrame) -> DataFrame:
    paid = (F.col("transaction_status") == "success") & (F.col("transaction_type") == "payment")
    per_key = (
        fact_transactions.where(paid)
        .groupBy("payment_method_key")
        .agg(F.count(F.lit(1)).alias("transactions_count"), F.sum("amount").alias("total_amount"))
    )
    return (
        per_key.join(F.broadcast(dim_payment_method), "payment_method_key")
        .groupBy("payment_method_name", "payment_category")
        .agg(F.sum("transactions_count").alias("transactions_count"), F.sum("total_amount").alias("total_amount"))
        .withColumn("avg_transaction", ratio(F.col("total_amount"), F.col("transactions_count")))
        .orderBy(F.col("total_amount").desc(), "payment_method_name")
    )


def top_stations(fact: DataFrame, dim_station: DataFrame, k: int = 10) -> DataFrame:
    per_key = fact.where(completed()).groupBy("start_station_key").agg(F.count(F.lit(1)).alias("departures_count"))
    names = dim_station.select("station_key", "station_id", "station_name", "station_type", "district")
    return (
        per_key.join(names, F.col("start_station_key") == F.col("station_key"))
        .orderBy(F.col("departures_count").desc(), "station_id")
        .limit(k)
        .select("station_name", "station_type", "district", "departures_count")
    )


def top_station_pairs(fact: DataFrame, dim_station: DataFrame, k: int = 10) -> DataFrame:
    pairs = (
        fact.where(completed() & (F.col("start_station_key") != F.col("end_station_key")))
        .groupBy("start_station_key", "end_station_key")
        .agg(*totals())
    )

    def role(prefix: str) -> DataFrame:
        return dim_station.select(
            F.col("station_key").alias(f"{prefix}_station_key"),
            F.col("station_id").alias(f"{prefix}_id"),
            F.col("station_name").alias(f"{prefix}_station"),
        )

    return (
        pairs.join(role("start"), "start_station_key")
        .join(role("end"), "end_station_key")
        .orderBy(F.col("trips").desc(), "start_id", "end_id")
        .limit(k)
        .select("start_station", "end_station", F.col("trips").alias("trips_count"),
                avg_minutes().alias("avg_duration"), avg_km().alias("avg_distance"))
    )


def vehicle_type_stats(fact: DataFrame, dim_vehicle: DataFrame) -> DataFrame:
    """Averages as reported weigh a vehicle by its trips (one row when it has none);
    ``*_per_vehicle`` give each vehicle the same weight."""
    per_vehicle = fact.groupBy("vehicle_key").agg(F.count(F.lit(1)).alias("trips"))
    fleet = dim_vehicle.where(F.col("current_status") == "active").join(per_vehicle, "vehicle_key", "left")
    weight = F.coalesce(F.col("trips"), F.lit(1))

    def weighted(c: str) -> Column:
        """Unknown values weigh nothing."""
        return ratio(F.sum(F.col(c) * weight), F.sum(F.when(F.col(c).isNotNull(), weight)))

    return (
        fleet.groupBy("vehicle_type")
        .agg(
            F.count(F.lit(1)).alias("vehicles_count"),
            weighted("vehicle_age").alias("avg_age"),
            weighted("capacity").alias("avg_capacity"),
            ratio(F.sum("vehicle_age"), F.count("vehicle_age")).alias("avg_age_per_vehicle"),
            ratio(F.sum("capacity"), F.count("capacity")).alias("avg_capacity_per_vehicle"),
            F.coalesce(F.sum("trips"), F.lit(0)).alias("total_trips"),
        )
        .orderBy(F.col("vehicles_count").desc(), "vehicle_type")
    )


def busiest_vehicles(fact: DataFrame, dim_vehicle: DataFrame, dim_route: DataFrame, k: int = 10) -> DataFrame:
    per_vehicle = fact.where(completed()).groupBy("vehicle_key").agg(F.count(F.lit(1)).alias("trips_count"))
    current = dim_route.where("is_current").select(F.col("route_id").alias("current_route_id"), "route_number")
    return (
        per_vehicle.join(dim_vehicle, "vehicle_key")
        .join(current, "current_route_id")
        .select("vehicle_id", "vehicle_type", "route_number", "trips_count", "manufacture_year", "vehicle_age")
        .orderBy(F.col("trips_count").desc(), "vehicle_id")
        .limit(k)
    )


def daily_trips(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fact.where(completed()).groupBy("start_date_key").agg(*totals())
    return (
        by_date(per_day, dim_date)
        .select("date", "day_name", "is_weekend", F.col("trips").alias("trips_count"), F.col("fare").alias("daily_revenue"))
        .orderBy("date")
    )


def weekly_trips(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = fact.where(completed()).groupBy("start_date_key").agg(*totals())
    return (
        by_date(per_day, dim_date)
        .groupBy("year", "week")
        .agg(*summed())
        .select("week", "year", F.col("trips").alias("trips_count"), F.col("fare").alias("weekly_revenue"),
                avg_minutes().alias("avg_duration"))
        .orderBy("year", "week")
    )


def system_kpis(fact: DataFrame) -> DataFrame:
    done, gone = F.count_if(completed()), F.count_if(F.col("trip_status") == "cancelled")
    return fact.agg(
        F.count_distinct("user_key").alias("total_active_users"),
        F.count_distinct("route_key").alias("total_active_routes"),
        F.count_distinct("vehicle_key").alias("total_active_vehicles"),
        F.count(F.lit(1)).alias("total_trips"),
        done.alias("completed_trips"),
        gone.alias("cancelled_trips"),
        percentage(done, F.count(F.lit(1))).alias("completion_rate"),
        F.sum("actual_fare").alias("total_revenue"),
        ratio(F.sum("duration_minutes"), F.count("duration_minutes")).alias("avg_trip_duration"),
        ratio(F.sum("distance_km"), F.count("distance_km")).alias("avg_trip_distance"),
    )


def kpi_last_n_days(fact: DataFrame, dim_route: DataFrame, dim_date: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    recent = since(fact.where(completed()), as_of - dt.timedelta(days=days))
    return (
        by_date(recent, dim_date.select("date_key"))
        .join(dim_route.select("route_key", "transport_type"), "route_key")
        .groupBy("transport_type")
        .agg(
            F.count(F.lit(1)).alias("trips_count"),
            F.sum("actual_fare").alias("revenue"),
            ratio(F.sum("duration_minutes"), F.count("duration_minutes")).alias("avg_duration"),
            F.count_distinct("user_key").alias("unique_passengers"),
            F.count_distinct("vehicle_key").alias("active_vehicles"),
        )
        .orderBy(F.col("revenue").desc(), "transport_type")
    )


def cohort_retention(fact: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Active users per registration month and activity month, as a share of the cohort's first month."""
    active = (
        fact.where(completed())
        .select("user_key", F.floor(F.col("start_date_key") / 100).cast("int").alias("month_key"))
        .distinct()
    )
    cohorts = dim_user.select("user_key", F.trunc("registration_date", "month").alias("cohort_month"))
    # (user, month) is unique here, so counting rows counts distinct users.
    activity = (
        active.join(cohorts, "user_key")
        .groupBy("cohort_month", date_from_key(F.col("month_key") * 100 + 1).alias("activity_month"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    # Grouped rows per cohort are bounded by the months on record.
    first = F.first("active_users").over(Window.partitionBy("cohort_month").orderBy("activity_month"))
    return activity.withColumn("retention_pct", percentage(F.col("active_users"), first)).orderBy(
        "cohort_month", "activity_month"
    )


def fare_change_demand(fact: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Trips per tariff version of a route, against the version before.

    Trips are reduced to (route version, day) first; the validity join then meets
    at most one row per route and day, however hot the route is.
    """
    per_day = (
        fact.where(completed())
        .groupBy("route_key", "start_date_key")
        .agg(F.count(F.lit(1)).alias("trips"))
        .withColumn("day", date_from_key("start_date_key"))
    )
    ids = dim_route.select("route_key", F.col("route_id").alias("trip_route"))
    periods = dim_route.select("route_id", "route_number", "base_fare", "effective_date", "expiration_date")
    valid = (F.col("day") >= F.col("effective_date")) & (
        (F.col("day") < F.col("expiration_date")) | F.col("expiration_date").isNull()
    )
    demand = (
        per_day.join(ids, "route_key")
        .join(periods, (F.col("trip_route") == F.col("route_id")) & valid)
        .groupBy("route_id", "route_number", "base_fare", "effective_date")
        .agg(F.sum("trips").alias("trips_count"))
    )
    previous = F.lag("trips_count").over(Window.partitionBy("route_id").orderBy("effective_date"))
    return demand.select(
        "route_id", "route_number", "base_fare", "effective_date", "trips_count",
        previous.alias("prev_trips"), (F.col("trips_count") - previous).alias("demand_change"),
    ).orderBy("route_number", "effective_date", "route_id")


def rfm_scores(fact: DataFrame, dim_user: DataFrame, as_of: dt.date, k: int = 100) -> DataFrame:
    """Recency, frequency, monetary quintiles and segment; the k greatest by monetary value.

    Every user counts, also those without a completed trip.  Quintiles come from
    distributed row numbers; user_key breaks ties; NULLs rank first when
    descending and last when ascending.
    """
    per_user = (
        fact.where(completed())
        .groupBy("user_key")
        .agg(
            F.datediff(F.lit(as_of), date_from_key(F.max("start_date_key"))).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("actual_fare").alias("monetary"),
        )
    )
    rfm = (
        dim_user.select("user_key")
        .join(per_user, "user_key", "left")
        .withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    )
    key = F.col("user_key")
    orders = {
        "r_score": [F.col("recency_days").desc_nulls_first(), key],
        "f_score": [F.col("frequency").asc_nulls_last(), key],
        "m_score": [F.col("monetary").asc_nulls_last(), key],
    }
    for score, order in orders.items():
        rfm = number_rows(rfm, order, "_rn", total="_n")
        rfm = rfm.withColumn(score, ntile(F.col("_rn"), F.col("_n"), 5)).drop("_rn", "_n")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "VIP").when(f >= 4, "Loyal").when(r <= 2, "At Risk").otherwise("Regular")
    )
    best = rfm.withColumn("rfm_segment", segment).orderBy(F.col("monetary").desc_nulls_first(), "user_key").limit(k)
    # Names are fetched for the k users only.
    return (
        best.join(dim_user.select("user_key", "username"), "user_key")
        .orderBy(F.col("monetary").desc_nulls_first(), "user_key")
        .select("username", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_segment")
    )
