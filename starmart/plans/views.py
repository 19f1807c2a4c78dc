"""Denormalised and filtered views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import seconds_between
from starmart.plans.analytics import by_date, by_minute, completed


def completed_trips(
    fact: DataFrame,
    dim_user: DataFrame,
    dim_route: DataFrame,
    dim_vehicle: DataFrame,
    dim_station: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
) -> DataFrame:
    """Completed trips with every description: user, route, date and time are
    required, vehicle and stations optional."""
    users = dim_user.select("user_key", "user_id", "username", "user_segment")
    routes = dim_route.select("route_key", "route_id", "route_number", "route_name", "transport_type", "base_fare")
    vehicles = dim_vehicle.select("vehicle_key", "vehicle_id", "vehicle_type")

    def station(role: str) -> DataFrame:
        return dim_station.select(
            F.col("station_key").alias(f"{role}_station_key"), F.col("station_name").alias(f"{role}_station")
        )

    dated = by_date(fact.where(completed()), dim_date.select("date_key", "date", "day_name", "is_weekend"))
    timed = by_minute(dated, dim_time.select("time_key", "hour", "time_period", "is_rush_hour"))
    return (
        timed.join(users, "user_key")
        .join(routes, "route_key")
        .join(vehicles, "vehicle_key", "left")
        .join(station("start"), "start_station_key", "left")
        .join(station("end"), "end_station_key", "left")
        .select(
            "trip_id", "user_id", "username", "user_segment", "route_id", "route_number", "route_name",
            "transport_type", "base_fare", "vehicle_id", "vehicle_type", "start_station", "end_station",
            F.col("date").alias("trip_date"), "day_name", "is_weekend", F.col("hour").alias("start_hour"),
            "time_period", "is_rush_hour", "distance_km", "duration_minutes", "actual_fare",
            "start_timestamp", "end_timestamp",
        )
    )


def successful_transactions(
    fact: DataFrame, dim_user: DataFrame, dim_payment_method: DataFrame, dim_date: DataFrame, dim_time: DataFrame
) -> DataFrame:
    days = dim_date.select("date_key", F.col("date").alias("transaction_date"), "day_name", "is_weekend")
    minutes = dim_time.select(F.col("time_key").alias("minute_key"), "hour")
    methods = dim_payment_method.select("payment_method_key", "payment_method_name", "payment_category")
    return (
        fact.where(F.col("transaction_status") == "success")
        .drop("time_key")
        .join(F.broadcast(days), "date_key")
        .join(F.broadcast(minutes), "minute_key")
        .join(F.broadcast(methods), "payment_method_key")
        .join(dim_user.select("user_key", "user_id", "username"), "user_key")
        .select(
            "transaction_id", "user_id", "username", "payment_method_name", "payment_category", "transaction_date",
            "day_name", "is_weekend", "hour", "amount", "transaction_type", "transaction_timestamp",
        )
    )


def latest_positions(
    positions: DataFrame, dim_vehicle: DataFrame, dim_route: DataFrame, as_of: dt.datetime, minutes: int = 60
) -> DataFrame:
    """Positions at each vehicle's latest instant of the last hour; simultaneous ones all stay.

    The maximum is reduced before the shuffle and met again on (vehicle, instant),
    so one busy vehicle does not gather in one task.
    """
    since = F.lit(as_of - dt.timedelta(minutes=minutes)).cast("timestamp_ntz")
    recent = positions.where(F.col("recorded_at") > since)
    last = recent.groupBy("vehicle_key").agg(F.max("recorded_at").alias("recorded_at"))
    vehicles = dim_vehicle.select("vehicle_key", "vehicle_id", "vehicle_type")
    routes = dim_route.select("route_key", "route_id", "route_number", "route_name")
    age = seconds_between("recorded_at", F.lit(as_of).cast("timestamp_ntz")) / 60
    return (
        recent.join(last, ["vehicle_key", "recorded_at"])
        .join(vehicles, "vehicle_key")
        .join(routes, "route_key")
        .select(
            "position_id", "vehicle_id", "vehicle_type", "route_id", "route_number", "route_name", "latitude",
            "longitude", "speed_kmh", "direction_degree", "recorded_at", age.alias("minutes_ago"),
        )
    )


def active_users(dim_user: DataFrame, as_of: dt.date) -> DataFrame:
    return dim_user.where(F.col("current_status") == "active").select(
        "user_key", "user_id", "username", "email", "full_name", "age_group", "current_status", "current_balance",
        "user_segment", "registration_date",
        F.datediff(F.lit(as_of), "registration_date").alias("days_since_registration"),
    )


def active_vehicles(dim_vehicle: DataFrame, dim_route: DataFrame, as_of: dt.date) -> DataFrame:
    current = dim_route.where("is_current").select(
        F.col("route_id").alias("current_route_id"), "route_number", "route_name"
    )
    return (
        dim_vehicle.where(F.col("current_status") == "active")
        .join(current, "current_route_id", "left")
        .select(
            "vehicle_key", "vehicle_id", "vehicle_type", "vehicle_type_name", "current_route_id", "route_number",
            "route_name", "capacity", "vehicle_age", "model", "maintenance_status", "last_maintenance_date",
            F.datediff(F.lit(as_of), "last_maintenance_date").alias("days_since_maintenance"),
        )
    )


def active_trips(
    trips: DataFrame, users: DataFrame, routes: DataFrame, stations: DataFrame, as_of: dt.datetime
) -> DataFrame:
    start = stations.select(
        F.col("station_id").alias("start_station_id"), F.col("station_name").alias("start_station_name")
    )
    elapsed = seconds_between("start_time", F.lit(as_of).cast("timestamp_ntz")) / 60
    return (
        trips.where(F.col("status") == "in_progress")
        .join(users.select("user_id", "username"), "user_id")
        .join(routes.select("route_id", "route_number", "route_name"), "route_id")
        .join(start, "start_station_id", "left")
        .select(
            "trip_id", "user_id", "username", "route_id", "route_number", "route_name", "vehicle_id", "start_time",
            "start_station_id", "start_station_name", elapsed.alias("duration_minutes"),
        )
    )


def user_statistics(users: DataFrame, trips: DataFrame, transactions: DataFrame) -> DataFrame:
    """Trips and spending per active user.  Each child is reduced to one row per
    user before the join, so trips cannot multiply payments; and as trip_id is the
    key of trips, plain counts then equal distinct ones."""
    ridden = trips.groupBy("user_id").agg(
        F.count("trip_id").alias("total_trips"),
        F.count_if(F.col("status") == "completed").alias("completed_trips"),
        F.max("start_time").alias("last_trip_date"),
    )
    paid = (F.col("transaction_type") == "payment") & (F.col("status") == "success")
    spent = transactions.where(paid).groupBy("user_id").agg(F.sum("amount").alias("total_spent"))
    return (
        users.where(F.col("status") == "active")
        .join(ridden, "user_id", "left")
        .join(spent, "user_id", "left")
        .select(
            "user_id", "username", "email", "balance",
            F.coalesce("total_trips", F.lit(0)).alias("total_trips"),
            F.coalesce("completed_trips", F.lit(0)).alias("completed_trips"),
            F.coalesce("total_spent", F.lit(0).cast("decimal(10,2)")).alias("total_spent"),
            "last_trip_date",
        )
    )
