"""Fact loads: key lookup, smart keys, measures, fares."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import date_key, duration_minutes, minute_key, month_key, time_key
from starmart.operators.scd2 import as_of_join
from starmart.operators.surrogate import lookup


def resolve_fares(trips: DataFrame, payments: DataFrame) -> DataFrame:
    """``actual_fare``: what was successfully paid for the trip, else its ``base_fare``.

    Payments are summed per trip before the join, so several payments cannot
    multiply the trip.
    """
    paid = (
        payments.where((F.col("transaction_type") == "payment") & (F.col("status") == "success"))
        .where(F.col("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(F.sum("amount").alias("_paid"))
    )
    fare = F.coalesce(F.col("_paid"), F.col("base_fare")).cast("decimal(10,2)")
    return trips.join(paid, "trip_id", "left").withColumn("actual_fare", fare).drop("_paid", "base_fare")


def trip_facts(
    trips: DataFrame,
    payments: DataFrame,
    dim_user: DataFrame,
    dim_route: DataFrame,
    dim_vehicle: DataFrame,
    dim_station: DataFrame,
    *,
    route_key_mode: str = "as_of",
    load_time: dt.datetime,
    source_system: str = "OLTP",
) -> DataFrame:
    """Trip fact rows.  Unresolved keys stay NULL: split them off with ``split_unresolved``."""
    fact = lookup(trips, dim_user, "user_id", "user_id", "user_key")
    # One lookup brings the version's key and its tariff.
    if route_key_mode == "current":
        current = dim_route.where("is_current").select(F.col("route_id").alias("_id"), "route_key", "base_fare")
        fact = fact.join(current, F.col("route_id") == F.col("_id"), "left").drop("_id")
    elif route_key_mode == "as_of":
        dated = fact.withColumn("_day", F.col("start_time").cast("date"))
        fact = as_of_join(dated, dim_route, "route_id", "_day", ["route_key", "base_fare"])
    else:
        raise ValueError(f"unknown route_key_mode {route_key_mode}")
    fact = lookup(fact, dim_vehicle, "vehicle_id", "vehicle_id", "vehicle_key")
    fact = lookup(fact, dim_station, "start_station_id", "station_id", "station_key", "start_station_key")
    fact = lookup(fact, dim_station, "end_station_id", "station_id", "station_key", "end_station_key")
    fact = resolve_fares(fact, payments)
    return fact.select(
        "user_key",
        "route_key",
        "vehicle_key",
        date_key("start_time").alias("start_date_key"),
        time_key("start_time").alias("start_time_key"),
        minute_key("start_time").alias("start_minute_key"),
        date_key("end_time").alias("end_date_key"),
        time_key("end_time").alias("end_time_key"),
        "start_station_key",
        "end_station_key",
        F.col("distance_km").cast("decimal(6,2)").alias("distance_km"),
        duration_minutes("start_time", "end_time").alias("duration_minutes"),
        "actual_fare",
        "trip_id",
        F.col("status").alias("trip_status"),
        F.col("start_time").alias("start_timestamp"),
        F.col("end_time").alias("end_timestamp"),
        F.lit(load_time).cast("timestamp_ntz").alias("created_date"),
        F.lit(source_system).alias("source_system"),
    )


def transaction_facts(
    transactions: DataFrame, dim_user: DataFrame, fact_trips: DataFrame, dim_payment_method: DataFrame
) -> DataFrame:
    """Transaction fact rows; ``trip_key`` is NULL for top-ups."""
    fact = lookup(transactions, dim_user, "user_id", "user_id", "user_key")
    # Rows without a trip match nothing: they go round the join, so their NULLs don't meet in one task.
    paid = lookup(fact.where(F.col("trip_id").isNotNull()), fact_trips, "trip_id", "trip_id", "trip_key")
    no_trip = F.lit(None).cast(fact_trips.schema["trip_key"].dataType).alias("trip_key")
    fact = paid.unionByName(fact.where(F.col("trip_id").isNull()).select("*", no_trip))
    methods = dim_payment_method.select(F.col("payment_method_code").alias("payment_method"), "payment_method_key")
    fact = fact.join(F.broadcast(methods), "payment_method", "left")  # 4 rows
    return fact.select(
        "user_key",
        "trip_key",
        "payment_method_key",
        date_key("transaction_date").alias("date_key"),
        time_key("transaction_date").alias("time_key"),
        minute_key("transaction_date").alias("minute_key"),
        F.col("amount").cast("decimal(10,2)").alias("amount"),
        "transaction_id",
        "transaction_type",
        F.col("status").alias("transaction_status"),
        F.col("transaction_date").alias("transaction_timestamp"),
    )


def position_facts(pings: DataFrame, dim_vehicle: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Position fact rows from a batch or a stream of pings (the dimensions are static)."""
    fact = lookup(pings, dim_vehicle, "vehicle_id", "vehicle_id", "vehicle_key")
    fact = lookup(fact, dim_route.where("is_current"), "route_id", "route_id", "route_key")
    return fact.select(
        "vehicle_key",
        "route_key",
        date_key("ts").alias("date_key"),
        time_key("ts").alias("time_key"),
        minute_key("ts").alias("minute_key"),
        month_key(date_key("ts")).alias("month_key"),
        F.col("latitude").cast("decimal(10,8)").alias("latitude"),
        F.col("longitude").cast("decimal(11,8)").alias("longitude"),
        F.col("speed").cast("decimal(5,2)").alias("speed_kmh"),
        F.col("bearing").cast("smallint").alias("direction_degree"),
        F.col("ts").alias("recorded_at"),
    )
