"""Type-1 dimensions: shape the snapshot, then replace in place without losing keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import age_group, maintenance_status
from starmart.operators.surrogate import append_keys
from starmart.sources.reference_rows import STATION_TYPE_NAMES, UNKNOWN_NAME, VEHICLE_TYPE_NAMES

DEFAULT_SEGMENT, SOURCE_SYSTEM = "occasional", "OLTP"


def label(code: Column, names: dict[str, str]) -> Column:
    found = F.lit(None).cast("string")
    for value, text in names.items():
        found = F.when(code == value, text).otherwise(found)
    return F.coalesce(found, F.lit(UNKNOWN_NAME))


def user_rows(users: DataFrame, as_of: dt.date, segment: Column | None = None) -> DataFrame:
    """``segment`` defaults to the neutral one until the segmentation is fed back."""
    full_name = F.coalesce(F.concat("first_name", F.lit(" "), "last_name"), F.col("username"))
    return users.select(
        "user_id",
        "username",
        "email",
        "phone",
        "first_name",
        "last_name",
        full_name.alias("full_name"),
        "date_of_birth",
        age_group(F.col("date_of_birth"), as_of).alias("age_group"),
        F.to_date("registration_date").alias("registration_date"),
        F.col("status").alias("current_status"),
        F.col("balance").cast("decimal(10,2)").alias("current_balance"),
        (F.lit(DEFAULT_SEGMENT) if segment is None else segment).alias("user_segment"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )


def station_rows(stations: DataFrame) -> DataFrame:
    return stations.select(
        "station_id",
        "station_name",
        F.col("latitude").cast("decimal(10,8)").alias("latitude"),
        F.col("longitude").cast("decimal(11,8)").alias("longitude"),
        "station_type",
        label(F.col("station_type"), STATION_TYPE_NAMES).alias("station_type_name"),
        "district",
        "zone",
        "is_active",
        F.lit(False).alias("is_transfer_station"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )


def vehicle_rows(vehicles: DataFrame, as_of: dt.date) -> DataFrame:
    return vehicles.select(
        "vehicle_id",
        "license_plate",
        "vehicle_type",
        label(F.col("vehicle_type"), VEHICLE_TYPE_NAMES).alias("vehicle_type_name"),
        F.col("route_id").alias("current_route_id"),
        "capacity",
        "manufacture_year",
        (F.lit(as_of.year) - F.col("manufacture_year")).alias("vehicle_age"),
        "model",
        "last_maintenance_date",
        maintenance_status(F.col("last_maintenance_date"), as_of).alias("maintenance_status"),
        F.col("status").alias("current_status"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
    )


def replace_attributes(
    dim: DataFrame, snapshot: DataFrame, business_key: str, surrogate_key: str, load_time: dt.datetime
) -> DataFrame:
    """Key-preserving type-1 load.

    Known members take the snapshot's attributes and keep key and creation time;
    new members get the next keys; members absent from the snapshot stay.
    """
    attributes = [c for c in snapshot.columns if c != business_key]
    stamp = F.lit(load_time).cast("timestamp_ntz")
    # A snapshot that repeats a key gives one member: the greatest of its attribute rows.
    new = snapshot.groupBy(business_key).agg(F.max(F.struct(*attributes)).alias("_new"))
    old = dim.select(
        business_key,
        surrogate_key,
        F.col("created_date").alias("_created"),
        F.col("updated_date").alias("_updated"),
        F.struct(*attributes).alias("_old"),
    )
    kept = F.coalesce(F.col("_new"), F.col("_old"))
    known = old.join(new, business_key, "left").select(
        surrogate_key,
        business_key,
        *[kept[c].alias(c) for c in attributes],
        F.col("_created").alias("created_date"),
        F.when(F.col("_new").isNotNull(), stamp).otherwise(F.col("_updated")).alias("updated_date"),
    )
    # Known members keep their keys, so only new ones are numbered.
    first = new.join(dim.select(business_key), business_key, "left_anti").select(
        business_key, *[F.col("_new")[c].alias(c) for c in attributes], stamp.alias("created_date"), stamp.alias("updated_date")
    )
    return known.unionByName(append_keys(dim, first, surrogate_key, [business_key]))


def flag_transfer_stations(dim_station: DataFrame, route_stations: DataFrame) -> DataFrame:
    """``is_transfer_station``: more than one route serves the station."""
    served = route_stations.groupBy("station_id").agg(F.count_distinct("route_id").alias("_routes"))
    flagged = dim_station.join(served, "station_id", "left")
    return flagged.withColumn("is_transfer_station", F.coalesce(F.col("_routes") > 1, F.lit(False))).drop("_routes")


def apply_segments(dim_user: DataFrame, segments: DataFrame) -> DataFrame:
    """Feed the segmentation mart back; users it does not know keep their segment."""
    fresh = segments.select("user_id", F.col("user_segment").alias("_segment"))
    out = dim_user.join(fresh, "user_id", "left")
    return out.withColumn("user_segment", F.coalesce("_segment", "user_segment")).drop("_segment")
