"""Domain jobs: ledger, vehicle movement, occupancy, route stops, searches, subscriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import duration_minutes, haversine_km, percentage, seconds_between
from starmart.operators.ordered import previous_row, running_sums

# Occupancy rush hours, inclusive.
OCCUPANCY_RUSH = [(7, 9), (17, 19)]


def ledger_amount() -> Column:
    """Signed effect of a transaction on the balance; only successful ones count."""
    kind, amount = F.col("transaction_type"), F.col("amount")
    signed = F.when(kind.isin("topup", "refund"), amount).when(kind == "payment", -amount)
    return F.when(F.col("status") == "success", signed).otherwise(F.lit(0).cast("decimal(10,2)"))


def account_balance(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("user_id").agg(
        F.sum(ledger_amount()).alias("balance"), F.count(F.lit(1)).alias("transactions")
    )


def running_balance(transactions: DataFrame) -> DataFrame:
    order = [F.col("transaction_date"), F.col("transaction_id")]
    return running_sums(transactions, ["user_id"], order, {"running_balance": ledger_amount()})


def ping_kinematics(pings: DataFrame) -> DataFrame:
    """Distance, elapsed time and implied speed since the vehicle's previous ping."""
    order = [F.col("ts"), F.col("position_id")]
    before = {"prev_ts": "ts", "prev_lat": "latitude", "prev_lon": "longitude"}
    moved = previous_row(pings, ["vehicle_id"], order, before)
    km = haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("latitude"), F.col("longitude"))
    return moved.withColumn("elapsed_seconds", seconds_between("prev_ts", "ts")).withColumn("distance_km", km).withColumn(
        "implied_kmh", F.try_divide(F.col("distance_km") * 3600, F.col("elapsed_seconds"))
    )


def trip_durations(pings: DataFrame) -> DataFrame:
    """Whole minutes between consecutive pings of a vehicle."""
    moved = previous_row(pings, ["vehicle_id"], [F.col("ts"), F.col("position_id")], {"prev_ts": "ts"})
    return moved.withColumn("duration_minutes", duration_minutes("prev_ts", "ts"))


def stationary_spells(
    pings: DataFrame, slow_below: float = 1.0
) -> DataFrame:
    """Gaps and islands: each uninterrupted run of slow pings of a vehicle.

    A spell lasts from its first slow ping to the next moving one, or to its last
    slow ping while none has come.
    """
    order = [F.col("ts"), F.col("position_id")]
    slow = pings.withColumn("slow", F.col("speed") < F.lit(slow_below))
    marked = previous_row(slow, ["vehicle_id"], order, {"prev_slow": "slow"})
    opens = (F.col("slow") & ~F.coalesce(F.col("prev_slow"), F.lit(False))).cast("int")
    # The moving ping that ends a spell carries the number of the spell before it.
    numbered = running_sums(marked, ["vehicle_id"], order, {"spell": opens}).where(F.col("spell") > 0)
    ends = ~F.col("slow") & F.col("prev_slow")
    spells = numbered.where(F.col("slow") | ends).groupBy("vehicle_id", "spell").agg(
        F.min(F.when(F.col("slow"), F.col("ts"))).alias("stopped_at"),
        F.max("ts").alias("until"),
        F.count_if("slow").alias("slow_pings"),
        F.count_if(ends).cast("boolean").alias("moved_on"),
    )
    return spells.withColumn("delay_minutes", seconds_between("stopped_at", "until") / 60)


def occupancy_by_period(pings: DataFrame) -> DataFrame:
    """Distribution of occupancy codes in rush and off-peak hours."""
    hour = F.hour("ts")
    rush = F.lit(False)
    for first, last in OCCUPANCY_RUSH:
        rush = rush | hour.between(first, last)
    counts = pings.groupBy(F.when(rush, "rush").otherwise("off_peak").alias("period"), "occupancy").agg(
        F.count(F.lit(1)).alias("pings")
    )
    # At most one row per occupancy code in each of the two periods.
    whole = F.sum("pings").over(Window.partitionBy("period"))
    return counts.withColumn("share_pct", percentage(F.col("pings"), whole))


def number_stops(stops: DataFrame, order: list[Column]) -> DataFrame:
    """Sequence number, travel minutes and kilometres from the first stop."""
    along = {
        "seq": F.lit(1).cast("long"),
        "minutes_from_start": F.col("travel_minutes"),
        "km_from_start": F.col("distance_km"),
    }
    return running_sums(stops, ["route_id"], order, along)


def downstream(stops: DataFrame) -> DataFrame:
    """Per stop of a numbered route: how many stops can still be reached, and what lies ahead.

    Every later stop is reachable, so counts and prefix differences give the
    answer without listing pairs of stops.
    """
    # Totals come from the addends, so this side does not repeat the prefix sums.
    ends = stops.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("_last"), F.sum("travel_minutes").alias("_minutes"), F.sum("distance_km").alias("_km")
    )
    return stops.join(ends, "route_id").select(
        *stops.columns,
        (F.col("_last") - F.col("seq")).alias("stops_ahead"),
        (F.col("_minutes") - F.col("minutes_from_start")).alias("minutes_ahead"),
        (F.col("_km") - F.col("km_from_start")).alias("km_ahead"),
    )


def legs(requests: DataFrame, stops: DataFrame) -> DataFrame:
    """Requested rides (route_id, start_seq, end_seq): feasible when the end lies after the start.

    Two equi lookups per request; minutes and kilometres are differences of the prefixes.
    """

    def role(prefix: str) -> DataFrame:
        return stops.select(
            "route_id",
            F.col("seq").alias(f"{prefix}_seq"),
            F.col("minutes_from_start").alias(f"{prefix}_minutes"),
            F.col("km_from_start").alias(f"{prefix}_km"),
        )

    ridden = requests.join(role("start"), ["route_id", "start_seq"], "left").join(
        role("end"), ["route_id", "end_seq"], "left"
    )
    ok = F.coalesce(
        F.col("start_minutes").isNotNull() & F.col("end_minutes").isNotNull() & (F.col("end_seq") > F.col("start_seq")),
        F.lit(False),
    )
    return ridden.select(
        *requests.columns,
        ok.alias("feasible"),
        F.when(ok, F.col("end_minutes") - F.col("start_minutes")).alias("ride_minutes"),
        F.when(ok, F.col("end_km") - F.col("start_km")).alias("ride_km"),
    )


def type_compatible(stations: DataFrame, routes: DataFrame) -> DataFrame:
    """Stations and routes of one kind: the station type without its ``_stop`` or
    ``_station`` suffix is the transport type.  Counted per kind, never paired."""
    kind = F.regexp_replace("station_type", "_(stop|station)$", "")
    served = stations.groupBy(kind.alias("transport_type")).agg(F.count(F.lit(1)).alias("stations"))
    running = routes.groupBy("transport_type").agg(F.count(F.lit(1)).alias("routes"))
    return served.join(running, "transport_type")


def search_funnel(searches: DataFrame, suggestions_json: str, selected: str) -> DataFrame:
    """Parse the suggested routes of a search and tell whether the choice was among them.

    Route ids are read with the type of the chosen one.
    """
    kind = searches.schema[selected].dataType.simpleString()
    ids = F.from_json(F.col(suggestions_json), f"array<struct<route_id:{kind}>>")["route_id"]
    parsed = searches.withColumn("_ids", ids)
    chosen = F.col(selected)
    return parsed.select(
        *searches.columns,
        F.coalesce(F.size("_ids"), F.lit(0)).alias("suggestions"),
        F.when(chosen.isNull(), "none")
        .when(F.coalesce(F.array_contains("_ids", chosen), F.lit(False)), "suggested")
        .otherwise("other")
        .alias("selection"),
    )


def subscription_coverage(subscriptions: DataFrame) -> DataFrame:
    """Active subscriptions per type and day (both ends included).

    A sweep: +1 on the start, -1 after the end, summed per day, then a prefix sum
    over the days of a type.  Nothing is expanded per covered day; only days on
    which the number changes are reported.
    """
    changes = _sweep(subscriptions, ["subscription_type"])
    by_day = Window.partitionBy("subscription_type").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return changes.withColumn("active", F.sum("delta").over(by_day)).drop("delta")


def subscription_overlaps(subscriptions: DataFrame) -> DataFrame:
    """Per user: subscriptions held, the most held on one day, days with more than one."""
    changes = _sweep(subscriptions, ["user_id"])
    # Changes per user are bounded by the days on record.
    by_day = Window.partitionBy("user_id").orderBy("day")
    level = F.sum("delta").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    spans = changes.select("user_id", level.alias("level"), F.datediff(F.lead("day").over(by_day), "day").alias("days"))
    peaks = spans.groupBy("user_id").agg(
        F.max("level").alias("most_at_once"),
        F.coalesce(F.sum(F.when(F.col("level") > 1, F.col("days"))), F.lit(0)).alias("days_overlapping"),
    )
    held = subscriptions.groupBy("user_id").agg(F.count(F.lit(1)).alias("subscriptions"))
    return held.join(peaks, "user_id")


def _sweep(subscriptions: DataFrame, keys: list[str]) -> DataFrame:
    steps = F.array(
        F.struct(F.col("start_date").alias("day"), F.lit(1).alias("delta")),
        F.struct(F.date_add("end_date", 1).alias("day"), F.lit(-1).alias("delta")),
    )
    return (
        subscriptions.select(*keys, F.inline(steps)).groupBy(*keys, "day").agg(F.sum("delta").alias("delta"))
    )
