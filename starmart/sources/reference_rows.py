"""Small reference tables delivered with the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Seed rows of the reference dimensions and calendar rules.
PAYMENT_METHODS = [
    ("card", "Банковская карта", "digital", False),
    ("cash", "Наличные", "cash", False),
    ("subscription", "Подписка", "subscription", False),
    ("balance", "Баланс приложения", "digital", True),
]
OCCUPANCY_LEVELS = [
    ("empty", "Пусто", 0, 20, 1, "#00FF00", "Много свободных мест"),
    ("many_seats_available", "Много мест", 21, 40, 2, "#90EE90", "Комфортно, много свободных мест"),
    ("few_seats_available", "Мало мест", 41, 60, 3, "#FFD700", "Есть свободные места"),
    ("standing_room_only", "Только стоячие места", 61, 80, 4, "#FFA500", "Все сидячие места заняты"),
    ("crushed_standing_room_only", "Переполнен", 81, 100, 5, "#FF0000", "Очень много людей"),
    ("full", "Полный", 95, 100, 5, "#8B0000", "Новые пассажиры не помещаются"),
    ("not_accepting_passengers", "Не принимает пассажиров", None, None, 0, "#808080",
     "Транспорт не принимает пассажиров"),
]
HOLIDAYS = [(1, day, "Новый год") for day in range(1, 9)] + [
    (2, 23, "День защитника Отечества"),
    (3, 8, "Международный женский день"),
    (5, 1, "Праздник Весны и Труда"),
    (5, 9, "День Победы"),
    (6, 12, "День России"),
    (11, 4, "День народного единства"),
]
TRANSPORT_TYPE_NAMES = {"bus": "Автобус", "tram": "Трамвай", "metro": "Метро"}
VEHICLE_TYPE_NAMES = {"bus": "Автобус", "tram": "Трамвай", "metro": "Вагон метро"}
STATION_TYPE_NAMES = {
    "bus_stop": "Автобусная остановка",
    "tram_stop": "Трамвайная остановка",
    "metro_station": "Станция метро",
}
UNKNOWN_NAME = "Неизвестно"


def _inline_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A literal table: its size is known to the planner and no job builds it."""

    def text(value) -> str:
        if value is None:
            return "NULL"
        return "'" + value + "'" if isinstance(value, str) else str(value)

    values = ", ".join("(" + ", ".join(map(text, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def payment_methods(spark: SparkSession) -> DataFrame:
    return _inline_table(
        spark,
        [(i, *row) for i, row in enumerate(PAYMENT_METHODS, 1)],
        "payment_method_key, payment_method_code, payment_method_name, payment_category, requires_balance",
    )


def occupancy_levels(spark: SparkSession) -> DataFrame:
    return _inline_table(
        spark,
        [(i, *row) for i, row in enumerate(OCCUPANCY_LEVELS, 1)],
        "occupancy_key, occupancy_code, occupancy_name, occupancy_percentage_min, occupancy_percentage_max, "
        "occupancy_level, color_code, description",
    )


def holidays(spark: SparkSession) -> DataFrame:
    return _inline_table(spark, HOLIDAYS, "month, day, holiday_name")
