"""Column functions: smart keys, durations, buckets, geometry."""

from starmart.functions.buckets import (  # noqa: F401
    activity_segment,
    age_group,
    day_period,
    is_rush_hour,
    maintenance_status,
    occupancy_code,
    rush_hour_type,
)
from starmart.functions.geo import haversine_km  # noqa: F401
from starmart.functions.keys import (  # noqa: F401
    date_from_key,
    date_key,
    datetime_keys,
    duration_minutes,
    key_of,
    minute_key,
    month_key,
    seconds_between,
    time_key,
)
from starmart.functions.numbers import percentage, ratio  # noqa: F401
