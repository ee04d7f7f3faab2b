"""Column-level rules (the reference's macros and scalar expressions)."""

from aerocast.functions.keys import surrogate_key
from aerocast.functions.timefmt import (
    parse_utc_text, parse_zoned_text, weekday_name, date_of, hour_of,
    minus_minutes, plus_minutes, abs_diff_micros, batch_id_now,
)
from aerocast.functions.delay import delay_minutes, delay_status
from aerocast.functions.categories import (
    range_category, wind_category, precipitation_category, rain_category,
    temperature_category, cloudcover_category, visibility_category,
    weather_description, weather_flags, weather_condition, THUNDERSTORM_CODES,
)
from aerocast.functions.clean import null_tokens, code_upper, numeric_or_null, tri_bool
from aerocast.functions.direction import by_direction, home_airport_filter
from aerocast.functions.exact import half_up_ratio, to_units

__all__ = [
    "surrogate_key", "parse_utc_text", "parse_zoned_text", "weekday_name", "date_of",
    "hour_of", "minus_minutes", "plus_minutes", "abs_diff_micros", "batch_id_now",
    "delay_minutes", "delay_status", "range_category", "wind_category",
    "precipitation_category", "rain_category", "temperature_category",
    "cloudcover_category", "visibility_category", "weather_description",
    "weather_flags", "weather_condition", "THUNDERSTORM_CODES", "null_tokens",
    "code_upper", "numeric_or_null", "tri_bool", "by_direction",
    "home_airport_filter", "half_up_ratio", "to_units",
]
