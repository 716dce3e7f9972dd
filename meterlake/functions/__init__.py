from meterlake.functions.columns import (  # noqa: F401
    energy_present,
    fixed_point_text,
    hour_key,
    is_weekend,
    parse_reading_ts,
    parse_weather_ts,
    temperature_bin,
    to_double,
    weather_context,
    z_threshold,
)
