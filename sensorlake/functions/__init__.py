"""Column expressions shared by the operators (all JVM-side built-ins)."""

from sensorlake.functions.scalar import (  # noqa: F401
    exact_avg, hour_parts, is_date_shaped, json_double,
    parse_instant, parse_values, round_max, round_min, to_ntz, ntz_columns,
)
