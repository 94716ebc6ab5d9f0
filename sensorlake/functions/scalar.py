"""Scalar helpers: timestamp parsing, JSON access, exact averages, formatting.

All of them return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_date_shaped(text) -> Column:
    """Guard before parsing: bare times ('10:00:00') would parse to today."""
    return _c(text).rlike(_DATE_SHAPE)


def parse_instant(text) -> Column:
    """Text with its own offset -> instant (TimestampType); bad text -> NULL."""
    t = _c(text)
    return F.when(is_date_shaped(t), F.try_to_timestamp(t))


def parse_values(text) -> Column:
    """``values`` JSON text -> Variant, NULL when the text is not JSON."""
    return F.try_parse_json(_c(text))


def json_double(variant, path: str) -> Column:
    """Numeric field (numbers and numeric strings) -> double, else NULL."""
    return F.try_variant_get(_c(variant), path, "double")


# Doubles from here on are added as doubles: a decimal of 28 digits ends there.
HUGE = 1e21


def exact_avg(col, scale: int = 6, digits: int = 3) -> Column:
    """Average rounded to ``digits``, identical whatever the summation order.

    A plain double AVG depends on the order rows are added, which moves
    rounding ties between runs and engines. Summing as a decimal is exact;
    the single division and the decimal rounding are then deterministic.
    NaN and infinities count and are added like AVG adds them (NaN: NaN),
    and so are values too large for the decimal; a mean too large to have
    ``digits`` of its own is given as it is.
    """
    x = _c(col)
    plain = F.abs(x) < HUGE  # false for NaN, which is above every number
    total = F.sum(F.when(plain, x).cast(T.DecimalType(28, scale))).cast("double")
    rest = F.sum(F.when(~plain, x))
    mean = F.try_divide(F.coalesce(total, F.lit(0.0)) + F.coalesce(rest, F.lit(0.0)), F.count(x))
    return F.when(F.abs(mean) < 1e15, F.round(mean.cast(T.DecimalType(28, scale)), digits).cast("double")).otherwise(mean)


def round_max(col, digits: int = 3) -> Column:
    return F.round(F.max(_c(col)), digits)


def round_min(col, digits: int = 3) -> Column:
    return F.round(F.min(_c(col)), digits)


def hour_parts(ts) -> list[Column]:
    """Zero-padded year/month/day/hour strings of an instant (UTC session)."""
    t = _c(ts)
    return [F.date_format(t, "yyyy").alias("year"), F.date_format(t, "MM").alias("month"),
            F.date_format(t, "dd").alias("day"), F.date_format(t, "HH").alias("hour")]


def to_ntz(col) -> Column:
    return _c(col).cast(T.TimestampNTZType())


def ntz_columns(df: DataFrame) -> DataFrame:
    """Cast every TimestampType column to wall-clock UTC (timestamp_ntz).

    Used at presentation boundaries so results do not depend on the reader's
    local time zone.
    """
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampType):
            cols.append(F.col(f"`{field.name}`").cast(T.TimestampNTZType()).alias(field.name))
        else:
            cols.append(F.col(f"`{field.name}`"))
    return df.select(*cols)
