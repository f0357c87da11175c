"""Value rules, unit conversions and small array and name helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.calendar import second_of_day

# Fixed values.
SPIKE_LIMIT = 40000
KELVIN_OFFSET = 273.15
WATT_PER_KILOWATT = 1000
HOURS_PER_STEP = 0.25
MODEL_NAME_VERSION = r"_v([^.]*)\."
MODEL_NAME_CLIENT = r"^model_(\d+)_v"
MODEL_NAME_DATE = r"_(\d{4}-\d{2}-\d{2})"


def spike_to_null(value: Column, limit: float = SPIKE_LIMIT) -> Column:
    """Null instead of a value above the limit."""
    return F.when(value <= limit, value)


def kelvin_to_celsius(value: Column) -> Column:
    return value - KELVIN_OFFSET


def watt_to_kilowatt(value: Column) -> Column:
    return value / WATT_PER_KILOWATT


def watt_to_kwh(value: Column) -> Column:
    """Mean power over one quarter hour to energy."""
    return value * HOURS_PER_STEP / WATT_PER_KILOWATT


def to_whole(value: Column) -> Column:
    """Rounded to a whole number, as a database does when a fraction meets an integer column."""
    return F.round(value).cast("long")


def night_to_zero(forecast: Column, time: Column, sunrise: Column, sunset: Column) -> Column:
    """No solar power below zero or outside daylight; both daylight bounds count as day."""
    clock = second_of_day(time)
    dark = (clock < second_of_day(sunrise)) | (clock > second_of_day(sunset))
    return F.when((forecast < 0) | dark, F.lit(0.0)).otherwise(forecast)


def version_of(name: Column) -> Column:
    """Integer between ``_v`` and the next dot; null for other names."""
    return F.nullif(F.regexp_extract(name, MODEL_NAME_VERSION, 1), F.lit("")).try_cast("int")


def client_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, MODEL_NAME_CLIENT, 1), F.lit("")).try_cast("int")


def date_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, MODEL_NAME_DATE, 1), F.lit("")).try_cast("date")


def capitalise_columns(df: DataFrame) -> DataFrame:
    """First letter of every column name in upper case."""
    return df.toDF(*[name[:1].upper() + name[1:] for name in df.columns])


def mean_of_arrays(a: Column, b: Column) -> Column:
    """Element-wise mean of two arrays of equal length."""
    return F.zip_with(a, b, lambda x, y: (x + y) / 2)


def pad_with_last(values: Column, extra: int) -> Column:
    """Append the last element ``extra`` times."""
    return F.concat(values, F.array_repeat(F.element_at(values, -1), extra))
