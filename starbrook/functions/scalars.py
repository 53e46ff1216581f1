"""Scalar expressions of the event model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
UNKNOWN_CUSTOMER = "-1"
UNKNOWN_TEXT = "Not Defined"
MISSING_KEY = "NA"
LARGEST_EPOCH_SECOND = 9_999_999_999

# Years 1 to 9999, in milliseconds.
FIRST_MILLI = -62_135_596_800_000
LAST_MILLI = 253_402_300_799_999

# Fixed value: every character that counts as white space.
_WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Calendar date, any one separator, time down to milli- or microseconds, numeric offset.
_ISO = (
    r"(?s)^\d{4}-\d{2}-\d{2}"
    r"(.([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d(\.\d{3}(\d{3})?)?)?)?"
    r"([+-]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?)?)?$"
)


def present(c: Column) -> Column:
    """Neither null nor empty."""
    return c.isNotNull() & (c != "")


def text_or_unknown(c: Column) -> Column:
    """The text as it is, or the unknown label when null or only white space."""
    return F.when(F.ltrim(c, F.lit(_WHITE_SPACE)) != "", c).otherwise(F.lit(UNKNOWN_TEXT))


def customer_id(cookie: Column) -> Column:
    return F.when(present(cookie), cookie).otherwise(F.lit(UNKNOWN_CUSTOMER))


def store_name(store_id: Column) -> Column:
    return F.concat(F.lit("Store "), store_id)


def device_id(user_agent: Column, resolution: Column) -> Column:
    """The one device identity, used by the dimension and by the fact lookup alike."""
    label = F.concat(text_or_unknown(user_agent), F.lit("_"), text_or_unknown(resolution))
    return F.sha2(label, 256)


def has_device(user_agent: Column, resolution: Column) -> Column:
    return present(user_agent) | present(resolution)


def epoch_millis(time_stamp: Column) -> Column:
    """Seconds or milliseconds to milliseconds; null outside the calendar."""
    millis = F.when(time_stamp > LARGEST_EPOCH_SECOND, time_stamp).otherwise(
        F.try_multiply(time_stamp, F.lit(1000).cast("bigint"))
    )
    return F.when(millis.between(FIRST_MILLI, LAST_MILLI), millis)


def event_time(time_stamp: Column) -> Column:
    return F.timestamp_millis(epoch_millis(time_stamp))


def date_id(when: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic instead of formatting."""
    return F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)


def date_of(date_id_column: Column) -> Column:
    return F.make_date(
        F.floor(date_id_column / 10000).cast("int"),
        F.floor(date_id_column / 100).cast("int") % 100,
        date_id_column % 100,
    )


def iso_date(text: Column) -> Column:
    """Wall-clock date of an ISO timestamp text, null when it is not one."""
    return F.when(text.rlike(_ISO), F.substring(text, 1, 10).try_cast("date"))


def date_attributes(day: Column) -> list[Column]:
    """The eleven columns of the date dimension for a DATE column."""
    return [
        date_id(day).alias("date_id"),
        day.alias("full_date"),
        F.date_format(day, "EEEE").alias("date_of_week"),
        F.date_format(day, "EEE").alias("date_of_week_short"),
        F.when(F.weekday(day) >= 5, F.lit("weekend"))
        .otherwise(F.lit("weekday"))
        .alias("is_weekday_or_weekend"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        F.date_format(day, "yyyyMM").alias("year_month"),
    ]


def fact_id(keys: list[Column], time_stamp: Column) -> Column:
    """SHA-256 over the six keys and the raw timestamp."""
    parts = [F.coalesce(c.cast("string"), F.lit(MISSING_KEY)) for c in [*keys, time_stamp]]
    return F.sha2(F.concat_ws("_", *parts), 256)
