"""Small text, date and size functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.plans.catalog import OA_STATUSES

# The time stamp inside snapshot names and its Spark pattern.
STAMP_PATTERN = "yyyyMMdd_HHmmss"
STAMP_REGEX = r"^state_backup_(\d{8}_\d{6})\.json$"


def oa_status(status: Column) -> Column:
    """Lower-cased open-access status; anything unknown counts as closed, nothing as NULL."""
    lowered = F.lower(status)
    return F.when(status.isNull() | (status == ""), F.lit(None).cast("string")).otherwise(
        F.when(lowered.isin(*OA_STATUSES), lowered).otherwise(F.lit("closed"))
    )


def stamp(moment: Column) -> Column:
    """A time stamp as used in file names."""
    return F.date_format(moment, STAMP_PATTERN)


def stamp_of(name: Column) -> Column:
    """The time stamp of a snapshot's name, NULL when the name has another form or does not parse."""
    found = F.nullif(F.regexp_extract(name, STAMP_REGEX, 1), F.lit(""))
    return F.try_to_timestamp(found, F.lit(STAMP_PATTERN))


def iso(moment: Column) -> Column:
    """ISO-8601 text with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def gigabytes(size: Column) -> Column:
    return F.round(size / F.lit(1024.0**3), 2)


# Unit names and the size up to which each is used, as in PostgreSQL's
# pretty sizes (a value moves to the next unit at 10240).
SIZE_UNITS = ("bytes", "kB", "MB", "GB", "TB", "PB")
SIZE_STEP = 10240


def pretty_size(size: Column) -> Column:
    """A byte count in the largest unit that keeps it below 10240, rounded half up."""
    shown = F.lit(None).cast("string")
    for power, unit in reversed(list(enumerate(SIZE_UNITS))):
        scale = 1024**power
        rounded = F.floor((size + F.lit(scale // 2)) / F.lit(scale)).cast("bigint")
        text = F.concat(rounded.cast("string"), F.lit(f" {unit}"))
        last = power == len(SIZE_UNITS) - 1
        shown = text if last else F.when(rounded < SIZE_STEP, text).otherwise(shown)
    return shown


def partition_date(path: Column, key: str = "updated_date") -> Column:
    """The date of a ``key=YYYY-MM-DD`` folder inside a path."""
    return F.regexp_extract(path, rf"{key}=([^/]+)", 1).try_cast("date")
