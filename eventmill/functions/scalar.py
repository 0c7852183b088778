"""Column functions: strings, lists, dates and dimension keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(column: str | Column) -> Column:
    """True for null, empty and white-space-only text."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull() | column.rlike(r"^\s*$")


def null_if_blank(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(~blank(column), column)


# -- strings and lists ---------------------------------------------------------------


def split_index(text: str | Column, index: int, separator: str = ",") -> Column:
    """The index-th part of a list text, null where it is missing."""
    return F.get(F.split(text, separator), F.lit(index))


def zip_lists(*lists: Column) -> Column:
    """Zip comma lists item by item, ``a,b[,c]`` joined by ``->``, to the shortest."""
    parts = [F.split(text, ",") for text in lists]
    sizes = [F.size(p) for p in parts]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    cut = [F.slice(p, F.lit(1), shortest) for p in parts]
    zipped = cut[0]
    for other in cut[1:]:
        zipped = F.zip_with(zipped, other, lambda a, b: F.concat(a, F.lit(","), b))
    return F.array_join(zipped, "->")


def zip_packed(text: str | Column, count: int) -> Column:
    """The same for one text that packs ``count`` lists separated by ``-``."""
    return zip_lists(*[split_index(text, i, "-") for i in range(count)])


def lower_null_safe(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(F.nullif(column, F.lit("")))


def normalize_tokens(text: str | Column) -> Column:
    """Lower-case words without commas and full stops."""
    # translate() would look up every character; two searches for a byte cost less.
    bare = F.replace(F.replace(F.lower(text), F.lit(",")), F.lit("."))
    return F.array_remove(F.split(bare, r"\s+"), "")


def url_decode(column: str | Column) -> Column:
    return F.try_url_decode(column)


# -- dimensions and keys -----------------------------------------------------------


def version_dim(name: str | Column, version: str | Column) -> Column:
    """``name:version``; fixed texts stand in for blank parts."""
    name = F.col(name) if isinstance(name, str) else name
    version = F.col(version) if isinstance(version, str) else version
    # Fixed values of the dimension tables, spelling included.
    no_name, no_version = "unknown:unknown", "unknow"
    return (
        F.when(blank(name), no_name)
        .when(blank(version), F.concat_ws(":", name, F.lit(no_version)))
        .otherwise(F.concat_ws(":", name, version))
    )


def row_key(time_ms: Column, uuid: Column, member: Column, alias: Column) -> Column:
    """``time_crc``: the checksum runs over uuid, member, uuid, alias; blanks skipped."""
    skip = F.lit("")
    user = F.coalesce(null_if_blank(uuid), skip)
    fed = F.concat(user, F.coalesce(null_if_blank(member), skip), user, alias)
    return F.concat_ws("_", time_ms.cast("string"), F.crc32(fed.cast("binary")).cast("string"))


# -- dates -------------------------------------------------------------------------


def week_of_year(ts: str | Column) -> Column:
    """Week number with weeks from Sunday; week 1 holds the first of January."""
    day = F.to_date(ts)
    saturday = F.date_add(day, 7 - F.dayofweek(day))
    january_first = F.trunc(day, "year")
    lead_days = F.dayofweek(january_first) - 1
    in_year = F.floor((F.dayofyear(day) - 1 + lead_days) / 7) + 1
    return F.when(F.year(saturday) > F.year(day), F.lit(1)).otherwise(in_year).cast("int")


def date_parts(ts: str) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "season": F.quarter(ts),
        "month": F.month(ts),
        "week": week_of_year(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def period_starts(ts: str, shift_days: int = 0) -> dict[str, Column]:
    """Dates (midnight) on which this, the previous and next week and month begin."""
    day = F.to_date(ts)
    week = F.date_sub(day, F.dayofweek(day) - 1)
    month = F.trunc(day, "month")
    return {
        "this_week": week,
        "previous_week": F.date_sub(week, 7),
        "next_week": F.date_add(week, 7),
        "this_month": month,
        "previous_month": F.add_months(month, -1),
        "next_month": F.add_months(month, 1),
        "today": day,
        "shifted": F.date_add(day, shift_days),
    }


def is_running_date(text: str | Column) -> Column:
    """Is the text written as yyyy-MM-dd?"""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit(False))


def parse_running_date(text: str | Column) -> Column:
    """The date, null where the text does not name one."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(is_running_date(text), F.try_to_date(text, "yyyy-MM-dd"))


def epoch_millis(text: str | Column) -> Column:
    """Milliseconds of a fractional-second text, -1 where it is not a number."""
    text = F.col(text) if isinstance(text, str) else text
    millis = (F.trim(text).try_cast("double") * 1000).try_cast("bigint")
    return F.coalesce(millis, F.lit(-1).cast("bigint"))


def epoch_timestamp(text: str | Column) -> Column:
    millis = epoch_millis(text)
    return F.when(millis >= 0, F.timestamp_millis(millis))
