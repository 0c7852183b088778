"""Log and message parsing as column expressions over a table of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.scalar import blank, epoch_millis, row_key
from eventmill.session import prepare

# The access-log line format and the tracking-log separators.
ACCESS_LINE = (
    r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+)$'
)
TRACKING_SEPARATOR = r"\^A"
# Three parts of any kind, one that is not empty, then separators only.
TRACKING_SHAPE = (
    rf"(?s)^(?:(?:(?!{TRACKING_SEPARATOR}).)*{TRACKING_SEPARATOR}){{3}}"
    rf"(?:(?!{TRACKING_SEPARATOR}).)+(?:{TRACKING_SEPARATOR})*$"
)
# Event aliases of tracking logs (launch, page view, order request,
# order success, order refund, event).
EVENT_ALIASES = ("e_l", "e_pv", "e_crt", "e_cs", "e_cr", "e_e")


def parse_delimited(
    lines: DataFrame, value: str, fields: dict[str, str], separator: str = ","
) -> DataFrame:
    """Split, trim and cast each line into named fields; a bad cast gives null."""
    parts = F.split(value, separator)
    return lines.select(
        *[
            F.trim(F.get(parts, F.lit(i))).try_cast(kind).alias(name)
            for i, (name, kind) in enumerate(fields.items())
        ]
    )


def parse_access_log(lines: DataFrame, value: str) -> DataFrame:
    """Nine fields of every valid line.

    The pattern is matched once per line, as the filter; since no field of a
    valid line holds white space, one split then yields all fields.
    """
    part = [F.get(F.split(value, r"\s"), F.lit(i)) for i in range(10)]
    return lines.filter(F.col(value).rlike(ACCESS_LINE)).select(
        part[0].alias("ip"),
        part[1].alias("client_ident"),
        part[2].alias("user_id"),
        F.concat_ws(" ", F.ltrim(part[3], F.lit("[")), F.rtrim(part[4], F.lit("]"))).alias(
            "date_time"
        ),
        F.substring(part[5], F.lit(2), F.length(part[5])).alias("method"),
        part[6].alias("endpoint"),
        F.substring(part[7], F.lit(1), F.length(part[7]) - 1).alias("protocol"),
        part[8].cast("int").alias("response_code"),
        part[9].try_cast("bigint").alias("content_size"),
    )


def parse_space_log(lines: DataFrame, value: str) -> DataFrame:
    """Fields 0, 1, 3, 5, 6 of a space-separated request log."""
    part = [F.trim(F.get(F.split(value, " "), F.lit(i))) for i in range(7)]
    return lines.select(
        part[0].alias("ip"),
        part[1].alias("user_id"),
        F.try_to_timestamp(part[3], F.lit("dd/MM/yyyy:HH:mm:ss")).alias("event_time"),
        part[5].alias("method"),
        part[6].alias("url"),
    )


def query_text(uri: Column) -> Column:
    """The part after the ``?`` of a URI with exactly one; a trailing ``?`` does not count."""
    bare = F.rtrim(uri, F.lit("?"))
    marks = F.length(bare) - F.length(F.replace(bare, F.lit("?")))
    return F.when(marks == 1, F.trim(F.split_part(bare, F.lit("?"), F.lit(2)), F.lit("&")))


def query_params(text: Column) -> Column:
    """URL-decoded parameters of a query text as a map; the last of equal names wins.

    A name without a value maps to null, no text to an empty map. Repeated names
    need the session setting made by :func:`eventmill.session.prepare`; without
    it they raise an error.
    """
    decoded = F.transform_values(
        F.str_to_map(text, F.lit("&+"), F.lit("=")),
        lambda _, v: F.try_url_decode(F.nullif(F.split_part(v, F.lit("="), F.lit(1)), F.lit(""))),
    )
    return F.when(text != "", decoded).otherwise(F.create_map().cast("map<string, string>"))


def parse_tracking_log(lines: DataFrame, value: str) -> DataFrame:
    """ip, server time, host and parameter map of every four-part line.

    Empty parts at the end of a line do not count as parts.
    """
    prepare(lines.sparkSession)
    # The shape is matched on the line itself: a filter on the parts would be pushed
    # below their projection and split the line again.
    part = F.col("_part")
    return (
        lines.filter(F.col(value).rlike(TRACKING_SHAPE))
        .select(F.split(value, TRACKING_SEPARATOR).alias("_part"))
        .withColumn("_query", query_text(F.get(part, F.lit(3))))
        .select(
            F.get(part, F.lit(0)).alias("ip"),
            F.get(part, F.lit(1)).alias("s_time"),
            F.get(part, F.lit(2)).alias("http_host"),
            query_params(F.col("_query")).alias("params"),
        )
    )


def keep_known_events(parsed: DataFrame, alias: Column) -> DataFrame:
    """Only the six known event kinds; lines without one fall out with them."""
    return parsed.filter(alias.isin(*EVENT_ALIASES))


def tracking_row_keys(parsed: DataFrame) -> DataFrame:
    """Add the key under which a tracking event is stored."""
    params = F.col("params")
    return parsed.withColumn(
        "row_key",
        row_key(epoch_millis("s_time"), params["u_ud"], params["u_mid"], params["en"]),
    )


def parse_json_order(messages: DataFrame, value: str, schema: str) -> DataFrame:
    """JSON order messages; broken messages give null fields, not a failure."""
    return messages.select(F.from_json(value, schema).alias("o")).select("o.*")


def parse_order_line(lines: DataFrame, value: str) -> DataFrame:
    """``order,province,price`` lines; malformed ones (with a space) count as (0, 0.0)."""
    part = F.split(value, ",")
    malformed = F.col(value).contains(" ")
    province = F.when(malformed, F.lit(0)).otherwise(F.get(part, F.lit(1)).try_cast("int"))
    price = F.when(malformed, F.lit(0.0)).otherwise(F.get(part, F.lit(2)).try_cast("double"))
    return lines.filter(~blank(value)).select(
        province.alias("province_id"), price.alias("order_price")
    )


def quarantine(df: DataFrame, casts: dict[str, str], flag: str = "is_bad") -> DataFrame:
    """Cast text columns and flag the rows that do not fit their types."""
    bad = F.lit(False)
    for name, kind in casts.items():
        bad = bad | (F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
    flagged = df.withColumn(flag, bad)
    return flagged.withColumns({n: F.col(n).try_cast(kind) for n, kind in casts.items()})
