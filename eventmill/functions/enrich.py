"""Enrichment: user agent and IP region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.scalar import blank
from eventmill.operators.joins import range_lookup

# Browser rules in order of precedence: name, texts that give it away, and the
# pattern in front of its version.
BROWSERS = (
    ("Edge", ("Edge/", "Edg/", "EdgA/", "EdgiOS/"), r"Edg(?:e|A|iOS)?/"),
    ("Opera", ("OPR/", "Opera/", "Opera "), r"(?:OPR|Opera)[/ ]"),
    ("Firefox", ("Firefox/",), r"Firefox/"),
    ("Chrome", ("Chrome/",), r"Chrome/"),
    ("IE", ("MSIE ",), r"MSIE "),
    ("IE", ("Trident/",), r"Trident/.*rv:"),
    ("Safari", ("Version/",), r"Version/"),
)
# Operating systems: family, texts that give it away, version name or its pattern.
SYSTEMS = (
    ("Windows", ("Windows NT 10.0",), "Windows 10", None),
    ("Windows", ("Windows NT 6.3",), "Windows 8.1", None),
    ("Windows", ("Windows NT 6.2",), "Windows 8", None),
    ("Windows", ("Windows NT 6.1",), "Windows 7", None),
    ("Windows", ("Windows NT 6.0",), "Windows Vista", None),
    ("Windows", ("Windows NT 5.1", "Windows NT 5.2"), "Windows XP", None),
    ("iOS", ("iPhone", "iPad"), None, r" OS ([0-9_]+)"),
    ("OS X", ("Mac OS X",), None, r"Mac OS X ([0-9_.]+)"),
    ("Android", ("Android",), None, r"Android ([0-9.]+)"),
    ("Linux", ("Linux",), "Linux", None),
)


def _first_rule(agent: Column, hints) -> Column:
    """Number of the first rule one of whose texts occurs, null if none does."""
    found = F.when(agent.isNull(), None)
    for number, texts in enumerate(hints):
        hit = agent.contains(texts[0])
        for text in texts[1:]:
            hit = hit | agent.contains(text)
        found = found.when(hit, number)
    return found


def with_user_agent(df: DataFrame, agent: str) -> DataFrame:
    """Add browser, browser_v, os, os_v; null for a blank agent.

    The rules are searched once per row, as plain substrings; only the version
    of the browser found is taken by pattern.
    """
    ua = F.col(agent)
    ruled = df.withColumn("_browser", _first_rule(ua, [r[1] for r in BROWSERS])).withColumn(
        "_system", _first_rule(ua, [r[1] for r in SYSTEMS])
    )
    name, version, system, release = (F.when(blank(agent), None) for _ in range(4))
    for number, (browser, _, prefix) in enumerate(BROWSERS):
        hit = F.col("_browser") == number
        name = name.when(hit, browser)
        version = version.when(hit, F.regexp_extract(ua, prefix + r"([0-9.]+)", 1))
    for number, (family, _, fixed, pattern) in enumerate(SYSTEMS):
        hit = F.col("_system") == number
        system = system.when(hit, family)
        if fixed is None:
            digits = F.translate(F.regexp_extract(ua, pattern, 1), "_", ".")
            release = release.when(hit, F.concat_ws(" ", F.lit(family), digits))
        else:
            release = release.when(hit, fixed)
    return ruled.withColumns({
        "browser": name.otherwise("unknown"),
        "browser_v": version.otherwise("unknown"),
        "os": system.otherwise("unknown"),
        "os_v": release.otherwise("unknown"),
    }).drop("_browser", "_system")


def ipv4_to_long(ip: str | Column) -> Column:
    """Dotted quad as a number, null if it is not one."""
    parts = [F.get(F.split(ip, r"\."), F.lit(i)).try_cast("bigint") for i in range(4)]
    number = ((parts[0] * 256 + parts[1]) * 256 + parts[2]) * 256 + parts[3]
    valid = F.size(F.split(ip, r"\.")) == 4
    for p in parts:
        valid = valid & p.between(0, 255)
    return F.when(valid, number)


# Fixed values of the region texts: what an unknown or local address counts as,
# regions named by their first two characters, and administrative suffixes.
CHINA, HOME_PROVINCE, UNKNOWN = "中国", "上海市", "unknown"
LOCAL_TEXTS = ("局域网",)
VENDOR_PREFIX = "CZ88"
AUTONOMOUS = ("广西", "西藏", "宁夏", "新疆")
MUNICIPALITIES = ("上海", "北京", "重庆", "天津")
SPECIAL_REGIONS = ("香港", "澳门")
INNER_MONGOLIA, INNER_MONGOLIA_FULL = "内蒙", "内蒙古自治区"
PROVINCE, CITY, DISTRICT, COUNTY, SPECIAL = "省", "市", "区", "县", "特别行政区"


def _until(text: Column, mark: str) -> Column:
    """Text up to and including ``mark`` where something precedes it, else null."""
    at = F.instr(text, mark)
    return F.when(at > 1, F.substring(text, F.lit(1), at))


def region_of(text: str | Column) -> dict[str, Column]:
    """Country, province and city of a location text."""
    text = F.col(text) if isinstance(text, str) else text
    head = F.substring(text, 1, 2)
    rest2 = F.substring(text, F.lit(3), F.length(text))
    rest3 = F.substring(text, F.lit(4), F.length(text))
    unknown = F.lit(UNKNOWN)
    local = (
        text.isNull() | (text == "") | text.isin(*LOCAL_TEXTS)
        | F.trim(text).startswith(VENDOR_PREFIX)
    )
    in_province = F.instr(text, PROVINCE) > 1
    after_province = F.substring(text, F.instr(text, PROVINCE) + 1, F.length(text))
    too_short = F.length(text) < 2
    inner_mongolia = head == INNER_MONGOLIA
    autonomous = head.isin(*AUTONOMOUS)
    municipality = head.isin(*MUNICIPALITIES)
    special = head.isin(*SPECIAL_REGIONS)
    chinese = inner_mongolia | autonomous | municipality | special
    country = (
        F.when(local | in_province, CHINA)
        .when(too_short, unknown)
        .when(chinese, CHINA)
        .otherwise(text)
    )
    province = (
        F.when(local, HOME_PROVINCE)
        .when(in_province, _until(text, PROVINCE))
        .when(inner_mongolia, INNER_MONGOLIA_FULL)
        .when(autonomous, head)
        .when(municipality, F.concat(head, F.lit(CITY)))
        .when(special, F.concat(head, F.lit(SPECIAL)))
        .otherwise(unknown)
    )
    city_in_province = F.when(
        F.instr(after_province, CITY) > 0,
        F.substring(after_province, F.lit(1), F.instr(after_province, CITY)),
    )
    city = (
        F.when(local, unknown)
        .when(in_province, city_in_province)
        .when(inner_mongolia, _until(rest3, CITY))
        .when(autonomous, _until(rest2, CITY))
        .when(municipality, F.coalesce(_until(rest3, DISTRICT), _until(rest3, COUNTY)))
    )
    return {"country": country, "province": province, "city": F.coalesce(city, unknown)}


def ip_region(events: DataFrame, ip: str, ranges: DataFrame, lo: str, hi: str, text: str):
    """Add country, province, city by range lookup of the address.

    The equi key is the /16 prefix, so ranges and addresses hash-join; the ranges
    do not overlap, which bounds their expansion by 65,536 plus their number.
    """
    numbered = events.withColumn("_ip", ipv4_to_long(ip))
    located = range_lookup(numbered, ranges.select(lo, hi, text), "_ip", lo, hi, 65536)
    return located.withColumns(region_of(text)).drop("_ip", lo, hi, text)
