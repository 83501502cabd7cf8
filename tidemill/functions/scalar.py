"""Column functions. All are built from native expressions and stay in generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three accepted text formats of a timestamp.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
PLAIN_SECONDS = "yyyy-MM-dd HH:mm:ss"
ISO_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSS"
US_DATE = "MM/dd/yyyy"
US_STAMP = "MM/dd/yyyy hh:mm:ss a"

# Fixed value: characters stripped from both ends of a word.
PUNCTUATION = ".,!?;:'\"()[]{}"


def parse_ts(c: Column, *formats: str) -> Column:
    """First format that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def coerce_ts(c: Column, *formats: str) -> Column:
    """Epoch milliseconds (any whole number) or one of the text formats; anything else is NULL."""
    return F.coalesce(F.timestamp_millis(c.try_cast("long")), parse_ts(c, *formats))


def date_diff_days(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def duration_minutes(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(60_000_000.0)


def day_suffix(topic: Column, ts: Column) -> Column:
    return F.concat_ws("-", topic, F.date_format(ts, "yyyyMMdd"))


def concat_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def count_words(text: Column) -> Column:
    """Number of blank-separated words; blank text has none."""
    t = F.btrim(text, F.lit(" \t\n\r"))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, "[ \t\n\r]+")))


def mask_email(c: Column) -> Column:
    """First character, ``***`` and everything from the @ on; short or @-less text stays."""
    at = F.instr(c, "@")
    rest = F.substr(c, at, F.length(c))
    return F.when(at <= 2, c).otherwise(F.concat(F.substring(c, 1, 1), F.lit("***"), rest))


def regex_route(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, pattern, replacement)


def surrogate_key(*cols: Column) -> Column:
    """md5 over the business columns, each with its length before it and NULL as a bare mark, so that no two lists collide."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.md5(F.concat_ws(",", *[part(c) for c in cols]))


def hex_mod(digest: Column, n: int, digits: int) -> Column:
    """Remainder of a long hex number, folded eight digits at a time in BIGINT."""
    out = F.lit(0).cast("long")
    for start in range(1, digits, 8):
        piece = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        out = (out * F.lit(2 ** 32) + piece) % F.lit(n)
    return out


def hash_partition(key: Column, n: int, algorithm: str = "sha256") -> Column:
    """Partition number from the whole digest of a key; stable across languages."""
    text = key.cast("string")
    if algorithm == "sha256":
        return hex_mod(F.sha2(text, 256), n, 64).cast("int")
    if algorithm == "md5":
        return hex_mod(F.md5(text), n, 32).cast("int")
    raise ValueError("algorithm must be sha256 or md5")


def to_money(c: Column, precision: int = 10) -> Column:
    return F.round(c, 2).cast(f"decimal({precision},2)")


def bool_decode(c: Column) -> Column:
    """'t'/'f', TRUE/FALSE, yes/no, 1/0 in any case; junk is NULL."""
    return F.btrim(c).try_cast("boolean")


def json_get(c: Column, ddl: str) -> Column:
    return F.from_json(c, ddl)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \t\n\r]+"), lambda w: w != "")


def strip_chars(c: Column, chars: str = PUNCTUATION) -> Column:
    return F.btrim(c, F.lit(chars))


def risk_frequency(n: Column) -> Column:
    return F.least(F.lit(0.5) + (n - 5) * F.lit(0.1), F.lit(1.0))


def risk_value(amount: Column, full: float = 10000.0) -> Column:
    return F.least(amount / F.lit(full), F.lit(1.0))


def risk_velocity(total: Column, threshold: float = 10000.0, span: float = 25000.0) -> Column:
    return F.least(F.lit(0.6) + (total - F.lit(threshold)) / F.lit(span), F.lit(1.0))


def map_lookup(c: Column, table: Mapping[object, object]) -> Column:
    """Literal lookup table as a map expression; a missing key gives NULL."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def any_of(tests: Sequence[Column]) -> Column:
    return reduce(Column.__or__, tests)


def all_of(tests: Sequence[Column]) -> Column:
    return reduce(Column.__and__, tests)
