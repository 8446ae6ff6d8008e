"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that survive cleaning, and the divisor from ms to days.
UNWANTED_CHARACTERS = "[^a-zA-Z0-9,-]"
MS_PER_DAY = 86_400_000

# The ASCII characters that the pattern matches.
_UNWANTED_ASCII = "".join(c for c in map(chr, range(128)) if not (c.isalnum() or c in ",-"))

# More than there are positions: the longs, and null.
_POSITIONS = (1 << 64) + 1


def stripped(text: Column) -> Column:
    """Keep ASCII letters, digits, commas and hyphens only (so spaces vanish as well).

    Pure ASCII text, which has as many bytes as characters, takes a character lookup that
    costs a quarter of the pattern match; all other text takes the pattern.
    """
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.translate(text, _UNWANTED_ASCII, "")).otherwise(
        F.regexp_replace(text, UNWANTED_CHARACTERS, "")
    )


def state_of(location: Column) -> Column:
    """State part of "City,ST"; null without a comma."""
    return F.get(F.split(location, ","), F.lit(1))


def instant(ts: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.call_function("div", ts, F.lit(1000)))


def recency(ts: Column, position: Column | None = None) -> Column:
    """One decimal that orders events by time, then by position within the session, null first.

    A decimal instead of struct(ts, position) keeps the aggregation buffer fixed-width, which a
    hash aggregate needs; a struct buffer would make Spark sort the whole log. Exact for every
    position; a time too far off for 38 digits, over 5.4e18 ms, is an error.
    """
    whole = "decimal(20,0)"
    rank = F.lit(0).cast(whole)
    if position is not None:
        rank = F.coalesce(position.cast(whole) + F.lit(str((1 << 63) + 1)).cast(whole), rank)
    return ts.cast(whole) * F.lit(str(_POSITIONS)).cast(whole) + rank.cast("decimal(38,0)")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed days between two epoch-ms values, truncated towards zero."""
    return ((later - earlier) / F.lit(MS_PER_DAY)).cast("int")


def hash_uniform(key: Column, seed: int) -> Column:
    """Number in [0, 1) that depends on the key and the seed alone.

    Unlike rand(seed) it does not change with partitioning, file layout or retries.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
