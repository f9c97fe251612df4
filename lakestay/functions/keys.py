"""Keys, masks and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestay.functions.parsing import clean_str


def date_id(c: Column | str) -> Column:
    """A day as the integer YYYYMMDD."""
    day = F.to_date(c)
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def surrogate_key(*parts: Column | str) -> Column:
    """A key stable over runs: the first 63 bits of the MD5 of the parts."""
    digest = F.md5(F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts]))
    high = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    low = F.conv(F.substring(digest, 16, 1), 16, 10).cast("bigint")
    return F.shiftleft(high, 3) + F.shiftright(low, 1)


def mask_email(c: Column | str) -> Column:
    return F.coalesce(F.sha2(F.lower(clean_str(c)), 256), F.lit(""))


def mask_phone(c: Column | str) -> Column:
    """Hash of the digits and plus signs; a missing phone gives an empty text."""
    return F.coalesce(F.sha2(F.regexp_replace(clean_str(c), "[^0-9+]", ""), 256), F.lit(""))


def to_usd(amount: Column, units_per_usd: Column) -> Column:
    """Exact decimal conversion, half up to cents; NULL without a usable rate."""
    rate = F.nullif(units_per_usd, F.lit(0).cast("decimal(18,6)"))
    return F.round(amount / rate, 2).cast("decimal(18,2)")
