"""Reading dirty text: every parser returns NULL for text it cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestay import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_str(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def null_if_empty(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def to_money(c: Column | str) -> Column:
    """Amount text to decimal(15,2), keeping only digits and dots.

    A minus sign is dropped and "1.234,56" reads as 1.23456, on purpose.
    """
    return F.nullif(F.regexp_replace(_col(c), "[^0-9.]", ""), F.lit("")).try_cast("decimal(15,2)")


def to_bool(c: Column | str) -> Column:
    word = F.lower(F.trim(_col(c)))
    return F.when(word.isin(*fv.TRUE_WORDS), True).when(word.isin(*fv.FALSE_WORDS), False)


def parse_date(c: Column | str) -> Column:
    return F.try_to_date(clean_str(c), fv.DATE_FORMAT)


def parse_ts(c: Column | str) -> Column:
    return F.try_to_timestamp(clean_str(c), F.lit(fv.TIMESTAMP_FORMAT))


def parse_int(c: Column | str) -> Column:
    return clean_str(c).try_cast("int")


def parse_double(c: Column | str) -> Column:
    return clean_str(c).try_cast("double")


def clean_list_literal(c: Column | str) -> Column:
    """"['Bar', 'Beach']" to "bar,beach"; NULL to an empty text."""
    return F.coalesce(F.lower(F.regexp_replace(_col(c), r"[\[\]'\" ]", "")), F.lit(""))


def to_tag_array(c: Column | str) -> Column:
    """Comma text to a sorted array without empty tags."""
    return F.sort_array(F.filter(F.split(F.lower(_col(c)), ","), lambda tag: tag != ""))


def stay_nights(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_col(end), _col(start))
