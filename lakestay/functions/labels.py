"""Canonical labels and calendar classes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestay import fixed_values as fv


def _map_words(word: Column, words: Mapping) -> Column:
    """A WHEN chain, one branch per distinct result."""
    result = None
    for target in dict.fromkeys(words.values()):
        hit = word.isin(*[w for w, t in words.items() if t == target])
        result = F.when(hit, F.lit(target)) if result is None else result.when(hit, F.lit(target))
    return result


def map_status(c: Column | str) -> Column:
    word = F.upper(F.trim(c))
    return _map_words(word, fv.STATUS_SPELLINGS).otherwise(fv.STATUS_OTHER)


def map_channel(c: Column | str) -> Column:
    word = F.lower(F.trim(c))
    return (
        _map_words(word, fv.CHANNEL_SPELLINGS)
        .when(word.startswith(fv.CHANNEL_PARTNER_PREFIX), fv.CHANNEL_PARTNER)
        .otherwise(fv.CHANNEL_OTHER)
    )


def device_channel(c: Column) -> Column:
    return _map_words(c, fv.DEVICE_CHANNELS).otherwise(fv.CHANNEL_ID_OTHER)


def season(day: Column) -> Column:
    months = {m: name for name, ms in fv.SEASON_MONTHS.items() for m in ms}
    return _map_words(F.month(day), months).otherwise(fv.SEASON_OTHER)


def is_status(c: Column | str, status: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c) == status
