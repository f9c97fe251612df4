"""Bronze to silver: typed, judged, de-duplicated, masked."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lakestay import fixed_values as fv
from lakestay.functions import keys, labels, parsing
from lakestay.operators import quality
from lakestay.sinks.batches import write_day, write_quarantine
from lakestay.sources.readers import layer_path, read_layer

# How a field of each kind is read from its raw text.
KINDS: dict[str, Callable[[str], Column]] = {
    "text": parsing.clean_str,
    "upper": lambda c: F.upper(parsing.clean_str(c)),
    "lower": lambda c: F.lower(parsing.clean_str(c)),
    "title": lambda c: F.initcap(parsing.clean_str(c)),
    "text_or_empty": lambda c: F.coalesce(parsing.clean_str(c), F.lit("")),
    "money": parsing.to_money,
    "money_or_zero": lambda c: F.coalesce(parsing.to_money(c), F.lit(0).cast("decimal(15,2)")),
    "int": parsing.parse_int,
    "int_or_zero": lambda c: F.coalesce(parsing.parse_int(c), F.lit(0)),
    "double": parsing.parse_double,
    "flag": lambda c: F.coalesce(parsing.to_bool(c), F.lit(False)),
    "date": parsing.parse_date,
    "time": parsing.parse_ts,
    "list": parsing.clean_list_literal,
    "status": labels.map_status,
    "channel": labels.map_channel,
    "email_hash": keys.mask_email,
    "phone_hash": keys.mask_phone,
}


@dataclass(frozen=True)
class Entity:
    """A silver table: which raw field becomes which column, and how it is judged."""

    name: str
    fields: tuple[tuple[str, str, str], ...]  # (column, kind, raw field)
    derived: tuple[tuple[str, Column], ...] = ()

    @property
    def key(self) -> str:
        return fv.ENTITY_KEYS[self.name][0]

    @property
    def recency(self) -> str:
        return fv.ENTITY_KEYS[self.name][1]

    @property
    def rules(self) -> tuple[tuple[str, str], ...]:
        return fv.DQ_RULES[self.name]

    def typed(self, bronze: DataFrame) -> DataFrame:
        carried = [c for c in (*fv.META_COLUMNS, "_row_id") if c in bronze.columns]
        columns = [KINDS[kind](raw).alias(column) for column, kind, raw in self.fields]
        return bronze.select(*columns, *carried).withColumns(dict(self.derived))

    def ties(self, typed: DataFrame) -> list[str]:
        """Columns that make the order of equal keys total: source file, then the row's id or all others."""
        if "_row_id" in typed.columns:
            return ["_source_file", "_row_id"]
        rest = [c for c in typed.columns if c not in (self.key, self.recency, "_source_file")]
        return ["_source_file", *rest]


def _fields(kinds: dict[str, str]) -> tuple[tuple[str, str, str], ...]:
    """"column: kind" or "column: kind < raw field"."""
    out = []
    for column, kind in kinds.items():
        kind, _, raw = kind.partition(" < ")
        out.append((column, kind, raw or column))
    return tuple(out)


def _entities() -> dict[str, Entity]:
    return {
        e.name: e
        for e in (
            Entity(
                "bookings",
                _fields({
                    "booking_id": "upper", "hotel_id": "upper", "user_id": "upper",
                    "room_type": "text", "checkin_date": "date", "checkout_date": "date",
                    "total_amount": "money", "currency": "upper", "booking_status": "status",
                    "booking_channel": "channel < source_channel", "payment_method": "upper",
                    "created_at": "time",
                }),
                (("nights", parsing.stay_nights("checkin_date", "checkout_date")),),
            ),
            Entity(
                "hotels",
                _fields({
                    "hotel_id": "upper", "hotel_name": "text", "hotel_tier": "lower",
                    "star_rating": "int", "city": "text", "country": "upper", "region": "text",
                    "latitude": "double", "longitude": "double", "total_rooms": "int",
                    "facilities": "list", "partner_since": "date", "is_active": "flag",
                }),
            ),
            Entity(
                "payments",
                _fields({
                    "payment_id": "upper", "booking_id": "upper", "amount": "money",
                    "currency": "upper", "payment_method": "upper", "payment_status": "upper",
                    "gateway_code": "text_or_empty", "processed_at": "time",
                    "refund_amount": "money_or_zero", "refund_at": "time",
                }),
            ),
            Entity(
                "customers",
                _fields({
                    "user_id": "upper", "email_hash": "email_hash < email",
                    "phone_hash": "phone_hash < phone", "country": "upper",
                    "user_segment": "lower", "loyalty_tier": "title",
                    "loyalty_points": "int_or_zero", "first_booking_date": "date",
                    "total_bookings": "int_or_zero", "is_active": "flag",
                    "registered_at": "date",
                }),
            ),
            Entity(
                "clickstream",
                _fields({
                    "event_id": "text", "session_id": "text", "user_id": "upper",
                    "event_type": "lower", "page_url": "text_or_empty", "hotel_id": "upper",
                    "search_query": "text", "device_type": "lower", "os": "text_or_empty",
                    "event_timestamp": "time",
                }),
            ),
        )
    }


ENTITIES: dict[str, Entity] = {}


def entity(name: str) -> Entity:
    """An entity by name; built on first use, as columns need a running session."""
    if not ENTITIES:
        ENTITIES.update(_entities())
    return ENTITIES[name]


def silver_frames(name: str, bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of one entity."""
    e = entity(name)
    typed = e.typed(bronze)
    spread = ["_row_id"] if "_row_id" in typed.columns else None
    return quality.split_dq(typed, e.rules, [e.key], e.recency, e.ties(typed), spread)


def cleanse(
    spark: SparkSession,
    root: str,
    name: str,
    date: str,
    max_ratio: float = fv.MAX_REJECT_RATIO,
) -> dict[str, object]:
    """Write silver and quarantine of one entity and day.

    The share of invalid rows is checked before anything is written, in a pass
    without a shuffle of rows; a tripped breaker leaves the last good silver.
    """
    e = entity(name)
    bronze = read_layer(spark, root, "bronze", name, date, row_id=True)
    typed = e.typed(bronze)

    reasons = {
        r[fv.DQ_REASON]: r["n_rows"]
        for r in quality.with_reason(typed, e.rules)
        .groupBy(fv.DQ_REASON)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .collect()
    }
    total = sum(reasons.values())
    invalid = total - reasons.pop("", 0)
    quality.check_breaker(invalid, total, max_ratio)

    judged = quality.mark_dq(typed, e.rules, [e.key], e.recency, e.ties(typed), ["_row_id"])
    judged = judged.drop("_row_id").persist(StorageLevel.DISK_ONLY)
    try:
        valid = judged.filter(F.col(fv.DQ_REASON) == "").drop(fv.DQ_REASON)
        silver = write_day(valid, layer_path(root, "silver", name), date)
        rest = judged.filter(F.col(fv.DQ_REASON) != "")
        write_quarantine(rest, layer_path(root, "quarantine", name), date)
    finally:
        judged.unpersist()
    kept = spark.read.parquet(silver).count()
    return {
        "bronze_rows": total,
        "silver_rows": kept,
        "duplicates": total - invalid - kept,
        "dq_invalid": invalid,
        "dq_reasons": reasons,
    }
