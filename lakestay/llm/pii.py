"""Personal data in texts, with DataFrame functions alone.

Regular expressions propose spans, validators confirm them (Luhn for cards, the remainder
modulo 97 for bank accounts, ranges and numbers of digits elsewhere), and words near a span
raise or lower its score. Base kinds are kept whatever their score; added kinds need
LEAST_SCORE.

Positions come from the pieces between matches: split() and regexp_extract_all() see the
same matches, so the lengths of pieces and matches add up to starts and ends. Patterns are
possessive, so that no run of characters, however long, is tried twice or nests calls.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestay.llm.batches import prepare

LEAST_SCORE = 0.5
# Code points before and after a span in which context words count.
CONTEXT = 40
# Matches whose lengths are summed one by one; sums of whole stretches come before them.
_STRETCH = 256


class Kind(NamedTuple):
    name: str
    sign: str  # cheap pattern every text with a match has
    pattern: str
    valid: Callable[[Column], Column]
    score: float  # of a confirmed span without context
    helps: str  # words that add to the score
    hinders: str  # words that take from it


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn checksum."""
    values = F.transform(
        _characters(F.reverse(digits)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether a bank account number without spaces passes the checksum modulo 97."""
    turned = F.concat(F.substring(account, 5, 100), F.substring(account, 1, 4))
    rest = F.aggregate(
        _characters(turned), F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97,
    )
    return rest == 1


def _card(match: Column) -> Column:
    return F.length(_digits(match)).between(14, 19) & luhn(_digits(match))


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

BASE_KINDS = (
    Kind(
        "email", "@",
        # Starts where a run of these characters starts, or where the last match ended.
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True), 0.8, "mail|contact|write to|reach", "example|noreply|no-reply",
    ),
    Kind(
        "ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), 0.6,
        "address|host|server|login|client", "version|release|section|chapter",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?[0-9]){13}", r"[0-9](?:[\x20-]?[0-9]){13,}+", _card, 0.7,
        "card|credit|debit|visa|master|payment|cvv|expir", "order|invoice|tracking|serial",
    ),
    Kind(
        "phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6,
        "phone|call|mobile|cell|fax|contact|whatsapp|tel", "order|invoice|serial|version",
    ),
)
ADDED_KINDS = (
    Kind(
        "iban", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda m: mod97(F.replace(m, F.lit(" "), F.lit(""))), 0.8, "iban|account|bank|bic|swift", "serial|licen",
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "ssn|social security|tax|taxpayer", "order|part|serial",
    ),
)
KINDS = BASE_KINDS + ADDED_KINDS

SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often and in whatever lambda it is used."""
    return F.transform(F.array(value), body)[0]


def _prefix(lengths: Column, n: Column, whole: Column) -> Column:
    """Sum of the first n lengths; whole has the sums before each stretch."""
    at = F.floor(n / _STRETCH).cast("int")
    inside = F.slice(lengths, at * _STRETCH + 1, n - at * _STRETCH)
    return whole[at] + F.aggregate(inside, F.lit(0).cast("bigint"), lambda a, v: a + v)


def _stretches(lengths: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.floor(F.size(lengths) / _STRETCH).cast("int")),
        lambda k: F.aggregate(F.slice(lengths, F.lit(1), k * _STRETCH), F.lit(0).cast("bigint"), lambda a, v: a + v),
    )


def _placed(text: Column, pattern: str) -> Column:
    """All matches: start, end, match, and the text around each."""

    def build(t: Column) -> Column:
        matches, pieces = t["matches"], t["pieces"]
        lengths = F.transform(matches, lambda m, i: (F.length(pieces[i]) + F.length(m)).cast("bigint"))

        def rows(s: Column) -> Column:
            def row(m: Column, i: Column) -> Column:
                end = _prefix(s["lengths"], i + 1, s["whole"])
                return F.struct(
                    (end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"),
                    F.concat_ws(
                        " ", F.substring(pieces[i], -CONTEXT, CONTEXT), F.substring(pieces[i + 1], 1, CONTEXT)
                    ).alias("around"),
                )

            return F.transform(matches, row)

        return _let(lengths, lambda n: _let(F.struct(n.alias("lengths"), _stretches(n).alias("whole")), rows))

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.split(text, pattern, -1).alias("pieces"),
    )
    return _let(both, build)


def _spans(text: Column, kind: Kind, rank: int, least: float | None) -> Column:
    """Confirmed spans of one kind; an empty list where the text has no sign of it."""

    def span(m: Column) -> Column:
        around = F.lower(m["around"])
        score = F.lit(kind.score)
        score += F.when(around.rlike(kind.helps), 0.3).otherwise(0.0)
        score -= F.when(around.rlike(kind.hinders), 0.2).otherwise(0.0)
        return F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2).alias("score"),
        )

    confirmed = F.filter(_placed(text, kind.pattern), lambda m: kind.valid(m["match"]))
    found = F.transform(confirmed, span)
    if least is not None:
        found = F.filter(found, lambda s: s["score"] >= least)
    sign = text.contains(kind.sign) if len(kind.sign) == 1 else text.rlike(kind.sign)
    return F.when(sign, found).otherwise(F.array().cast(SPANS))


def personal_data(
    docs: DataFrame, least_score: float = LEAST_SCORE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and spans (start, rank of the kind, end, kind, score) of every row, by start and kind.

    start and end are code points, end exclusive; matches of one kind do not overlap. A null
    or empty text has no spans; null ids and repeated rows are kept; other columns are not
    read. No shuffle.
    """
    prepare(docs.sparkSession)
    own = docs.select(
        docs[id_column].cast("bigint").alias("doc_id"), F.coalesce(docs[text_column], F.lit("")).alias("text")
    )
    kinds = [
        _spans(F.col("text"), kind, rank, None if kind in BASE_KINDS else least_score)
        for rank, kind in enumerate(KINDS)
    ]
    return own.select("doc_id", F.array_sort(F.concat(*kinds)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of spans in their order, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts (n_spans: of all kinds) and digests of personal_data(): one row for each row found."""
    spans = F.col("spans")

    def count(rank: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("bigint")

    base = F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *[count(rank).alias(f"n_{k.name}") for rank, k in enumerate(BASE_KINDS)],
        F.size(spans).cast("bigint").alias("n_spans"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(spans).alias("spans"),
    )
