"""Token counts of a corpus for every context limit, from its exact histogram of lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestay.llm.batches import prepare, slices
from lakestay.llm.tokens import BYTE_VOCABULARY, encoder

# Lengths of one power of two fall into so many ranges; sums over ranges come first.
_RANGES = 64


def lengths(
    docs: DataFrame, vocabulary: str = BYTE_VOCABULARY, end_tokens: int = 0, text_column: str = "text"
) -> DataFrame:
    """One row per document: n_tokens, with end_tokens added to each. Null text is empty."""
    prepare(docs.sparkSession)
    schema = pa.schema([("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for part in slices(batches, text_column):
            _, first = tokens.encode(part.column(text_column))
            yield pa.RecordBatch.from_arrays([pa.array(np.diff(first) + end_tokens)], schema=schema)

    return docs.select(docs[text_column].alias(text_column)).mapInArrow(run, "n_tokens bigint")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens and the number of documents of that length; combined map-side."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def every_limit(counts: DataFrame) -> DataFrame:
    """For each length L that occurs, what a context limit of L does to the corpus.

    * n_docs: documents of that length; docs_longer: of a greater length (cut at L).
    * docs_within, tokens_within: documents of at most L and their tokens.
    * truncated_tokens: tokens left when every document is cut at L, that is
      tokens_within + L * docs_longer.
    * total_docs, total_tokens: of the corpus; share_within: docs_within / total_docs, so the
      q-quantile of length is the least L with share_within >= q.

    Between two lengths nothing changes but L itself, so these rows answer any limit (see
    at_limits). The sums run within ranges of lengths, 64 to a power of two; only totals of
    ranges, a few thousand at most, meet in one task. An empty corpus has no rows.
    """
    power = F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")))
    width = F.pow(F.lit(2.0), power)
    place = F.floor((F.col("n_tokens") - width) * _RANGES / width)
    own = counts.withColumn("_range", F.when(F.col("n_tokens") < 1, F.lit(-1)).otherwise(power * _RANGES + place).cast("int"))
    own = own.withColumn("_tokens", F.col("n_docs") * F.col("n_tokens"))
    sums = own.groupBy("_range").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(
        "_range",
        F.coalesce(F.sum("_d").over(below), F.lit(0)).alias("_docs_below"),
        F.coalesce(F.sum("_t").over(below), F.lit(0)).alias("_tokens_below"),
        F.sum("_d").over(every).alias("total_docs"),
        F.sum("_t").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("_range").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    own = own.join(sums, "_range").select(
        "n_tokens", "n_docs", "total_docs", "total_tokens",
        (F.col("_docs_below") + F.sum("n_docs").over(inside)).alias("docs_within"),
        (F.col("_tokens_below") + F.sum("_tokens").over(inside)).alias("tokens_within"),
    )
    longer = F.col("total_docs") - F.col("docs_within")
    return own.select(
        "n_tokens", "n_docs", "docs_within", longer.alias("docs_longer"), "tokens_within",
        (F.col("tokens_within") + F.col("n_tokens") * longer).alias("truncated_tokens"),
        "total_docs", "total_tokens",
        (F.col("docs_within") / F.col("total_docs")).alias("share_within"),
    )


def at_limits(counts: DataFrame, limits: list[int]) -> DataFrame:
    """The totals at given context limits: context_limit, docs_within, docs_longer,
    tokens_within, truncated_tokens. One pass over the histogram for all limits."""
    n, d = F.col("n_tokens"), F.col("n_docs")
    columns = []
    for limit in limits:
        within = n <= limit
        columns.append(F.struct(
            F.lit(limit).cast("bigint").alias("context_limit"),
            F.coalesce(F.sum(F.when(within, d)), F.lit(0)).alias("docs_within"),
            F.coalesce(F.sum(F.when(~within, d)), F.lit(0)).alias("docs_longer"),
            F.coalesce(F.sum(F.when(within, d * n)), F.lit(0)).alias("tokens_within"),
            F.coalesce(F.sum(F.least(n, F.lit(limit)) * d), F.lit(0)).alias("truncated_tokens"),
        ))
    return counts.agg(F.array(*columns).alias("a")).select(F.inline("a"))


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """From every_limit: share and the least length that so much of the documents is within."""
    columns = [
        F.struct(
            F.lit(float(q)).alias("share"),
            F.min(F.when(F.col("share_within") >= q, F.col("n_tokens"))).alias("n_tokens"),
        )
        for q in shares
    ]
    return limits.agg(F.array(*columns).alias("a")).select(F.inline("a"))
