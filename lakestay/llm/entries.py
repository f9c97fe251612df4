"""The operators as queries over the supplied tables, and the SQL some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestay.llm import (
    collocations,
    decontamination,
    html_extraction,
    jaccard_join,
    packing,
    pii,
    quality,
    secret_scan,
    sentence_pieces,
    token_counts,
    token_files,
    vector_search,
    whitening,
)
from lakestay.llm.batches import prepare, table
from lakestay.llm.components import stored
from lakestay.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_packing")
def op1_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "cost",
    )


@query("op4_token_counts")
def op4_token_counts(spark, folder):
    lengths = token_counts.lengths(table(spark, folder, "documents"))
    # Read twice below; the texts are to be encoded once.
    counts = stored(token_counts.histogram(lengths), "lengths")
    return token_counts.every_limit(counts)


@query("op5_token_files")
def op5_token_files(spark, folder):
    path = work_folder(prepare(spark), "token-files")
    token_files.write_token_files(table(spark, folder, "documents"), path)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query("op10_quality")
def op10_quality(spark, folder):
    docs = table(spark, folder, "documents")
    model = quality.train(docs, table(spark, folder, "labels"))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return quality.score(docs, model).withColumn("predicted", predicted)


@query("op6_decontamination")
def op6_decontamination(spark, folder):
    return decontamination.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op9_secret_scan")
def op9_secret_scan(spark, folder):
    return secret_scan.digest(secret_scan.secrets(table(spark, folder, "documents")))


@query("op7_personal_data")
def op7_personal_data(spark, folder):
    return pii.digest(pii.personal_data(table(spark, folder, "documents")))


@query("op8_jaccard_join")
def op8_jaccard_join(spark, folder):
    return jaccard_join.similar_documents(table(spark, folder, "documents"))


@query("op2_html_extraction")
def op2_html_extraction(spark, folder):
    return html_extraction.extract(table(spark, folder, "pages"))


TOP_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.c, v.c) AS BIGINT) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM s QUALIFY rank <= 10
"""


@query("op3_vector_search", TOP_SQL)
def op3_vector_search(spark, folder):
    return vector_search.top_products(table(spark, folder, "embeddings"))


@query("op11_sentence_pieces")
def op11_sentence_pieces(spark, folder):
    coded = sentence_pieces.encode(table(spark, folder, "documents").select("doc_id", "text"))
    both = sentence_pieces.decode(coded)
    return both.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


@query("op12_whitening")
def op12_whitening(spark, folder):
    white = whitening.whitened_components(table(spark, folder, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


# DuckDB counts every run of one to five words by itself and compares lists of words.
PHRASES_SQL = f"""
WITH pieces AS (
  SELECT lang, [x FOR x IN string_split_regex(piece, '[ \\t]+') IF x <> ''] AS w FROM (
    SELECT ifnull(lang, 'und') AS lang, unnest(string_split_regex(translate(ifnull(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
    FROM documents)
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f AS (
  SELECT lang, g, len(g) AS k, count(*) AS a
  FROM (SELECT lang, w[i:i + k - 1] AS g FROM starts, range(1, {collocations.LONGEST + 1}) AS t(k) WHERE i + k - 1 <= len(w))
  GROUP BY lang, g HAVING count(*) >= {collocations.LEAST_COUNT}
), inner_parts AS (
  SELECT lang, g[i:i + k2 - 1] AS g, max(a) AS longer
  FROM f, range(2, {collocations.LONGEST}) AS s(k2), range(1, {collocations.LONGEST}) AS t(i) WHERE k2 < k AND i + k2 - 1 <= k
  GROUP BY ALL
), cuts AS (
  SELECT f.lang, f.g, f.a, x.a AS l, y.a AS r, n, c,
    CAST((CAST(1000 AS HUGEINT) * f.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM f JOIN totals USING (lang) LEFT JOIN inner_parts q ON q.lang = f.lang AND q.g = f.g
    JOIN range(1, {collocations.LONGEST}) AS t(c) ON c < f.k
    JOIN f AS x ON x.lang = f.lang AND x.g = f.g[1:c] JOIN f AS y ON y.lang = f.lang AND y.g = f.g[c + 1:]
  WHERE f.k > 1 AND (q.longer IS NULL OR 100 * q.longer < {collocations.COVERED_PERCENT} * f.a)
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM best QUALIFY rank <= {collocations.BEST}
"""


@query("op13_collocations", PHRASES_SQL)
def op13_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))
