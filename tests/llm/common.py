"""Small tables the operators are tried on."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

FOLDER = "/root/testdata/sf0.001"
DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()),
    StructField("lang", StringType()), StructField("source", StringType()),
    StructField("n_chars", LongType()),
])
# White space of all kinds, letters beyond ASCII, marks, special tokens, empty and null.
ODD_TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb c\n\n\nd", "\x1ca b", "x\ty\r\nz",
    "don't stop, I'll go", "İstanbul ΣΑΣ é è é", "<|endoftext|> a", "\x01 b \x02c",
    "日本語 テキスト。 x", "\x85a  b", "a \nb", "#2 # 2", "a​b", "a\n\xa0 b  c", "tail\n",
    "  \n x \n\n", "“quoted” — text", "Ab c d e", "ab C d e",
]


def documents(spark, rows):
    """A documents table from (doc_id, text) pairs."""
    full = [(d, t, "en", "src", len(t or "")) for d, t in rows]
    return spark.createDataFrame(full, DOCS)


def odd_documents(spark):
    """Null ids, repeated rows, odd texts and one long text."""
    rows = list(enumerate(ODD_TEXTS)) + [(None, "no id here"), (3, "\n"), (3, "\n")]
    rows.append((1000, "long words and more of them. " * 20_000))
    return documents(spark, rows)


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
