"""Ids and texts against the sentencepiece library."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lakestay.llm import sentence_pieces as sp
from lakestay.llm.tokens import vocabulary_path
from tests.llm.common import FOLDER, ODD_TEXTS, documents, odd_documents

ODD = [
    *ODD_TEXTS, "▁▁ a▁b", "aaaaaaaaa" * 40, "abab" * 99, " " * 100 + "x" + " " * 33, "<0x41><s></s><unk>",
    "\u0000a", "1234567 89", "�", "\U0001f600 é́", "one\x0btwo",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(sp.PIECES))


@pytest.fixture(scope="module")
def own():
    return sp.Pieces(vocabulary_path(sp.PIECES))


def same(own, library, texts):
    ids, first = own.encode(pa.array(texts, pa.string()))
    want = library.encode([t or "" for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want
    assert own.decode(ids.astype(np.int64), first) == [library.decode(w) for w in want]


def test_odd_and_random_texts(own, library):
    r = random.Random(5)
    same(own, library, ODD)
    same(own, library, ["".join(r.choice("aest ") for _ in range(r.randint(0, 300))) for _ in range(400)])
    letters = "abcdefghijklmnopqrstuvwxyz ▁\n\t.,'éßñ日1€"
    same(own, library, ["".join(r.choice(letters) for _ in range(r.randint(0, 200))) for _ in range(400)])
    # A word of 50,000 characters.
    same(own, library, ["".join(r.choice("abcdefgh") for _ in range(50_000)), "qwxz" * 5000])


def test_a_slice_of_a_column(own, library):
    column = pa.array(["x", None, "a b", "", "some words"], pa.string()).slice(1, 4)
    ids, first = own.encode(column)
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == library.encode(["", "a b", "", "some words"])


def test_a_full_store_begins_anew(own, library, monkeypatch):
    monkeypatch.setattr(sp, "KEPT_PIECES", 40)
    small = sp.Pieces(vocabulary_path(sp.PIECES))
    for i in range(5):
        same(small, library, [f"word{j} other{j * i} x" for j in range(9)])


def test_any_ids_decode(own, library):
    r = random.Random(6)
    rows = [[r.randrange(32000) if r.random() < 0.5 else r.randrange(259) for _ in range(r.randint(0, 30))] for _ in range(500)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    got = own.decode(np.array([i for x in rows for i in x], np.int64), first)
    assert got == [library.decode(x) for x in rows]


def test_operator_keeps_rows_and_columns(spark, library):
    docs = odd_documents(spark).withColumn("ids", F.lit("clash")).withColumn("_id", F.lit(1))
    coded = sp.encode(docs)
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "_id", "ids"]
    back = sp.decode(coded).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.filter("doc_id is not null").collect()}
    assert len(back) == docs.count()
    for row in back:
        if row["doc_id"] is not None:
            want = library.encode(texts[row["doc_id"]], add_bos=True, add_eos=True)
            assert np.frombuffer(row["ids"], "<u4").tolist() == want
            assert row["text"] == library.decode(want)
    plain = sp.encode(documents(spark, [(1, "a b")]), ends=False).first()["ids"]
    assert np.frombuffer(plain, "<u4").tolist() == library.encode("a b")
    assert sp.decode(sp.encode(documents(spark, []))).count() == 0
    with pytest.raises(Exception, match="no id 99999"):
        sp.decode(spark.createDataFrame([(bytes(np.array([99999], "<u4")),)], "ids binary")).collect()


def test_query(spark, library):
    import hashlib

    from lakestay.llm.entries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op11_sentence_pieces"](spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode(row["text"] or "", add_bos=True, add_eos=True)
        found = got[row["doc_id"]]
        assert found["n_tokens"] == len(ids)
        assert found["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
