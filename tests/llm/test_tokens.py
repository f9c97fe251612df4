"""Encoding, packing, counts and files of token ids."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestay.llm import packing, range_coder, token_counts, token_files, tokens
from lakestay.llm.entries import QUERIES
from lakestay.llm.range_coder import decode_block, encode_block
from lakestay.llm.tokens import BYTE_VOCABULARY, WORD_VOCABULARY, encoder, vocabulary_path
from tests.llm.common import FOLDER, ODD_TEXTS, documents, odd_documents

VOCABULARIES = [BYTE_VOCABULARY, WORD_VOCABULARY]


def direct(name, text):
    return encoder(name).ids([text or ""])[0]


@pytest.mark.parametrize("name", VOCABULARIES)
def test_ids_are_those_of_the_library(name):
    for _ in range(2):  # from the library, then from the store
        ids, first = encoder(name).encode(pa.array(ODD_TEXTS))
        for i, text in enumerate(ODD_TEXTS):
            assert ids[first[i] : first[i + 1]].tolist() == direct(name, text).tolist(), repr(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sé, .\n\t 　\x1c\x01İ1#日"), max_size=12), max_size=4))
def test_ids_of_any_texts(texts):
    for name in VOCABULARIES:
        ids, first = encoder(name).encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            assert ids[first[i] : first[i + 1]].tolist() == direct(name, text).tolist()


def _given(monkeypatch, own):
    """The texts an encoder gives to the library from now on."""
    given, real = [], own.ids
    monkeypatch.setattr(own, "ids", lambda texts: given.extend(texts) or real(texts))
    return given


@pytest.mark.parametrize("name", VOCABULARIES)
def test_a_full_store_keeps_the_pieces_of_its_slice(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 64)
    own = tokens.Encoder(vocabulary_path(name))
    old, new = [" ".join(f"{w}{i}" for i in range(40)) for w in ("known", "fresh")]
    own.encode(pa.array([old]))
    given = _given(monkeypatch, own)
    ids, first = own.encode(pa.array([f"{old} {new}", old]))
    assert given and not any("known" in text for text in given)
    assert ids[: first[1]].tolist() == direct(name, f"{old} {new}").tolist()
    assert ids[first[1] :].tolist() == direct(name, old).tolist()


@pytest.mark.parametrize("name", VOCABULARIES)
def test_new_pieces_go_to_the_library_in_bounded_texts(name, monkeypatch):
    own = tokens.Encoder(vocabulary_path(name))
    given = _given(monkeypatch, own)
    text = " ".join(f"word{i}" for i in range(100_000))
    ids, _ = own.encode(pa.array([text]))
    assert max(map(len, given)) < 1 << 19
    assert ids.tolist() == direct(name, text).tolist()


@pytest.mark.parametrize("name", VOCABULARIES)
def test_new_pieces_go_to_the_library_in_short_texts(name, monkeypatch):
    own = tokens.Encoder(vocabulary_path(name))
    given = _given(monkeypatch, own)
    text = " ".join(f"word{i}" for i in range(5000)) + " " + "x" * 9000
    ids, _ = own.encode(pa.array([text]))
    assert max(len(t) for t in given if "xx" not in t) < 5000 and len(given) > 10
    assert ids.tolist() == direct(name, text).tolist()


def test_a_word_is_encoded_once_whatever_signs_follow(monkeypatch):
    own = tokens.Encoder(vocabulary_path(BYTE_VOCABULARY))
    given = _given(monkeypatch, own)
    text = "a Qvxwé Qvxwé, Qvxwé. (Qvxwé) Qvxwé's Qvxwé,' Qvxwé!? Qvxwé… Qvxwé×. Qvxwé/Qvxwé@Qvxwé.de3"
    ids, _ = own.encode(pa.array([text]))
    assert sum(t.count(" Qvxwé") for t in given) == 3  # by itself, before … and before ×
    fresh = Tokenizer.from_file(vocabulary_path(BYTE_VOCABULARY))
    assert ids.tolist() == fresh.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aÉé×÷ªʼ日٣9'’sltre,.!_~@\x7f\x1c\x00 \n"), max_size=14), max_size=4))
def test_ids_of_any_texts_with_signs(texts):
    fresh = Tokenizer.from_file(vocabulary_path(BYTE_VOCABULARY))
    ids, first = encoder(BYTE_VOCABULARY).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = fresh.encode(text, add_special_tokens=False).ids
        assert ids[first[i] : first[i + 1]].tolist() == want, repr(text)


@pytest.mark.parametrize("name", VOCABULARIES)
def test_ids_of_texts_with_added_tokens(name):
    fresh = Tokenizer.from_file(vocabulary_path(name))
    texts = [
        "a <|endoftext|> b", "plain", "<|endoftext|>", None, "<|endof", "text|> b", "x<|startoftext|>y  <|endoftext|>\n",
        "<|ENDOFTEXT|> c", "<|endoftext|><|endoftext|>", "é\u00a0<|endoftext|> d", "don't <|endoftext|>'s", "last \n",
        "some more words, " * 10_000 + "<|endoftext|> and more " * 3,
    ]
    assert len(fresh.encode("<|endoftext|>", add_special_tokens=False).ids) == 1
    for _ in range(2):
        ids, first = encoder(name).encode(pa.array(texts))
        for i, text in enumerate(texts):
            want = fresh.encode(text or "", add_special_tokens=False).ids
            assert ids[first[i] : first[i + 1]].tolist() == want, repr(text)[:80]


@pytest.mark.parametrize("vocabulary", [2, 300, 50257, 200_000])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 129, 5000, 70_000])
def test_blocks_round_trip(vocabulary, n):
    random = np.random.default_rng(n)
    for ids in (random.integers(0, vocabulary, n), np.full(n, vocabulary - 1), np.arange(n) % vocabulary % 7):
        back, end = decode_block(block := encode_block(ids, vocabulary))
        assert end == len(block) and back.tolist() == ids.tolist()


def test_repeats_are_cheap_and_damage_is_found():
    ids = np.tile(np.arange(1000), 100)
    block = encode_block(ids, 50_257)
    assert len(block) < 0.8 * 2 * len(ids)
    bad = bytearray(block)
    bad[len(bad) // 2] ^= 1
    with pytest.raises(ValueError):
        decode_block(bytes(bad))


def test_any_damaged_byte_of_a_block_is_found():
    block = encode_block(np.arange(600) % 7, 50_257)
    for i in range(len(block)):
        bad = bytearray(block)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            decode_block(bytes(bad))


@pytest.mark.parametrize("vocabulary", [5000, 4_000_000])
@pytest.mark.parametrize("bottom", [32, 46])
def test_blocks_of_many_lanes_round_trip(vocabulary, bottom, monkeypatch):
    monkeypatch.setattr(range_coder, "_LANE_IDS", 3)
    # The higher it is, the more often a lane must settle between its two parts of a step.
    monkeypatch.setattr(range_coder, "_BOTTOM", np.uint64(1 << bottom))
    random = np.random.default_rng(1)
    ids = np.minimum(random.zipf(1.3, 40_000), 4999)
    ids[random.random(len(ids)) < 0.01] = 4999
    back, _ = decode_block(encode_block(ids, vocabulary))
    assert back.tolist() == ids.tolist()


def test_blocks_are_smaller_than_order_0_entropy():
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).combine_chunks()
    ids = np.concatenate([encoder(BYTE_VOCABULARY).encode(rows.slice(a, 50))[0] for a in range(0, len(rows), 50)])
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    entropy = -(share * np.log2(share)).sum() / 8
    assert len(encode_block(ids, 50_257)) < 0.97 * entropy * len(ids)


def whole(name, text):
    return np.append(direct(name, text), 2).astype("<u4")


def test_packing_places_every_id_once(spark):
    docs = odd_documents(spark)
    pieces = packing.pack(docs, group_tokens=5000).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        by_sequence[p.sequence_id].append(p)
        by_doc[(p.doc_id, p.doc_tokens)].append(p)
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in own])
        assert [p.offset for p in own] == [0, *ends[:-1]] and ends[-1] <= 4096
        padding += 0 if ends[-1] & (ends[-1] - 1) == 0 else 4096 - ends[-1]
    assert padding == 0
    expected = Counter((r.doc_id, whole(WORD_VOCABULARY, r.text).tobytes()) for r in docs.collect())
    got = Counter()
    for (doc, _), own in by_doc.items():
        starts = Counter(p.start for p in own)
        own.sort(key=lambda p: p.start)
        copies = starts[0]
        assert all(n == copies for n in starts.values())
        got[(doc, b"".join(p.ids for p in own[::copies]))] += copies
    assert got == expected
    again = packing.pack(docs, group_tokens=5000).collect()
    assert sorted(map(str, again)) == sorted(map(str, pieces))


def test_groups_of_a_task_share_their_ends(spark):
    """Many small groups: only the last one of the task ends in short sequences."""
    texts = ["some words of a document " * (i % 37) for i in range(500)] + ["long " * 30_000]
    docs = documents(spark, list(enumerate(texts))).coalesce(1)
    pieces = packing.pack(docs, group_tokens=3000).collect()
    used, parts = Counter(), defaultdict(list)
    for p in pieces:
        used[p.sequence_id] += p.length
        parts[p.doc_id].append((p.start, p.length, bytes(p.ids), p.doc_tokens))
    assert len(used) > 20 and sum(n < 4096 for n in used.values()) <= 12
    for doc, text in enumerate(texts):
        own = sorted(parts[doc])
        assert [a for a, *_ in own] == [0, *np.cumsum([n for _, n, *_ in own])[:-1]]
        assert b"".join(x for *_, x, _ in own) == whole(WORD_VOCABULARY, text).tobytes()


def test_packing_balances_cost():
    random = np.random.default_rng(1)
    lengths = random.integers(1, 900, 4000).tolist()
    places = packing.assign(lengths, 4096, lambda n: n + n * n / 4096)
    cost = Counter()
    used = Counter()
    for _, _, n, s, _ in places:
        cost[s] += n + n * n / 4096
        used[s] += n
    full = [cost[s] for s in cost if used[s] == 4096]
    assert max(full) < 1.1 * min(full)
    assert sum(used.values()) == sum(lengths) and len(places) < 1.2 * len(lengths)


def test_packing_of_nothing(spark):
    assert packing.pack(documents(spark, [])).count() == 0
    assert packing.assign([4096, 8192], 4096, float) == [(0, 0, 4096, 0, 0), (1, 0, 4096, 1, 0), (1, 4096, 4096, 2, 0)]


def test_token_counts_against_brute_force(spark):
    docs = odd_documents(spark)
    sizes = [len(direct(BYTE_VOCABULARY, r.text)) for r in docs.collect()]
    counts = token_counts.histogram(token_counts.lengths(docs))
    limits = token_counts.every_limit(counts)
    rows = {r.n_tokens: r for r in limits.collect()}
    assert set(rows) == set(sizes)
    for n, r in rows.items():
        within = [s for s in sizes if s <= n]
        assert (r.n_docs, r.docs_within, r.docs_longer) == (sizes.count(n), len(within), len(sizes) - len(within))
        assert r.tokens_within == sum(within) and r.truncated_tokens == sum(min(s, n) for s in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
        assert r.share_within == len(within) / len(sizes)
    for r in token_counts.at_limits(counts, [0, 3, 100, 10**9]).collect():
        assert r.truncated_tokens == sum(min(s, r.context_limit) for s in sizes)
        assert r.docs_longer == sum(s > r.context_limit for s in sizes)
    for r in token_counts.quantiles(limits, [0.0, 0.5, 1.0]).collect():
        place = max(0, int(np.ceil(r.share * len(sizes))) - 1)
        assert r.n_tokens == sorted(sizes)[place]
    assert token_counts.every_limit(token_counts.histogram(token_counts.lengths(documents(spark, [])))).count() == 0


def test_token_files_round_trip(spark, tmp_path):
    docs = odd_documents(spark).withColumn("start", F.lit("a clashing name"))
    token_files.write_token_files(docs, str(tmp_path / "t"))
    rows = token_files.read_token_files(spark, str(tmp_path / "t")).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    want = Counter((r.doc_id, whole(BYTE_VOCABULARY, r.text).tobytes()) for r in docs.collect())
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == want


def test_token_files_of_nothing(spark, tmp_path):
    token_files.write_token_files(documents(spark, []), str(tmp_path / "t"))
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == 0


def test_frames_with_many_blocks(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    ids = np.arange(1050) % 17
    frame = token_files.encode_frame([5, None], np.array([50, 1000]), ids, 17)
    docs, lengths, back = token_files.decode_frame(frame)
    assert docs == [5, None] and lengths.tolist() == [50, 1000] and back.tolist() == ids.tolist()
    bad = bytearray(frame)
    bad[30] ^= 1
    with pytest.raises((ValueError, zlib.error)):
        token_files.decode_frame(bytes(bad))


@pytest.mark.parametrize("name,vocabulary", [("op1_packing", WORD_VOCABULARY), ("op5_token_files", BYTE_VOCABULARY)])
def test_query_digests(spark, name, vocabulary):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES[name](spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(texts)
    before = 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        ids = whole(vocabulary, texts[r.doc_id])
        if name == "op5_token_files":
            assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids), zlib.crc32(ids.tobytes()))
            before += len(ids)
        else:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
