"""Operators 1 to 3 against the libraries and against brute force."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import byte_bpe, queries, sharding, token_files
from tallyhouse.llm.common import shared_path

SF = "/root/testdata/sf0.001"
RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = ["", None, " ", "a", "a b", "a  b", "a   b", "a \n  b", "\n ", " \t x", "x   y", "it's  they'll",
       "\x00\x1c\x85", "日本語 テキスト 123", "é ́x", "😀" * 3, "word" * 50_000, "<|endoftext|> x",
       "x " * 30_000, "a b", "a b"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i % 7 else None, t, "x", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.read_ranks(RANKS), P.PATTERN, memo=100)


def test_every_vocabulary_entry_is_one_piece(codec):
    chars = byte_bpe.byte_characters()
    assert len(set(chars)) == 256
    found = codec.model.encode(["".join(chars[b] for b in p) for p in codec.vocabulary[:256]])
    assert found == [[i] for i in range(256)]


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r \x1c'.,ab1é日😀"), st.characters(codec="utf-8")), max_size=60))
def test_ids_equal_the_library_and_decode_back(codec, tik, text):
    ids = codec.encode(text).tolist()
    assert ids == tik.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_encode_decode_odd_texts(spark, odd, tik):
    out = byte_bpe.encode(odd, RANKS, P.PATTERN).select("text", "n_tokens", "encoded.ids", "encoded")
    back = byte_bpe.decode(out, RANKS, P.PATTERN)
    rows = back.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = r["text"] or ""
        assert r["ids"] == tik.encode_ordinary(text) and r["encoded"]["n_tokens"] == len(r["ids"])
        assert bytes(r["decoded"]) == text.encode() and r["n_tokens"] == "x"
    assert byte_bpe.round_trip(odd.limit(0), RANKS, P.PATTERN).count() == 0


def test_op1_query(spark, tik):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = tik.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()


@pytest.fixture(scope="module")
def word_pair():
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = True
    return token_files.Encoder(WORDS, memo=50), library


@settings(max_examples=600, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,;'!_-\u0331\u0301\u030a´abhtwyHTWYzKé²ßÀØ×÷日😀İΣς1"),
                                  st.characters(codec="utf-8")), max_size=40))
def test_word_ids_equal_the_library(word_pair, text):
    own, library = word_pair
    assert np.frombuffer(own.encode(text), own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def expected_documents(rows):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_op2_query(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(map(tuple, queries.op2_token_files(spark, SF).collect())) == expected_documents(rows)


def test_token_files_odd_texts_and_sequences(spark, odd):
    folder = shared_path(spark, "test-tokens")
    docs = odd.withColumn("doc_id", F.col("doc_id") * 3)
    manifest = token_files.write_token_files(docs, folder, WORDS, 1, length=16, batch=4, range_bytes=100_000)
    files = manifest.collect()
    assert len(files) > 1
    found = token_files.read_token_files(spark, folder, manifest).collect()
    known = {}
    for doc_id, _, n, crc in expected_documents([(r["doc_id"], r["text"]) for r in docs.collect()]):
        known[(doc_id, n, crc)] = known.get((doc_id, n, crc), 0) + 1
    for r in found:
        known[(r["doc_id"], r["n_tokens"], r["ids_crc32"])] -= 1
    assert not any(known.values())
    order = sorted(found, key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert ids == sorted(ids)
    assert [r["start"] for r in order] == [0, *np.cumsum([r["n_tokens"] for r in order])[:-1]]
    for f in files:  # equal-length sequences; masks are false on the padding alone
        file = token_files.TokenFile(folder, f["file"])
        assert len(file) == f["sequences"]
        pairs = [file.sequence(i) for i in range(len(file))]
        assert all(len(x) == len(m) == 16 for x, m in pairs)
        assert sum(m.sum() for _, m in pairs) == f["tokens"]
        flat = np.concatenate([x for x, _ in pairs])[:f["tokens"]]
        assert flat.tolist() == np.concatenate([x for *_, x in file.documents()]).tolist()


def test_token_files_of_no_documents(spark, odd):
    folder = shared_path(spark, "test-none")
    manifest = token_files.write_token_files(odd.limit(0), folder, WORDS, 1)
    assert manifest.count() == 0 and token_files.read_token_files(spark, folder, manifest).count() == 0


def check_shards(rows, shards, slack):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    sizes = [sum(r["size"] for r in by.get(s, [])) for s in range(shards)]
    total = sum(sizes)
    edge = 0
    for i, size in enumerate(sizes[:-1]):  # each boundary lies within the slack of its place
        edge += size
        assert abs(edge - total * (i + 1) / shards) <= slack(total / shards)
    return by


def test_op3_query(spark):
    rows = queries.op3_histogram_sort(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    longest = max(r["size"] for r in rows)
    check_shards(rows, 16, lambda share: longest)


def test_shards_of_hot_text_and_odd_rows(spark):
    rows = [(i, "copy of one text") for i in range(3000)] + [(None, None), (None, ""), (5, None)]
    rows += [(10_000 + i, f"text {i} " * (i % 40)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash"))
    out = sharding.shard_by_bytes(docs, shards=8, range_bytes=20_000).collect()
    assert len(out) == len(rows)
    longest = max(r["size"] for r in out)
    by = check_shards(out, 8, lambda share: max(0.002 * share, longest))
    cut = {r["text"] for s in by for r in by[s]}
    places = {t: {r["shard"] for r in out if r["text"] == t} for t in cut}
    assert len(places["copy of one text"]) > 1  # too large for the tolerance
    assert sum(len(p) > 1 for p in places.values()) <= 7
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0
    one = sharding.shard_by_bytes(docs.limit(1)).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


def test_few_probes_a_round_find_the_same_boundaries(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    many = sharding.shard_by_bytes(docs, range_bytes=2000, tolerance=0.0).select("doc_id", "shard", "slot").collect()
    monkeypatch.setattr(sharding, "MAX_PROBES", 1)
    few = sharding.shard_by_bytes(docs, range_bytes=2000, tolerance=0.0).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, many)) == sorted(map(tuple, few))
    assert sharding.ranges_of(10 ** 14, 32 << 20, 16) == sharding.MAX_RANGES


def test_same_rows_same_place_for_any_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = sharding.shard_by_bytes(docs.repartition(7)).select("doc_id", "shard", "slot")
    b = sharding.shard_by_bytes(docs.coalesce(1)).select("doc_id", "shard", "slot")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
