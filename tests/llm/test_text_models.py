"""Operators 4, 5 and 10 against brute force, libraries and held-out rows."""

import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tallyhouse.llm import decontamination as dec
from tallyhouse.llm import quality, queries, token_count

SF = "/root/testdata/sf0.01"
PIECES = P.path("piece_bpe_32k.model")


# --- quality classifier

def test_op4_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op4_quality_trees(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.93


def walk(forest, x):
    """One row through one tree after the other."""
    total = forest.start
    inner = forest.feature.shape[1]
    for f, t, leaf in zip(forest.feature, forest.threshold, forest.leaf):
        at = 0
        while at < inner:
            at = 2 * at + 1 + (x[f[at]] > t[at])
        total += leaf[at - inner]
    return 1 / (1 + np.exp(-total))


def test_arrays_walk_like_trees():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    forest = quality.grow(x, y)
    scores = forest.score(x)
    assert np.allclose(scores, [walk(forest, r) for r in x])
    assert ((scores > 0.5) == y).mean() > 0.97


def test_quality_odd_rows(spark):
    rows = [(1, "Good text here.", "a"), (2, "", "b"), (None, None, "c"), (3, "x " * 200_000, "d"), (3, "again", "e"),
            (4, "$$$ &&&\n" * 40, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (4, 0), (None, 1), (2, None), (9, 0)], "doc_id long, quality int")
    forest = quality.fit(docs, labels)
    out = quality.score(docs, forest).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    untaught = quality.fit(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, untaught).collect()} == {0.5}
    one_class = quality.fit(docs, labels.where("quality = 1"))
    assert all(r["score"] > 0.5 for r in quality.score(docs, one_class).collect())
    assert quality.score(docs.limit(0), forest).count() == 0
    assert len(quality.fit(docs, labels, max_rows=1).leaf) == 0  # one label: one class


# --- decontamination

def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlap(a, item):
    width = min(13, len(item))
    allowed = 2 if len(item) >= 13 else 0
    if len(item) < 7:
        return False
    for i in range(len(item) - width + 1):
        for j in range(len(a) - width + 1):
            if sum(x != y for x, y in zip(a[j:j + width], item[i:i + width])) <= allowed:
                return True
    return False


def test_masks_miss_no_window_with_two_replaced():
    for lost in itertools.combinations(range(dec.WINDOW), dec.REPLACED):
        assert any(not {p + o for o in mask} & set(lost)
                   for mask in dec.MASKS for p in range(dec.WINDOW - mask[-1]))


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, [rng.choice(vocabulary) for _ in range(n)]) for i, n in enumerate([30, 13, 14, 12, 7, 6, 60, 25])]
    docs = []
    for k in range(160):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        item = rng.choice(items)[1]
        i = rng.randrange(max(1, len(item) - 5))
        passage = list(item[i:i + rng.randrange(5, 25)])
        for _ in range(rng.randrange(4)):
            passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
        at = rng.randrange(len(base) + 1)
        docs.append((k, base[:at] + passage + base[at:]))
    rows = [(k, " ".join(w).upper() + ".") for k, w in docs] + [(None, " ".join(items[0][1])), (500, None), (501, ""), (502, "x " * 50_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash")).withColumn("words", F.lit(1))
    items += [(99, items[0][1]), (99, items[1][1]), (99, items[1][1]), (None, items[6][1])]  # repeated words and ids
    b = spark.createDataFrame([(i, ", ".join(w)) for i, w in items] + [(98, None), (None, "short")], "item_id long, text string")
    expected = {(k, i) for k, t in rows for i, w in items if overlap(words(t), w)}
    assert len(expected) > 20
    found = dec.overlaps(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(found) == len(expected)
    spark.conf.set("spark.tallyhouse.broadcastMaxBytes", "1")  # the way for large benchmarks
    try:
        assert {(r["doc_id"], r["item_id"]) for r in dec.overlaps(d, b).collect()} == expected
        kept = {r["doc_id"] for r in dec.decontaminate(d, b).collect()}
    finally:
        spark.conf.unset("spark.tallyhouse.broadcastMaxBytes")
    assert kept == {k for k, _ in rows} - {k for k, _ in expected}
    assert dec.decontaminate(d, b).columns == d.columns
    assert dec.overlaps(d, b.limit(0)).count() == 0 and dec.overlaps(d.limit(0), b).count() == 0


def test_clean_texts_of_a_leaked_id_stay(spark):
    """Null and repeated ids: only the texts that overlap go."""
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(None, item), (None, "clean text without id"), (None, None), (7, "before " + item), (7, "clean text"), (7, "clean text"),
            (8, item.upper()), (9, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(0, item)], "item_id long, text string")
    clean = sorted(((k, t) for k, t in rows if not overlap(words(t), words(item))), key=str)

    def kept():
        return sorted(map(tuple, dec.decontaminate(d, b).collect()), key=str)

    assert kept() == clean and len(clean) == 5
    spark.conf.set("spark.tallyhouse.broadcastMaxBytes", "1")
    try:
        assert kept() == clean
    finally:
        spark.conf.unset("spark.tallyhouse.broadcastMaxBytes")


def test_op5_query_equals_brute_force(spark):
    docs = [(r["doc_id"], words(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # For speed, only alignments that share four words in a row are compared;
    # 13 words with 2 replaced always do (3 gaps of 11 words).
    at = {}
    for i, w in items:
        for p in range(len(w) - 2):
            at.setdefault(tuple(w[p:p + 3]), set()).add(i)
    by_id = dict(items)
    expected = set()
    for d, w in docs:
        near = {i for p in range(len(w) - 2) for i in at.get(tuple(w[p:p + 3]), ())}
        expected |= {(d, i) for i in near if overlap(w, by_id[i])}
    assert {(r["doc_id"], r["item_id"]) for r in queries.op5_spaced_seeds(spark, SF).collect()} == expected and expected


# --- token counts

@pytest.fixture(scope="module")
def unigram():
    """The library's own unigram model with the same pieces and scores."""
    return proto.ModelProto.FromString(token_count.rank_unigram(PIECES))


ODD = ["", "a", " ", "  two  spaces ", "日本語の文字", "\n\n\ttabs", "x" * 400, "▁mark ▁▁", "é̀", "😀😀 ok", "it's 12345 <s> </s>",
       "aaaaaaaaaaaa bbbb", "\x00"]


def test_counts_equal_the_library(spark, unigram):
    texts = ODD + [r["text"][:1500] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").take(60)]
    for fallback in (True, False):
        unigram.trainer_spec.byte_fallback = fallback
        model = proto.ModelProto()
        model.CopyFrom(unigram)
        if not fallback:  # byte pieces are only legal with the fallback
            keep = [p for p in unigram.pieces if p.type != proto.ModelProto.SentencePiece.BYTE]
            del model.pieces[:]
            model.pieces.extend(keep)
        library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        own = token_count.Counter(model.SerializeToString(), memo=50)
        for text in texts:
            # word by word the library's 32-bit sums are exact
            for word in own.words(text):
                if not word.startswith("▁"):
                    continue
                word = word.replace("▁", " ")[1:]
                assert own.count(word) == len(library.encode(word)), (word, fallback)
        for text in ODD:
            assert own.count(text) == len(library.encode(text)), text


def test_ties_go_to_the_earliest_start():
    model = proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.remove_extra_whitespaces = False
    kinds = proto.ModelProto.SentencePiece
    model.pieces.add(piece="<unk>", score=0, type=kinds.UNKNOWN)
    model.pieces.add(piece="<s>", score=0, type=kinds.CONTROL)
    model.pieces.add(piece="</s>", score=0, type=kinds.CONTROL)
    for p in ("▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "ca", "aab"):
        model.pieces.add(piece=p, score=-float(len(p)))
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    own = token_count.Counter(model.SerializeToString())
    for n in range(1, 7):
        for letters in itertools.product("abc", repeat=n):
            text = "".join(letters)
            assert own.count(text) == len(library.encode(text)), text


def test_op10_query_and_odd_rows(spark, unigram):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, None, "word " * 40_000, "a b", "a b"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    unigram.trainer_spec.byte_fallback = True
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram.SerializeToString())
    out = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(docs, token_count.rank_unigram(PIECES)).collect()}
    for i, t, _ in rows:
        if t is None or len(t) < 1000:
            assert out[i] == (len(library.encode(t)) if t else 0)
    assert out[len(ODD) + 1] == 40_000 * len(library.encode("word")) + 1  # the last space
    assert token_count.count_tokens(docs.limit(0), token_count.rank_unigram(PIECES)).count() == 0
    found = queries.op10_token_counts(spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    counter = token_count.Counter(token_count.rank_unigram(PIECES))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in found.collect()[:100]:
        assert r["n_tokens"] == sum(counter.word(w) for w in counter.words(texts[r["doc_id"]]))


def test_query_equals_the_library_on_whole_texts(spark, unigram):
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram.SerializeToString())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    counts = library.encode([r["text"] or "" for r in docs], num_threads=2)
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op10_token_counts(spark, SF).collect()}
    assert got == {r["doc_id"]: len(c) for r, c in zip(docs, counts)}
