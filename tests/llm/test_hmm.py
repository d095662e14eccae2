"""Operator 7 against counts and recursions by brute force."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import hmm, queries
from tallyhouse.llm.common import crc32_of

SF = "/root/testdata/sf0.01"


def split(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def base_scores(rows, held):
    c = Counter(w for i, t in rows if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    return n, [(len(split(t)), sum(c[w] > 0 for w in split(t)),
                sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in split(t))) for _, t in rows]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_op7_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n, base = base_scores(rows, held)
    expected = {i: b for (i, _), b in zip(rows, base)}
    found = queries.op7_hidden_markov(spark, SF).collect()
    assert len(found) == len(rows)
    gain = tokens = better = 0
    for r in found:
        size, known, score = expected[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (size, known, n, held(r["doc_id"]))
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        if r["held_out"]:
            gain, tokens = gain + r["score"] - r["base_score"], tokens + size
            better += r["score"] > r["base_score"]
    assert gain / tokens > 0.1 and better / sum(r["held_out"] for r in found) > 0.8


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("PIECE", 5), ("BATCH", 40), ("LONG", 9)):
        monkeypatch.setattr(hmm, name, value)
    rng = np.random.default_rng(2)
    first, move, emit = rng.random((2, 3)), rng.random((3, 3)), rng.random((12, 3))
    return hmm.Model(first / first.sum(1, keepdims=True), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def paths(model, ids, kind):
    for states in itertools.product(range(3), repeat=len(ids)):
        p = model.first[kind, states[0]]
        for a, b in zip(states, states[1:]):
            p *= model.move[a, b]
        for s, i in zip(states, ids):
            p *= model.emit[i, s]
        yield states, p


def test_expected_counts_equal_all_paths(small):
    rng = np.random.default_rng(4)
    pieces = [rng.integers(0, 12, n) for n in (1, 4, 5, 2, 5)]
    later = np.array([False, True, False, False, True])
    firsts, moves, emitted, likelihood = hmm.expected_counts(small, pieces, later)
    want = np.zeros((2, 3)), np.zeros((3, 3)), np.zeros((12, 3))
    total = 0.0
    for ids, kind in zip(pieces, later.astype(int)):
        every = list(paths(small, ids, kind))
        whole = sum(p for _, p in every)
        total += math.log10(whole)
        for states, p in every:
            want[0][kind, states[0]] += p / whole
            for a, b in zip(states, states[1:]):
                want[1][a, b] += p / whole
            for s, i in zip(states, ids):
                want[2][i, s] += p / whole
    for got, expected in zip((firsts, moves, emitted), want):
        assert np.allclose(got, expected, atol=1e-4)
    assert likelihood == pytest.approx(total, abs=1e-4)


def test_likelihoods_equal_all_paths_and_each_other(small, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [rng.integers(0, 12, n) for n in (1, 3, 7, 8, 6)]
    found = hmm.likelihoods(small, rows)
    assert np.allclose(found, [math.log10(sum(p for _, p in paths(small, r, 0))) for r in rows])
    rows = [rng.integers(0, 12, n) for n in (9, 200, 3, 41, 40, 81)]  # by transfer matrices from 9 on
    by_matrix = hmm.likelihoods(small, rows)
    monkeypatch.setattr(hmm, "LONG", 10 ** 6)
    assert np.allclose(by_matrix, hmm.likelihoods(small, rows), rtol=1e-10)


def test_rounds_raise_the_likelihood(spark, small):
    rng = np.random.default_rng(6)
    rows = [(bytes(rng.integers(0, 12, n).astype("<u2").tobytes()),) for n in rng.integers(1, 40, 60)]
    coded = spark.createDataFrame(rows, "ids binary").repartition(3)
    model, seen = small, []
    for _ in range(4):
        model, likelihood = hmm.baum_welch(coded, model, np.full(12, 1e-9))
        seen.append(likelihood)
        assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1)
    assert seen[0] < seen[1] and seen[-1] >= seen[1]


def test_a_full_distribution_over_texts(spark):
    """Probabilities of all words after nothing, the end and one unknown per
    class add up to one."""
    words = hmm.lexicon(hmm.word_counts(spark.createDataFrame([("a b c a",), ("d a",)], "text string")))[0]
    assert (words.tokens, words.words) == (8, 5)
    model = hmm.starting_model(words)
    found, n = np.unique(np.concatenate([hmm.tokens(b"a b c a"), hmm.tokens(b"d a")]), return_counts=True)
    classes, counts = words.classify(found)
    assert counts.tolist() == n.tolist()
    state = model.emit[classes].mean(axis=1) * 10 ** words.share(classes, counts)
    others = model.emit.mean(axis=1)
    unknown = sum(others[c] / (words.class_tokens[c] + words.class_words[c] + 1) for c in range(hmm.OWN, hmm.CLASSES))
    unused = others[:hmm.OWN][words.class_words[:hmm.OWN] == 0].sum()
    assert state.sum() + unknown + unused == pytest.approx(1)


def test_odd_rows_and_rare_words_by_join(spark, monkeypatch):
    rows = [(1, "a b A\tb  c"), (2, None), (3, ""), (None, "z"), (None, "z"), (4, " \n"), (5, "word " * 30_000),
            (6, "É é Ünicode  x"), (6, "again"), *[(100 + i, f"w{i} w{i} a q{i % 7}") for i in range(60)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("count", F.lit(1))
    n, base = base_scores(rows, held)
    expected = Counter((i, *b[:2], round(b[2], 6)) for (i, _), b in zip(rows, base))
    outcomes = []
    for head in (hmm.HEAD, 2):  # with 2 nearly all words take the join
        monkeypatch.setattr(hmm, "HEAD", head)
        found = hmm.score(docs, crc32_of("doc_id") % 7 == 2, rounds=2).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in found) == expected
        assert all(r["train_tokens"] == n and r["score"] < 0 for r in found)
    none = hmm.score(docs, F.lit(True), rounds=1).collect()
    assert {r["train_tokens"] for r in none} == {0} and all(math.isfinite(r["score"]) for r in none)
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in none)
    assert hmm.score(docs.limit(0), F.lit(False), rounds=1).count() == 0
