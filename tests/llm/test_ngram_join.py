"""Operator 9 against brute force and SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import components, ngram_join, queries

SF = "/root/testdata/sf0.01"


def shingle_set(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, num=9, den=10, width=3):
    """Counter of (doc_id, n_shingles, component_id)."""
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    kinds = {}
    for i, s in enumerate(sets):
        if s:
            kinds.setdefault(s, []).append(i)
    kinds = list(kinds.items())
    for _, members in kinds:
        for i in members:
            parent[root(i)] = root(members[0])
    for x, (a, i) in enumerate(kinds):
        for b, j in kinds[x + 1:]:
            if den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    parent[root(i[0])] = root(j[0])
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = root(i)
            smallest[r] = min(d, smallest.get(r, d))
    return Counter((d, len(s), smallest.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def found(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_op9_query_equals_sql_and_brute_force(spark):
    out = found(queries.op9_ngram_product(spark, SF))
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert out == brute(rows)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    sql = "select doc_id, n_shingles, component_id from (" + queries.oracle_sql()["op9_ngram_product"] + ")"
    assert Counter(con.execute(sql).fetchall()) == out


def variants(rng, n, size, changes, vocabulary):
    base = [rng.choice(vocabulary) for _ in range(size)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            at = rng.randrange(len(words))
            if rng.random() < 0.3:
                del words[at]
            else:
                words[at] = rng.choice(vocabulary)
        yield " ".join(words)


@pytest.mark.parametrize("bound", [(9, 10), (4, 5), (1, 1)])
def test_groups_of_near_copies_equal_brute_force(spark, bound):
    rng = random.Random(sum(bound))
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for n, size, changes in ((150, 60, 3), (40, 200, 8), (30, 12, 1), (30, 21, 2), (20, 1000, 40), (60, 9, 1), (25, 4, 1)):
        texts += variants(rng, n, size, changes, vocabulary)
    texts += ["A b", "a  B", "a", "A", "a b c", "c b a", "a b c a b c", "É é", "é é"]
    texts += [texts[3]] * 200
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(ngram_join.ngram_components(docs, *bound)) == brute(rows, *bound)


def test_odd_rows(spark):
    long = "one two three four " * 20_000
    rows = [(7, None), (3, ""), (9, " \t\n"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (5, "x y z"), (None, None),
            (2, long), (1, long + "five"), (None, "only nulls here ok"), (None, "only nulls here ok")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("clash")).withColumn("rid", F.lit(1))
    assert found(ngram_join.ngram_components(docs)) == brute(rows)
    assert ngram_join.ngram_components(docs.limit(0)).count() == 0


def test_row_blocks_meet_each_other(spark, monkeypatch):
    """Blocks of a few rows: links between blocks, and only a forest of them."""
    rng = random.Random(8)
    texts = list(variants(rng, 90, 80, 4, [f"w{i}" for i in range(500)]))
    sets = sorted({s: i for i, s in enumerate(map(shingle_set, texts))}.values())
    packed = [ngram_join.shingles(texts[i].encode()) for i in sets]
    pairs = []
    for i in range(0, len(packed), 16):
        for j in range(i, len(packed), 16):
            wanted = np.ones((len(packed[i:i + 16]), len(packed[j:j + 16])), bool)
            if i == j:
                wanted = np.triu(wanted, 1)
            links = ngram_join._overlaps(packed[i:i + 16], packed[j:j + 16], 9, 10, wanted)
            pairs += [(i + x, j + y) for x, y in zip(*np.nonzero(links))]
            forest = ngram_join._forest(links, list(range(i, i + 16)), list(range(j, j + 16)))
            assert len(forest) < 32
    exact = {(i, j) for i in range(len(packed)) for j in range(i + 1, len(packed))
             if 10 * len(np.intersect1d(packed[i], packed[j])) >= 9 * len(np.union1d(packed[i], packed[j]))}
    assert set(pairs) == exact and exact
    monkeypatch.setattr(ngram_join, "BLOCK_COLUMNS", 7)
    wanted = np.triu(np.ones((len(packed), len(packed)), bool), 1)
    assert {(i, j) for i, j in zip(*np.nonzero(ngram_join._overlaps(packed, packed, 9, 10, wanted)))} == exact


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 300)] + [(500 + i, 500 + (i + 1) % 7) for i in range(7)]
    edges += [(900, 900), (3, 2)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}, **{i: 500 for i in range(500, 507)}}
    assert components.components(df.limit(0), "a", "b").count() == 0


def test_keep_one_by_five_word_shingles(spark):
    """Width 5 and four fifths keep the smallest id of every group that a
    brute force on five words links; three words and nine tenths keep more."""
    rng = random.Random(45)
    texts = [t for n, size in ((8, 60), (8, 90), (8, 14), (8, 5)) for t in variants(rng, n, size, 2, [f"w{i}" for i in range(400)])]
    rows = list(enumerate(texts))
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in ngram_join.keep_one(docs, 4, 5, width=5).collect()}
    assert kept == set(group)
    assert kept < {r["doc_id"] for r in ngram_join.keep_one(docs, 9, 10).collect()}
    with pytest.raises(ValueError):
        ngram_join.keep_one(docs, 4, 5, width=0)


def boilerplate(rng, n, common, own):
    """Documents of the same ``common`` words and ``own`` of their own."""
    shared = [f"c{i}" for i in range(common)]
    return [(i, " ".join([*shared, *(f"o{i}-{k}" for k in range(own))])) for i in range(n)]


def test_documents_that_share_common_words_alone_do_not_meet(spark, monkeypatch):
    from tallyhouse.llm import rare_shingles
    rows = boilerplate(random.Random(1), 400, 60, 14)
    rows += [(1000, rows[7][1]), (1001, rows[9][1] + " end"), (1002, " ".join(rows[11][1].split()[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    met = []
    candidates = ngram_join._candidates
    monkeypatch.setattr(ngram_join, "_candidates", lambda x: met.append(candidates(x)) or met[-1])
    want = brute(rows)
    for least in (rare_shingles.FREQUENT_LEAST, 30):  # 30: the common ones are not even sent
        monkeypatch.setattr(rare_shingles, "FREQUENT_LEAST", least)
        assert found(ngram_join.ngram_components(docs)) == want
        assert met[-1].count() <= 8  # of 402 classes
    assert found(ngram_join.ngram_components(docs, 4, 5)) == brute(rows, 4, 5)


@pytest.mark.parametrize("bound", [(9, 10), (1, 2)])
def test_few_bits_and_frequent_shingles_lose_no_link(spark, monkeypatch, bound):
    """Shingles and names that agree in their bits, and frequent ones, only
    add candidates."""
    from tallyhouse.llm import rare_shingles
    monkeypatch.setattr(rare_shingles, "FREQUENT_LEAST", 5)
    monkeypatch.setattr(rare_shingles, "NAME_BITS", 3)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [t for n, size, changes in ((60, 40, 4), (40, 15, 2), (30, 6, 1), (10, 300, 30)) for t in variants(rng, n, size, changes, vocabulary)]
    rows = list(enumerate(texts + texts[:20]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(ngram_join.ngram_components(docs, *bound)) == brute(rows, *bound)


def test_rarest_shingles_of_sets():
    from tallyhouse.llm import rare_shingles as rs
    sets = {bytes([i] * 16): np.array(sorted(x), np.uint64) << np.uint64(24) for i, x in enumerate(([1, 2, 9], [2, 3, 9], [5, 9, 1 << 33]))}
    packed = rs._pack(sets, 24, np.array([9], np.uint64), lambda n: 1, 32, 0)
    assert [g for g, *_ in packed] == [0, 2, -1]
    names, keys, counts = rs._repeated(0, [packed[0][1]], [packed[0][2]])
    assert keys.tolist() == [2, 2] and counts.tolist() == [2, 2] and sorted(names.tolist()) == [0, 0x01010101]
    told = np.frombuffer(packed[2][1], np.int64).tolist()
    assert told == [rs.HELD_FREQUENT, 9] * 3
    assert rs.frequent_in([np.array([1, 2], np.uint64)] * 3) is None
    many = rs.frequent_in([np.array([1, i], np.uint64) for i in range(2, 9)])
    assert np.frombuffer(many[0], np.uint64).tolist() == [1] and np.frombuffer(many[1], np.uint32).tolist() == [7]
