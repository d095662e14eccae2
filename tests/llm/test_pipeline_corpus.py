"""The corpus pipeline stage by stage against brute force."""

import base64
import os
import sys
import zlib

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as cp  # noqa: E402
from tests.llm.test_ngram_join import brute  # noqa: E402
from tests.llm.test_text_models import overlap, words  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        out.append(stage(spark, out[-1], SF))
    return out


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_names_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["quality_filter", "near_duplicates", "benchmark_leaks", "token_ids"]
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_stages_equal_brute_force(spark, steps):
    source, good, single, clean, ids = map(table, steps)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert set(good) < set(source)
    kept = {r[0] for r in good}
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.9

    groups = brute([r[:2] for r in good], 4, 5, width=5)
    assert {r[0] for r in single} == {c if c is not None else d for d, n, c in groups} and set(single) <= set(good)
    assert len(single) < len(good)

    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean == [r for r in single if not any(overlap(words(r[1]), i) for i in items)]

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert [(r[0], r[1], list(r[2]), r[3]) for r in ids] == [
        (r[0], len(tik.encode_ordinary(r[1])), tik.encode_ordinary(r[1]), True) for r in clean]


def test_run_equals_the_stages(spark, steps):
    assert table(cp.run(spark, SF)) == table(steps[-1])


def test_odd_rows_through_all_stages(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(1, "A good text of words that stand alone.", "en", "s", 1), (1, "A good text of words that stand alone.", "en", "s", 1),
            (1, "Another text with the same id.", "en", "s", 1), (None, "No id here but a text.", "en", None, None),
            (None, "No id here but a text.", "en", None, None), (2, None, None, None, None), (3, "", "", "", 0),
            (4, "a good TEXT of words that stand alone.", "en", "s", 1), (5, "long word " * 30_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{folder}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    # without labels every score is 0.5: all documents go
    assert cp.run(spark, folder).count() == 0
    single = cp.near_duplicates(spark, docs, folder)
    assert single.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in single.collect()))
    assert [i for i, _ in got] == [0, 1, 1, 2, 3, 5]
    assert len({t.lower() for i, t in got if i == 1}) == 2
    # Five-word shingles: a word more keeps 26 of 27 and five words less 21 of
    # 26, which link; another word in the middle keeps 21 of 31.
    base = [f"w{i}" for i in range(30)]
    near = [(10, " ".join(base)), (11, " ".join([*base, "more"])), (12, " ".join([*base[:15], "x", *base[16:]])),
            (13, " ".join(base[:25])), (14, " ".join([*base[:3], "y", *base[4:]]))]
    kept = cp.near_duplicates(spark, spark.createDataFrame([(*r, "en", "s", 1) for r in near], docs.schema), folder)
    want = {c for _, _, c in brute(near, 4, 5, width=5)}
    assert {r["doc_id"] for r in kept.collect()} == want and 11 not in want
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, folder).count() == 0
    assert zlib.crc32(b"") % 4 == 0
    assert cp.token_ids(spark, docs, folder).where(~F.col("decodes")).count() == 0
