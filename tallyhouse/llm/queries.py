"""Registered queries of the training-data operators: each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe, decontamination, hard_negatives, hmm, html_text, license_scan, ngram_join, quality, sharding, token_count, token_files, topk, vector_codes
from tallyhouse.llm.common import crc32_of, read_table, shared_path


def held_out(folds: int) -> Column:
    """Rows of the fold that nothing is learnt from."""
    return crc32_of("doc_id") % folds == 2


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "digests.*")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_path(spark, "tokens")
    manifest = token_files.write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(spark, folder, manifest)


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs).select(
        "doc_id", "size", crc32_of("text").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~held_out(4))
    forest = quality.fit(docs.where(~held_out(4)), labels)
    return quality.score(docs, forest).select(
        "doc_id", held_out(4).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.overlaps(docs, read_table(spark, sf_dir, "benchmark"))


def op6_voronoi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return hmm.score(docs, held_out(7))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_ngram_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.ngram_components(docs, 9, 10)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = token_count.rank_unigram(public_tokenizers.path("piece_bpe_32k.model"))
    return token_count.count_tokens(docs, model).select("doc_id", "n_tokens")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_byte_bpe, op2_token_files, op3_histogram_sort, op4_quality_trees, op5_spaced_seeds, op6_voronoi_join, op7_hidden_markov, op8_license_scan, op9_ngram_product,
        op10_token_counts, op11_vector_codes, op12_hard_negatives, op13_html_text)}


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages, html_text.fit(pages)).select("page_id", "url", "text", "n_chars")


def _codes_sql(rounds: int = 6) -> str:
    """Codebooks of 16 entries refined step by step, one statement part a
    round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} as materialized (
          select t.*, k % 256 as e, k // 256 as d from (
            select t.vec_id, t.p, any_value(t.x) as x, min(256 * (list_dot_product(t.x, t.x) - 2 * list_dot_product(t.x, b.x)
              + list_dot_product(b.x, b.x))::hugeint + b.e) as k
            from parts t join book{r} b on t.p = b.p group by t.vec_id, t.p) t)""")
        if r < rounds:
            steps.append(f"""
        mean{r} as materialized (
          select p, e, list(m order by i) as x from (
            select p, e, i, floor(sum(x[i]) / count(*))::bigint as m from near{r}, range(1, 1 + len(x)) s(i) group by p, e, i)
          group by p, e),
        book{r + 1} as materialized (
          select b.p, b.e, coalesce(m.x, b.x) as x from book{r} b left join mean{r} m on b.p = m.p and b.e = m.e)""")
    return """
        with kept as (
          select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        parts as materialized (
          select vec_id, p, v[p * len(v) // 8 + 1:(p + 1) * len(v) // 8] as x from kept, range(8) s(p)),
        book0 as materialized (
          select p, row_number() over (partition by p order by vec_id) - 1 as e, x from parts qualify e < 16),""" + ",".join(
            steps) + f""",
        coded as (
          select vec_id, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error
          from near{rounds} group by vec_id)
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
          (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) from book{rounds}) as codebooks_sha256
        from coded join kept using (vec_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op11_vector_codes": _codes_sql(),
            "op12_hard_negatives": """
        with vectors as (
          select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
          where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
          from vectors a join vectors c on a.vec_id <> c.vec_id where a.vec_id % 100 = 0),
        positives as (
          select anchor_id, vec_id as positive_id, score as positive_score from scored where same
          qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select p.anchor_id, p.positive_id, row_number() over (
            partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id)::int as rank,
          n.vec_id as negative_id, p.positive_score, n.score as negative_score
        from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
          and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
        qualify rank <= 5""",
            "op6_voronoi_join": """
        with vectors as (
          select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
          where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
          from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
        ranked as (
          select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 5""",
            "op9_ngram_product": r"""
        with recursive words as (
          select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
        sets as (
          select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
            else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
          from words),
        members as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
        links as (
          select a.doc_id as u, b.doc_id as v from members a join members b on a.shingle = b.shingle and a.doc_id <> b.doc_id
            and 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
          group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        reached as (
          select doc_id, doc_id as other from documents union select r.doc_id, l.v from reached r join links l on r.other = l.u)
        select s.doc_id, len(s.s)::bigint as n_shingles, min(r.other) as component_id
        from sets s join reached r on s.doc_id = r.doc_id group by s.doc_id, s.s"""}
