"""Benchmark decontamination by spaced seeds (operator 5).

DataFrame functions only. Texts become lower-case words (runs of letters
and digits). At every word position two fixed masks pick six words each
and ignore the words between; the hashes of the picked words of documents
and benchmark items are joined, and around every hit the two texts are
compared word by word: a document overlaps an item if some 13 neighbouring
words of the item, aligned at the hit, differ from the document's in at
most 2 places. The masks are chosen so that 13 words with any 2 of them
replaced keep at least one seed, so no such overlap is missed. An item of
7 to 12 words overlaps when all of it stands in the document.

Results in special cases: null and empty texts and items below 7 words
overlap with nothing; benchmark items of equal words are compared once and
each is named (null ids too); repeated rows and documents of one id are reported
together under that id (null ids too), but the filter goes by id and words;
empty tables give an empty result; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved, small, text_or_empty
from tallyhouse.operators.joins import broadcast_if_small, broadcast_limit
from tallyhouse.session import estimated_size_bytes

#: Word offsets that each mask picks. For every choice of 2 replaced words
#: out of 13 one of the masks fits between them at some position.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 5, 7, 8))
WINDOW = 13
REPLACED = 2
SHORTEST = min(m[-1] for m in MASKS) + 1


def words_of(text_col: str) -> Column:
    """Hashes of the lower-case words of a text."""
    found = F.array_remove(F.split(F.lower(text_or_empty(text_col)), r"[^\p{L}\p{N}]+"), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def seeds(df: DataFrame, words: str = "words") -> DataFrame:
    """One row per position and mask that fits: adds ``at`` (from 1),
    ``span`` and ``seed``."""
    n = F.size(words)
    at = df.where(n >= SHORTEST).withColumn("at", F.explode(F.sequence(F.lit(1), n - (SHORTEST - 1))))
    hashes = []
    for mask in MASKS:
        picked = [F.get(words, F.col("at") + (offset - 1)) for offset in mask]
        fits = F.col("at") + mask[-1] <= n
        hashes += [F.lit(mask[-1] + 1), F.when(fits, F.xxhash64(F.lit(mask[-1]), *picked))]
    out = at.select("*", F.stack(F.lit(len(MASKS)), *hashes).alias("span", "seed"))
    return out.where("seed is not null")


def best_match() -> Column:
    """Most equal words in a window of the item around a hit, as the surplus
    over what the window needs (below 0: no overlap). Uses words, at, span
    (document) and item_words, item_at."""
    n = F.size("item_words")
    width = F.least(F.lit(WINDOW), n)
    need = F.when(n >= WINDOW, F.lit(WINDOW - REPLACED)).otherwise(n)
    first = F.greatest(F.lit(1), F.col("item_at") + F.col("span") - width)
    last = F.least(n, F.col("item_at") + width - 1)
    equal = F.transform(F.sequence(first, last), lambda k: F.coalesce(
        (F.get("item_words", k - 1) == F.get("words", F.col("at") - F.col("item_at") + k - 1)).cast("int"), F.lit(0)))
    windows = F.transform(F.sequence(F.lit(1), last - first - width + 2), lambda s: F.aggregate(
        F.slice(equal, s, width), F.lit(0), lambda a, x: a + x))
    return F.array_max(windows) - need


def _items(benchmark: DataFrame, item_text_col: str) -> DataFrame:
    """item_words and item_key of the distinct items that can be found; the
    key is fixed by writing the table."""
    items = benchmark.select(words_of(item_text_col).alias("item_words")).where(F.size("item_words") >= SHORTEST).distinct()
    return saved(items.withColumn("item_key", F.monotonically_increasing_id()), "benchmark-items")


def _checked(texts: DataFrame, items: DataFrame) -> DataFrame:
    """The verified hits of ``texts`` (doc_id, text_key, words) with text_key,
    item_key, at and span."""
    item_seeds = seeds(items.select("item_key", F.col("item_words").alias("words")))
    item_seeds = saved(item_seeds.select("item_key", F.col("at").alias("item_at"), "span", "seed"), "benchmark-seeds")

    size = estimated_size_bytes(item_seeds)
    if size is not None and size <= broadcast_limit(texts):
        # The measured seeds are small: one pass over the documents.
        hits = seeds(texts).join(F.broadcast(item_seeds), ["seed", "span"])
    else:
        # Otherwise positions travel without their text, and only texts
        # with hits are fetched again.
        found = (seeds(texts).select("doc_id", "text_key", "at", "span", "seed")
                 .join(item_seeds, ["seed", "span"]).drop("seed"))
        found = saved(found.withColumnRenamed("doc_id", "hit_id"), "benchmark-hits")
        hits = found.join(texts.dropDuplicates(["doc_id", "text_key"]).withColumnRenamed("text_key", "key"),
                          (F.col("text_key") == F.col("key")) & F.col("hit_id").eqNullSafe(F.col("doc_id")))
    return hits.join(broadcast_if_small(items), "item_key").where(best_match() >= 0)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), words_of(text_col).alias("words"))
    return texts.withColumn("text_key", F.xxhash64("words"))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per (doc_id, item_id) that overlap, with the word range of
    the document that the verified seeds span (``first_word`` from 0, and
    ``end_word`` behind the last) and the number of ``hits``."""
    items = _items(benchmark, item_text_col)
    found = _checked(_texts(docs, id_col, text_col), items).groupBy("doc_id", "item_key").agg(
        (F.min("at") - 1).alias("first_word"), F.max(F.col("at") + F.col("span") - 1).alias("end_word"),
        F.count("*").alias("hits"))
    rows = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), words_of(item_text_col).alias("item_words"))
    names = rows.join(broadcast_if_small(items), "item_words").select("item_key", "item_id").distinct()
    # Rows of one id but other words are one item of the result.
    return found.join(broadcast_if_small(saved(names, "benchmark-names")), "item_key").groupBy("doc_id", "item_id").agg(
        F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"), F.sum("hits").alias("hits"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no item, all columns kept.
    Rows go by id and words: clean texts of a leaked text's id stay."""
    leaked = _checked(_texts(docs, id_col, text_col), _items(benchmark, item_text_col)).select(
        F.col("doc_id").alias("__leaked_id"), F.col("text_key").alias("__leaked_key")).distinct()
    leaked = saved(leaked, "leaked-texts")
    keyed = docs.withColumn("__text_key", F.xxhash64(words_of(text_col)))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__leaked_id")) & (F.col("__text_key") == F.col("__leaked_key"))
    return keyed.join(small(leaked), same, "left_anti").drop("__text_key")
