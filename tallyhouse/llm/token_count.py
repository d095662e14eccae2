"""Count-only Viterbi tokenizer (operator 10).

Counts the tokens of texts under a unigram vocabulary without building
them: an Aho-Corasick automaton enumerates all vocabulary matches of a
word, and dynamic programming over its positions carries the best score
and the number of pieces on the best path.

The rules are those of sentencepiece's unigram model: spaces become the
word mark, a text gets one in front; a character that is no piece by
itself may stand as unknown at ten below the lowest score; among paths of
equal score the one whose last piece starts first wins; with byte fallback
an unknown character counts once per UTF-8 byte, otherwise unknown
neighbours count once together. Scores add up without rounding from the
start of each word (no piece reaches over a word start). The library adds
32-bit floats from the start of the text, so the two agree wherever its
sums are exact.

Results in special cases: null and empty texts have 0 tokens; repeated
rows give repeated rows; an empty table gives an empty table; an input
column with the name of the output is replaced, all others are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tallyhouse.llm.common import MEMO_ENTRIES, text_or_empty

MARK = "▁"  # sentencepiece's word mark
UNKNOWN_BELOW = 10.0  # how far an unknown character's score lies below the lowest
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Counter:
    def __init__(self, serialised: bytes, memo: int = MEMO_ENTRIES):
        model = proto.ModelProto.FromString(serialised)
        kinds = proto.ModelProto.SentencePiece
        norm = model.normalizer_spec
        if (norm.remove_extra_whitespaces or norm.precompiled_charsmap
                or not norm.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only models that leave texts as they are can be counted")
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        pieces = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece reaches over a word start")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.byte_fallback = model.trainer_spec.byte_fallback
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_BELOW
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.memo: dict[str, int] = {}
        self.limit = memo

    def _cost_of_unknown(self, char: str, after_unknown: bool) -> int:
        if self.byte_fallback:
            return len(char.encode())
        return 0 if after_unknown else 1

    def word(self, word: str) -> int:
        """Pieces on the best path through one word."""
        n = len(word)
        best, count, unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        at = 0  # positions up to here are final

        def settle(end: int, single: bool) -> None:
            """Consider the unknown piece that ends at ``end`` last."""
            if not single:
                score = best[end - 1] + self.unknown
                if best[end] is None or score > best[end]:
                    best[end], unknown[end] = score, True
                    count[end] = count[end - 1] + self._cost_of_unknown(word[end - 1], unknown[end - 1])

        single = True
        for last, (length, piece_score) in self.automaton.iter(word):
            end = last + 1
            while at < end:  # ends without (further) matches before this one
                if at:
                    settle(at, single)
                at, single = at + 1, False
            # Matches of one end come longest first: on equal scores the
            # earliest start stays.
            score = best[end - length] + piece_score
            if best[end] is None or score > best[end]:
                best[end], count[end] = score, count[end - length] + 1
            single = single or length == 1
        while at <= n:
            if at:
                settle(at, single)
            at, single = at + 1, False
        return count[n]

    def words(self, text: str) -> list[str]:
        if MARK in text or "  " in text or text.startswith(" "):
            return _WORDS.findall(self.prefix + text.replace(" ", MARK))
        first, *rest = text.split(" ")
        return [self.prefix + first, *(MARK + w for w in rest)]

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = self.words(text)
        try:
            return sum(map(self.memo.__getitem__, words))
        except KeyError:
            total, memo = 0, self.memo
            for w in words:
                n = memo.get(w)
                if n is None:
                    if len(memo) >= self.limit:
                        memo.clear()
                    n = memo[w] = self.word(w) if w else 0
                total += n
            return total


@lru_cache(maxsize=2)
def _counter(model: bytes) -> Counter:
    return Counter(model)


def rank_unigram(path: str) -> bytes:
    """A sentencepiece model as a unigram model whose pieces score by their
    negative rank. (Merge models have these scores but for the lone word
    mark at -1e9, beside which 32-bit sums lose all other scores.)"""
    with open(path, "rb") as f:
        model = proto.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    ranked = (p for p in model.pieces if p.type == proto.ModelProto.SentencePiece.NORMAL)
    for rank, piece in enumerate(ranked):
        piece.score = -float(rank)
    return model.SerializeToString()


def count_tokens(docs: DataFrame, model: bytes, text_col: str = "text", output: str = "n_tokens") -> DataFrame:
    """Add ``output``: tokens of every whole text. ``model`` is a serialised
    sentencepiece model; its pieces and scores are the unigram vocabulary."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary, not data

    @F.arrow_udf("bigint")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(shipped.value)
        for batch in batches:
            yield pa.array([counter.count(t) for t in batch.to_pylist()], pa.int64())

    return docs.withColumn(output, run(text_or_empty(text_col)))
