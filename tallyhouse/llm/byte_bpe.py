"""Byte-level BPE encoding and decoding (operator 1).

The sentencepiece model is serialised straight from a rank file: every
byte string of the vocabulary becomes one piece by mapping each byte to
one printable character, its score is the negative rank, normalisation is
the identity. sentencepiece merges the adjacent pair with the best score,
leftmost first, which is the merge order of the ranks. Texts are cut into
pre-tokens by the tokenizer's pattern, each pre-token is encoded alone,
and ids are decoded by the inverse of the byte mapping.

Results in special cases: a null text counts as empty; the empty text has
no ids; repeated rows give repeated rows; an empty table gives an empty
table; an input column with the name of an output column is replaced, all
other columns are kept.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from tallyhouse.llm.common import MEMO_ENTRIES, Memo, text_or_empty

ENCODED = "struct<n_tokens:bigint,ids:array<int>,decodes:boolean>"
DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


def byte_characters() -> list[str]:
    """One character per byte value, none of them white space or special to
    sentencepiece: printable Latin-1 bytes stand for themselves, the others
    take the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in plain}
    chars |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in chars)}
    return [chars[b] for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Byte strings of a rank file, by rank. Ranks must be 0..n-1."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not gapless from 0")
    return [ranks[i] for i in range(len(ranks))]


def serialise_model(vocabulary: list[bytes]) -> bytes:
    """The vocabulary as a serialised sentencepiece BPE model. Piece ids are
    ranks; the unknown piece, which no byte string can reach, comes last."""
    chars = byte_characters()
    model = proto.ModelProto()
    spec = model.trainer_spec
    spec.model_type = proto.TrainerSpec.BPE
    spec.vocab_size = len(vocabulary) + 1
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(vocabulary), -1, -1, -1
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    for rank, piece in enumerate(vocabulary):
        model.pieces.add(piece="".join(chars[b] for b in piece), score=-float(rank),
                         type=proto.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one worker process."""

    def __init__(self, vocabulary: list[bytes], pattern: str, memo: int = MEMO_ENTRIES):
        self.vocabulary = vocabulary
        self.pieces = {piece: i for i, piece in enumerate(vocabulary)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(vocabulary))
        self.pattern = regex.compile(pattern)
        self.double_space = regex.compile(r"\s\s")
        self.to_chars = dict(enumerate(byte_characters()))
        # inverse mapping: id -> characters of its piece -> bytes
        back = {c: b for b, c in self.to_chars.items()}
        self.id_bytes = [bytes(back[c] for c in self.model.id_to_piece(i))
                         for i in range(len(vocabulary))]
        self.id_packed = [struct.pack("<I", i) for i in range(len(vocabulary))]
        self.id_text = [str(i) for i in range(len(vocabulary))]
        self.memo = Memo(memo)  # chunk -> packed ids

    def chunks(self, text: str) -> list[str]:
        """The text in pieces that no match of the pattern reaches over, so
        that they can be encoded (and remembered) one by one. Without double
        white space these are: a line end, a word with the space before it,
        and the sentence sign after a letter or digit at a word's end."""
        if self.double_space.search(text):
            return self.pattern.findall(text)
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append("\n")
            first = True
            for word in line.split(" "):
                if first:
                    first = False
                    if not word:
                        continue
                else:
                    word = " " + word
                if word[-1] in ".," and word[-2:-1].isalnum():
                    out.append(word[:-1])
                    out.append(word[-1])
                else:
                    out.append(word)
        return out

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that the memo lacks: one library call for all their
        pre-tokens."""
        new, pieces, cut = self.memo.missing(chunks), self.pieces, self.pattern.findall
        parts = [[m.encode() for m in cut(c)] for c in new]
        todo = list({p for own in parts for p in own if p not in pieces})
        found = self.model.encode([p.decode("latin-1").translate(self.to_chars) for p in todo], num_threads=1)
        done = {p: struct.pack(f"<{len(ids)}I", *ids) for p, ids in zip(todo, found)}
        known = self.memo.now
        for c, own in zip(new, parts):
            # a whole pre-token of the vocabulary is its own id
            known[c] = b"".join([self.id_packed[pieces[p]] if p in pieces else done[p] for p in own])

    def encode(self, text: str) -> np.ndarray:
        chunks = self.chunks(text)
        try:
            return np.frombuffer(b"".join(map(self.memo.now.__getitem__, chunks)), dtype="<u4")
        except KeyError:
            self.learn(chunks)
            return np.frombuffer(b"".join(map(self.memo.now.__getitem__, chunks)), dtype="<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.id_bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(vocabulary_file: str, pattern: str) -> Codec:
    return Codec(read_ranks(SparkFiles.get(vocabulary_file)), pattern)


def _shipped(spark: SparkSession, path: str) -> str:
    """Send the vocabulary file to all executors; its name there."""
    spark.sparkContext.addFile(path)
    return path.rstrip("/").rsplit("/", 1)[-1]


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
           output: str = "encoded") -> DataFrame:
    """Add ``output``: struct of n_tokens and ids of every whole text, and
    whether the ids decode to it. ``vocabulary`` is the path of a rank file
    on the driver."""
    name = _shipped(docs.sparkSession, vocabulary)

    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(name, pattern)
        for batch in batches:
            texts = batch.to_pylist()
            found = [codec.encode(text) for text in texts]
            same = [codec.decode(ids.tolist()) == text.encode() for ids, text in zip(found, texts)]
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                pa.array(np.concatenate([np.zeros(0, "<u4"), *found]).astype(np.int32)))
            yield pa.StructArray.from_arrays([pa.array(sizes), ids, pa.array(same, pa.bool_())],
                                             names=["n_tokens", "ids", "decodes"])

    return docs.withColumn(output, run(text_or_empty(text_col)))


def decode(df: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids",
           output: str = "decoded") -> DataFrame:
    """Add ``output``: the bytes of an id array (null ids: null). An id
    outside the vocabulary is an error."""
    name = _shipped(df.sparkSession, vocabulary)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(name, pattern)
        for batch in batches:
            yield pa.array([None if ids is None else codec.decode(ids)
                            for ids in batch.to_pylist()], pa.binary())

    return df.withColumn(output, run(F.col(f"`{ids_col}`")))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
               output: str = "digests") -> DataFrame:
    """Add ``output``: struct of n_tokens, ids_sha256 (decimal ids joined by
    one space) and decoded_sha256 (bytes decoded from those ids). Encodes
    and decodes in one pass, so that ids of a corpus are not moved only to
    be digested."""
    name = _shipped(docs.sparkSession, vocabulary)

    @F.arrow_udf(DIGESTS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(name, pattern)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.to_pylist():
                ids = codec.encode(text).tolist()
                counts.append(len(ids))
                shown = " ".join(map(codec.id_text.__getitem__, ids))
                ids_sha.append(hashlib.sha256(shown.encode()).hexdigest())
                text_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(output, run(text_or_empty(text_col)))
