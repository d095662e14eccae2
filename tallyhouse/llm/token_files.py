"""Token ids in Arrow stream files of equal-length sequences (operator 2).

Documents are put in ascending id order, encoded, closed with an end id
and packed without gaps into sequences of one length. A file holds record
batches of two fixed-size-list columns: ``ids`` (the smallest unsigned
type that holds the vocabulary) and ``mask`` (false: padding, only at the
end of a file). All lists have the same length, so sequence i of a mapped
file lies at a known place and is read without copying. Beside each file
lies an index (Arrow stream, one row a document), and the manifest lists
the files in order with their counts.

A file is written under a name of its own attempt and then renamed, so a
repeated task replaces whole files by equal ones.

Results in special cases: a null text counts as empty (its only id is the
end id); null ids come first; rows of equal id are ordered by a hash of
the text; an empty table has no files; other columns are not stored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.byte_bpe import byte_characters
from tallyhouse.llm.common import Memo, saved, text_or_empty
from tallyhouse.llm.sharding import find_splitters, key_part, range_of, ranges_of, text_size

#: Entries of a generation of the words and word parts that a worker keeps.
WORDS = 200_000
MANIFEST = "part int, file string, documents long, tokens long, sequences long"


class Encoder:
    """A tokenizer with memos of encoded words. Its matches never reach over
    a space or a line end, so each word between them is encoded alone; nor
    from a letter or digit to a sentence sign, so signs at a word's end are
    encoded apart from it."""

    ENDS = ".,;:!?#$%&*"
    # Lower-casing A-Z before composition is only the same without these.
    LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
    COMBINING = re.compile("[\u0300-\u036f]")

    def __init__(self, path: str, memo: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # Lower-case Latin words may go straight to the merges if the steps
        # before them do no more than write their bytes as characters.
        probe = "".join(c for c in map(chr, range(0x61, 0x100)) if self.LATIN.fullmatch(c))
        norm, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.to_chars = dict(enumerate(byte_characters()))
        self.direct = ((norm is None or norm.normalize_str(probe) == probe)
                       and cut is not None and [x for x, _ in cut.pre_tokenize_str(probe)] == [self.as_bytes(probe)])
        probe = "abcdefghijklmnopqrstuvwxyz"
        self.lowers = norm is not None and norm.normalize_str(probe.upper()) == probe
        self.words, self.parts = Memo(memo), Memo(memo)

    def as_bytes(self, word: str) -> str:
        """One character per UTF-8 byte."""
        return word.encode().decode("latin-1").translate(self.to_chars)

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.dtype.char}", *ids)

    def cut(self, word: str) -> tuple[str, ...]:
        stem = word.rstrip(self.ENDS)
        if stem and stem[-1].isalnum():
            end = word[len(stem):]
            return (stem, end) if end else (stem,)
        return (word,)

    def learn(self, words: list[str]) -> None:
        known, pack, merges, others = self.words, self.pack, self.tokenizer.model.tokenize, []
        direct, latin = self.direct, self.LATIN.fullmatch
        for w in known.missing(words):
            if direct and latin(w):
                known.now[w] = pack([x.id for x in merges(w if w.isascii() else self.as_bytes(w))])
            else:
                others.append(w)
        cuts = {w: self.cut(w) for w in others}
        new = self.parts.missing(p for c in cuts.values() for p in c)
        parts = self.parts.now
        for p, x in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            parts[p] = pack(x.ids)
        known.now.update((w, b"".join(map(parts.__getitem__, c))) for w, c in cuts.items())

    def apart(self, text: str) -> list[str]:
        """The words of a text, sentence signs apart and A-Z in lower case
        where that changes no token, so that few of them are new."""
        text = text.replace("\n", " ")
        if self.lowers and (text.isascii() or not self.COMBINING.search(text)):
            text = text.encode().lower().decode()
        for sign in (". ", ", "):
            parts = text.split(sign)
            if all(p[-1:].isalnum() for p in parts[:-1]):
                text = f" {sign}".join(parts)
        return text.split(" ")

    def encode(self, text: str) -> bytes:
        words = self.apart(text)
        try:
            return b"".join(map(self.words.now.__getitem__, words))
        except KeyError:
            self.learn(words)
            return b"".join(map(self.words.now.__getitem__, words))


@lru_cache(maxsize=2)
def _encoder(file: str) -> Encoder:
    return Encoder(SparkFiles.get(file))


def _place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def sequence_schema(dtype: np.dtype, length: int) -> pa.Schema:
    ids = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("position", pa.int64()), ("n_tokens", pa.int64())])


class FileWriter:
    """Packs the documents of one range into one file."""

    def __init__(self, folder: str, part: int, dtype: np.dtype, length: int, batch: int):
        self.fs, self.folder = _place(folder)
        self.name, self.attempt = f"part-{part:06d}", uuid.uuid4().hex
        self.fs.create_dir(self.folder, recursive=True)
        self.dtype, self.length, self.room = dtype, length, length * batch
        self.schema = sequence_schema(dtype, length)
        self.sink = self.fs.open_output_stream(self._temporary("arrow"))
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.buffer, self.held = [], 0
        self.tokens = self.sequences = 0
        self.ids, self.sizes = [], []

    def _temporary(self, kind: str) -> str:
        return f"{self.folder}/.{self.name}.{self.attempt}.{kind}"

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.ids.append(doc_id)
        self.sizes.append(n)
        self.buffer.append(ids)
        self.held += n
        self.tokens += n
        if self.held >= self.room:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.buffer), dtype=self.dtype)
        at = 0
        while len(flat) - at >= self.room or last and at < len(flat):
            part = flat[at:at + self.room]
            at += len(part)
            padding = -len(part) % self.length
            mask = np.ones(len(part) + padding, dtype=bool)
            if padding:
                mask[len(part):] = False
                part = np.concatenate([part, np.zeros(padding, dtype=self.dtype)])
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (part, mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
            self.sequences += len(columns[0])
        self.buffer, self.held = [flat[at:].tobytes()], len(flat) - at

    def close(self) -> None:
        self._flush(last=True)
        self.out.close()
        self.sink.close()
        position = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)
        with self.fs.open_output_stream(self._temporary("index")) as sink, pa.ipc.new_stream(sink, INDEX) as out:
            out.write_batch(pa.RecordBatch.from_arrays(
                [pa.array(self.ids, pa.int64()), pa.array(position), pa.array(self.sizes, pa.int64())], schema=INDEX))
        for kind in ("index", "arrow"):
            self.fs.move(self._temporary(kind), f"{self.folder}/{self.name}.{kind}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", length: int = 1024, batch: int = 64,
                      range_bytes: int = 16 << 20) -> DataFrame:
    """Write the files of all documents into ``folder`` (a URI that every
    executor can write) and return the manifest, one row a file, in order.
    ``tokenizer`` is the path of a tokenizer file on the driver."""
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer)
    file = tokenizer.rsplit("/", 1)[-1]
    # Range splitters over (id, text hash), balanced by bytes.
    a, b = key_part(id_col), F.xxhash64(text_or_empty(text_col))
    keys = saved(docs.select(a.alias("a"), b.alias("b"), text_size(text_col).alias("size")), "token-keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()["size"]
    parts = ranges_of(total, range_bytes)
    splitters = find_splitters(keys, parts, tolerance=0.1)

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Texts travel compressed; the exchange is the largest thing on disk.
        press = zstandard.ZstdCompressor(level=3)
        for x in batches:
            yield pa.array([press.compress(t) for t in x.cast(pa.binary()).to_pylist()], pa.binary())

    moved = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), a.alias("a"), b.alias("b"),
                        packed(text_or_empty(text_col)).alias("text"))
    moved = moved.withColumn("part", range_of(F.col("a"), F.col("b"), splitters))
    moved = moved.repartitionById(parts, F.col("part")).sortWithinPartitions("a", "b")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, encoder, unpack = None, None, zstandard.ZstdDecompressor()
        for x in batches:
            if writer is None and x.num_rows:
                part = x["part"][0].as_py()
                encoder = _encoder(file)
                end = np.array([end_id], dtype=encoder.dtype).tobytes()
                writer = FileWriter(folder, part, encoder.dtype, length, batch)
            for doc_id, text in zip(x["doc_id"].to_pylist(), x["text"].to_pylist()):
                writer.add(doc_id, encoder.encode(unpack.decompress(text).decode()) + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([f"{writer.name}.arrow"]),
                 *(pa.array([n], pa.int64()) for n in (len(writer.ids), writer.tokens, writer.sequences))],
                names=["part", "file", "documents", "tokens", "sequences"])

    manifest = moved.select("doc_id", "text", "part").mapInArrow(write, MANIFEST)
    return saved(manifest, "token-manifest").orderBy("part")


class TokenFile:
    """Random access to the sequences of one file; local files are mapped,
    so ``sequence`` copies nothing."""

    def __init__(self, folder: str, file: str):
        fs, path = _place(folder)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.source = pa.memory_map(f"{path}/{file}") if local else fs.open_input_file(f"{path}/{file}")
        self.batches = list(pa.ipc.open_stream(self.source))
        with fs.open_input_file(f"{path}/{file.removesuffix('arrow')}index") as f:
            self.index = pa.ipc.open_stream(f).read_all()
        self.step = len(self.batches[0]) if self.batches else 1

    def __len__(self) -> int:
        return sum(map(len, self.batches))

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``. All batches but the last have the
        same number of sequences."""
        batch, row = self.batches[i // self.step], i % self.step
        ids, mask = (batch.column(k).slice(row, 1).flatten() for k in (0, 1))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, position in the file, ids) of each document."""
        if not self.batches:
            return
        flat = [b.column(0).flatten().to_numpy() for b in self.batches]
        step = len(flat[0])
        for row in self.index.to_pylist():
            at, left, parts = row["position"], row["n_tokens"], []
            while left:
                piece = flat[at // step][at % step:at % step + left]
                parts.append(piece)
                at, left = at + len(piece), left - len(piece)
            yield row["doc_id"], row["position"], np.concatenate(parts) if len(parts) != 1 else parts[0]


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row a document from the files of a manifest: doc_id, start (ids
    of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian 32-bit integers). One task reads one file."""
    rows = manifest.orderBy("part").collect()  # one row a file
    starts = [0, *accumulate(r["tokens"] for r in rows)]
    files = spark.createDataFrame([(r["part"], r["file"], s) for r, s in zip(rows, starts)],
                                  "part int, file string, start long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for file, start in zip(x["file"].to_pylist(), x["start"].to_pylist()):
                found = [(d, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                         for d, at, ids in TokenFile(folder, file).documents()]
                columns = list(zip(*found)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = files.repartitionById(max(1, len(rows)), F.col("part") % max(1, len(rows)))
    return tasks.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
