"""Hidden Markov language model (operator 7).

Tokens fall into a fixed number of classes: the most frequent words have a
class each, all others share classes by hash. A Markov chain of hidden
states emits classes; a word of a shared class has its add-one share of
the class. Baum-Welch runs over all training documents, cut into pieces of
bounded length; every partition adds up its expected counts and only the
sums meet. Scores are exact: the scaled forward recursion runs over whole
documents; very long ones as a product of transfer matrices.

The model's size is fixed by CLASSES and STATES. Word counts are exact and
stay distributed: only the most frequent words (at most HEAD) travel to
the tasks, all other words meet their counts in a join.

Tokens are words (what space and tab to carriage return separate, A-Z in
lower case) and one end per document. Words are told apart by 64-bit
hashes.

Results in special cases: a null text counts as empty and has the end as
its only token; null ids count as ids of empty text; repeated rows count
and are scored as often as they stand there; without training documents
all scores are those of a uniform model over the classes; an empty table
gives an empty table; other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved, text_or_empty

STATES = 8
CLASSES = 1 << 16
OWN = 49_152  # classes of one token: the end (class 0) and frequent words
HEAD = 1 << 18  # at most so many words have their counts in every task
ROUNDS = 5  # of Baum-Welch
PIECE = 256  # tokens of a training piece
PRIOR = 20_000.0  # weight, in tokens, of the class frequencies in each state
BATCH = 1 << 20  # tokens handled together
LONG = 4096  # from here on documents are scored by transfer matrices
END = xxhash.xxh3_64_intdigest(b"")  # no word is empty
_BLOCK = 256  # classes of a row of expected counts


def tokens(raw: bytes) -> np.ndarray:
    """Hashes of a text's tokens, the end last."""
    words = raw.lower().split()  # bytes: A-Z alone, ASCII white space alone
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out[-1] = END
    return out


def word_counts(texts: DataFrame) -> DataFrame:
    """(hash, count) over a table with a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

        held, size = [], 0
        for b in batches:
            for raw in b["text"].cast(pa.binary()).to_pylist():
                held.append(tokens(raw))
                size += len(held[-1])
                if size > 4 * BATCH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return texts.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("count"))


@dataclass(frozen=True)
class Lexicon:
    """What every task knows of the training words: sorted hashes of the
    head with counts and classes, and size and number of words of each
    shared class."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    words: int

    def classify(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its count (-1: not in the head)."""
        classes = (OWN + found % np.uint64(CLASSES - OWN)).astype(np.int64)
        counts = np.full(len(found), -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            known = self.hashes[at] == found
            counts[known] = self.counts[at[known]]
            classes = np.where(known, self.classes[at], classes)
        classes[found == np.uint64(END)] = 0
        return classes, counts

    def share(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of a token's share of its class."""
        total = self.class_tokens[classes] + self.class_words[classes] + 1
        return np.where(classes < OWN, 0.0, np.log10((counts + 1) / total))

    def frequency(self) -> np.ndarray:
        u = self.class_tokens + self.class_words + 1.0
        return u / u.sum()


def lexicon(counts: DataFrame) -> tuple[Lexicon, DataFrame]:
    """The lexicon of a count table, and the counts of all other words."""
    step = F.floor(F.log2("count") * 16).cast("int")
    # Words per step of the frequency scale: about a thousand rows at most.
    bins = {r["step"]: (r["words"], r["tokens"]) for r in counts.groupBy(step.alias("step")).agg(
        F.count("*").alias("words"), F.sum("count").alias("tokens")).collect()}
    least, room = max(bins, default=0) + 1, HEAD
    for s in sorted(bins, reverse=True):
        if bins[s][0] > room:
            break
        least, room = s, room - bins[s][0]
    head = counts.where(step >= least).collect()  # at most HEAD rows
    hashes = np.array([r["hash"] for r in head], dtype=np.int64).view(np.uint64)
    n = np.array([r["count"] for r in head], dtype=np.int64)
    order = np.lexsort((hashes, -n))
    order = order[hashes[order] != np.uint64(END)]
    classes = (OWN + hashes % np.uint64(CLASSES - OWN)).astype(np.int64)
    own = order[:OWN - 1]
    classes[own] = 1 + np.arange(len(own))
    classes[hashes == np.uint64(END)] = 0
    class_tokens, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    np.add.at(class_tokens, classes, n)
    np.add.at(class_words, classes, 1)
    tail = counts.where((step < least) & (F.col("hash") != F.lit(np.uint64(END).astype(np.int64).item())))
    # The end belongs to class 0 even where few documents were read.
    ends = counts.where((step < least) & (F.col("hash") == F.lit(np.uint64(END).astype(np.int64).item()))).collect()
    if ends:
        class_tokens[0], class_words[0] = ends[0]["count"], 1
        hashes, n, classes = np.append(hashes, np.uint64(END)), np.append(n, ends[0]["count"]), np.append(classes, 0)

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b["hash"].to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((OWN + found % np.uint64(CLASSES - OWN)).astype(np.int32)), b["count"]],
                                             names=["class", "count"])

    for r in (tail.mapInArrow(classed, "class int, count long").groupBy("class")
              .agg(F.sum("count").alias("tokens"), F.count("*").alias("words")).collect()):  # one row a class
        class_tokens[r["class"]] += r["tokens"]
        class_words[r["class"]] += r["words"]
    by_hash = np.argsort(hashes)
    return Lexicon(hashes[by_hash], n[by_hash], classes[by_hash], class_tokens, class_words,
                   sum(t for _, t in bins.values()), sum(w for w, _ in bins.values())), tail


@dataclass(frozen=True)
class Model:
    """first: state of the first token of a document (row 0) and of a
    later piece (row 1, in training alone); move: state to state; emit:
    class by state."""

    first: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def starting_model(words: Lexicon) -> Model:
    """Class frequencies, pushed apart between the states by fixed noise."""
    noise = np.random.default_rng(7).normal(scale=0.5, size=(CLASSES, STATES))
    emit = words.frequency()[:, None] * np.exp(noise)
    move = np.full((STATES, STATES), 0.05 / max(STATES - 1, 1))
    np.fill_diagonal(move, 0.95 if STATES > 1 else 1.0)
    return Model(np.full((2, STATES), 1 / STATES), move, emit / emit.sum(axis=0))


def _columns(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by falling length as one array of columns; its order; and how
    many rows reach each column."""
    sizes = np.array([len(r) for r in rows])
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros((sizes.max(initial=0), len(rows)), dtype=np.int64)
    for at, i in enumerate(order):
        out[:sizes[i], at] = rows[i]
    active = np.searchsorted(-sizes[order], -np.arange(len(out)), side="left")
    return out, order, active


def expected_counts(model: Model, pieces: list[np.ndarray], later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One pass of forward and backward recursions over pieces of classes:
    expected counts of first states, moves and emissions, and the log10
    likelihood. ``later`` marks pieces that do not start a document."""
    ids, order, active = _columns(pieces)
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    kind = later[order].astype(np.int64)
    states = move.shape[0]
    alpha = np.zeros((*ids.shape, states), dtype=np.float32)
    scale = np.ones(ids.shape, dtype=np.float32)
    for t, n in enumerate(active):
        before = model.first.astype(np.float32)[kind[:n]] if t == 0 else alpha[t - 1, :n] @ move
        a = before * emit[ids[t, :n]]
        scale[t, :n] = a.sum(axis=1)
        alpha[t, :n] = a / scale[t, :n, None]
    likelihood = float(np.log10(scale.astype(np.float64)).sum())
    moves = np.zeros((states, states))
    beta = np.ones((ids.shape[1], states), dtype=np.float32)
    for t in range(len(ids) - 2, -1, -1):
        n = active[t + 1]
        ahead = emit[ids[t + 1, :n]] * beta[:n] / scale[t + 1, :n, None]
        moves += alpha[t, :n].T @ ahead
        alpha[t + 1, :n] *= beta[:n]  # now the state probabilities
        beta[:n] = ahead @ move.T
    firsts = np.zeros((2, states))
    if len(ids):
        alpha[0] *= beta
        np.add.at(firsts, kind, alpha[0])
    used = np.arange(ids.shape[1])[None, :] < np.asarray(active)[:, None]
    flat, weight = ids[used], alpha[used]
    emitted = np.stack([np.bincount(flat, weight[:, s], len(emit)) for s in range(states)], axis=1)
    return firsts, moves * model.move, emitted, likelihood


def _cut(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i:i + PIECE] for i in range(0, len(ids), PIECE)]


def baum_welch(coded: DataFrame, model: Model, prior: np.ndarray) -> tuple[Model, float]:
    """One round over the column ``ids`` of a table: the next model and the
    log10 likelihood under the given one."""
    classes, states = model.emit.shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, moves = np.zeros((2, states)), np.zeros((states, states))
        emitted, likelihood = np.zeros((classes, states)), 0.0
        held, later, size = [], [], 0

        def add() -> None:
            nonlocal firsts, moves, emitted, likelihood, held, later, size
            f, m, e, ll = expected_counts(model, held, np.array(later, dtype=bool))
            firsts, moves, emitted, likelihood = firsts + f, moves + m, emitted + e, likelihood + ll
            held, later, size = [], [], 0

        for b in batches:
            for ids in b["ids"].to_pylist():
                for i, piece in enumerate(_cut(np.frombuffer(ids, "<u2"))):
                    held.append(piece)
                    later.append(i > 0)
                    size += len(piece)
                    if size >= BATCH:
                        add()
        if held:
            add()
        if likelihood:
            rows = [(-1, np.concatenate([firsts.ravel(), moves.ravel(), [likelihood]]).astype("<f8").tobytes())]
            for at in range(0, classes, _BLOCK):
                block = emitted[at:at + _BLOCK]
                if block.any():
                    rows.append((at // _BLOCK, block.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["block", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for block, packed in zip(b["block"].to_pylist(), b["counts"].to_pylist()):
                x = np.frombuffer(packed, "<f8" if block < 0 else "<f4").astype(np.float64)
                sums[block] = sums[block] + x if block in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype("<f8").tobytes() for x in sums.values()], pa.binary())],
                                         names=["block", "counts"])

    schema = "block int, counts binary"
    # One row per block and partition moves; the sums, of fixed size, come back.
    sums = {r["block"]: np.frombuffer(r["counts"], "<f8")
            for r in coded.select("ids").mapInArrow(count, schema).repartition("block").mapInArrow(add_up, schema).collect()}
    if -1 not in sums:
        return model, 0.0
    firsts, moves = sums[-1][:2 * states].reshape(2, states), sums[-1][2 * states:-1].reshape(states, states)
    emitted = np.zeros((classes, states))
    for block, x in sums.items():
        if block >= 0:
            emitted[block * _BLOCK:block * _BLOCK + len(x) // states] = x.reshape(-1, states)
    emit = emitted + PRIOR * prior[:, None]
    first, move = firsts + 1.0, moves + 1.0
    return Model(first / first.sum(axis=1, keepdims=True), move / move.sum(axis=1, keepdims=True),
                 emit / emit.sum(axis=0)), float(sums[-1][-1])


def _forward(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each row of classes, step by step over all."""
    ids, order, active = _columns(rows)
    out, now = np.zeros(len(rows)), None
    for t, n in enumerate(active):
        before = np.repeat(model.first[:1], n, axis=0) if t == 0 else now[:n] @ model.move
        now = before * model.emit[ids[t, :n]]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        out[:n] += np.log10(scale)
    back = np.empty(len(rows))
    back[order] = out
    return back


def _transfers(model: Model, pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of each piece that carries state weights over it, and the
    log10 of the factor taken out of it."""
    ids, order, active = _columns(pieces)
    states = model.move.shape[0]
    now, out = np.tile(np.eye(states), (len(pieces), 1, 1)), np.zeros(len(pieces))
    for t, n in enumerate(active):
        step = (now[:n] @ model.move) * model.emit[ids[t, :n]][:, None, :]
        scale = step.max(axis=(1, 2))
        now[:n] = step / scale[:, None, None]
        out[:n] += np.log10(scale)
    back, logs = np.empty_like(now), np.empty(len(pieces))
    back[order], logs[order] = now, out
    return back, logs


def likelihoods(model: Model, rows: list[np.ndarray]) -> np.ndarray:
    """log10 probability of whole class sequences, none of them empty."""
    out = np.zeros(len(rows))
    short = [i for i, r in enumerate(rows) if len(r) < LONG]
    if short:
        out[short] = _forward(model, [rows[i] for i in short])
    for i in sorted(set(range(len(rows))) - set(short)):
        row = rows[i]
        weights = model.first[0] * model.emit[row[0]]
        total = np.log10(weights.sum())
        weights = weights / weights.sum()
        for at in range(1, len(row), BATCH):
            part = row[at:at + BATCH]
            size = max(PIECE, int(len(part) ** 0.5))
            matrices, logs = _transfers(model, [part[j:j + size] for j in range(0, len(part), size)])
            for m, log in zip(matrices, logs):
                weights = weights @ m
                total += log + np.log10(weights.sum())
                weights = weights / weights.sum()
        out[i] = total
    return out


def train(coded: DataFrame, words: Lexicon, rounds: int = ROUNDS) -> Model:
    model, prior = starting_model(words), words.frequency()
    for _ in range(rounds):
        model, _ = baum_welch(coded, model, prior)
    return model


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """Learn from the rows that are not ``held_out`` and score all rows:
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigram) and score, both log10 probabilities of the whole text."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out.alias("held_out"), text_or_empty(text_col).alias("text"))
    counts = saved(word_counts(source.where("not held_out")), "word-counts")
    words, tail = lexicon(counts)
    shipped = spark.sparkContext.broadcast(words)  # at most HEAD words and CLASSES classes

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shipped.value
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                found = [tokens(raw) for raw in part["text"].cast(pa.binary()).to_pylist()]
                edge = np.concatenate([[0], np.cumsum([len(x) for x in found])])
                flat = np.concatenate(found)
                classes, count = words.classify(flat)
                inside = count >= 0
                share = np.where(inside, words.share(classes, np.maximum(count, 0)), 0.0)
                logs = np.where(inside, np.log10(np.maximum(count, 0) + 1.0), 0.0)
                sums = [np.add.reduceat(x, edge[:-1]) for x in (inside.astype(np.int64), logs, share)]
                ids = classes.astype("<u2")
                rest = []
                for i, j in zip(edge, edge[1:]):
                    tail_found, n = np.unique(flat[i:j][~inside[i:j]], return_counts=True)
                    rest.append(tail_found.tobytes() + n.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(np.diff(edge), pa.int64()), *map(pa.array, sums),
                     pa.array([ids[i:j].tobytes() for i, j in zip(edge, edge[1:])], pa.binary()), pa.array(rest, pa.binary())],
                    names=["doc_id", "held_out", "n_tokens", "head_known", "head_log", "head_share", "ids", "rest"])

    id_type = dict(source.dtypes)["doc_id"]
    coded = source.mapInArrow(code, f"doc_id {id_type}, held_out boolean, n_tokens long, head_known long, head_log double, "
                                    "head_share double, ids binary, rest binary")
    coded = saved(coded.withColumn("row", F.monotonically_increasing_id()), "coded-documents")
    model = train(coded.where("not held_out"), words, rounds)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                packed = part["rest"].to_pylist()
                n = [len(x) // 12 for x in packed]
                if sum(n):
                    hashes = np.concatenate([np.frombuffer(x, "<i8", k) for x, k in zip(packed, n)])
                    times = np.concatenate([np.frombuffer(x, "<u4", k, 8 * k) for x, k in zip(packed, n)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part["row"].to_numpy(), n)), pa.array(hashes),
                                                      pa.array(times, pa.int32())], names=["row", "hash", "times"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shipped.value
        for b in batches:
            n = b["times"].to_numpy().astype(np.float64)
            count = b["count"].to_numpy(zero_copy_only=False)
            classes = (OWN + b["hash"].to_numpy().view(np.uint64) % np.uint64(CLASSES - OWN)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b["row"], pa.array(np.where(count > 0, n, 0).astype(np.int64)), pa.array(n * np.log10(count + 1.0)),
                 pa.array(n * words.share(classes, count))], names=["row", "known", "log", "share"])

    # Words beyond the head meet their counts.
    rare = coded.select("row", "rest").mapInArrow(spread, "row long, hash long, times int")
    met = rare.join(tail, "hash", "left").select("row", "hash", "times", F.coalesce("count", F.lit(0)).alias("count"))
    rest = (met.mapInArrow(weigh, "row long, known long, log double, share double")
            .groupBy("row").agg(*[F.sum(c).alias(c) for c in ("known", "log", "share")]))
    fitted = spark.sparkContext.broadcast(model)  # CLASSES x STATES numbers

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows: list[np.ndarray] = []
        size = 0

        def solved() -> Iterator[pa.RecordBatch]:
            found, at = likelihoods(fitted.value, rows), 0
            for x in held:
                names = [c for c in x.schema.names if c != "ids"]
                yield pa.RecordBatch.from_arrays([*(x[c] for c in names), pa.array(found[at:at + x.num_rows])],
                                                 names=[*names, "chain"])
                at += x.num_rows

        for b in batches:
            held.append(b)
            rows += [np.frombuffer(x, "<u2") for x in b["ids"].to_pylist()]
            size += b["ids"].nbytes // 2
            if size >= 4 * BATCH:
                yield from solved()
                held, rows, size = [], [], 0
        if held:
            yield from solved()

    kept = ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_log", "head_share"]
    types = dict(coded.dtypes)
    chain = coded.select(*kept, "ids").mapInArrow(forward, ", ".join(f"{c} {types[c]}" for c in kept) + ", chain double")
    size = float(np.log10(words.tokens + words.words + 1.0))
    zero = [F.coalesce(c, F.lit(0)) for c in ("known", "log", "share")]
    return chain.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + zero[0]).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + zero[1] - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("chain") + F.col("head_share") + zero[2]).alias("score"))
