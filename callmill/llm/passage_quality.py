"""Text quality by attention over passages, learned from labels of whole documents.

A text is cut into passages of PASSAGE_WORDS words. Every passage is described by shares of kinds of characters, how its words
repeat, and a profile of its hashed byte trigrams, and encoded by one layer of a network. A gated attention, the product
of a tanh and a sigmoid branch, gives each passage a weight, the weights of a document add up to one, and the weighted sum of its
passages' codes is scored by a logistic function. Encoder, attention and score are learned together, from the documents' labels
alone: no passage has a label.

Texts are looked at as bytes, many documents at a time. Long ones go through in pieces of PIECE_BYTES, cut at white space, and
the weighted sums of the pieces are put together as if they had been one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import prepare, saved, text_of
from callmill.llm.toxicity import in_test_fold

PASSAGE_WORDS = 64
PIECE_BYTES = 1 << 20
# The documented bound of the labelled rows that are learned from.
SAMPLE = 4000
KEPT_FROM = 0.3

BUCKETS = 128
STATISTICS = 16
WIDTH, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.005, 1e-4

# Kinds of bytes.
SPACE, LOWER, UPPER, DIGIT, SYMBOL, MARK, OTHER, BEYOND = range(8)


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for b in range(256):
        if b >= 0x80:
            kinds[b] = BEYOND
        elif chr(b) in " \t\n\x0b\f\r":
            kinds[b] = SPACE
        elif chr(b).islower():
            kinds[b] = LOWER
        elif chr(b).isupper():
            kinds[b] = UPPER
        elif chr(b).isdigit():
            kinds[b] = DIGIT
        elif chr(b) in "#*$%&|<>":
            kinds[b] = SYMBOL
        elif chr(b) in "!?":
            kinds[b] = MARK
    return kinds


KINDS = _kinds()
POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def cut(text: bytes) -> list[bytes]:
    """The text in pieces of at most PIECE_BYTES, cut behind white space where there is some."""
    pieces, at = [], 0
    while len(text) - at > PIECE_BYTES:
        end = at + PIECE_BYTES
        spaces = np.flatnonzero(KINDS[np.frombuffer(text, np.uint8, PIECE_BYTES, at)] == SPACE)
        end = at + int(spaces[-1]) + 1 if len(spaces) else end
        pieces.append(text[at:end])
        at = end
    return [*pieces, text[at:]]


def described(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A row for each passage of each piece, and the number of passages of each piece: one at least."""
    data = np.frombuffer(b"".join(p + b" " for p in pieces), np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(p) + 1 for p in pieces])))[:-1]
    kind = KINDS[data]
    black = kind != SPACE
    before = np.concatenate(([False], black[:-1]))
    starts, ends = np.flatnonzero(black & ~before), np.flatnonzero(~black & before)
    piece = np.searchsorted(begins, starts, "right") - 1
    words = np.bincount(piece, minlength=len(pieces))
    counts = np.maximum(1, -(-words // PASSAGE_WORDS))
    first_passage = np.concatenate(([0], np.cumsum(counts)))[:-1]
    first_word = np.concatenate(([0], np.cumsum(words)))[:-1]
    passage = first_passage[piece] + (np.arange(len(starts)) - first_word[piece]) // PASSAGE_WORDS
    n = int(counts.sum())
    rows = np.zeros((n, STATISTICS + BUCKETS), np.float32)
    if not len(starts):
        return rows, counts

    size = np.bincount(passage, minlength=n)
    some = size > 0
    per_word = np.maximum(size, 1)
    lead = np.flatnonzero(np.diff(passage, prepend=-1))
    last = np.concatenate((lead[1:], [len(starts)])) - 1
    low, high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    low[some], high[some] = starts[lead], ends[last]
    per_byte = np.maximum(high - low, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
        return (total[high] - total[low]) / per_byte

    def of_words(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=values, minlength=n) / per_word

    upper, lower = share(kind == UPPER), share(kind == LOWER)
    length = ends - starts
    word = np.cumsum(black & ~before) - 1
    place = np.minimum(np.arange(len(data)) - starts[np.maximum(word, 0)], len(POWERS) - 1)
    hashes = np.add.reduceat(np.where(black, (data.astype(np.uint64) + np.uint64(1)) * POWERS[np.maximum(place, 0)], np.uint64(0)), starts)
    hashes ^= hashes >> np.uint64(29)
    # Equal words of a passage stand side by side.
    order = np.lexsort((hashes, passage))
    p, h = passage[order], hashes[order]
    fresh = np.concatenate(([True], (p[1:] != p[:-1]) | (h[1:] != h[:-1])))
    at = np.flatnonzero(fresh)
    often = np.zeros(n, np.int64)
    np.maximum.at(often, p[at], np.diff(np.concatenate((at, [len(p)]))))
    again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])))

    statistics = (
        np.log1p(size) / np.log(PASSAGE_WORDS + 1),
        of_words(np.minimum(length, 40)) / 10,
        of_words(length > 12),
        upper / np.maximum(upper + lower, 1e-9),
        share(kind == DIGIT),
        share(kind == SYMBOL),
        share(kind == MARK),
        share(kind == OTHER),
        share(kind == BEYOND),
        share(data == 10),
        share(kind == SPACE),
        np.bincount(p[at], minlength=n) / per_word,
        often / per_word,
        of_words(again),
        of_words(kind[starts] == UPPER),
        of_words((kind[ends - 1] == SYMBOL) | (kind[ends - 1] == MARK)),
    )
    for k, column in enumerate(statistics):
        rows[:, k] = np.where(some, column, 0)
    wide = data.astype(np.uint32)
    trigram = (wide[:-2] << 16) + (wide[1:-1] << 8) + wide[2:]
    bucket = (trigram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 7)
    # None that reaches into the next piece, or stands before the first word of its own.
    own = starts[np.maximum(word, 0)] >= np.repeat(begins, np.diff(begins, append=len(data)))
    own[begins[1:] - 1] = own[begins[1:] - 2] = False
    inside = np.flatnonzero((word[:-2] >= 0) & own[:-2])
    cell = passage[word[inside]] * BUCKETS + bucket[inside]
    profile = np.bincount(cell, minlength=n * BUCKETS).reshape(n, BUCKETS)
    rows[:, STATISTICS:] = np.sqrt(profile / np.maximum(profile.sum(axis=1, keepdims=True), 1))
    return rows, counts


@dataclass
class Model:
    """Mean and scale of the descriptions, and the layers' weights."""

    mean: np.ndarray
    scale: np.ndarray
    encode: np.ndarray
    encode_bias: np.ndarray
    tanh_gate: np.ndarray
    sigmoid_gate: np.ndarray
    attend: np.ndarray
    weigh: np.ndarray
    bias: np.ndarray

    LAYERS = ("encode", "encode_bias", "tanh_gate", "sigmoid_gate", "attend", "weigh", "bias")

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and attention (before it is shared out) of each passage."""
        codes = np.tanh(((x - self.mean) / self.scale) @ self.encode + self.encode_bias)
        return codes, (np.tanh(codes @ self.tanh_gate) * _sigmoid(codes @ self.sigmoid_gate)) @ self.attend


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _shared(attention: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each passage's share of its bag's attention; the shares of a bag add up to one."""
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    raised = np.exp(attention - np.repeat(np.maximum.reduceat(attention, first), counts))
    return raised / np.repeat(np.add.reduceat(raised, first), counts)


def _step(model: Model, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """The gradients of the mean log loss over the bags, one for each of Model.LAYERS."""
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    codes = np.tanh(x @ model.encode + model.encode_bias)
    left, right = np.tanh(codes @ model.tanh_gate), _sigmoid(codes @ model.sigmoid_gate)
    share = _shared((left * right) @ model.attend, counts)
    bags = np.add.reduceat(share[:, None] * codes, first)
    off = (_sigmoid(bags @ model.weigh + model.bias[0]) - y) / len(y)
    d_bags = np.repeat(off[:, None] * model.weigh, counts, axis=0)
    pull = (d_bags * codes).sum(axis=1)
    d_attention = share * (pull - np.repeat(np.add.reduceat(share * pull, first), counts))
    d_gate = d_attention[:, None] * model.attend
    d_left, d_right = d_gate * right * (1 - left**2), d_gate * left * right * (1 - right)
    d_codes = share[:, None] * d_bags + d_left @ model.tanh_gate.T + d_right @ model.sigmoid_gate.T
    d_codes = d_codes * (1 - codes**2)
    return [
        x.T @ d_codes,
        d_codes.sum(axis=0),
        codes.T @ d_left,
        codes.T @ d_right,
        (left * right).T @ d_attention,
        bags.T @ off,
        np.array([off.sum()]),
    ]


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, seed: int = 11) -> Model:
    """A model of bags of `counts` passages each, in the order of `x`, by Adam's steps over small batches of bags.

    Without bags it scores 0.5 everywhere.
    """
    r = np.random.default_rng(seed)
    start = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
    n = STATISTICS + BUCKETS
    model = Model(
        x.mean(axis=0) if len(x) else np.zeros(n),
        x.std(axis=0) + 1e-3 if len(x) else np.ones(n),
        start(n, WIDTH), np.zeros(WIDTH), start(WIDTH, GATE), start(WIDTH, GATE), start(GATE, 1)[:, 0],
        np.zeros(WIDTH), np.zeros(1),
    )
    x = (x - model.mean) / model.scale
    first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    layers = [getattr(model, name) for name in Model.LAYERS]
    mean, square, t = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers], 0
    for _ in range(EPOCHS):
        order = r.permutation(len(counts))
        for a in range(0, len(order), BATCH):
            some = order[a : a + BATCH]
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in some])
            t += 1
            for v, g, m, s in zip(layers, _step(model, x[rows], counts[some], y[some]), mean, square):
                g = g + DECAY * v
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return model


def _grouped(texts: list[str]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Pieces of texts, some PIECE_BYTES at a time, each with the number of its text."""
    pieces, owners, held = [], [], 0
    for row, text in enumerate(texts):
        for piece in cut(text.encode()):
            if held and held + len(piece) > PIECE_BYTES:
                yield pieces, owners
                pieces, owners, held = [], [], 0
            pieces.append(piece)
            owners.append(row)
            held += len(piece) + 1
    if pieces:
        yield pieces, owners


def scores(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score, passages, the passage with the largest weight, that weight) of each text."""
    n = len(texts)
    top, total, passages = np.full(n, -np.inf), np.zeros(n), np.zeros(n, np.int64)
    bags, best = np.zeros((n, WIDTH)), np.zeros(n, np.int64)
    for pieces, owners in _grouped(texts):
        x, counts = described(pieces)
        codes, attention = model.passages(x)
        first = np.concatenate(([0], np.cumsum(counts)))
        most = np.maximum.reduceat(attention, first[:-1])
        raised = np.exp(attention - np.repeat(most, counts))
        sums = np.add.reduceat(raised, first[:-1])
        codes = np.add.reduceat(raised[:, None] * codes, first[:-1])
        for k, row in enumerate(owners):
            if most[k] > top[row]:
                best[row] = passages[row] + int(np.argmax(attention[first[k] : first[k + 1]]))
            new = max(top[row], most[k])
            old, own = np.exp(top[row] - new), np.exp(most[k] - new)
            total[row] = total[row] * old + sums[k] * own
            bags[row] = bags[row] * old + codes[k] * own
            top[row] = new
            passages[row] += counts[k]
    total = np.maximum(total, 1)
    return _sigmoid((bags / total[:, None]) @ model.weigh + model.bias[0]), passages, best, 1 / total


DESCRIBED = "bag long, quality int, at long, described array<float>"
SCORED = "doc_id long, score double, n_passages long, top_passage long, top_weight double"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags, labels = batch.column("bag").to_pylist(), batch.column("quality").to_pylist()
        done: dict[int, int] = {}
        for pieces, owners in _grouped(batch.column("_text").to_pylist()):
            x, counts = described(pieces)
            row = np.repeat(owners, counts)
            at = []
            for owner, count in zip(owners, counts.tolist()):
                at.extend(range(done.get(owner, 0), done.get(owner, 0) + count))
                done[owner] = done.get(owner, 0) + count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bags[r] for r in row], pa.int64()),
                    pa.array([labels[r] for r in row], pa.int32()),
                    pa.array(at, pa.int64()),
                    pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32())),
                ],
                names=["bag", "quality", "at", "described"],
            )


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """bag, quality and text of at most `sample` different labelled texts outside the test fold, chosen by hash.

    Null labels and ids are left out; an id labelled more than once counts once, with its highest label.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~in_test_fold(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    # Both lists have `sample` rows of a few numbers at most.
    rows = rows.join(F.broadcast(marks), "doc_id").withColumn("bag", F.xxhash64("doc_id", "_text"))
    chosen = rows.select("bag").distinct().orderBy("bag").limit(sample)
    return rows.join(F.broadcast(chosen), "bag").dropDuplicates(["bag"]).select("bag", "quality", "_text")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the descriptions of the labelled texts' passages, all of them."""
    prepare(docs.sparkSession)
    bags = labelled(docs, labels, sample).mapInArrow(_describe, DESCRIBED)
    # The same order whatever task a text was in.
    found = saved(bags, "passages").toArrow().sort_by([("bag", "ascending"), ("at", "ascending")]).combine_chunks()
    if not len(found):
        return fit(np.zeros((0, STATISTICS + BUCKETS)), np.zeros(0, np.int64), np.zeros(0))
    x = found["described"].combine_chunks().flatten().to_numpy().reshape(len(found), -1)
    bag, label = found["bag"].to_numpy(), found["quality"].to_numpy()
    first = np.flatnonzero(np.concatenate(([True], bag[1:] != bag[:-1])))
    return fit(x.astype(np.float64), np.diff(np.concatenate((first, [len(bag)]))), label[first].astype(np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, score, predicted, n_passages, top_passage (from 0, the one of most weight), top_weight.

    Null and empty texts, and texts of white space, are one passage without words. Texts are scored whole, however long.
    Repeated rows each keep their row, an empty table gives none, other columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, passages, best, weight = scores(batch.column("_text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value), pa.array(passages), pa.array(best), pa.array(weight)],
                names=["doc_id", "score", "n_passages", "top_passage", "top_weight"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text"))
    return rows.mapInArrow(run, SCORED).select(
        "doc_id", "score", (F.col("score") >= KEPT_FROM).cast("int").alias("predicted"), "n_passages", "top_passage", "top_weight"
    )
