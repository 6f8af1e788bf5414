"""Benchmark decontamination with an FM-index over each shard of the training texts.

A shard is what Spark hands a task at a time. Its texts become word numbers; words that no benchmark item has only
separate, so stretches too short for any window drop out before the index is built and the rest stays small. The
windows of the benchmark are searched backwards, all at once, by ranks in a wavelet matrix over the Burrows-Wheeler
transform; a suffix position is stored for every eighth place, and the others are found by walking
to the next stored one. Occurrences become word ranges, merged per document.

The benchmark is the stated query set. It goes to the tasks in blocks of a bounded number of words, each block searched
over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmill.llm.common import prepare, matched, saved, text_of, whole_rows, with_text

WINDOW = 13
KEY = ("doc_id", "_text_hash")
SAMPLED = 8
# Words of a benchmark block: about 20 MB as Python objects.
BLOCK_WORDS = 200_000

# Letters A-Z become lower case, bytes outside words become spaces.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


class _Numbers(dict):
    def __missing__(self, word):
        return 0


class FMIndex:
    """Backward search over a sequence of small positive integers; 0 separates and never matches."""

    def __init__(self, symbols: np.ndarray):
        text = np.append(symbols.astype(np.int64), -1) + 1  # the end is the smallest
        self.n = n = len(text)
        suffixes = _suffix_array(text)
        bwt = text[suffixes - 1]
        counts = np.bincount(text, minlength=int(text.max()) + 2)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        self.levels = []
        self.bits = max(1, int(text.max()).bit_length())
        row = bwt
        for level in range(self.bits - 1, -1, -1):
            bit = (row >> level) & 1
            ones = np.concatenate(([0], np.cumsum(bit)))
            zeros = n - int(ones[-1])
            self.levels.append((level, bit, ones, zeros))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        self.stored = suffixes % SAMPLED == 0
        self.stored_rank = np.concatenate(([0], np.cumsum(self.stored)))
        self.samples = suffixes[self.stored]

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end in the transform."""
        start, end = np.zeros_like(end), end.copy()
        for level, _, ones, zeros in self.levels:
            bit = (symbol >> level) & 1
            s1, e1 = ones[start], ones[end]
            start = np.where(bit == 1, zeros + s1, start - s1)
            end = np.where(bit == 1, zeros + e1, end - e1)
        return end - start

    def _step_back(self, rows: np.ndarray) -> np.ndarray:
        at, symbol = rows, np.zeros_like(rows)
        for _, bits, ones, zeros in self.levels:
            bit = bits[at]
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + ones[at], at - ones[at])
        return self.before[symbol] + self.rank(symbol, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase number, first row, end row) of the phrases (one per row) that occur."""
        number = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[number, column].astype(np.int64) + 1
            known = symbol < len(self.before) - 1
            number, low, high, symbol = number[known], low[known], high[known], symbol[known]
            low = self.before[symbol] + self.rank(symbol, low)
            high = self.before[symbol] + self.rank(symbol, high)
            alive = low < high
            number, low, high = number[alive], low[alive], high[alive]
            if not len(number):
                break
        return number, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        places = np.empty(len(rows), np.int64)
        pending, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(pending):
            here = self.stored[rows]
            done = pending[here]
            places[done] = self.samples[self.stored_rank[rows[here]]] + steps
            pending, rows = pending[~here], self._step_back(rows[~here])
            steps += 1
        return places


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling."""
    n, step = len(text), 1
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(np.diff(text[order]) != 0)))
    while rank.max() < n - 1:
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        rank[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        step *= 2
    return order


class Benchmark:
    """A block of benchmark items: word numbers, different windows by length, and the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]]):
        self.numbers = _Numbers()
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            k = min(WINDOW, len(ids))
            for i in range(len(ids) - k + 1 if k else 0):
                owners.setdefault(tuple(ids[i : i + k]), set()).add(item)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for window in owners:
            by_length.setdefault(len(window), []).append(window)
        self.windows = [
            (k, np.array(ws, np.int32), [sorted(owners[w]) for w in ws]) for k, ws in sorted(by_length.items())
        ]
        self.shortest = min(by_length, default=0)

    def find(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], list[str]]]:
        """For each text its merged ranges of hit words and its items."""
        empty = [([], []) for _ in texts]
        if not self.windows or not texts:
            return empty
        get = self.numbers.__getitem__
        numbered = [np.fromiter(map(get, words), np.int32, len(words)) for words in texts]
        sequence, document, place = _stretches(numbered, self.shortest)
        if not len(sequence):
            return empty
        index = FMIndex(sequence)
        starts, lengths, who = [], [], []
        for k, windows, owners in self.windows:
            number, low, high = index.search(windows)
            if not len(number):
                continue
            spread = np.repeat(np.arange(len(number)), high - low)
            offset = np.arange(len(spread)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            at = index.locate(low[spread] + offset)
            starts.append(at)
            lengths.append(np.full(len(at), k))
            who += [owners[number[j]] for j in spread]
        if not starts:
            return empty
        start, length = np.concatenate(starts), np.concatenate(lengths)
        docs, first = document[start], place[start]
        found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
        for j in np.lexsort((first, docs)).tolist():
            ranges, items = found.setdefault(int(docs[j]), ([], set()))
            a, b = int(first[j]), int(first[j] + length[j])
            if ranges and a <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(b, ranges[-1][1]))
            else:
                ranges.append((a, b))
            items.update(who[j])
        for d, (ranges, items) in found.items():
            empty[d] = (ranges, sorted(items))
        return empty


def _stretches(numbered: list[np.ndarray], shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of known words that can hold a window, separated by 0, with document and word of each place."""
    lengths = np.array([len(x) + 1 for x in numbered])
    joined = np.zeros(int(lengths.sum()), np.int32)
    base = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    for start, x in zip(base.tolist(), numbered):
        joined[start : start + len(x)] = x
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (joined > 0).astype(np.int8), [0]))))
    first, last = edge[::2], edge[1::2]
    long = last - first >= shortest
    first, last = first[long], last[long]
    size = last - first + 1  # with its separator
    at = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(int(size.sum()))
    sequence = joined[at]  # the place after a stretch holds 0
    document = np.searchsorted(base, at, side="right") - 1
    return sequence, document, at - base[document]


HITS = (
    "doc_id long, _text_hash long, n_words long, ranges array<struct<from:int,to:int>>, items array<string>"
)
_ARROW_HITS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("_text_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("ranges", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def _searcher(shared):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Benchmark(shared.value)
        for batch in batches:
            texts = [words_of(t) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            found = block.find(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_text_hash"),
                    pa.array([len(w) for w in texts], pa.int64()),
                    pa.array([[{"from": a, "to": b} for a, b in r] for r, _ in found], _ARROW_HITS.field("ranges").type),
                    pa.array([i for _, i in found], pa.list_(pa.string())),
                ],
                schema=_ARROW_HITS,
            )

    return search


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of about BLOCK_WORDS words, one block on the driver at a time."""
    block, size = [], 0
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), text_of().alias("t"))
    for row in items.distinct().toLocalIterator():
        words = words_of(row.t.encode())
        if not words:
            continue
        block.append((row.i, words))
        size += len(words)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, _text_hash, n_words, ranges (merged, of hit words), items (sorted ids)."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), text_of().alias("_text")
    )
    blocks = blocks_of(benchmark)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return rows.mapInArrow(_searcher(spark.sparkContext.broadcast(first)), HITS)
    # Equal rows give equal hits in each block, so they are counted and dealt out again. A block is searched, its hits
    # are written, and it is given up before the next one is read: the driver holds one and looks ahead by one.
    union = None
    for k, block in enumerate(chain([first, second], blocks)):
        shared = spark.sparkContext.broadcast(block)
        part = saved(rows.mapInArrow(_searcher(shared), HITS).withColumn("_block", F.lit(k)), f"hits-{k}")
        shared.destroy()
        union = part if union is None else union.unionByName(part)
    keys = ["doc_id", "_text_hash", "n_words"]
    merged = union.groupBy(keys).agg(
        F.count_if(F.col("_block") == 0).alias("_copies"),
        F.flatten(F.collect_set("ranges")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return merged.mapInArrow(_merge_ranges, HITS + ", _copies long").withColumn("_copy", copies).drop("_copy", "_copies")


def _merge_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        merged = []
        for ranges in batch.column("ranges").to_pylist():
            out: list[dict] = []
            for r in sorted(ranges, key=lambda r: r["from"]):
                if out and r["from"] <= out[-1]["to"]:
                    out[-1] = {"from": out[-1]["from"], "to": max(out[-1]["to"], r["to"])}
                else:
                    out.append(r)
            merged.append(out)
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns["ranges"] = pa.array(merged, _ARROW_HITS.field("ranges").type)
        names = [*_ARROW_HITS.names, "_copies"]
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, ranges, _text_hash.

    A window is 13 neighbouring words of an item, or all words of a shorter one; a word is hit if an occurrence of a
    window covers it, and a document is contaminated if at least one word in twenty is hit. Null or empty texts have no
    words and are clean; items without words are never found; null item ids count as the empty id; repeated items
    count once per id. Repeated documents each get their row. Texts are searched whole, whatever their length. Empty tables
    give no hits or no rows.
    """
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + (r["to"] - r["from"]))
    return hits(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        "ranges",
        "_text_hash",
    )


def removal_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans of merged word ranges, from the first byte of the first word to the last of the last."""
    plain = text.translate(_BYTES)
    inside = np.frombuffer(plain, np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.astype(np.int8), [0]))))
    return [(int(edge[2 * a]), int(edge[2 * b - 1])) for a, b in ranges]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        for text, ranges in zip(texts, batch.column("ranges").to_pylist()):
            at, left = 0, []
            for a, b in removal_spans(text, [(r["from"], r["to"]) for r in ranges]):
                left.append(text[at:a])
                at = b
            out.append(b"".join(left) + text[at:])
        cut = pa.array(out, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("_row"), cut], names=["_row", "_cut"])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without contaminated documents; benchmark words in the others are cut out and n_chars follows.

    All columns stay. Documents without a hit are returned as they are, null and empty texts among them. Repeated rows stay or
    go together, and an empty table stays empty.
    """
    verdicts = saved(contamination(docs, benchmark).filter("n_hit > 0"), "contamination")
    # Small tables of their own: while they are small, the texts stay where they are.
    hit = saved(verdicts.select(*KEY).distinct(), "hit")
    touched = verdicts.filter(~F.col("contaminated")).select(*KEY, "ranges").dropDuplicates(KEY)
    touched = saved(touched, "touched")
    rows = whole_rows(docs).select("_row", "doc_id", F.xxhash64("_text").alias("_text_hash"), "_text")
    clean = matched(rows.drop("_text"), hit, KEY, "left_anti").select("_row", F.lit(None).cast("string").alias("_cut"))
    # Only the few touched texts go through Python.
    schema = T.StructType([rows.schema["_row"], T.StructField("_cut", T.StringType())])
    cut = matched(rows, touched, KEY).select("_row", "_text", "ranges").mapInArrow(_cut, schema)
    return with_text(clean.unionByName(cut), docs.columns, F.coalesce(F.col("_cut"), F.col("_row.text")))


def digest(verdicts: DataFrame) -> DataFrame:
    return verdicts.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")

