"""Removal of byte strings of 100 bytes that occur earlier in the corpus, by merged Burrows-Wheeler transforms.

Finding what can repeat. Each 100-byte window has an anchor, the least hash among its 24-byte strings. Neighbouring windows
mostly share theirs, so a document is a sequence of runs, one per 40 bytes or so. Equal windows have equal anchors;
an anchor that occurs once in the corpus settles its windows, and only hashes have moved for it. The runs of other anchors are
cut out as segments, the run's windows with all their bytes.

Comparing. All windows with one anchor meet in one bucket. A bucket's segments are dealt into shards, each shard has its own
transform, and the transforms are merged by refining their interleave: it starts with the shards one after another, and a turn
replaces the shard numbers by those of the predecessors, dealt by symbol. After h turns the rows are in the order of their first
h symbols, and rows that no turn has parted have these in common. No suffixes are sorted for the merge. The symbols here are blocks of
25 bytes, so four turns give common prefixes of 100 bytes, and the repeated intervals are the groups that
are still together then. Names of blocks come from 64-bit hashes; the bytes of each interval are compared afterwards.

Copies. A task hands on each different segment once, with its earliest place; the others are known to repeat. So a segment that
many documents share arrives once per task. An anchor that very many runs have may have as many different segments, and
its windows are dealt one by one, by a hash of their bytes, instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import prepare, removed, matched, saved, settled, text_of

LENGTH = 100
ANCHOR = 24
BLOCK = 25
TURNS = LENGTH // BLOCK
# An anchor of more runs than this is dealt by windows.
HOT = 20_000
BUCKET_SEGMENTS = 4096
SHARD_SEGMENTS = 1024
# Different segments that a task remembers to find copies; more are handed on and forgotten.
REMEMBERED = 40_000

_ODD = 0x9E3779B97F4A7C15
_PLACE = np.uint64(0xFFF)
_KEY = ("doc_id", "_text_hash")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def string_hashes(data: np.ndarray, length: int, base: int = _ODD) -> np.ndarray:
    """Hash of the `length` bytes from every place on, by doubling."""
    out, have = None, 0
    power, size = data.astype(np.uint64) + np.uint64(1), 1
    rest = length
    n = len(data)
    while rest:
        if rest & 1:
            end = n - length + 1
            part = power[have : have + end]
            out = part if out is None else out * np.uint64(pow(base, size, 2**64)) + part
            have += size
        rest >>= 1
        if rest:
            power = power[: len(power) - size] * np.uint64(pow(base, size, 2**64)) + power[size:]
            size *= 2
    return _mixed(out)


def _least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor) of the runs of neighbouring windows with one anchor."""
    if len(text) < LENGTH:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    hashes = string_hashes(np.frombuffer(text, np.uint8), ANCHOR)
    # The place in the low bits: equal strings inside one window are different anchors, or a text that
    # repeats itself within a window would pass for one run.
    tagged = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64) & _PLACE
    width = LENGTH - ANCHOR + 1
    least = _least_of(tagged, width)
    # Where the place starts again from 0 inside a window, half its range is added for the comparison.
    turn = int(_PLACE) + 1
    half = np.uint64(turn // 2)
    for at in range(turn, len(hashes), turn):
        near = np.arange(at - width + 1, min(at + width - 1, len(hashes)), dtype=np.uint64)
        moved = _least_of(hashes[near[0] : near[-1] + 1] & ~_PLACE | (near + half) & _PLACE, width)
        least[near[0] : near[0] + len(moved)] = moved & ~_PLACE | (moved - half) & _PLACE
    start = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return start, np.diff(np.append(start, len(least))), least[start] >> np.uint64(12)


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, places, anchors = [], [], []
        keys = batch.column("_doc").to_numpy()
        for k, text in enumerate(batch.column("_text").cast(pa.binary()).to_pylist()):
            start, size, anchor = runs(text)
            docs.append(np.full(len(start), keys[k]))
            places.append(start << 8 | size)
            anchors.append(anchor.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in (docs, places, anchors)],
            names=["_doc", "place", "anchor"],
        )


SEGMENTS = "route long, segment binary, doc_id long, _text_hash long, start long, until long"
_ARROW_SEGMENTS = pa.schema(
    [("route", pa.int64()), ("segment", pa.binary())]
    + [(c, pa.int64()) for c in ("doc_id", "_text_hash", "start", "until")]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_ARROW_SEGMENTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(columns, _ARROW_SEGMENTS)], schema=_ARROW_SEGMENTS
    )


def _before(a: tuple, b: tuple) -> bool:
    """Order of places (doc_id, text hash, start); null ids come first."""
    return (a[0] is not None, a[0] or 0, *a[1:]) < (b[0] is not None, b[0] or 0, *b[1:])


def _segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a segment: its earliest place in this task. Rows without: a removal, [start, until)."""
    first: dict[tuple[int, bytes], tuple] = {}

    def flushed() -> pa.RecordBatch:
        rows = [(*key, *place, None) for key, place in first.items()]
        first.clear()
        return _batch(rows)

    for batch in batches:
        gone: list[tuple] = []
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        ids, hashes = batch.column("doc_id").to_pylist(), batch.column("_text_hash").to_pylist()
        for text, doc, text_hash, found in zip(texts, ids, hashes, batch.column("_runs").to_pylist()):
            for run in found:
                start, size, anchor = run["place"] >> 8, run["place"] & 255, run["anchor"]
                if run["hot"]:
                    cuts = [
                        (xxhash.xxh3_64_intdigest(text[a : a + LENGTH]) - 2**63, a, 1) for a in range(start, start + size)
                    ]
                else:
                    cuts = [(anchor, start, size)]
                for route, a, windows in cuts:
                    segment = text[a : a + windows + LENGTH - 1]
                    if len(segment) < LENGTH:
                        continue  # a place of another document whose key is the same by chance
                    place, key = (doc, text_hash, a), (route, segment)
                    held = first.setdefault(key, place)
                    if held is place or held == place:
                        continue
                    late = place
                    if _before(place, held):
                        first[key], late = place, held
                    until = late[2] + len(segment)
                    if gone and late is place and gone[-1][2:4] == late[:2] and gone[-1][4] <= late[2] <= gone[-1][5]:
                        gone[-1] = (*gone[-1][:5], max(gone[-1][5], until))  # a copy's segments overlap
                    else:
                        gone.append((0, None, *late, until))
        if gone:
            yield _batch(gone)
        if len(first) >= REMEMBERED:
            yield flushed()
    yield flushed()


class ShardTransform:
    """The Burrows-Wheeler transform of a shard of segments over named blocks.

    Position p is followed by p + BLOCK: a segment is BLOCK interlaced strings. Symbol 0 ends a string.
    """

    def __init__(self, names: np.ndarray, before: np.ndarray, positions: np.ndarray):
        # names: the symbol at each position of the bucket; before: the symbol of its predecessor, 0 for none.
        # Order of the first TURNS symbols, last one first. A step over an end gives symbols 0 from there on.
        steps = [names[positions]]
        for k in range(1, TURNS):
            ahead = np.zeros_like(steps[0])
            ahead[: max(len(positions) - k * BLOCK, 0)] = steps[0][k * BLOCK :]
            ahead[steps[-1] == 0] = 0
            steps.append(ahead)
        ranked = _sorted_by(steps[-1])
        for symbols in reversed(steps[:-1]):
            ranked = ranked[_sorted_by(symbols[ranked])]
        self.suffixes = positions[ranked]
        self.symbols = before[self.suffixes]
        self.ends = int(np.count_nonzero(steps[0] == 0))


def _sorted_by(values: np.ndarray) -> np.ndarray:
    """Stable order of 32-bit non-negative integers, by 16 bits at a time."""
    halves = np.ascontiguousarray(values, "<u4").view("<u2").reshape(-1, 2)
    order = np.argsort(halves[:, 0], kind="stable")
    high = halves[order, 1]
    return order[np.argsort(high, kind="stable")] if high.any() else order


def merged(shards: list[ShardTransform]) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, group) in merged order; suffixes of one group have TURNS symbols in common."""
    symbols = np.concatenate([s.symbols for s in shards])
    kind = np.uint8 if len(shards) < 256 else np.uint16
    ends = np.repeat(np.arange(len(shards), dtype=kind), [s.ends for s in shards])
    interleave = np.repeat(np.arange(len(shards), dtype=kind), [len(s.symbols) for s in shards])
    group = np.zeros(len(symbols), np.int32)
    for _ in range(TURNS):
        here = np.empty_like(symbols)
        here[np.argsort(interleave, kind="stable")] = symbols
        # Rows without a predecessor give nothing; rows that end a string follow from none and stay in front.
        has = np.flatnonzero(here)
        taken = has[_sorted_by(here[has])]
        symbol, group = here[taken], group[taken]
        parts = np.ones(len(taken), np.int32)
        parts[1:] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        interleave = np.concatenate((ends, interleave[taken]))
        group = np.concatenate((np.zeros(len(ends), np.int32), np.cumsum(parts, dtype=np.int32)))
    suffixes = np.empty(len(symbols), np.int64)
    suffixes[np.argsort(interleave, kind="stable")] = np.concatenate([s.suffixes for s in shards])
    return suffixes, group


def repeated_windows(segments: list[bytes], key: np.ndarray) -> np.ndarray:
    """For each byte place of the joined segments, whether a window starts there that also starts at a lesser key.

    `key` gives the order of the places; segments are different, at least LENGTH long, and each is joined with an end
    byte, so that a block that reaches the segment's end is followed by a place, too.
    """
    data = np.frombuffer(b"".join(s + b"\0" for s in segments), np.uint8)
    lengths = np.array([len(s) + 1 for s in segments])
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(len(data))
    windows = place + LENGTH < ends
    whole = place + BLOCK < ends
    edges = np.cumsum(lengths)
    for base in (_ODD, _ODD ^ 0x5555555555555554, 0xD6E8FEB86659FD93):
        hashes = np.zeros(len(data), np.uint64)
        hashes[: len(data) - BLOCK + 1] = string_hashes(data, BLOCK, base)
        names = np.zeros(len(data), np.int32)
        names[whole] = np.unique(hashes[whole], return_inverse=True)[1] + 1
        before = np.zeros(len(data), np.int32)
        before[BLOCK:] = np.where(whole[:-BLOCK], names[:-BLOCK], 0)
        shards = []
        for i in range(0, len(segments), SHARD_SEGMENTS):
            a = int(edges[i - 1]) if i else 0
            b = int(edges[min(i + SHARD_SEGMENTS, len(segments)) - 1])
            shards.append(ShardTransform(names, before, place[a:b]))
        suffixes, group = merged(shards)
        inside = windows[suffixes]
        suffixes, group = suffixes[inside], group[inside]
        if _bytes_agree(data, suffixes, group):
            break
    else:
        raise ValueError("three hash functions gave equal names to different blocks")
    out = np.zeros(len(data), bool)
    if len(group):
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        least = np.minimum.reduceat(key[suffixes], first)
        out[suffixes] = key[suffixes] > np.repeat(least, np.diff(np.append(first, len(suffixes))))
    return out


def _bytes_agree(data: np.ndarray, suffixes: np.ndarray, group: np.ndarray) -> bool:
    """Whether the windows of every group are equal byte for byte, each compared with the next."""
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    pairs = np.flatnonzero(group[1:] == group[:-1]) if len(group) > 1 else np.zeros(0, np.int64)
    for i in range(0, len(pairs), 20_000):
        at = pairs[i : i + 20_000]
        if not np.array_equal(rows[suffixes[at]], rows[suffixes[at + 1]]):
            return False
    return True


SPANS = "doc_id long, _text_hash long, start long, until long"


def _spans_of(rows: list[tuple]) -> list[tuple]:
    """Removals (doc_id, text hash, start, until) within the earliest places of a bucket's segments.

    Rows are (segment, doc_id, text hash, start).
    """
    segments = [r[0] for r in rows]
    documents = sorted({(r[1] is not None, r[1] or 0, r[2]) for r in rows})
    rank = {d: i for i, d in enumerate(documents)}
    lengths = np.array([len(s) + 1 for s in segments])  # with the end byte
    base = np.array([rank[(r[1] is not None, r[1] or 0, r[2])] << 40 | r[3] for r in rows], np.int64)
    edges = np.cumsum(lengths)
    key = np.repeat(base - (edges - lengths), lengths) + np.arange(int(edges[-1]))
    late = repeated_windows(segments, key)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], late.view(np.int8), [0]))))
    out = []
    # A segment's last places start no window, so a run never leaves its segment.
    for a, b, i in zip(edge[::2].tolist(), edge[1::2].tolist(), np.searchsorted(edges, edge[::2], side="right").tolist()):
        _, doc, text_hash, start = rows[i]
        shift = start - int(edges[i] - lengths[i])
        out.append((doc, text_hash, a + shift, b - 1 + shift + LENGTH))
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, route, segment and place; removals pass through.

    A segment that is alone on its route has copies at most, which go: no other segment has a window in common with it.
    """
    names = ["doc_id", "_text_hash", "start", "until"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    bucket = route = last = None
    kept: list[tuple] = []  # of the bucket's routes with several segments
    alone: list[tuple] = []  # the route's segments so far

    def settle() -> None:
        if len(alone) > 1:
            kept.extend(alone)
        alone.clear()

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("_bucket", "route", "segment", *names)]
        for here, way, segment, doc, text_hash, start, until in zip(*columns):
            if segment is None:
                out.append((doc, text_hash, start, until))
                continue
            if here != bucket or way != route:
                settle()
                last = None
                if here != bucket:
                    if kept:
                        out += _spans_of(kept)
                        kept.clear()
                    bucket = here
                route = way
            if segment == last:
                if (doc, text_hash, start) != alone[-1][1:]:
                    out.append((doc, text_hash, start, start + len(segment)))
                continue
            alone.append((segment, doc, text_hash, start))
            last = segment
        if out:
            yield batch_of(out)
    settle()
    yield batch_of(_spans_of(kept) if kept else [])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed_, spans_, digests = [], [], []
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        for text, spans in zip(texts, batch.column("_spans").to_pylist()):
            runs_ = merge_spans(spans or [])
            at, left = 0, hashlib.sha256()
            for a, b in runs_:
                left.update(text[at:a])
                at = b
            left.update(text[at:])
            removed_.append(sum(b - a for a, b in runs_))
            spans_.append([{"start": a, "until": b} for a, b in runs_])
            digests.append(left.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(removed_, pa.int64()),
                pa.array([len(s) for s in spans_], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(spans_, pa.list_(pa.struct([("start", pa.int64()), ("until", pa.int64())]))),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def merge_spans(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in sorted(spans, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["until"]))
        else:
            out.append((s["start"], s["until"]))
    return out


RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start:bigint,until:bigint>>"
)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, _text_hash, _spans): byte ranges that 100-byte strings with an earlier start cover, not yet merged."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), text_of().alias("_text")
    )
    # One number stands for the document while only hashes move. Two documents with one number would only cost
    # a look at places that need none.
    numbered = rows.withColumn("_doc", F.xxhash64("doc_id", "_text_hash"))
    anchors = saved(
        numbered.select("_doc", "_text").mapInArrow(_anchored, "_doc long, place long, anchor long"), "anchors"
    )
    # A table of its own, so that the join below reads two plain shuffles and can split a hot anchor.
    shared = saved(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    listed = saved(
        anchors.join(shared, "anchor")
        .groupBy("_doc")
        .agg(F.array_sort(F.collect_set(F.struct("place", "anchor", (F.col("n") > HOT).alias("hot")))).alias("_runs")),
        "runs",
    )
    removed(anchors)
    n = listed.agg(F.coalesce(F.sum(F.size("_runs")), F.lit(0)).alias("n")).first().n
    settled(spark)
    buckets = max(1, -(-n // BUCKET_SEGMENTS))
    cut = numbered.join(listed, "_doc").select("doc_id", "_text_hash", "_text", "_runs").mapInArrow(_segmented, SEGMENTS)
    spans = (
        cut.withColumn(
            "_bucket",
            # Removals only pass through and may go anywhere.
            F.when(F.col("segment").isNotNull(), F.pmod(F.xxhash64("route"), F.lit(buckets)))
            .otherwise(F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets))),
        )
        .repartition("_bucket")
        .sortWithinPartitions("_bucket", "route", "segment", "doc_id", "_text_hash", "start")
        .mapInArrow(_compared, SPANS)
    )
    found = saved(
        spans.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "until")).alias("_spans")), "spans"
    )
    settled(spark)
    return found


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (merged, in bytes).

    Each byte goes that lies in a 100-byte string which also starts earlier, in a document of a lesser id or further up in the same. Rows
    that repeat id and text are one document and get the same answer; rows with one id and different texts come in the
    order of the text's hash. Null ids come first, null texts are empty. Texts under 100 bytes lose nothing. An empty table gives
    no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    found = repeated_spans(docs)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), text_of().alias("_text")
    )
    return (
        matched(rows, found, _KEY, "left")
        .select("doc_id", "_text", "_spans")
        .mapInArrow(_cut, RESULT)
    )
