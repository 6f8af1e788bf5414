"""Near-duplicate classes by order MinHash, verified by banded alignment.

A text's k-mers are its five-word shingles, each labelled with how often it stood before, so that repeats count. A sketch takes
the three labelled k-mers with the least hashes and keeps them in text order: two texts meet in a sketch if they share these and
have them in the same order. At a similarity of 0.8 a sketch meets with a probability of about 0.8 ** 3, and all 24 miss with
(1 - 0.512) ** 24 < 4e-8.

Equal texts are one node from the start. Nodes that meet in a sketch form a bucket. A bucket is not expanded into all pairs:
its first node is compared with the others, and who is similar joins its class. Buckets whose nodes are then in one class
are done; in the others the next node is taken as the first one, a few times over. Of what is left, two nodes of different
classes are only compared if they share one of their rarest k-mers and if enough of a sample of their k-mers stand in about the same place.

The bounds leave out only what can't be similar. A similar pair shares at least 0.8 / 1.8 of both texts' k-mers, `a` together.
So each must have `a` that some other candidate has, too; and of the k-mers they share, the rarest is among the `n - a + 1`
rarest of either. This rules out most comparisons: texts that only have a passage in common, and copies of one
text with many changes of their own each.

Places rule out texts made of the same parts in different orders. What is aligned in a similar pair stands at most
`n - a` places farther on in the text of `n` k-mers than in the other, and is 0.8 of all k-mers of both. So the k-mer with the least
hash is the same in both, and as close, with a probability of 0.8 or more for each hash. (A k-mer that repeats in a text may stand
anywhere.) Fewer than 160 of 256 hashes have such a one with a probability under 1e-9.

Two texts are similar if the aligned shingles are at least 0.8 of all: with `c` shingles in the longest common
subsequence, c / (n + m - c) >= 0.8. That bounds how far an alignment strays from the diagonal, hence the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import holds_lookups, matched, prepare, saved, settled, text_of, whole_rows
from callmill.llm.decontam import words_of

SHINGLE = 5
TAKEN = 3
SKETCHES = 24
SIMILAR = 0.8
LISTED = 100_000
# Counters of k-mers: they set the order in which rare k-mers come first. Any order gives the same pairs in the end.
COUNTERS = 1 << 20
# How often the nodes of a bucket are compared with its first one, at most.
ROUNDS = 4
# Hashes that sample k-mers with their places, and how many of them must agree.
PLACED = 256
AGREED = 160
# Nodes that are compared with one first node in one task.
COMPARED = 500
REMEMBERED = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _seeds(name: str, n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{name} {j}") | 1 for j in range(n)], np.uint64)


_SEEDS = _seeds("sketch", SKETCHES)
_PLACE_SEEDS = _seeds("place", PLACED)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_HASHES = _Hashes()


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the five-word shingles in text order; a text of fewer words is one shingle, one of none has none."""
    words = words_of(text)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    holds_lookups("order_minhash", _HASHES.clear)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    k = min(SHINGLE, n)
    out = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        out = out * _BASE + h[i : n - k + 1 + i]
    return _mixed(out)


def labelled(kmers: np.ndarray) -> np.ndarray:
    """The k-mers with their occurrence numbers mixed in: all different."""
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    if len(first) == len(kmers):
        return kmers
    number = np.arange(len(kmers)) - np.repeat(first, np.diff(np.append(first, len(kmers))))
    out = kmers.copy()
    out[order] = _mixed(ordered + number.astype(np.uint64) * _BASE)
    out[order[number == 0]] = ordered[number == 0]
    return out


def _hashed(tagged: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A row of hashes of all k-mers for each seed."""
    hashed = (tagged[None, :] ^ seeds[:, None]) * seeds[:, None]
    hashed ^= hashed >> np.uint64(32)
    hashed *= _BASE
    return hashed


def sketches(kmers: np.ndarray) -> np.ndarray:
    """One hash per sketch: of the labelled k-mers with the least hashes, in text order."""
    if not len(kmers):
        return np.zeros(0, np.int64)
    tagged = labelled(kmers)
    n, taken = len(tagged), min(TAKEN, len(tagged))
    out = _SEEDS.copy()
    width = max(1, 1_000_000 // n)
    for j in range(0, SKETCHES, width):
        seeds = _SEEDS[j : j + width]
        places = np.argpartition(_hashed(tagged, seeds), taken - 1, axis=1)[:, :taken] if taken < n else np.tile(np.arange(n), (len(seeds), 1))
        places.sort(axis=1)
        for column in range(taken):
            out[j : j + width] = _mixed(out[j : j + width] * _BASE + tagged[places[:, column]])
    return out.view(np.int64)


def placed(kmers: np.ndarray) -> np.ndarray:
    """For each place seed the labelled k-mer with the least hash: 16 of its bits above, its place from 1 on below, or 0 if it repeats.

    Places are counted in steps of size / 2 ** 15, rounded down, so that they fit.
    """
    if not len(kmers):
        return np.zeros(0, np.int32)
    tagged = labelled(kmers)
    _, same, count = np.unique(kmers, return_inverse=True, return_counts=True)
    steps = np.arange(len(kmers)) // max(1, len(kmers) >> 15) + 1
    place = np.where(count[same] > 1, 0, steps).astype(np.uint32)
    width = max(1, 1_000_000 // len(tagged))
    at = np.concatenate(
        [_hashed(tagged, _PLACE_SEEDS[j : j + width]).argmin(axis=1) for j in range(0, PLACED, width)]
    )
    return ((tagged[at] >> np.uint64(48)).astype(np.uint32) << np.uint32(16) | place[at]).view(np.int32)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Multiset Jaccard similarity of two sequences with labelled repeats."""
    if not len(a) or not len(b):
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """c / (n + m - c) for the longest common subsequence within the band outside which `least` can't be reached.

    Bit-parallel: a bit for each place of `a`, a row for each place of `b`.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    band = n + m - 2 * need
    if band < abs(n - m):
        return 0.0
    short = min(n, m)
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    rest = short - head
    same = a[n - rest :][::-1] == b[m - rest :][::-1] if rest else np.ones(0, bool)
    tail = rest if same.all() else int(np.argmin(same))
    a, b = a[head : n - tail], b[head : m - tail]
    common = head + tail
    if len(a) and len(b):
        places: dict[int, int] = {}
        for i, x in enumerate(a.tolist()):
            places[x] = places.get(x, 0) | 1 << i
        full = (1 << len(a)) - 1
        row, window = full, (1 << (2 * band + 1)) - 1
        for j, x in enumerate(b.tolist()):
            match = places.get(x)
            if match:
                match &= window << (j - band) if j >= band else window >> (band - j)
                kept = row & match
                row = ((row + kept) | (row - kept)) & full
        common += len(a) - row.bit_count()
    return common / (n + m - common)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kmers = [shingles(t) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("_node"),
                pa.array([len(k) for k in kmers], pa.int64()),
                pa.array([sketches(k) for k in kmers], pa.list_(pa.int64())),
            ],
            names=["doc_id", "_node", "_size", "_keys"],
        )


def _kmers_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    kmers = [shingles(t) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
    return [labelled(k) if len(k) else k for k in kmers]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every labelled k-mer with its text's number."""
    for batch in batches:
        kmers = _kmers_of(batch)
        number = np.repeat(batch.column("_id").to_numpy(), [len(k) for k in kmers])
        joined = np.concatenate(kmers).view(np.int64) if kmers else np.zeros(0, np.int64)
        for i in range(0, len(joined), LISTED):
            at = slice(i, i + LISTED)
            yield pa.RecordBatch.from_arrays([pa.array(joined[at]), pa.array(number[at])], names=["kmer", "_id"])


def _rarest(shared):
    """The rarest k-mers of each node that others may have, each with how many k-mers are as rare or more common, and all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            row, rest, kmer, lists, sampled = [], [], [], [], []
            for r, text in enumerate(batch.column("_text").cast(pa.binary()).to_pylist()):
                kmers = shingles(text)
                mine = labelled(kmers) if len(kmers) else kmers
                n = counts[mine % np.uint64(COUNTERS)]
                order = np.lexsort((mine, n))[: int((1 - SIMILAR) * len(mine)) + 2]
                places = np.flatnonzero(n[order] > 1)  # a count of one is of this text alone
                listed = mine[order[places]].view(np.int64)
                row += [r] * len(places)
                rest += (len(mine) - places).tolist()
                kmer.append(listed)
                lists += [listed] * len(places)
                sampled += [placed(kmers)] * len(places)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c).take(at) for c in ("_v", "_root", "_size")],
                    pa.array(rest, pa.int64()),
                    pa.array(np.concatenate(kmer) if kmer else np.zeros(0, np.int64)),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(sampled, pa.list_(pa.int32())),
                ],
                names=["_v", "_root", "_size", "_rest", "kmer", "_rarest", "_placed"],
            )

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a first node's own row, then those to compare with it."""
    first = kmers = tagged = None
    for batch in batches:
        rows = ([], [], [])
        leads, nodes = batch.column("_lead").to_pylist(), batch.column("_v").to_pylist()
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        for k, own in enumerate(batch.column("_own").to_pylist()):
            mine = shingles(texts[k])
            if own:
                first, kmers = leads[k], mine
                tagged = labelled(kmers) if len(kmers) else kmers
                continue
            assert leads[k] == first
            j = jaccard(tagged, labelled(mine) if len(mine) else mine)
            rows[0].append(k)
            rows[1].append(j)
            rows[2].append(j >= SIMILAR and aligned(kmers, mine) >= SIMILAR)
        at = pa.array(rows[0], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("_lead").take(at),
                batch.column("_v").take(at),
                pa.array(rows[1], pa.float64()),
                pa.array(rows[2], pa.bool_()),
            ],
            names=["_lead", "_v", "jaccard", "similar"],
        )


# A node: the least id among equal texts, and a hash of the text's digest to tell apart nodes of one id.
NODE = "struct<first:bigint,id:bigint>"


def _digest(column: str = "text") -> Column:
    return F.unhex(F.substring(F.sha2(F.encode(text_of(column), "UTF-8"), 256), 1, 32))


def components(links: DataFrame) -> DataFrame:
    """(_v, _root) for every end of the links (_lead, _v): its component's least node.

    Large-star and small-star in turns, until every node hangs on a root that hangs on none.
    """
    edges = saved(links.select(F.greatest("_lead", "_v").alias("_v"), F.least("_lead", "_v").alias("_m")), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("_m").alias("_v"), F.col("_v").alias("_m")))
        least = both.groupBy("_v").agg(F.min("_m").alias("_n")).select("_v", F.least("_v", "_n").alias("_least"))
        large = both.join(least, "_v").filter(F.col("_m") > F.col("_v")).select(
            F.col("_m").alias("_v"), F.col("_least").alias("_m")
        )
        edges = saved(large.distinct(), "edges")
        least = edges.groupBy("_v").agg(F.min("_m").alias("_least"))
        small = edges.join(least, "_v").filter(F.col("_m") > F.col("_least")).select(
            F.col("_m").alias("_v"), F.col("_least").alias("_m")
        )
        edges = saved(small.unionByName(least.select("_v", F.col("_least").alias("_m"))).distinct(), "edges")
    roots = edges.select("_m").distinct().select(F.col("_m").alias("_v"), F.col("_m").alias("_root"))
    return edges.select("_v", F.col("_m").alias("_root")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    ends = edges.select("_v", F.lit(1).alias("hangs")).unionByName(
        edges.select(F.col("_m").alias("_v"), F.lit(0).alias("hangs")).distinct()
    )
    seen = ends.groupBy("_v").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("n"))
    return seen.filter("hangs > 0 AND n > 1").isEmpty()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(_lead, _v, jaccard, similar) of the pairs (_lead, _v). A first node's comparisons are dealt over tasks."""
    groups = pairs.groupBy("_lead").agg(F.ceil(F.count("*") / COMPARED).cast("int").alias("_groups"))
    salts = F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_salt")
    own = groups.select("_lead", salts, F.lit(True).alias("_own"), F.col("_lead").alias("_v"))
    salt = F.pmod(F.xxhash64("_v", "_lead"), F.col("_groups")).cast("int").alias("_salt")
    others = pairs.join(groups, "_lead").select("_lead", salt, F.lit(False).alias("_own"), "_v")
    return (
        own.unionByName(others)
        .join(texts.select("_v", "_text"), "_v")
        .select("_lead", "_salt", "_own", "_v", "_text")
        .repartition("_lead", "_salt")
        .sortWithinPartitions("_lead", "_salt", F.desc("_own"))
        .mapInArrow(_compared, f"_lead {NODE}, _v {NODE}, jaccard double, similar boolean")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), _digest, representative.

    A class is a connected component of similar texts. Words are those of decontam: letters and digits, A-Z in lower case. Equal texts are
    always one class, null and empty texts one together; texts without words have no other near copies. Exactly the
    rows of the class's first node are representatives: one id, but as many rows as the table repeats. Null ids
    come first. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _digest().alias("_node"), text_of().alias("_text")
    )
    sketched = rows.mapInArrow(_sketched, "doc_id long, _node binary, _size long, _keys array<long>")
    nodes = saved(
        sketched.groupBy("_node")
        .agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("_least"), F.first("_size").alias("_size"), F.first("_keys").alias("_keys"))
        .select(
            F.struct(F.col("_least.doc_id").alias("first"), F.xxhash64("_node").alias("id")).alias("_v"),
            "_node",
            "_size",
            "_keys",
        ),
        "sketches",
    )
    classes = nodes.select("_v", "_node").join(_roots(rows, nodes), "_v", "left").select(
        "_node", F.coalesce("_root", "_v").alias("_root"), (F.col("_root").isNull() | (F.col("_root") == F.col("_v"))).alias("_first")
    )
    # Equal texts may be a third of all rows: the right side has each digest once, so skewed parts can be split.
    return rows.select("doc_id", "_node").join(classes, "_node").select(
        "doc_id",
        F.col("_root.first").alias("class_id"),
        F.col("_node").alias("_digest"),
        (F.col("_first") & F.col("doc_id").eqNullSafe(F.col("_root.first"))).alias("representative"),
    )


def _supported(texts: DataFrame) -> DataFrame:
    """(_id, _v, _size, _others): of each candidate's k-mers, how many another candidate has, too; those with too few are left out."""
    listed = texts.select(F.col("_v.id").alias("_id"), "_text").mapInArrow(_listed, "kmer long, _id long")
    # In a group of one, the maximum is of that one.
    alone = listed.groupBy("kmer").agg(F.count("*").alias("n"), F.max("_id").alias("_id")).filter("n = 1")
    own = alone.groupBy("_id").agg(F.count("*").alias("_own"))
    others = (F.col("_size") - F.coalesce("_own", F.lit(0))).alias("_others")
    wanted = texts.select(F.col("_v.id").alias("_id"), "_v", "_size").distinct()
    counted = wanted.join(own, "_id", "left").select("_id", "_v", "_size", others)
    return counted.filter(F.col("_others") >= SIMILAR * F.col("_size") - 1e-9)


def _may_be_similar() -> Column:
    """Enough k-mers that others have, for both texts' sizes; that bounds the ratio of the sizes, too."""
    shared = F.least("_others", "_lead_others", "_size", "_lead_size")
    return shared * (1 + SIMILAR) >= SIMILAR * (F.col("_size") + F.col("_lead_size")) - 1e-9


def _roots(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(_v, _root) of the nodes that are similar to others; _root is the class's least node."""
    # A number stands for the node while buckets form. Two nodes with one number would only be compared in vain.
    members = nodes.select(F.col("_v.id").alias("_id"), F.explode("_keys").alias("_key"))
    # A table of its own, so that the join below reads two plain shuffles and can split a hot bucket.
    shared = saved(members.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select("_key"), "shared")
    met = saved(members.join(shared, "_key"), "buckets")
    numbered = nodes.select("_v", F.col("_v.id").alias("_id"), "_size", "_node", F.col("_v.first").alias("doc_id"))
    named = numbered.join(met.select("_id").distinct(), "_id").drop("_id")
    texts = saved(matched(rows, named, ["_node", "doc_id"]).select("_v", "_size", "_text"), "candidates")
    supported = saved(_supported(texts), "supported")
    labels = supported.select("_v", F.col("_v").alias("_root"))
    active = _undecided(met.join(supported, "_id").select("_key", "_v", "_size", "_others", F.col("_v").alias("_root")))
    settled(rows.sparkSession)
    left = active
    for _ in range(ROUNDS):
        leads = _leads(left)
        apart = (F.col("_v") > F.col("_lead")) & (F.col("_root") != F.col("_lead_root"))
        pairs = saved(
            left.join(leads, "_key")
            .filter(apart & _may_be_similar())
            .select("_lead", "_v", "_lead_root", "_root")
            .distinct(),
            "pairs",
        )
        moved = _joined(pairs, texts)
        labels = saved(_relabelled(labels, moved), "labels")
        done = leads.select("_key", F.col("_lead").alias("_v"))
        # A table of its own: what follows reads it several times.
        left = _undecided(saved(_relabelled(left, moved).join(done, ["_key", "_v"], "left_anti"), "left"))
        if moved.isEmpty() or left.isEmpty():
            break
    pairs = saved(_rare_pairs(left.select("_v", "_root", "_size").distinct(), texts), "pairs")
    return _relabelled(labels, _joined(pairs, texts))


def _joined(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(_root, _to): the classes that similar pairs (_lead, _v) join, and the class that they become."""
    similar = _verified(pairs.select("_lead", "_v"), texts).filter("similar").select("_lead", "_v")
    new = pairs.join(saved(similar, "similar"), ["_lead", "_v"]).select(
        F.col("_lead_root").alias("_lead"), F.col("_root").alias("_v")
    )
    moved = components(new.distinct()).select(F.col("_v").alias("_root"), F.col("_root").alias("_to"))
    return saved(moved, "moved")


def _rare_pairs(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(_lead, _v, _lead_root, _root): nodes of different classes that share one of the rarest k-mers of both, in about the same places."""
    mine = saved(texts.select("_v", "_text").join(nodes, "_v"), "undecided")
    counter = F.expr(f"CAST(CAST(kmer AS BIGINT) & {COUNTERS - 1} AS INT)").alias("counter")
    listed = mine.select(F.col("_v.id").alias("_id"), "_text").mapInArrow(_listed, "kmer long, _id long")
    counted = listed.groupBy(counter).agg(F.count("*").alias("n")).toArrow()  # one row per counter at most
    counts = np.zeros(COUNTERS, np.int64)
    counts[counted.column("counter").to_numpy()] = counted.column("n").to_numpy()
    schema = f"_v {NODE}, _root {NODE}, _size long, _rest long, kmer long, _rarest array<long>, _placed array<int>"
    given = mine.select("_v", "_root", "_size", "_text")
    rare = saved(given.mapInArrow(_rarest(nodes.sparkSession.sparkContext.broadcast(counts)), schema), "rare")
    several = rare.groupBy("kmer").agg(F.min("_root").alias("_a"), F.max("_root").alias("_b")).filter("_a != _b")
    rare = saved(rare.join(several.select("kmer"), "kmer"), "rare")
    others = [F.col(c).alias(f"_lead{c}") for c in ("_root", "_size", "_rest", "_rarest", "_placed")]
    leads = rare.select("kmer", F.col("_v").alias("_lead"), *others)
    # A pair comes out once, by the rarest k-mer that it shares.
    rarest = F.col("kmer") == F.get(F.array_intersect("_rarest", "_lead_rarest"), 0)
    shared = F.least("_rest", "_lead_rest") * (1 + SIMILAR) >= SIMILAR * (F.col("_size") + F.col("_lead_size")) - 1e-9
    apart = (F.col("_v") > F.col("_lead")) & (F.col("_root") != F.col("_lead_root"))
    found = rare.join(leads, "kmer").filter(apart & shared & rarest & _agreed())
    return found.select("_lead", "_v", "_lead_root", "_root")


def _agreed() -> Column:
    """Enough of the sampled k-mers are the same and no farther apart than aligned ones can be."""
    need = SIMILAR * (F.col("_size") + F.col("_lead_size")) / (1 + SIMILAR) - 1e-9
    step, lead_step = (F.greatest(F.lit(1), F.shiftright(c, 15)) for c in ("_size", "_lead_size"))

    def agree(x: Column, y: Column) -> Column:
        a, b = x.bitwiseAND(0xFFFF), y.bitwiseAND(0xFFFF)
        ahead = a * step - b * lead_step
        near = ahead.between(need - F.col("_lead_size") - step, F.col("_size") - need + lead_step)
        return (F.shiftrightunsigned(x.bitwiseXOR(y), 16) == 0) & ((a == 0) | (b == 0) | near)

    return F.size(F.filter(F.zip_with("_placed", "_lead_placed", agree), lambda same: same)) >= AGREED


def _undecided(active: DataFrame) -> DataFrame:
    """The nodes that may be similar to one of another class in their bucket.

    A node has too few k-mers that others have if they don't suffice for the bucket's smallest text.
    """
    bounds = active.groupBy("_key").agg(
        F.min("_root").alias("_a"), F.max("_root").alias("_b"), F.min("_size").alias("_least")
    )
    enough = (1 + SIMILAR) * F.col("_others") >= SIMILAR * (F.col("_size") + F.col("_least")) - 1e-9
    able = active.join(bounds.filter("_a != _b"), "_key").filter(enough).select(*active.columns)
    classes = able.groupBy("_key").agg(F.min("_root").alias("_a"), F.max("_root").alias("_b"))
    return saved(able.join(classes.filter("_a != _b").select("_key"), "_key"), "buckets")


def _leads(active: DataFrame) -> DataFrame:
    """The first node of each bucket, with what is known of it."""
    least = active.groupBy("_key").agg(F.min(F.struct("_v", "_root", "_size", "_others")).alias("_least"))
    return least.select(
        "_key",
        F.col("_least._v").alias("_lead"),
        F.col("_least._root").alias("_lead_root"),
        F.col("_least._size").alias("_lead_size"),
        F.col("_least._others").alias("_lead_others"),
    )


def _relabelled(rows: DataFrame, moved: DataFrame) -> DataFrame:
    return rows.join(moved, "_root", "left").withColumn("_root", F.coalesce("_to", "_root")).select(*rows.columns)


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with the representative of each class alone, all columns; of rows that repeat id and text one stays."""
    keys = ("doc_id", "_text_hash")
    verdicts = saved(
        near_duplicates(docs).select("doc_id", F.xxhash64("_digest").alias("_text_hash"), "representative"), "classes"
    )
    # Small tables of their own: while they are small, the texts stay where they are.
    gone = saved(verdicts.filter("NOT representative").select(*keys).distinct(), "gone")
    repeated = verdicts.filter("representative").groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    repeated = saved(repeated.select(*keys), "repeated")
    rows = whole_rows(docs).select("_row", "doc_id", F.xxhash64(_digest("_text")).alias("_text_hash"))
    kept = matched(rows, gone, keys, "left_anti")
    if repeated.isEmpty():
        return kept.select("_row.*")
    several = matched(kept, repeated, keys, "left_semi").dropDuplicates(keys)
    return matched(kept, repeated, keys, "left_anti").unionByName(several).select("_row.*")
