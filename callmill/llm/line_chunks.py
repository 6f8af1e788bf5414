"""Removal of multi-line chunks and of passages that occur elsewhere in the corpus.

Lines are hashed, a rolling hash over each two neighbouring line hashes marks every line, and a chunk ends where that mark
is a local minimum. Boundaries depend on the lines around them alone, so a passage is cut the same way wherever it
stands, but for its margins. Local minima are at least two lines apart: a chunk has two lines or more, three on average.

A passage is a run of lines of over PASSAGE_WORDS words. It need not hold a whole chunk, so the shortest passages that
start or end at each line are looked up besides. Their union is the text itself: every line of a passage, short or
long, one line or many, lies in a shortest passage inside it. So a repeated passage goes whole, whatever surrounds it.

Chunks and passages whose hash occurs once never move. Of the others the bytes are compared line by line: every line of
theirs is grouped by its hash and its bytes, and as long as no two lines share a hash, chunks and passages are equal if the lists of their
lines' hashes are. Should two lines share one, the parts themselves are compared. All but the first occurrence go. A passage that
overlaps its first occurrence stays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import prepare, matched, saved, text_of, whole_rows, with_text

KEY = ("doc_id", "_text_hash")
PASSAGE_WORDS = 50


def _starts() -> Column:
    """First lines of chunks, from 0. Line i ends a chunk if its mark is below the one before and not above the
    one after; the first line ends none, nor do the last two."""
    n = F.size("_hashes")

    def mark(i: Column) -> Column:
        return F.xxhash64(F.get("_hashes", i - 1), F.get("_hashes", i))

    def ends(i: Column) -> Column:
        return (mark(i) < mark(i - 1)) & (mark(i) <= mark(i + 1))

    inner = F.when(
        n >= 4, F.transform(F.filter(F.sequence(F.lit(1), n - 3), ends), lambda i: (i + 1).cast("int"))
    ).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(0)), inner)


def _line_hash(line: Column) -> Column:
    return F.xxhash64(line)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("_text_hash"), text_of().alias("_text")
    )


def spans_of(words: np.ndarray) -> np.ndarray:
    """The shortest passages that start or end at each line, by the lines' word counts: from * 2**32 + to, sorted."""
    before = np.concatenate(([0], np.cumsum(words, dtype="int64")))
    # Line ends by which a passage is over the limit, and the last starts from which it is.
    ends = np.searchsorted(before, before[:-1] + PASSAGE_WORDS, "right")
    starts = np.searchsorted(before, before[1:] - PASSAGE_WORDS, "left") - 1
    at = np.arange(len(words))
    worded = np.asarray(words) > 0
    forward, backward = worded & (ends <= len(words)), worded & (starts >= 0)
    return np.unique(np.concatenate(((at[forward] << 32) + ends[forward], (starts[backward] << 32) + at[backward] + 1)))


def _spans() -> Callable:
    @F.arrow_udf("array<bigint>")
    def spans(counts: pa.Array) -> pa.Array:
        flat, cuts = counts.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *counts.value_lengths().to_pylist()])
        found = [spans_of(flat[a:b]) for a, b in zip(cuts, cuts[1:])]
        offsets = np.cumsum([0, *map(len, found)]).astype("int32")
        return pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, "int64"), *found]))

    return spans


def chunked(rows: DataFrame) -> DataFrame:
    """`rows` with _lines, _chunks and _passages (k, from, to, h). Chunks of one line or without a word have no
    hash; passages have no k."""
    split = rows.withColumn("_lines", F.split("_text", "\n")).withColumn(
        "_hashes", F.transform("_lines", lambda x: _line_hash(x))
    )
    words = F.transform("_lines", lambda x: F.regexp_count(x, F.lit(r"\S+")))
    started = split.withColumn("_starts", _starts())

    def chunk(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_starts", k + 1), F.size("_lines"))
        part = F.slice("_hashes", start + 1, end - start)
        worded = F.exists(F.slice("_lines", start + 1, end - start), lambda x: x.rlike(r"\S"))
        return F.struct(
            k.cast("int").alias("k"),
            start.alias("from"),
            end.alias("to"),
            F.when((end - start >= 2) & worded, F.xxhash64(part)).alias("h"),
        )

    def passage(span: Column) -> Column:
        start, end = F.shiftright(span, 32).cast("int"), span.bitwiseAND(0xFFFFFFFF).cast("int")
        return F.struct(
            F.lit(None).cast("int").alias("k"),
            start.alias("from"),
            end.alias("to"),
            F.xxhash64(F.lit("passage"), F.slice("_hashes", start + 1, end - start)).alias("h"),
        )

    return (
        started.withColumn("_chunks", F.transform("_starts", chunk))
        .withColumn("_passages", F.transform(_spans()(words), passage))
        .drop("_hashes", "_starts")
    )


def _part(values: str, part: str) -> Column:
    return F.slice(values, F.col(f"{part}.from") + 1, F.col(f"{part}.to") - F.col(f"{part}.from"))


def _lines_clash(texts: DataFrame) -> bool:
    """Whether two different lines of repeated parts share a hash."""
    inside = F.array_distinct(F.flatten(F.transform("_maybe", lambda c: F.slice("_lines", c["from"] + 1, c["to"] - c["from"]))))
    lines = texts.select(F.explode(inside).alias("line")).distinct()
    return not lines.groupBy(_line_hash(F.col("line"))).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def _left(gone: Column) -> Column:
    """The lines that are not among the numbers `gone`."""
    stays = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), gone)
    return F.array_join(F.transform(stays, lambda i: F.get("_lines", i)), "\n")


def removals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Statistics of every document, and the documents that lose lines with their counts and what is left.

    The first occurrence, by doc_id, text hash and place, is kept; rows that repeat id and text are one
    document. Null ids come first. Null texts count as empty; one line alone is never a chunk, and a passage
    only if it has over PASSAGE_WORDS words. Texts are split whole, whatever their length.
    """
    prepare(docs.sparkSession)
    stats = saved(
        chunked(keyed(docs)).select(
            *KEY,
            F.size("_lines").cast("long").alias("n_lines"),
            F.size("_chunks").cast("long").alias("n_chunks"),
            F.md5(F.encode("_text", "UTF-8")).alias("_md5"),
            F.concat(F.filter("_chunks", lambda c: c["h"].isNotNull()), "_passages").alias("_parts"),
        ),
        "chunks",
    )
    narrow = stats.dropDuplicates(KEY).select(*KEY, F.explode("_parts").alias("c")).select(
        *KEY, F.col("c.h").alias("h"), F.col("c.k").alias("k"), F.col("c.from").alias("from"), F.col("c.to").alias("to")
    )
    # Tables of their own, here and below, so that the joins read two plain shuffles and can split a hot chunk.
    repeated = saved(narrow.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h"), "repeated")
    # A document's list is as long as the document.
    candidates = (
        narrow.join(repeated, "h").groupBy(*KEY).agg(F.collect_list(F.struct("k", "from", "to", "h")).alias("_maybe"))
    )
    rows = keyed(docs)
    texts = saved(
        matched(rows, candidates, KEY).select(*KEY, "_text", "_maybe"),
        "repeating",
    ).withColumn("_lines", F.split("_text", "\n"))
    same_lines = F.transform(_part("_lines", "c"), lambda x: _line_hash(x))
    same_bytes = _part("_lines", "c")
    chunks = texts.select(*KEY, "_lines", F.explode("_maybe").alias("c")).select(
        *KEY, F.col("c.k").alias("k"), F.col("c.from").alias("from"), F.col("c.to").alias("to"), F.col("c.h").alias("h"),
        (same_bytes if _lines_clash(texts) else same_lines).alias("bytes"),
    )
    place = F.struct(*[F.col(c) for c in (*KEY, "from", "to")])
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"first.{c}"))
    firsts = saved(chunks.groupBy("h", "bytes").agg(F.min(place).alias("first")), "firsts")
    # The join compares every occurrence with the first one.
    gone = (
        chunks.join(firsts, ["h", "bytes"])
        .filter(~(same & (F.col("first.to") > F.col("from"))))
        .groupBy(*KEY)
        .agg(
            F.count_distinct("k").alias("n_removed_chunks"),
            F.collect_set(F.struct("from", "to")).alias("_removed"),
        )
        .select(
            *KEY,
            "n_removed_chunks",
            F.array_distinct(
                F.flatten(F.transform("_removed", lambda r: F.sequence(r["from"], r["to"] - 1)))
            ).alias("_gone"),
        )
    )
    changed = matched(texts, gone, KEY).select(
        *KEY, "n_removed_chunks", F.size("_gone").cast("long").alias("n_removed_lines"), _left(F.col("_gone")).alias("_left")
    )
    return stats, saved(changed.dropDuplicates(KEY), "changed")


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, kept_md5.

    n_removed_lines counts the lines of repeated chunks and passages. kept_md5 is of the lines that are left, joined by line ends. Repeated rows each keep their row, an empty
    table gives none, other columns are ignored.
    """
    stats, changed = removals(docs)
    counts = changed.select(
        *KEY,
        "n_removed_chunks",
        "n_removed_lines",
        F.md5(F.encode("_left", "UTF-8")).alias("_new_md5"),
    )
    zero = F.lit(0).cast("long")
    return matched(stats, counts, KEY, "left").select(
        "doc_id",
        "n_lines",
        "n_chunks",
        F.coalesce("n_removed_chunks", zero).alias("n_removed_chunks"),
        F.coalesce("n_removed_lines", zero).alias("n_removed_lines"),
        F.coalesce("_new_md5", "_md5").alias("kept_md5"),
    )


def drop_repeated_chunks(docs: DataFrame) -> DataFrame:
    """`docs` without repeated chunks and passages, all columns; n_chars follows. Documents with no word left go, unless they
    had none before: null and empty texts stay as they are. Repeated rows stay or change together, an empty table stays empty."""
    _, changed = removals(docs)
    left = changed.select(*KEY, F.col("_left"))
    rows = whole_rows(docs).select("_row", "doc_id", F.xxhash64("_text").alias("_text_hash"))
    joined = matched(rows, left, KEY, "left").select("_row", "_left")
    joined = joined.filter(F.col("_left").isNull() | F.col("_left").rlike(r"\S"))
    return with_text(joined, docs.columns, F.coalesce(F.col("_left"), F.col("_row.text")))
