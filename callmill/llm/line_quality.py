"""Quality rules: word statistics of each text and line frequency across the documents of a host.

A line that many documents of a host carry is boilerplate. Lines are normalised and hashed, the distinct
documents that have each line are counted per host, lines above the limits are removed, and documents
that are little else are rejected. Built-in functions only.

Equal texts of one host are one document here, however often they are stored: exact copies are the
business of the dedup stages, and would otherwise make every line of a copied text look like boilerplate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.llm.common import matched, saved, text_of, whole_rows, with_text

SPACES = r"[ \t\n\x0B\f\r]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """A line goes if more than `max_percent` of its host's documents have it, `min_docs` at least, or more than
    `max_docs` of them whatever their share; a document goes if less than `min_left_percent` of its word characters are
    then left. The share holds for hosts of any size: `min_docs` only keeps chance out of hosts of a few documents,
    and `max_docs` keeps a hot host from hiding a line in its size."""

    min_docs: int = 5
    max_percent: int = 5
    max_docs: int = 10_000
    min_left_percent: int = 50
    min_words: int = 20
    max_repeat_percent: int = 30


def _words() -> Column:
    return F.filter(F.split(F.col("_text"), SPACES), lambda w: w != "")


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^ \t\n\x0B\f\r]")


def _line_hash(line: Column) -> Column:
    """Case, digits and the amount of white space don't tell lines apart."""
    plain = F.trim(F.regexp_replace(F.lower(line), SPACES, " "))
    return F.xxhash64(F.regexp_replace(plain, "[0-9]", "0"))


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words, the words inside any 8-word window that occurs twice.

    Only texts with equal windows sort them: the places whose neighbour in hash order is equal, in text order,
    each count the words up to the next one, eight at most.
    """
    tagged = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")

    def twice(e: Column, i: Column) -> Column:
        before, after = F.get("_sorted", i - 1)["h"], F.get("_sorted", i + 1)["h"]
        return F.coalesce(before == e["h"], F.lit(False)) | F.coalesce(after == e["h"], F.lit(False))

    steps = F.transform(
        "_places", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - p, F.lit(WINDOW)))
    )
    return (
        df.withColumn("_sorted", F.when(repeated, F.array_sort(tagged)))
        .withColumn("_places", F.array_sort(F.transform(F.filter("_sorted", twice), lambda e: e["i"])))
        .withColumn(
            "n_repeat_words",
            F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")),
        )
    )


def statistics(docs: DataFrame, limits: Limits) -> DataFrame:
    """The per-text columns, the text's hash, and its normalised lines with their word characters."""
    windows = F.when(
        F.size("_hashes") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    worded = F.filter(F.split(F.col("_text"), "\n"), _has_word)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("_host"), text_of().alias("_text"))
    base = (
        texts.select("*", _words().alias("_words"), worded.alias("_lines"))
        .select(
            "doc_id",
            "_host",
            F.xxhash64("_text").alias("_text_hash"),
            F.size("_words").cast("long").alias("n_words"),
            F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
            F.transform(
                "_lines",
                lambda x: F.struct(
                    _line_hash(x).alias("line"),
                    F.length(F.regexp_replace(x, SPACES, "")).cast("long").alias("chars"),
                ),
            ).alias("_lines"),
        )
        .withColumn("_windows", windows)
    )
    return _with_repeat_words(base).select(
        "doc_id", "_host", "_text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (
            (F.col("n_words") < limits.min_words)
            | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words"))
        ).alias("base_failed"),
        "_lines",
    )


def frequent_lines(measured: DataFrame, limits: Limits) -> DataFrame:
    """(_host, line, n_docs) of lines above the limits."""
    distinct = measured.groupBy("_host", "_text_hash").agg(
        F.first(F.array_distinct(F.transform("_lines", lambda x: x["line"]))).alias("_distinct")
    )
    per_line = (
        distinct.select("_host", F.explode("_distinct").alias("line"))
        .groupBy("_host", "line")
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= min(limits.min_docs, limits.max_docs + 1))
    )
    hosts = distinct.groupBy("_host").agg(F.count("*").alias("host_docs"))
    return (
        matched(per_line, hosts, ["_host"])
        .filter(
            (F.col("n_docs") >= limits.min_docs) & (100 * F.col("n_docs") > limits.max_percent * F.col("host_docs"))
            | (F.col("n_docs") > limits.max_docs)
        )
        .select("_host", "line", "n_docs")
    )


def line_verdicts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Statistics and verdict of every document, with the hashes of its removed lines in `removed`.

    Null texts have no words and fail the base rules. A null host is a host of its own. Rows with the same
    id, host and text get the same verdict, one row each. A line without a word is never counted.
    An empty table gives no rows; other columns are ignored.
    """
    measured = saved(statistics(docs, limits), "line-statistics")
    frequent = frequent_lines(measured, limits)
    keys = ("doc_id", "_host", "_text_hash")
    # Only lines that are frequent come out of this join, so a document's list is short.
    mine = measured.dropDuplicates(keys).select(*keys, F.explode("_lines").alias("_line")).select(
        *keys, F.col("_line.line").alias("line"), F.col("_line.chars").alias("chars")
    )
    cut = (
        matched(mine, frequent, ["_host", "line"])
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_removed_lines"),
            F.sum("chars").alias("removed_chars"),
            F.collect_set("line").alias("removed"),
        )
    )
    depleted = 100 * (F.col("word_chars") - F.col("removed_chars")) < limits.min_left_percent * F.col("word_chars")
    return (
        matched(measured, cut, keys, "left")
        .select(
            *keys,
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            F.coalesce("n_removed_lines", F.lit(0).cast("long")).alias("n_removed_lines"),
            F.coalesce("removed_chars", F.lit(0).cast("long")).alias("removed_chars"),
            F.coalesce("removed", F.array().cast("array<bigint>")).alias("removed"),
        )
        .withColumn("depleted", depleted)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    )


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that are kept, all columns, without their frequent lines; n_chars follows the text.

    A text without frequent lines is returned unchanged. Null and empty texts are rejected: they have no words. Repeated
    rows stay or go together, and an empty table stays empty. Texts are looked at whole, whatever their length.
    """
    verdicts = line_verdicts(docs, limits).filter("kept").dropDuplicates(["doc_id", "_host", "_text_hash"])
    rows = whole_rows(docs).select(
        "_row", "doc_id", F.col("_row.source").cast("string").alias("_host"), F.xxhash64("_text").alias("_text_hash")
    )
    joined = matched(rows, verdicts, ["doc_id", "_host", "_text_hash"]).select("_row", "removed")
    left = F.array_join(
        F.filter(
            F.split(F.col("_row.text"), "\n"),
            lambda x: ~(_has_word(x) & F.array_contains(F.col("removed"), _line_hash(x))),
        ),
        "\n",
    )
    return with_text(joined, docs.columns, F.when(F.size("removed") > 0, left).otherwise(F.col("_row.text")))
