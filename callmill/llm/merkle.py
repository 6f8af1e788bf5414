"""Merkle manifest of the documents: built levels as linked node rows, climbed by a recursive query.

Every document is a leaf, every language a tree whose nodes are the digests of up to FAN_OUT consecutive ones below, and
the trees' tops, the subroots, are the leaves of one tree more. The leaves are numbered from per-partition totals over a
range partitioning, so no task holds a language. Every level above is FAN_OUT times smaller and is written as rows that hold a
node's key, its parent's key and the digests of its siblings to the left and to the right.

A proof is then climbed by Spark's recursive query: it starts from every leaf, joins the node it has reached with that node's row,
appends the siblings, folds the (tampered) digest with them, and goes on from the parent. The leaves of one run share their way up, so
the row that climbs holds the leaves of a run, at most FAN_OUT.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callmill.llm.common import prepare, saved

FAN_OUT = 8
# How a missing field is written in a leaf, and by what a document is tampered with.
MISSING = "-"
TAMPERED_DIVISOR = 3

# Rows that one task writes at least: a file for each of many shuffle partitions costs far more than the few rows in it.
ROWS_A_TASK = 10_000

TOP = "top"
NODE = "node string, parent string, left string, right string, subroot string"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(MISSING))


def tampered(doc_id: Column) -> Column:
    """Whether 3 divides the checksum of the id's digits. A null id counts as the empty text."""
    digits = F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")
    return F.crc32(digits) % TAMPERED_DIVISOR == 0


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the language; null sorts first), doc_id, digest, and the digest `now` of the tampered document."""
    before = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.select(
        tree.alias("tree"),
        "doc_id",
        F.sha2(F.concat(*before, _field(F.col("text"))), 256).alias("digest"),
        F.when(tampered(F.col("doc_id")), F.sha2(F.concat(*before, _field(lowered)), 256)).alias("now"),
    ).withColumn("now", F.coalesce("now", "digest"))


def _filled(df: DataFrame, rows: int) -> DataFrame:
    """`df`, made of `rows` rows, in no more partitions than they are worth."""
    return df.coalesce(max(1, math.ceil(rows / ROWS_A_TASK)))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with idx, their place in their tree by `order`, and n, the size of the tree.

    One total per partition and tree gives every partition's offset; rows that are equal in all of `order` are parted
    by a row number, so that repeated rows spread as well.
    """
    return _placed(*_written(rows), order)


def _written(rows: DataFrame) -> tuple[DataFrame, int]:
    """`rows` with a number of their own, written, and how many they are."""
    own = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    return own, own.count()


def _placed(own: DataFrame, count: int, order: list[str]) -> DataFrame:
    by = [*order, "_row"]
    ranged = own.repartitionByRange("tree", *by).withColumn("part", F.spark_partition_id())
    ranged = saved(_filled(ranged, count), "merkle-ranges")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy("tree", "part")
        .agg(F.count("*").alias("rows"))
        .select(
            "tree",
            "part",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before"),
            F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
        )
    )
    inside = F.row_number().over(Window.partitionBy("part", "tree").orderBy(*by)) - 1
    placed = ranged.withColumn("_inside", inside).join(totals, ["tree", "part"])
    return placed.withColumn("idx", F.col("_before") + F.col("_inside")).drop("_row", "part", "_before", "_inside")


def runs(level: DataFrame, height: int, *kept: str) -> DataFrame:
    """Every FAN_OUT consecutive nodes of a tree as one row: members in order, and the key and digest of their parent."""
    member = F.struct("idx", "key", "digest", *kept)
    run = F.expr(f"idx DIV {FAN_OUT}")
    return (
        level.groupBy("tree", "n", run.alias("run"))
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
        .withColumn("parent", F.concat_ws("/", "tree", F.lit(height), F.col("run")))
        .withColumn("digest", F.sha2(F.array_join("members.digest", ""), 256))
    )


def _above(run: DataFrame) -> DataFrame:
    """The parents as the next level."""
    n = F.ceil(F.col("n") / FAN_OUT).cast("long")
    return run.where("n > 1").select("tree", n.alias("n"), F.col("run").alias("idx"), F.col("parent").alias("key"), "digest")


def _linked(run: DataFrame, subroots: bool) -> DataFrame:
    """NODE rows of the members of runs."""
    digests = F.transform("members", lambda m: m["digest"])

    def row(m: Column, i: Column) -> Column:
        return F.struct(
            m["key"].alias("node"),
            F.col("parent").alias("parent"),
            F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
            F.array_join(F.slice(digests, i + 2, F.lit(FAN_OUT)), "").alias("right"),
            (m["digest"] if subroots else F.lit(None).cast("string")).alias("subroot"),
        )

    return run.where("n > 1").select(F.inline(F.transform("members", row)))


def climbed_levels(level: DataFrame, height: int, top_tree: bool = False) -> tuple[list[DataFrame], DataFrame]:
    """NODE rows of `level` and all levels above it, and what remains of each tree (tree, key, digest).

    One run of the loop for each level: as many as a tree is high. Only the number of its nodes reaches the driver.
    """
    nodes, tops = [], []
    while True:
        tops.append(level.where("n = 1").select("tree", "key", "digest"))
        level = level.where("n > 1")
        count = level.count()
        if not count:
            return nodes, reduce(DataFrame.unionByName, tops)
        run = saved(_filled(runs(level, height + 1), count), "merkle-level")
        nodes.append(_linked(run, subroots=top_tree and height == 0))
        level, height = _above(run), height + 1


_CLIMB = """
WITH RECURSIVE climb (node, members, path, subroot) AS (
  SELECT node, members, CAST('' AS STRING), CAST(NULL AS STRING) FROM {starts}
  UNION ALL
  SELECT n.parent,
    transform(c.members, m -> named_struct(
      'doc_id', m.doc_id, 'digest', m.digest, 'folded', sha2(concat(n.left, m.folded, n.right), 256))),
    concat(c.path, n.left, n.right),
    coalesce(n.subroot, c.subroot)
  FROM climb c JOIN {nodes} n ON c.node = n.node
)
SELECT * FROM climb WHERE node = {root}
"""


def _starts(bottom: DataFrame) -> DataFrame:
    """The leaves of each run with the digests folded once; a lone leaf is a subroot and stays as it is."""
    digests = F.transform("members", lambda m: m["digest"])
    alone = F.col("n") == 1

    def leaf(m: Column, i: Column) -> Column:
        left = F.array_join(F.slice(digests, F.lit(1), i), "")
        right = F.array_join(F.slice(digests, i + 2, F.lit(FAN_OUT)), "")
        folded = F.when(alone, m["now"]).otherwise(F.sha2(F.concat(left, m["now"], right), 256))
        return F.struct(m["doc_id"].alias("doc_id"), m["digest"].alias("digest"), folded.alias("folded"))

    start = F.when(alone, F.get("members", F.lit(0))["key"]).otherwise(F.col("parent"))
    return bottom.select(start.alias("node"), F.transform("members", leaf).alias("members"))


def unlimited_recursion(spark: SparkSession) -> SparkSession:
    """Spark stops a recursive query at a million rows unless it is told otherwise."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return spark


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    leaf, subroot, root and proof are those of the untampered rows; folded_root is recomputed from the tampered leaf. A null
    field is `-` in its leaf, a null language is a tree of its own and comes first, and null ids come first in their
    tree. Rows with one id are ordered by their digests; repeated rows are leaves of their own. A null id's checksum is that of the
    empty text. A document that holds no A-Z is the same after tampering and verifies. Texts are hashed whole, whatever their
    length, and never move: only digests do. An empty table gives no rows; other columns are ignored.
    """
    spark = unlimited_recursion(prepare(docs.sparkSession))
    key = F.concat_ws("/", "tree", F.lit(0), F.col("idx"))
    own, count = _written(leaves(docs))
    placed = _placed(own, count, ["doc_id", "digest"]).withColumn("key", key)
    bottom = saved(_filled(runs(placed, 1, "doc_id", "now"), count), "merkle-leaves")
    lone = bottom.where("n = 1").select("tree", F.get("members", F.lit(0))["key"].alias("key"), "digest", F.get("members", F.lit(0))["digest"].alias("_leaf"))
    nodes, tops = climbed_levels(_above(bottom), 1)
    subroots = tops.unionByName(lone.select("tree", "key", F.col("_leaf").alias("digest")))
    ranked = numbered(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("lang"), "key", "digest"), ["lang"])
    upper, root = climbed_levels(ranked.drop("lang"), 0, top_tree=True)
    top = root.select("key", "digest").first()  # the one node that is left
    root_key, root_digest = (top.key, top.digest) if top else ("", "")
    linked = reduce(DataFrame.unionByName, [*nodes, *upper], spark.createDataFrame([], NODE))
    linked = saved(_filled(linked, count), "merkle-nodes")
    climbed = spark.sql(_CLIMB, starts=_starts(bottom), nodes=linked, root=root_key)
    climbed = saved(_filled(climbed, count), "merkle-climb")

    digests = F.transform("members", lambda m: m["digest"])

    def proved(m: Column, i: Column) -> Column:
        others = F.array_join(F.filter(digests, lambda _, k: k != i), "")
        return F.struct(
            m["doc_id"].alias("doc_id"),
            m["digest"].alias("leaf"),
            F.coalesce("subroot", F.lit(root_digest)).alias("subroot"),
            F.lit(root_digest).alias("root"),
            F.sha2(F.concat(others, F.col("path")), 256).alias("proof_sha256"),
            m["folded"].alias("folded_root"),
            (m["folded"] == F.lit(root_digest)).alias("verified"),
        )

    return climbed.select(F.inline(F.transform("members", proved)))
