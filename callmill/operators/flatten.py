"""Flatten nested struct columns, or documents of undeclared keys, to leaves named by their path."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callmill.functions import json_kinds as K
from callmill.session import scratch


def _leaves(fields: T.StructType, prefix: str, column_of, sep: str) -> dict[str, Column]:
    leaves: dict[str, Column] = {}
    for field in fields:
        name = f"{prefix}{sep}{field.name}" if prefix else field.name
        column = column_of(field.name)
        if isinstance(field.dataType, T.StructType):
            leaves.update(_leaves(field.dataType, name, column.getField, sep))
        else:
            leaves[name] = column
    return leaves


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """One column per leaf, path joined by ``sep``; arrays and maps stay whole.

    A struct without fields vanishes. Two leaves with one name keep the place of the
    first and the value of the last. One projection: scans still read only the
    leaves that are used.
    """
    leaves = _leaves(df.schema, "", lambda name: F.col(f"`{name.replace('`', '``')}`"), sep)
    return df.select(*[column.alias(name) for name, column in leaves.items()])


def flatten_documents(documents: DataFrame, text: str = "body", sep: str = "_") -> DataFrame:
    """Every leaf of JSON documents whose keys nobody declared: the columns of ``documents`` but ``text``, ``leaf`` (its path
    joined by ``sep``), ``value`` (its JSON) and ``row``, one number for each document.

    Objects are opened level by level until none is left. Lists
    stay whole, an object without keys vanishes, and a text that is no object has no leaf. Of leaves with
    one name the last of the document counts, of repeated keys of one object the last value, at the place of the first.

    A document's objects are found within its row, however deep they lie: nothing is shuffled, and all that is written is the
    documents, once, so that their numbers stay.
    """
    spark = documents.sparkSession
    kept = [name for name in documents.columns if name != text]
    place = scratch(spark, "flatten")
    documents.withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{place}/documents")
    own = spark.read.parquet(f"{place}/documents")
    # One row in, one row out: as a generator the search is not put in place of each use of its result.
    searched = own.select("row", *kept, text, F.explode(F.array(_objects(F.col(text), sep))).alias("_found"))
    given = searched.select(
        *("row", *kept, "_found.objects"),
        F.when(F.col("_found.unclear"), F.map_from_entries(_ordered_leaves(F.col(text), sep))).alias("_leaves"),
    )
    # A document whose leaves have been told apart is one object of leaves; values are opened no further.
    whole = F.array(F.struct(F.lit("").alias("leaf"), F.lit(None).cast("variant").alias("value"), F.lit(False).alias("nested")))
    objects = F.when(F.col("_leaves").isNull(), F.col("objects")).otherwise(whole)
    each = given.select("row", *kept, "_leaves", F.inline(objects).alias("_parent", "_object", "_nested"))
    parts = F.coalesce("_leaves", _parts(F.col("_object")))
    entries = each.select(
        *("row", *kept, "_parent", "_nested"), F.col("_leaves").isNull().alias("_open"), F.explode(parts).alias("_key", "_value")
    )
    leaves = entries.where(~(F.col("_open") & K.is_object(F.col("_value"))))
    value = F.to_json("_value")
    return leaves.select(
        *("row", *kept),
        _name(F.col("_parent"), F.col("_key"), sep).alias("leaf"),
        F.when(F.col("_nested"), _reread(value)).otherwise(value).alias("value"),
    )


# An object with more objects than that is not searched for like names of its keys: its leaves are told apart by their order.
FEW_OBJECTS = 100


def _parts(value: Column) -> Column:
    """The entries of an object, NULL for any other kind."""
    return F.try_variant_get(value, "$", "map<string, variant>")


def _name(parent: Column, key: Column, sep: str) -> Column:
    return F.when(parent == "", key).otherwise(F.concat(parent, F.lit(sep), key))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _turns(text: Column) -> Column:
    """As many elements as a document has levels at least: no level is without a brace of its own."""
    return F.sequence(F.lit(0), F.octet_length(text) - F.octet_length(F.replace(text, F.lit("{"))))


def _reread(value: Column) -> Column:
    """The JSON of a value of an object whose text was made anew on the way to it: numbers with a fraction or an exponent
    have become doubles."""
    text = F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "map<string, string>")["v"]
    fraction = ~value.startswith('"') & value.rlike("[0-9][.eE]")
    return F.when(fraction, F.to_json(F.try_parse_json(text))).otherwise(value)


def _objects(text: Column, sep: str) -> Column:
    """(objects, unclear): every object of a document with its name and whether it lies in another; and whether two leaves may
    have one name, so that the order of keys, which VARIANT does not keep, decides between them.

    Two paths of one name part at two keys of one object: one of them holds an object, and the other goes on with the
    separator. (A first key without a sign is left out of names: the rule does not hold there.)
    """

    def inner(parent: Column) -> Column:
        def found(entries: Column) -> Column:
            keys = F.concat(F.lit("\0"), F.array_join(F.transform(entries, lambda e: e["key"]), "\0"))
            objects = F.filter(entries, lambda e: K.is_object(e["value"]))
            return _bound(F.struct(keys.alias("keys"), objects.alias("objects")), named)

        def named(of: Column) -> Column:
            few = F.size(of["objects"]) <= FEW_OBJECTS

            def one(e: Column) -> Column:
                alike = F.contains(of["keys"], F.concat(F.lit("\0"), e["key"], F.lit(sep)))
                return _object(_name(parent["leaf"], e["key"], sep), e["value"], True, ~few | (e["key"] == "") | alike)

            return F.transform(of["objects"], one)

        return _bound(F.map_entries(_parts(parent["value"])), found)

    def turn(state: Column, _: Column) -> Column:
        n = F.size(state["objects"])
        opened = F.flatten(F.transform(F.slice(state["objects"], state["opened"] + 1, n - state["opened"]), inner))
        further = F.struct(F.concat(state["objects"], opened).alias("objects"), n.alias("opened"))
        return F.when(state["opened"] == n, state).otherwise(further)

    root = F.filter(F.array(_object(F.lit(""), F.try_parse_json(text), False, F.lit(False))), lambda o: K.is_object(o["value"]))
    begun = F.struct(root.alias("objects"), F.lit(0).alias("opened"))

    def end(state: Column) -> Column:
        objects = F.transform(state["objects"], lambda o: F.struct(o["leaf"].alias("leaf"), o["value"].alias("value"), o["nested"].alias("nested")))
        return F.struct(objects.alias("objects"), F.exists(state["objects"], lambda o: o["unclear"]).alias("unclear"))

    return F.aggregate(_turns(text), begun, turn, end)


def _object(leaf: Column, value: Column, nested: bool, unclear: Column) -> Column:
    return F.struct(leaf.alias("leaf"), value.alias("value"), F.lit(nested).alias("nested"), unclear.alias("unclear"))


def _ordered_leaves(text: Column, sep: str) -> Column:
    """(leaf, value) of a document in which several leaves may have one name: the last one of each, by the order of its text."""

    def level(objects: Column) -> Column:
        return F.flatten(F.transform(objects, lambda parent: _entries(parent, sep)))

    def turn(state: Column, _: Column) -> Column:
        def parted(entries: Column) -> Column:
            leaves = F.concat(state["leaves"], F.filter(entries, lambda e: e["raw"].isNull()))
            return F.struct(F.filter(entries, lambda e: e["raw"].isNotNull()).alias("open"), leaves.alias("leaves"))

        return F.when(F.size(state["open"]) == 0, state).otherwise(_bound(level(state["open"]), parted))

    none = F.lit(None).cast("variant")
    root = F.array(F.struct(F.lit("").alias("leaf"), F.array().cast("array<int>").alias("at"), none.alias("value"), text.alias("raw")))
    begun = F.struct(root.alias("open"), F.filter(root, lambda _: F.lit(False)).alias("leaves"))

    def end(state: Column) -> Column:
        keyed = F.transform(state["leaves"], lambda e, n: F.struct(e["leaf"].alias("key"), e["at"].alias("at"), n.alias("n")))
        last = _bound(F.array_sort(keyed), lambda found: _runs(found)["last"])
        return F.transform(last, lambda e: F.struct(e["key"].alias("leaf"), state["leaves"][e["n"]]["value"].alias("value")))

    return F.aggregate(_turns(text), begun, turn, end)


def _entries(parent: Column, sep: str) -> Column:
    """(leaf, at, value, raw) of every key of an object (leaf, at, raw): its name, its place in the text level by level, and its text if it
    is an object itself."""
    # Values of a repeated key from VARIANT, which keeps the last; places, and texts of objects, from the text itself.
    parsed = F.map_entries(_parts(F.try_parse_json(parent["raw"])))
    texts = F.map_entries(F.from_json(parent["raw"], "map<string, string>"))
    placed = F.transform(texts, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"), e["value"].alias("text")))
    by_key = F.struct(F.array_sort(parsed, _by_key).alias("parsed"), F.array_sort(placed, _by_key_and_place).alias("placed"))

    def named(runs: Column) -> Callable[[Column, Column], Column]:
        return lambda e, n: F.struct(
            _name(parent["leaf"], e["key"], sep).alias("leaf"),
            F.concat(parent["at"], F.array(runs["first"][n]["i"])).alias("at"),
            e["value"].alias("value"),
            F.when(K.is_object(e["value"]), runs["last"][n]["text"]).alias("raw"),
        )

    return _bound(by_key, lambda found: _bound(_runs(found["placed"]), lambda runs: F.transform(found["parsed"], named(runs))))


def _opened(objects: DataFrame, sep: str) -> DataFrame:
    """One level down, as rows: (row, leaf, at, value, raw) of every key; raw is the text of what is an object itself, which has no
    value."""
    each = objects.select("row", F.inline(_entries(F.struct("leaf", "at", "raw"), sep)))
    return each.select("row", "leaf", "at", F.when(F.col("raw").isNull(), F.to_json("value")).alias("value"), "raw")


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)


def _by_key_and_place(a: Column, b: Column) -> Column:
    return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(a["i"] - b["i"])


def _runs(entries: Column) -> Column:
    """(first, last): the first and the last of each key, of entries sorted by key."""

    def edge(step: int) -> Column:
        return F.filter(entries, lambda e, n: F.coalesce(F.get(entries, n + step)["key"] != e["key"], F.lit(True)))

    return F.struct(edge(-1).alias("first"), edge(1).alias("last"))


def leaf_names(leaves: DataFrame) -> DataFrame:
    """Each leaf name and the number of documents that have it."""
    return leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("documents"))
