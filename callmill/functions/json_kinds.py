"""What kind of JSON value a VARIANT holds, and whether a text is one document.

Casts out of VARIANT are lenient ("5" becomes 5), so rules about kinds must ask
for the kind first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The leading word of a value's schema; MISSING where there is no value.
MISSING = "MISSING"
NULL = "VOID"
OBJECT = "OBJECT"
ARRAY = "ARRAY"
STRING = "STRING"
BOOLEAN = "BOOLEAN"
INTEGER = "BIGINT"


def child(value: Column, path: str) -> Column:
    """Sub-value at a path: SQL NULL if absent, JSON null if given as null."""
    return F.try_variant_get(value, path, "variant")


def kind(value: Column) -> Column:
    """One of the names above, or another word for a number with a fraction."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0), F.lit(MISSING))


def is_object(value: Column) -> Column:
    """Like asking for the kind, but looks at the top level only; never NULL."""
    # No field is asked for: as a map of VARIANTs all that lies below would be encoded anew.
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def object_if_given(value: Column) -> Column:
    return value.isNull() | is_object(value)


def is_empty(value: Column) -> Column:
    """Whether a value is null, false, zero, or empty; absent counts as empty."""
    text = value.cast("string")
    return (
        F.when(kind(value).isin(MISSING, NULL), True)
        .when(kind(value) == STRING, text == "")
        .when(kind(value).isin(ARRAY, OBJECT, BOOLEAN), text.isin("[]", "{}", "false"))
        .otherwise(F.coalesce(text.try_cast("double") == 0, F.lit(False)))
    )


def elements(value: Column) -> Column:
    """The elements of an array value, NULL for any other kind."""
    return F.try_variant_get(value, "$", "array<variant>")


def ends_cleanly(text: Column) -> Column:
    """Whether nothing but blanks follows the first JSON value of a text.

    JSON readers stop after the first value. Put the text in an array with a mark
    behind it: the mark is the second element only if the text is one value. The
    mark is the text's own hash, so no text can bring it along.
    """
    mark = F.xxhash64(text).cast("string")
    seen = F.get_json_object(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")), "$[1]")
    return F.coalesce(seen == mark, F.lit(False))
