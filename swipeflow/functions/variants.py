"""Type labels and text of JSON values held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Lists inside each other that are reached by a constant path; Spark reads any other path anew for every row.
DEPTH = 12


def list_depth(text: Column) -> Column:
    """How many lists lie inside each other at the start of a value's JSON text."""
    return F.length(F.regexp_extract(text, r"^\[+", 0))


def innermost(value: Column, lists: Column) -> Column:
    """The first element, `lists` lists down."""
    out = F.when(lists == 0, value)
    for depth in range(1, DEPTH + 1):
        out = out.when(lists == depth, F.try_variant_get(value, F.lit("$" + "[0]" * depth), "variant"))
    return out.otherwise(F.try_variant_get(value, F.concat(F.lit("$"), F.repeat(F.lit("[0]"), lists)), "variant"))


def label_of(text: Column, lists: Column, inner: Column) -> Column:
    """The label of json_type_label() from a value's text, list_depth() and innermost()."""
    start = F.substring(text, lists + 1, F.lit(1))
    kind = F.schema_of_variant(inner)
    # an integer beyond 64 bits is held as a decimal
    large = kind.startswith("DECIMAL") & F.to_json(inner).rlike(r"^-?[0-9]{19,}$") & F.to_json(inner).try_cast("bigint").isNull()
    core = (
        F.when(start == "]", F.lit(""))
        .when(start == "n", F.lit("null"))
        .when(start.isin("t", "f"), F.lit("bool"))
        .when(start == '"', F.lit("str"))
        .when(start == "{", F.concat(
            F.lit("dict{"), F.array_join(F.map_keys(F.try_variant_get(inner, F.lit("$"), "map<string,variant>")), ", "), F.lit("}")))
        .when((kind == "BIGINT") | large, F.lit("int"))
        .otherwise(F.lit("float"))
    )
    nested = F.concat(F.repeat(F.lit("list["), lists), core, F.repeat(F.lit("]"), lists))
    return F.when(text.isNull(), F.lit("null")).otherwise(nested)


def json_type_label(value: Column) -> Column:
    """null / bool / int / float / str / list[..] / dict{keys}; a list is named by its first element, at any depth.

    The leading brackets of the JSON text say how many lists lie inside each other; one look-up at that
    depth gives what the innermost holds.
    """
    text = F.to_json(value)
    lists = list_depth(text)
    return label_of(text, lists, innermost(value, lists))


def cut_text(text: Column, cut: int = 120) -> Column:
    return F.when(F.length(text) > cut, F.concat(F.substring(text, 1, cut), F.lit("…"))).otherwise(text)
