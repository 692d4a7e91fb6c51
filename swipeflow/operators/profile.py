"""Field profile and schema of JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.functions import variants


def _fields(records: DataFrame, col: str, pos: str) -> DataFrame:
    """One row per record and top-level key."""
    rows = records.select(F.col(pos).alias("pos"), F.col(col).alias("record"))
    return records.sparkSession.sql(
        "SELECT r.pos, f.key AS field, f.value AS value FROM {rows} r, LATERAL variant_explode(r.record) f "
        "WHERE f.key IS NOT NULL",
        rows=rows,
    )


def json_field_profile(records: DataFrame, col: str = "record", pos: str = "pos", examples: int = 3,
                       cut: int = 120) -> DataFrame:
    """Per top-level key: type of the first filled value, share filled, first distinct examples.

    ``col`` is a VARIANT column, ``pos`` a unique record order. Values are
    reduced to their shown text plus a digest of the rest before grouping, which
    bounds the width of what is shuffled; picking the first few per key uses
    Spark's per-partition rank limit, so no key gathers all its values.
    """
    text = F.col("text")
    # One projection per step: each is used several times by the next, so Spark computes it once a row.
    typed = _fields(records, col, pos).select("field", "pos", "value", F.to_json("value").alias("text"))
    typed = typed.withColumn("lists", variants.list_depth(text))
    typed = typed.select("field", "pos", "text", "lists", variants.innermost(F.col("value"), F.col("lists")).alias("inner"))
    filled = typed.select(
        "field", "pos",
        # the text of a JSON null; a string's text begins with a quote
        F.when(text != "null", F.lit(1)).alias("filled"),
        variants.label_of(text, F.col("lists"), F.col("inner")).alias("label"),
        variants.cut_text(text, cut).alias("shown"),
        F.when(F.length(text) > cut, F.sha2(text, 256)).alias("digest"),
    )
    # Totals and examples both read both columns, so Spark computes and shuffles this once.
    distinct = filled.groupBy("field", "shown", "digest", "label").agg(
        F.count("filled").alias("n"), F.min("pos").alias("pos")
    )
    totals = distinct.groupBy("field").agg(
        F.sum("n").alias("n_filled"), F.min(F.when(F.col("n") > 0, F.col("pos"))).alias("first_pos")
    )
    by_pos = Window.partitionBy("field").orderBy("pos")
    ranked = distinct.filter(F.col("n") > 0).withColumn("rn", F.row_number().over(by_pos)).filter(
        F.col("rn") <= examples)
    shown = ranked.groupBy("field").agg(
        F.min("pos").alias("first_pos"),
        F.max(F.when(F.col("rn") == 1, F.col("label"))).alias("type"),
        *[F.max(F.when(F.col("rn") == i, F.col("shown"))).alias(f"example_{i}") for i in range(1, examples + 1)],
    )
    total = records.select(F.count(F.lit(1))).scalar()
    nested = F.coalesce(F.col("type"), F.lit("")).rlike("^(list|dict)")
    return (
        totals.join(shown, ["field", "first_pos"], "left")
        .select(
            "field",
            F.coalesce("type", F.lit("null")).alias("type"),
            F.concat(F.bround(F.col("n_filled") * 100 / total, 0).cast("int").cast("string"), F.lit("%"))
            .alias("fill_pct"),
            *[F.coalesce(f"example_{i}", F.lit("—")).alias(f"example_{i}") for i in range(1, examples + 1)],
        )
        .orderBy(nested.cast("int"), "field")
    )


def _named_types(schema: Column) -> Column:
    for sql_name, name in (
        (r"DECIMAL\(\d+,\s*\d+\)", "float"), ("DOUBLE", "float"), ("BIGINT", "int"), ("STRING", "str"),
        ("BOOLEAN", "bool"), ("VOID", "null"), ("ARRAY<", "list<"), ("OBJECT<", "dict<"),
    ):
        schema = F.regexp_replace(schema, rf"(?<![`\w]){sql_name}", name)
    return schema


def json_nested(records: DataFrame, col: str = "record", pos: str = "pos") -> DataFrame:
    """Per key inside an object, or inside the objects of a list: field, key, schema over all records."""
    fields = _fields(records, col, pos)
    items = fields.select("pos", "field", F.explode(F.coalesce(
        F.try_variant_get("value", "$", "array<variant>"), F.array("value"))).alias("record"))
    inner = items.sparkSession.sql(
        "SELECT r.field, f.key AS key, f.value AS value FROM {rows} r, LATERAL variant_explode(r.record) f WHERE f.key IS NOT NULL",
        rows=items)
    return inner.groupBy("field", "key").agg(_named_types(F.schema_of_variant_agg("value")).alias("schema")).orderBy("field", "key")


def json_schema(records: DataFrame, col: str = "record", pos: str = "pos", nested_only: bool = False) -> DataFrame:
    """Nested schema text of every top-level key, merged over all records."""
    schema = _named_types(F.schema_of_variant_agg("value"))
    out = _fields(records, col, pos).groupBy("field").agg(schema.alias("schema"))
    if nested_only:
        out = out.filter(F.col("schema").rlike("^(list|dict)"))
    return out.orderBy(F.col("schema").rlike("^(list|dict)").cast("int"), "field")
