"""Document fingerprints: bottom-k sketches of shingle hashes, in built-in expressions only.

A sketch is the ascending list of the k smallest distinct hashes of a text's word shingles. The sketch of a
union is the k smallest of the parts' hashes, so sketches merge; they estimate resemblance (Jaccard),
containment and the number of distinct shingles, and are exact for sets of up to k.

Null text is empty and has an empty sketch; a text of fewer words than a shingle is one shingle. Two empty
sketches resemble each other fully, an empty and another not at all. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.llm.tables import partitions, texts

SHINGLE = 5
K = 128
#: Hashes are cut to so many bits.
BITS = 48
_SPACE = r"[\x20\x09-\x0D]+"
_NO_ID = -(2**63)


def sketch(text: Column, shingle: int = SHINGLE, k: int = K) -> Column:
    """The bottom-k sketch of a text."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    hashed = lambda ws: F.shiftrightunsigned(F.xxhash64(ws), 64 - BITS)
    starts = lambda ws: F.sequence(F.lit(1), F.greatest(F.size(ws) - (shingle - 1), F.lit(1)))
    # one list of words for the whole expression: transform over a list that holds it alone
    each = F.transform(F.array(words), lambda ws: F.when(F.size(ws) == 0, F.array().cast("array<bigint>")).otherwise(
        F.slice(F.sort_array(F.array_distinct(F.transform(starts(ws), lambda i: hashed(F.slice(ws, i, shingle))))), 1, k)))
    return F.element_at(each, 1)


def merged(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(F.concat(a, b))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the sets."""
    both = merged(a, b, k)
    return F.when(F.size(both) == 0, 1.0).otherwise(
        F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of different shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        F.lit(float(k - 1) * 2.0**BITS) / F.element_at(a, k).cast("double"))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second has."""
    r, n, m = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), r * (n + m) / (1 + r) / n))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), BITS // 4, "0")), "")


def merged_by(sketches: DataFrame, key: str, k: int = K) -> DataFrame:
    """(key, sketch): one sketch for each group of parts. Only k hashes of a group leave each task."""
    values = sketches.select(key, F.explode("sketch").alias("hash")).distinct()
    order = Window.partitionBy(key).orderBy("hash")
    return values.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).groupBy(key).agg(
        F.sort_array(F.collect_list("hash")).alias("sketch"))


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are not above value, by two short scans."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    count = lambda xs: F.size(F.filter(xs, lambda x: x <= value))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    part = count(longs([p[0] for p in parts]))
    return F.when(part == 0, 0).otherwise((part - 1) * step + count(F.element_at(F.array(*map(longs, parts)), part)))


def beside_next(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch: the next row by descending doc_id; after the last, the first.

    Rows without doc_id come last; rows that share one are in order of text. Ranges of ids are in tasks of
    their own; the first row of each range is also sent to the range before it. The range bounds and first
    ids, one for each shuffle partition, are all that passes through the driver.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    rows = texts(docs).withColumn("sort_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    found = rows.agg(F.percentile_approx("sort_id", [i / n for i in range(1, n)] or [0.5], 20 * n)).first()[0] or []
    bucket = _bucket(F.col("sort_id"), sorted(set(found)))
    heads = sorted(rows.groupBy(bucket.alias("bucket")).agg(F.max("sort_id")).collect())
    # ranges run from high ids to low ones: a range's last row is followed by the first of the range below
    after = [(heads[i][1], heads[(i + 1) % len(heads)][0]) for i in range(len(heads))]
    sent = spark.createDataFrame(after, "head long, to int")
    both = rows.withColumn("bucket", bucket).join(F.broadcast(sent), F.col("sort_id") == F.col("head"), "left")
    places = F.array_compact(F.array(
        F.struct(F.col("bucket"), F.lit(0).alias("guest")),
        F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("bucket"), F.lit(1).alias("guest")))))
    dealt = both.select("doc_id", "sort_id", "text", F.explode(places).alias("at")).select(
        "doc_id", "sort_id", "text", "at.*").repartition(n, "bucket").withColumn("sketch", sketch(F.col("text"), shingle, k))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("sort_id").desc(), "text")
    return dealt.select("doc_id", "text", "sketch", "guest", F.lead("text").over(order).alias("next_text"),
                        F.lead("sketch").over(order).alias("next_sketch")).filter("guest = 0").drop("guest")


def edited(docs: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """Each row's fingerprint, that of its edited text (the second half replaced from the next row), and likenesses."""
    half = F.expr("length(text) div 2").cast("int")
    text = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = beside_next(docs, shingle, k).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), text.alias("edited"), "sketch", "next_sketch")
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), shingle, k))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
