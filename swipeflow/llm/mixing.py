"""Mixing sources to target weights with a low-discrepancy schedule.

1. Sources in code-point order (null last) weigh 5, 2, 1, 5, ... and share all words; a source gets at most
   three times its own words, and what it cannot take is shared among the others by weight.
2. A source's documents are shuffled by a hash of doc_id and cut, as one stream of words, into blocks of
   equal size. A target is a number of blocks.
3. Slot i of the schedule takes the golden-ratio point i * phi mod 1 and belongs to the source in whose
   stretch of the cumulated block numbers it falls. Any stretch of the schedule is mixed in proportion.
4. Slots are ranked within their source; slot r reads block r, and begins anew after the last block. The
   schedule is joined with the blocks, and a document takes the words that its blocks are read.

Running sums and ranks are taken within short pieces of a source plus the pieces' own running sums, so a
source with a third of all rows is spread over many tasks. Only the table of sources, a row for each, is
ordered in one task.

Null text has no words. Rows without words take none; no words at all give targets of 0. Rows that share a
doc_id are rows of their own; other columns are ignored. Results depend on the rows only, not on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.llm.tables import WORD, saved

WEIGHTS = (5, 2, 1)
#: A source, and so a document, is read so many times at most.
MOST = 3
#: Words of a block at most, blocks of a source at least, and blocks that an average source has at least.
BLOCK_WORDS, SOURCE_BLOCKS, MEAN_BLOCKS = 1024, 256, 2000
#: floor(2**32 / golden ratio), odd.
PHI = 2_654_435_769
_SPAN = 2**32


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: source, source_size. Adds number, weight, target and the block size of each source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("number") - 1, len(weights)) + 1).cast("int"))
    rows = sizes.withColumn("number", F.row_number().over(order).cast("long")).withColumn("weight", weight.cast("long"))
    filling = Window.orderBy(F.lit(float(most)) * F.col("source_size") / F.col("weight"), "number")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    exact = lambda c: c.cast("decimal(38,0)")
    zero = F.lit(0).cast("long")
    rows = rows.withColumns({
        "words": F.sum("source_size").over(everything),
        "sources": F.count("*").over(everything),
        "place": F.row_number().over(filling),
        "left": F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), zero),
        "shares": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero),
    })
    above = exact(most * F.col("source_size")) * exact(F.col("shares")) > exact(F.col("weight")) * exact(F.col("left"))
    rows = rows.withColumn("level", F.min(F.when(above, F.struct("place", "left", "shares"))).over(everything))
    full = F.col("level").isNull() | (F.col("place") < F.col("level.place"))
    capped = (most * F.col("source_size")).cast("double")
    shared = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.shares").cast("double")
    block = F.least(F.lit(BLOCK_WORDS), F.expr(f"words div ({MEAN_BLOCKS} * sources)"), F.expr(f"source_size div {SOURCE_BLOCKS}"))
    return rows.select(
        "number", "source", "source_size", F.when(full, capped).otherwise(shared).alias("target"),
        F.greatest(F.lit(1), block).cast("long").alias("block_words"))


def _schedule(spark, plan: DataFrame, most: int) -> DataFrame:
    """(number, block, uses): how often the slots read each block."""
    need = F.ceil(F.col("target") / F.col("block_words"))
    plan = plan.filter("target > 0").withColumn("need", need)
    totals = plan.agg(F.coalesce(F.sum("need"), F.lit(0)), F.count("*")).first()
    slots, cells = int(totals[0]), max(4096, 4 * totals[1])
    shift = 32 - (cells - 1).bit_length()
    to_end = F.sum("need").over(Window.orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
    edge = lambda c: F.floor(c.cast("double") / F.lit(float(max(slots, 1))) * F.lit(float(_SPAN)))
    stretches = plan.withColumn("end", to_end).select(
        "number", edge(F.col("end") - F.col("need")).alias("low"), edge(F.col("end")).alias("high"),
        F.expr("(source_size + block_words - 1) div block_words").alias("blocks")).filter("low < high")
    in_cells = stretches.withColumn("cell", F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))))
    points = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"pmod((id % {2**31}) * {PHI}, {_SPAN})").alias("point"))
    drawn = points.withColumn("cell", F.shiftright("point", shift)).join(in_cells, "cell").filter(
        "low <= point and point < high").select("slot", "number", "blocks", F.expr("slot div 65536").alias("piece"))
    counts = drawn.groupBy("number", "piece").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("number").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("number", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("number", "piece").orderBy("slot")) - 1
    ranked = drawn.withColumn("within", rank).join(counts, ["number", "piece"]).withColumn("rank", F.col("before") + F.col("within"))
    return ranked.filter(F.col("rank") < most * F.col("blocks")).groupBy(
        "number", F.expr("rank % blocks").alias("block")).agg(F.count("*").alias("uses"))


def _streams(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with the place of its first word in its source's stream."""
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = sized.withColumn("mark", mark).withColumn("piece", F.substring("mark", 1, 3)).join(
        plan.select("number", F.col("source").alias("of"), "block_words"), F.col("source").eqNullSafe(F.col("of")))
    pieces = rows.groupBy("number", "piece").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("number").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("number", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    running = F.sum("size").over(Window.partitionBy("number", "piece").orderBy("mark", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0))
    return rows.withColumn("running", running).join(pieces, ["number", "piece"]).select(
        "doc_id", "size", "number", "block_words", (F.col("before") + F.col("running") - F.col("size")).alias("start"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, number and source_size of the source, its target, taken words, and uses of the first block."""
    sized = saved(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"),
        F.regexp_count(F.coalesce(docs["text"], F.lit("")), F.lit(WORD)).cast("long").alias("size")), "mix-sizes")
    plan = saved(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-sources")
    uses = _schedule(docs.sparkSession, plan, most)
    streams = _streams(sized, plan)
    blocks = F.sequence(F.expr("start div block_words"), F.expr("greatest(start + size - 1, start) div block_words"))
    cut = streams.withColumn("block", F.explode(blocks)).withColumn("words", F.expr(
        "least(start + size, (block + 1) * block_words) - greatest(start, block * block_words)"))
    read = cut.join(uses, ["number", "block"], "left").groupBy("number", "start", "size", "doc_id").agg(
        F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken"),
        F.min(F.struct("block", F.coalesce("uses", F.lit(0)).alias("uses"))).alias("first"),
        F.sum(F.when(F.expr("block = start div block_words"), 1)).alias("rows"))
    rows = read.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))).withColumn(
        "taken", F.expr("taken div rows"))
    return rows.join(plan, "number").select("doc_id", "size", "source_size", "target", "taken", F.col("first.uses").alias("uses"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """docs as the mix reads them: a document as many times as the block with its first word is drawn.

    Documents without words stay once. Rows that share a doc_id go by the least of their numbers.
    """
    times = mixed(docs, weights, most).groupBy(F.col("doc_id").alias("mixed_id")).agg(
        F.min(F.when(F.col("size") > 0, F.col("uses")).otherwise(1)).alias("mixed_times"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("mixed_row")
    return docs.select(row).join(
        times.filter("mixed_times > 0"), F.col("mixed_row.doc_id").eqNullSafe(F.col("mixed_id"))).withColumn(
        "mixed_copy", F.explode(F.sequence(F.lit(1), F.col("mixed_times").cast("int")))).select("mixed_row.*")


#: The same in SQL.
ORACLE = f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][(number - 1) % 3 + 1]::BIGINT AS weight FROM sources),
filling AS (
    SELECT *, sum(source_size) OVER () AS words, count(*) OVER () AS sources,
           row_number() OVER o AS place,
           sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER b, 0) AS remaining,
           sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS shares
    FROM weighted
    WINDOW o AS (ORDER BY {MOST}.0::DOUBLE * source_size / weight, number),
           b AS (ORDER BY {MOST}.0::DOUBLE * source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT place AS stop, remaining AS r, shares AS s FROM filling
    WHERE {MOST} * source_size * shares > weight * remaining ORDER BY place LIMIT 1),
plan AS (
    SELECT number, source, source_size,
           CASE WHEN stop IS NULL OR place < stop THEN ({MOST} * source_size)::DOUBLE ELSE (weight * r)::DOUBLE / s::DOUBLE END AS target,
           greatest(1, least({BLOCK_WORDS}, words // ({MEAN_BLOCKS} * sources), source_size // {SOURCE_BLOCKS}))::BIGINT AS block_words
    FROM filling LEFT JOIN level ON true),
needs AS (SELECT *, ceil(target / block_words)::BIGINT AS need FROM plan WHERE target > 0),
ends AS (SELECT *, sum(need) OVER (ORDER BY number) AS last, sum(need) OVER () AS slots FROM needs),
stretches AS (
    SELECT number, (source_size + block_words - 1) // block_words AS blocks,
           floor((last - need)::DOUBLE / slots::DOUBLE * {_SPAN}.0::DOUBLE) AS low,
           floor(last::DOUBLE / slots::DOUBLE * {_SPAN}.0::DOUBLE) AS high FROM ends),
points AS (SELECT i, ((i % {2**31}) * {PHI}) % {_SPAN} AS point FROM range((SELECT coalesce(max(slots), 0) FROM ends)::BIGINT) t(i)),
ranked AS (
    SELECT number, blocks, row_number() OVER (PARTITION BY number ORDER BY i) - 1 AS rank
    FROM points JOIN stretches ON low <= point AND point < high),
uses AS (SELECT number, rank % blocks AS block, count(*) AS uses FROM ranked WHERE rank < {MOST} * blocks GROUP BY ALL),
streams AS (
    SELECT doc_id, size, p.*, sum(size) OVER (PARTITION BY number ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
           ROWS UNBOUNDED PRECEDING) - size AS start
    FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
cut AS (
    SELECT *, unnest(range((start // block_words)::BIGINT, (greatest(start + size - 1, start) // block_words + 1)::BIGINT)) AS block FROM streams)
SELECT c.doc_id, c.size, c.source_size, c.target,
       sum((least(start + size, (c.block + 1) * block_words) - greatest(start, c.block * block_words)) * coalesce(uses, 0))::BIGINT AS taken,
       arg_min(coalesce(uses, 0), c.block)::BIGINT AS uses
FROM cut c LEFT JOIN uses u ON u.number = c.number AND u.block = c.block
GROUP BY c.doc_id, c.size, c.source_size, c.target, c.number, c.start
"""
