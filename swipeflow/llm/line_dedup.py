"""Repeated runs of lines, found with a suffix array over line ids by distributed prefix doubling, and its LCP intervals.

Lines that hold only white space are passed over: they neither count nor interrupt a run, and stay. A run is
a sequence of lines of one document; it qualifies with `min_words` words or more. A place (a line of a document)
has a repeated run if the shortest qualifying run that begins there begins at an earlier place of the corpus too
(by doc_id, then line); its maximal repeated run is the longest that does, however long, overlaps allowed.
By default, as in ORACLE, the lines of the shortest qualifying part of every maximal repeated run are removed: lines
at its end that are short of `min_words` stay. With `whole`, all lines of every maximal repeated run are.

1. Lines that occur once cannot be in a repeated run and drop out. The others are ranked in the order of
   their hashes.
2. Round j ranks the places by their first 2^j lines, from the pairs of ranks of round j - 1: only the
   different pairs are sorted, by range, and their places are the new ranks. Places whose 2^j lines occur once
   drop out of the round; rounds end when none is left, so together they sort the repeated suffixes wholly.
3. Places whose first d lines agree are an interval of the suffix array with a longest common prefix of d or more.
   The shortest qualifying run at a place has some depth d, and two ranks of round floor(log2 d) name its interval.
   The first place of the interval has no repeated run, the others have.
4. From there each place goes down the intervals it lies in, by 2^j lines for each round j from the last to the
   first, as long as the smaller interval holds an earlier place. An interval is named by its depth and first place.
   The earliest place that agrees on more lines either came down to the same interval or is its first place, so
   these are all that is compared.

No step gathers the places of a line or an interval: they are joined with their interval's first place.

Null text is empty. Rows with the same doc_id and text are one document; rows without doc_id come last, in
order of a hash of the text, as do different texts with one doc_id. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.llm.tables import WORD, partitions, saved, texts

MIN_WORDS = 10
_PLACE = ["doc", "mark", "at"]
_LAST = 2**63 - 1


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumns({"doc": F.coalesce("doc_id", F.lit(_LAST)), "mark": F.xxhash64("text")})


def _lines(text: Column) -> Column:
    """(raw, line) of the lines that are not blank."""
    numbered = F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("raw"), x.alias("line")))
    return F.filter(numbered, lambda s: s["line"].rlike(WORD))


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose values of `by` other rows have too, with column `rank`: the place of these values in sorted order."""
    often = rows.groupBy(*by).agg(F.count("*").alias("n")).filter("n > 1").select(*by)
    values = often.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    ranks = saved(values.withColumn("rank", F.monotonically_increasing_id()), "line-ranks")
    return rows.join(ranks, by)


def _depth(min_words: int) -> Column:
    """Lines of the shortest qualifying run that begins here, null if the repeated lines end before."""
    ahead = F.collect_list(F.struct("at", "words")).over(
        Window.partitionBy("doc", "mark").orderBy("at").rowsBetween(0, min_words - 1))

    def step(state: Column, line: Column) -> Column:
        open_ = state["open"] & (line["at"] == F.col("at") + state["n"]) & (state["sum"] < min_words)
        return F.struct(F.when(open_, state["n"] + 1).otherwise(state["n"]).alias("n"),
                        F.when(open_, state["sum"] + line["words"]).otherwise(state["sum"]).alias("sum"), open_.alias("open"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(True).alias("open"))
    return F.aggregate(ahead, start, step, lambda s: F.when(s["sum"] >= min_words, s["n"]))


def _suffixes(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, mark, at, raw, rank, depth) of the lines that occur at several places."""
    line = F.col("found.line")
    lines = saved(_keyed(docs).select("doc", "mark", F.posexplode(_lines(F.col("text"))).alias("at", "found")).select(
        *_PLACE, "found.raw", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2"),
        F.regexp_count(line, F.lit(WORD)).cast("long").alias("words")), "lines")
    rows = _ranked(lines, ["h1", "h2"]).select(*_PLACE, "raw", "words", "rank").repartition("doc", "mark").distinct()
    return saved(rows.withColumn("depth", _depth(min_words)).drop("words"), "line-suffixes")


def _rounds(rows: DataFrame) -> list[DataFrame]:
    """(doc, mark, at, rank) for each round j: the places whose first 2^j lines begin at several places."""
    rounds = [rows.select(*_PLACE, "rank")]
    while len(rounds) == 1 or not rounds[-1].isEmpty():
        last = rounds[-1].withColumnRenamed("rank", "this")
        after = rounds[-1].select("doc", "mark", (F.col("at") - 2 ** (len(rounds) - 1)).alias("at"), F.col("rank").alias("then"))
        rounds.append(saved(_ranked(last.join(after, _PLACE), ["this", "then"]).select(*_PLACE, "rank"), "line-round"))
    return rounds[:-1]


def _shortest(rows: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(doc, mark, at, depth, lines, first) of the places whose `depth` lines begin at an earlier place too: lines is depth,
    first the earliest of these places."""
    ranks = reduce(DataFrame.union, [r.select("doc", "mark", "at", F.lit(j).alias("level"), "rank") for j, r in enumerate(rounds)])
    level = F.floor(F.log2("depth")).cast("int")
    reach = (F.col("at") + F.col("depth") - F.pow(F.lit(2), F.col("level")).cast("int")).alias("end")
    starts = rows.filter("depth is not null").select(*_PLACE, "depth", level.alias("level")).join(ranks, [*_PLACE, "level"])
    ends = ranks.select("doc", "mark", F.col("at").alias("end"), "level", F.col("rank").alias("b"))
    named = saved(starts.select(*_PLACE, "depth", "level", F.col("rank").alias("a"), reach).join(
        ends, ["doc", "mark", "end", "level"]).select(*_PLACE, "depth", "a", "b"), "line-runs")
    firsts = named.groupBy("depth", "a", "b").agg(F.min(F.struct(*_PLACE)).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return named.join(saved(firsts.drop("n"), "line-intervals"), ["depth", "a", "b"]).filter(
        F.struct(*_PLACE) != F.col("first")).select(*_PLACE, "depth", F.col("depth").alias("lines"), "first")


def _extended(runs: DataFrame, ranks: DataFrame, step: int) -> DataFrame:
    """runs, longer by `step` lines where these agree with an earlier place too; ranks are those of the round of `step` lines."""
    ahead = ranks.withColumnRenamed("at", "end")
    tried = saved(runs.withColumn("end", F.col("at") + F.col("lines")).join(ahead, ["doc", "mark", "end"], "left").drop("end"), "line-runs")
    open_ = tried.filter("rank is not null")
    firsts = open_.select("lines", "first").distinct().select(
        "lines", "first", "first.doc", "first.mark", (F.col("first.at") + F.col("lines")).alias("end")).join(ahead, ["doc", "mark", "end"])
    places = open_.select("lines", "first", "rank", F.struct(*_PLACE).alias("place")).union(
        firsts.select("lines", "first", "rank", F.col("first").alias("place")))
    smaller = saved(places.groupBy("lines", "first", "rank").agg(F.min("place").alias("next"), F.count("*").alias("n")).filter(
        "n > 1").drop("n"), "line-intervals")
    longer = F.col("next") < F.struct(*_PLACE)
    return tried.join(smaller, ["lines", "first", "rank"], "left").select(
        *_PLACE, "depth", F.when(longer, F.col("lines") + step).otherwise(F.col("lines")).alias("lines"),
        F.when(longer, F.col("next")).otherwise(F.col("first")).alias("first"))


def _runs(rows: DataFrame) -> DataFrame:
    rounds = _rounds(rows)
    runs = _shortest(rows, rounds)
    for j in reversed(range(len(rounds))):
        runs = _extended(runs, rounds[j], 2**j)
    return runs


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, mark, at, depth, lines, first) of every place with a repeated run: its maximal repeated run has `lines` lines, of
    which the first `depth` are enough to qualify, and begins at `first`, the earliest such place, too. Places count
    the lines that are not blank."""
    return _runs(_suffixes(docs, min_words))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """(doc, mark, raw): every line to remove, once."""
    rows = _suffixes(docs, min_words)
    ends = _runs(rows).select(*_PLACE, (F.col("at") + F.col("lines" if whole else "depth")).alias("end"))
    reach = F.max("end").over(Window.partitionBy("doc", "mark").orderBy("at"))
    return rows.join(ends, _PLACE, "left").withColumn("reach", reach).filter("reach > at").select("doc", "mark", "raw")


def _with_removed(docs: DataFrame, keyed: DataFrame, min_words: int, whole: bool) -> DataFrame:
    gone = repeated_lines(docs, min_words, whole).groupBy("doc", "mark").agg(F.collect_list("raw").alias("gone"))
    none = F.array().cast("array<int>")
    # grows with the documents, so it is joined by shuffle at every size
    return keyed.join(gone.hint("merge"), ["doc", "mark"], "left").withColumn("gone", F.coalesce("gone", none)).withColumn(
        "kept", F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(
            F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("gone", i)), "\n")))


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """doc_id, n_lines, n_removed, kept (the text that stays) for each row."""
    return _with_removed(docs, _keyed(docs), min_words, whole).select(
        "doc_id", F.size(_lines(F.col("text"))).cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"), "kept")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """docs with their texts cut (and n_chars to match); rows go that had lines and lost them all."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    keyed = docs.select(row).withColumns({"text": F.coalesce("row.text", F.lit("")), "doc": F.coalesce(
        F.col("row.doc_id").cast("long"), F.lit(_LAST))}).withColumn("mark", F.xxhash64("text"))
    cut = _with_removed(docs, keyed, min_words, whole).filter((F.size("gone") == 0) | F.col("kept").rlike(WORD))
    new = {"text": F.when(F.size("gone") == 0, F.col("row.text")).otherwise(F.col("kept"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("gone") == 0, F.col("row.n_chars")).otherwise(F.length("kept").cast(docs.schema["n_chars"].dataType))
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"row.{c}") for c in docs.columns])


#: The same in SQL.
ORACLE = rf"""
WITH keyed AS (SELECT DISTINCT coalesce(doc_id, {_LAST}) AS doc, coalesce(text, '') AS t FROM documents),
raws AS (SELECT doc, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) - 1 AS raw FROM keyed),
lines AS (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (PARTITION BY doc, t ORDER BY raw) AS place
    FROM raws WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
ahead AS (
    SELECT *, list(words) OVER w AS counts, list(line) OVER w AS texts
    FROM lines WINDOW w AS (PARTITION BY doc, t ORDER BY place ROWS BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)),
deep AS (
    SELECT *, list_filter(range(1, len(counts) + 1), lambda k: list_sum(counts[1:k]) >= {MIN_WORDS})[1] AS depth FROM ahead),
named AS (SELECT doc, t, place, depth, array_to_string(texts[1:depth], chr(10)) AS run FROM deep WHERE depth IS NOT NULL),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc, place) AS n FROM named) WHERE n > 1),
covered AS (SELECT DISTINCT doc, t, unnest(range(place, place + depth)) AS place FROM later),
gone AS (SELECT DISTINCT doc, t, raw FROM covered JOIN lines USING (doc, t, place)),
kept AS (
    SELECT r.doc, r.t, string_agg(r.line, chr(10) ORDER BY r.raw) FILTER (WHERE g.raw IS NULL) AS kept, count(g.raw) AS n_removed
    FROM raws r LEFT JOIN gone g ON r.doc = g.doc AND r.t = g.t AND r.raw = g.raw GROUP BY r.doc, r.t),
counts AS (SELECT doc, t, count(*) AS n_lines FROM lines GROUP BY doc, t)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d JOIN kept k ON coalesce(d.doc_id, {_LAST}) = k.doc AND coalesce(d.text, '') = k.t
LEFT JOIN counts c ON k.doc = c.doc AND k.t = c.t
"""
