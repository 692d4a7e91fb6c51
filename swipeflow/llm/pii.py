"""Personal data: base patterns, and terms that reveal a protected value, in built-in expressions only.

Base spans are the leftmost non-overlapping matches of a kind's pattern that pass its check. The values found
are the protected entities. The words of a document that holds an entity are candidate terms. Over the whole
corpus, df(t) and df(e) are the documents that have a term or an entity and df(t, e) those that have both. A term discloses by its pointwise mutual information with the entity, relative to the entity's own
information:

    disclosure(t, e) = log(N df(t, e) / (df(t) df(e))) / log(N / df(e))

which is 1 where a term occurs only around the entity and both say the same. Terms at or above a threshold
are marked in every document that holds the entity. They must occur with it in documents with several different
contexts (the words next to the entity's first place), so that copies of one text are no evidence. In a cleaned text base spans become their kind, terms become
their broader term if one is given, and are removed otherwise.

Null text is empty. Rows are treated one by one, also with equal or missing doc_ids; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.tables import saved, texts

KINDS = ("email", "ip", "card", "phone", "term")
#: The kinds' patterns; possessive, and barred from starting inside a run, so that no text takes quadratic time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for the kind's pattern to be tried.
_HINTS = {
    "email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]",
}
#: Letters of a term at least; characters on either side in which to look for a context; words on either side that name it.
TERM = r"\p{L}{3,}"
CONTEXT, NAMED_BY = 100, 3
#: Documents with different contexts that a term must share with an entity, and its least disclosure.
SUPPORT, DISCLOSURE = 3, 0.75
_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _placed(text: Column, pattern: Column, kind: int, passes) -> Column:
    """Spans of the pattern's matches that pass: the lengths of what lies between matches give their places."""
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(passes(pair["match"]), F.concat(state["found"], F.array(span))).otherwise(
            state["found"]).alias("found"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))
    pairs = F.arrays_zip(gaps.alias("gap"), matches.alias("match"))
    return F.aggregate(pairs, none, step, lambda s: s["found"])


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind."""
    none = F.array().cast(_SPANS)
    found = [F.when(text.rlike(_HINTS[kind]), _placed(text, F.lit(PATTERNS[kind]), i, lambda v, k=kind: _passes(k, v))).otherwise(none)
             for i, kind in enumerate(KINDS[:4])]
    return F.array_sort(F.concat(*found))


def _texts_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def revealing_terms(marked: DataFrame, docs: DataFrame, support: int = SUPPORT, threshold: float = DISCLOSURE) -> DataFrame:
    """(term, entity) of the terms whose disclosure of an entity reaches the threshold.

    marked: row, text, spans of the rows with spans; docs: doc_id, text of all rows.
    """
    mentions = marked.select("row", "text", F.explode("spans").alias("span")).select(
        "row", F.lower("span.value").alias("entity"), "span.start",
        F.lower(F.expr(f"substring(text, greatest(span.start - {CONTEXT}, 0) + 1, least(span.start, {CONTEXT}))")).alias("left"),
        F.lower(F.expr(f"substring(text, span.end + 1, {CONTEXT})")).alias("right"), (F.col("span.start") > CONTEXT).alias("cut"))
    words = lambda c: F.regexp_extract_all(c, F.lit(TERM), F.lit(0))
    # the outermost words may have been cut in two
    sides = mentions.withColumn("left", words(F.when(F.col("cut"), F.regexp_replace("left", r"^\p{L}+", "")).otherwise(F.col("left")))).withColumn(
        "right", words(F.when(F.length("right") == CONTEXT, F.regexp_replace("right", r"\p{L}+$", "")).otherwise(F.col("right"))))
    near = F.xxhash64(F.slice(F.reverse("left"), 1, NAMED_BY), F.slice("right", 1, NAMED_BY))
    # one context for each document, that of the entity's first place
    holders = saved(sides.groupBy("row", "entity").agg(F.min_by(near, F.struct("start", near)).alias("context")), "pii-holders")
    entity_docs = holders.groupBy("entity").agg(F.count("*").alias("entity_docs"), F.count_distinct("context").alias("contexts")).filter(
        F.col("contexts") >= support).drop("contexts")
    # in documents whose entities cannot have that support no pair is made
    wanted = holders.join(entity_docs.select("entity"), "entity").groupBy("row").agg(F.collect_list(F.struct("entity", "context")).alias("held"))
    pairs = marked.select("row", "text").join(wanted, "row").select("held", F.explode(F.array_distinct(words(F.lower("text")))).alias("term")).select(
        "term", F.explode("held").alias("of")).select("term", "of.entity", "of.context").filter(~F.contains(F.col("entity"), F.col("term")))
    together = pairs.groupBy("term", "entity", "context").agg(F.count("*").alias("n")).groupBy("term", "entity").agg(
        F.count("*").alias("contexts"), F.sum("n").alias("together")).filter(F.col("contexts") >= support)
    together = saved(together, "pii-pairs")
    terms = together.select("term").distinct()
    # counted before the join: a task sends each word it saw once, however common it is
    term_docs = docs.select(F.explode(F.array_distinct(words(F.lower("text")))).alias("term")).groupBy("term").agg(
        F.count("*").alias("term_docs")).join(terms, "term")
    counted = together.join(term_docs, "term").join(entity_docs, "entity").withColumn("n", F.lit(docs.count()))
    disclosure = F.log(F.col("n") * F.col("together") / (F.col("term_docs") * F.col("entity_docs"))) / F.log(
        F.greatest(F.col("n") / F.col("entity_docs"), F.lit(1.0 + 1e-9)))
    return counted.filter(disclosure >= threshold).select("term", "entity")


def spans(docs: DataFrame, support: int = SUPPORT, threshold: float = DISCLOSURE) -> DataFrame:
    """doc_id, text (null where nothing is marked), base and all spans of each row of docs."""
    rows = texts(docs)
    found = rows.select("doc_id", "text", base_spans(F.col("text")).alias("spans"))
    # a row number, kept with the table that is written here
    marked = saved(found.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text")), "pii-base")
    held = marked.filter(F.size("spans") > 0)
    reveals = saved(revealing_terms(held.select("row", "text", "spans"), rows, support, threshold), "pii-terms")
    entities = held.select("row", F.explode(F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"])))).alias("entity"))
    told = entities.join(reveals, "entity").groupBy("row").agg(F.array_join(F.sort_array(F.collect_set("term")), "|").alias("terms"))
    joined = marked.join(told, "row", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.col("terms"), F.lit(r")(?!\p{L})"))
    clear = lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"]))
    added = F.filter(_placed(F.col("text"), pattern, 4, lambda v: F.lit(True)), clear)
    return joined.select("doc_id", "text", F.col("spans").alias("base"), F.when(
        F.col("terms").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", added))).alias("spans"))


def found(docs: DataFrame) -> DataFrame:
    """Counts by kind and the spans as text, kind:start:end by start, then kind."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return spans(docs).select(
        "doc_id", *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:4])],
        F.sha2(_texts_of(F.col("base")).cast("binary"), 256).alias("base_sha256"), _texts_of(F.col("spans")).alias("spans"))


def cleaned(docs: DataFrame, broader: dict[str, str] | None = None, support: int = SUPPORT, threshold: float = DISCLOSURE) -> DataFrame:
    """doc_id and text of the rows with marked spans: kinds in brackets, terms generalised by `broader` or removed."""
    general = F.create_map(*[F.lit(x) for pair in (broader or {"": ""}).items() for x in pair])
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(state: Column, s: Column) -> Column:
        put = F.when(s["kind"] < 4, F.element_at(names, s["kind"] + 1)).otherwise(F.coalesce(F.try_element_at(general, F.lower(s["value"])), F.lit("")))
        out = F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), put)
        late = s["start"] < state["at"]
        return F.struct(F.when(late, state["at"]).otherwise(s["end"]).alias("at"), F.when(late, state["out"]).otherwise(out).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    return spans(docs, support, threshold).filter(F.size("spans") > 0).select("doc_id", F.aggregate("spans", start, step, rest).alias("text"))
