"""Licence recognition by sentences and ordered rules, in built-in expressions only.

A text is split into sentences, which are normalised (lower case, words and version numbers only). A table
maps normalised sentences to identifiers of known licence sentences; the first entry that fits counts. The
identifiers of a text, in order, form a sequence. A sentence ends at a stop or at the end of its line; where known
sentences cross line ends, as in wrapped texts, all lines up to a stop or blank line are one piece that gives each
known sentence it holds, in order. Rules name a licence by a sequence of identifiers that
follow each other, longest first; identifiers that a rule has used are not used again. Sentences that speak
of a licence but are not known are counted as unknown.

Null text is empty: no sentence, no licence. Rows are treated one by one whatever their doc_id; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.tables import texts

#: Known licence sentences, (identifier, what the normalised sentence holds), first match counts.
SENTENCES = (
    ("SpdxMIT", r"spdx license identifier mit\b"),
    ("SpdxApache2", r"spdx license identifier apache 2\.0\b"),
    ("SpdxBSD3", r"spdx license identifier bsd 3 clause\b"),
    ("SpdxBSD2", r"spdx license identifier bsd 2 clause\b"),
    ("SpdxGPL2", r"spdx license identifier gpl 2\.0\b"),
    ("SpdxGPL3", r"spdx license identifier gpl 3\.0\b"),
    ("SpdxMPL2", r"spdx license identifier mpl 2\.0\b"),
    ("SpdxISC", r"spdx license identifier isc\b"),
    ("LGPLver", r"(?:gnu (?:lesser|library) general public license|\blgpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?(?:2\.1|3|2)\b"),
    ("AGPL3", r"gnu affero general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3\b"),
    ("GPL3", r"(?:gnu general public license|\bgpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3\b"),
    ("GPL2", r"(?:gnu general public license|\bgpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2\b"),
    ("GPLany", r"under the (?:terms of the )?gnu general public license"),
    ("GPLlater", r"\bor at your option any later version\b"),
    ("GPLnowarranty", r"distributed in the hope that it will be useful but without any warranty"),
    ("GPLcopy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license"),
    ("Apache2", r"apache (?:software )?license(?: version| v)? ?2(?:\.0)?\b"),
    ("ApacheCompliance", r"you may not use this file except in compliance with the license"),
    ("ApacheObtain", r"you may obtain a copy of the license at"),
    ("ApacheAsIs", r"software distributed under the license is distributed on an as is basis"),
    ("ApacheLanguage", r"see the license for the specific language governing permissions"),
    ("MPL2", r"mozilla public license(?: version| v)? ?2\.0\b"),
    ("EPL2", r"eclipse public license(?: version| v)? ?(?:2\.0|1\.0)\b"),
    ("CCBYNCSA", r"(?:\bcc by nc sa\b|creative commons attribution noncommercial sharealike)"),
    ("CCBYNCND", r"(?:\bcc by nc nd\b|creative commons attribution noncommercial noderiv)"),
    ("CCBYNC", r"(?:\bcc by nc\b|creative commons attribution noncommercial)"),
    ("CCBYSA", r"(?:\bcc by sa\b|creative commons attribution sharealike)"),
    ("CCBYND", r"(?:\bcc by nd\b|creative commons attribution noderiv)"),
    ("CCBY", r"(?:\bcc by\b|creative commons attribution)"),
    ("CC0", r"(?:\bcc0\b|creative commons zero)"),
    ("PublicDomain", r"(?:dedicated to|released into|placed in) the public domain"),
    ("Unlicense", r"free and unencumbered software released into the public domain"),
    ("MITgrant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included"),
    ("MITasIs", r"the software is provided as is without warranty of any kind express or implied"),
    ("MITname", r"\bmit license\b"),
    ("ISCgrant", r"permission to use copy modify and or distribute this software for any purpose"),
    ("ISCasIs", r"the software is provided as is and the author disclaims all warranties"),
    ("BSDgrant", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSDsource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDbinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDendorse", r"neither the name of .* may be used to endorse or promote products"),
    ("BSDasIs", r"this software is provided by the copyright holders? and contributors as is"),
    ("BSD3name", r"\bbsd 3 clause\b"),
    ("BSD2name", r"\bbsd 2 clause\b"),
    ("BSDname", r"\bbsd license\b"),
    ("AllRights", r"\ball rights reserved\b"),
)
#: Ordered rules, (licence, sequence of identifiers); "?" after an identifier: may be absent.
RULES = (
    ("Apache-2.0", "Apache2 ApacheCompliance ApacheObtain ApacheAsIs ApacheLanguage?"),
    ("BSD-3-Clause", "BSDgrant BSDsource BSDbinary BSDendorse BSDasIs?"),
    ("BSD-2-Clause", "BSDgrant BSDsource BSDbinary BSDasIs?"),
    ("MIT", "MITname? MITgrant MITnotice? MITasIs?"),
    ("ISC", "ISCgrant ISCasIs?"),
    ("LGPL", "LGPLver GPLlater? GPLnowarranty? GPLcopy?"),
    ("AGPL-3.0", "AGPL3 GPLlater? GPLnowarranty? GPLcopy?"),
    ("GPL-3.0-or-later", "GPL3 GPLlater GPLnowarranty? GPLcopy?"),
    ("GPL-2.0-or-later", "GPL2 GPLlater GPLnowarranty? GPLcopy?"),
    ("GPL-3.0", "GPL3 GPLnowarranty? GPLcopy?"),
    ("GPL-2.0", "GPL2 GPLnowarranty? GPLcopy?"),
    ("GPL", "GPLany GPLlater? GPLnowarranty? GPLcopy?"),
    ("Unlicense", "Unlicense"),
    ("Apache-2.0", "Apache2 ApacheCompliance? ApacheObtain?"),
    ("Apache-2.0", "SpdxApache2"),
    ("MPL-2.0", "MPL2"),
    ("MPL-2.0", "SpdxMPL2"),
    ("EPL", "EPL2"),
    ("CC-BY-NC-SA", "CCBYNCSA"),
    ("CC-BY-NC-ND", "CCBYNCND"),
    ("CC-BY-NC", "CCBYNC"),
    ("CC-BY-SA", "CCBYSA"),
    ("CC-BY-ND", "CCBYND"),
    ("CC-BY", "CCBY"),
    ("CC0-1.0", "CC0"),
    ("public-domain", "PublicDomain"),
    ("MIT", "MITname"),
    ("MIT", "SpdxMIT"),
    ("ISC", "SpdxISC"),
    ("BSD-3-Clause", "BSD3name"),
    ("BSD-3-Clause", "SpdxBSD3"),
    ("BSD-2-Clause", "BSD2name"),
    ("BSD-2-Clause", "SpdxBSD2"),
    ("BSD", "BSDname"),
    ("GPL-3.0", "SpdxGPL3"),
    ("GPL-2.0", "SpdxGPL2"),
    ("all-rights-reserved", "AllRights"),
)
#: A text without any of these has no licence sentence; a sentence with one that is not known is unknown.
HINT = r"(?i)licen[cs]e|copyright|permission|warrant|redistribut|public domain|creative commons|\bcc[ -]by|\bcc0|\ball rights reserved|\b[al]?gpl|later version|provided as is"
_END = r"(?:[.!?]+[\x20\x09]+|[\x20\x09]*[\n\r]+)"
#: As HINT, with words that may be on different lines.
_WRAPPED_HINT = HINT.replace("[ -]", " ").replace(" ", "[^A-Za-z0-9]+")
#: Stops, and lines with no more than a comment's leader, which sentences do not cross.
_HARD_END = r"(?:[.!?]+(?:[\x20\x09]+|[\n\r]+)|(?:\r\n?+|\n)[\x20\x09*#/;-]*(?:\r\n?+|\n))"


def normalised(sentence: Column) -> Column:
    words = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(words, r"\.+( |$)", " "), " +", " "))


def _identifier(sentence: Column) -> Column:
    found = F.when(F.lit(False), F.lit(""))
    for name, pattern in SENTENCES:
        found = found.when(sentence.rlike(pattern), name)
    return found


def _held(piece: Column) -> Column:
    """Identifiers of the known sentences in a normalised piece, in order; a sentence overlapping an earlier entry's is none."""
    for name, pattern in SENTENCES:
        # names are upper case at the start and braced: no pattern matches or crosses them
        piece = F.regexp_replace(piece, pattern.replace(".*", "[^{}\\n]*"), f"{{{name}}}")
    return F.regexp_extract_all(piece, F.lit(r"\{(\w+)\}"), F.lit(1))


def _identifiers(text: Column) -> Column:
    """The identifiers of a text in order, "?" for unknown sentences."""
    def by_line(piece: Column) -> Column:
        sentences = F.filter(F.split(piece, _END), lambda s: s.rlike(HINT))
        return F.transform(F.transform(sentences, normalised), lambda s: F.coalesce(_identifier(s), F.lit("?")))

    none = F.array().cast("array<string>")

    def lines(piece: Column) -> Column:
        return F.when(piece.rlike(r"[\n\r]") & piece.rlike(_WRAPPED_HINT), F.transform(F.split(piece, r"[\n\r]+"), normalised)).otherwise(none)

    pieces = F.filter(F.split(text, _HARD_END), lambda p: p.rlike(_WRAPPED_HINT))
    held = F.transform(F.transform(pieces, lambda p: F.struct(p.alias("piece"), lines(p).alias("lines"))), lambda s: F.struct(
        s["piece"].alias("piece"), _held(F.array_join(s["lines"], "\n")).alias("apart"), _held(F.array_join(s["lines"], " ")).alias("joined")))
    # they differ only where a known sentence crosses a line's end
    found = F.transform(held, lambda s: F.when(s["apart"] == s["joined"], by_line(s["piece"])).otherwise(s["joined"]))
    return F.when(text.rlike(_WRAPPED_HINT), F.flatten(found)).otherwise(none)


def _rule(sequence: str) -> str:
    """A pattern over ",A,B,C,": each identifier with its comma, after the comma before."""
    parts = "".join(f"(?:{name[:-1]},)?" if name.endswith("?") else f"{name}," for name in sequence.split())
    return f",(?:{parts})+"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences known, n_unknown, sequence of identifiers, licences (each once, in rule order), unmatched."""
    rules = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit(_rule(sequence)).alias("pattern")) for name, sequence in RULES])

    def step(state: Column, rule: Column) -> Column:
        fits = F.regexp_like(state["rest"], rule["pattern"])
        return F.struct(
            F.when(fits, F.regexp_replace(state["rest"], rule["pattern"], F.lit(","))).otherwise(state["rest"]).alias("rest"),
            F.when(fits, F.array_append(state["found"], rule["licence"])).otherwise(state["found"]).alias("found"))

    def whole(ids: Column) -> Column:
        # "?" between identifiers: an unknown sentence interrupts a rule
        return F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))

    start = F.struct(whole(F.col("ids")).alias("rest"), F.array().cast("array<string>").alias("found"))
    rows = texts(docs).select("doc_id", _identifiers(F.col("text")).alias("ids")).withColumn(
        "matched", F.when(F.size("ids") > 0, F.aggregate(rules, start, step)))
    left = F.filter(F.split(F.coalesce("matched.rest", F.lit("")), ","), lambda x: (x != "") & (x != "?"))
    return rows.select(
        "doc_id", F.size(F.filter("ids", lambda x: x != "?")).cast("long").alias("n_sentences"),
        F.size(F.filter("ids", lambda x: x == "?")).cast("long").alias("n_unknown"), F.array_join("ids", ",").alias("sequence"),
        F.array_join(F.array_distinct(F.coalesce("matched.found", F.array().cast("array<string>"))), ",").alias("licences"),
        F.array_join(left, ",").alias("unmatched"))


def oracle() -> str:
    """The same in SQL, the rules one after another."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    cases = " ".join(f"WHEN regexp_matches(s, {quote(p)}) THEN {quote(n)}" for n, p in SENTENCES)
    steps = ""
    for i, (name, sequence) in enumerate(RULES):
        fits = f"regexp_matches(rest, {quote(_rule(sequence))})"
        steps += (f", r{i + 1} AS (SELECT doc_id, ids, CASE WHEN {fits} THEN list_append(found, {quote(name)}) ELSE found END AS found, "
                  f"regexp_replace(rest, {quote(_rule(sequence))}, ',', 'g') AS rest FROM r{i})")
    return rf"""
WITH cut AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), {quote(_END)}), lambda s: regexp_matches(s, {quote(HINT)})) AS raw FROM documents),
normal AS (
    SELECT doc_id, list_transform(raw, lambda s: trim(regexp_replace(regexp_replace(regexp_replace(
        lower(s), '[^a-z0-9.]+', ' ', 'g'), '\.+( |$)', ' ', 'g'), ' +', ' ', 'g'))) AS ss FROM cut),
r0 AS (
    SELECT doc_id, list_transform(ss, lambda s: CASE {cases} ELSE '?' END) AS ids, []::VARCHAR[] AS found,
           ',' || array_to_string(list_transform(ss, lambda s: CASE {cases} ELSE '?' END), ',') || ',' AS rest FROM normal)
{steps}
SELECT doc_id, len(list_filter(ids, lambda x: x <> '?'))::BIGINT AS n_sentences, len(list_filter(ids, lambda x: x = '?'))::BIGINT AS n_unknown,
       array_to_string(ids, ',') AS sequence,
       coalesce(array_to_string(list_filter(list_transform(range(1, len(found) + 1), lambda i: CASE WHEN list_position(found, found[i]) = i THEN found[i] END), lambda x: x IS NOT NULL), ','), '') AS licences,
       coalesce(array_to_string(list_filter(string_split(rest, ','), lambda x: x <> '' AND x <> '?'), ','), '') AS unmatched
FROM r{len(RULES)}
"""
