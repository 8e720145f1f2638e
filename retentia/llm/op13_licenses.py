"""License scan by ordered signature rules, in DataFrame functions only.

A rule is a regular expression over the words around an anchor: one of the rule's keywords, before which a mark is put.
A document's keywords are looked up first; only texts that hold some, only rules whose keywords are all there, and
only places of the rule's anchor word are matched, within `BEFORE` words before the anchor and `AFTER` from it on. So
the work grows with the places of keywords, and all of it happens in one scan, row by row, without a shuffle.

Rules have a priority: 3 grants and identifiers, 2 names with a version, 1 bare names. A detection is dropped if it
lies within another of the same or a higher priority (the first in the order of rules if both cover the same words),
or overlaps one of a higher priority. Places of the fixed phrases (`BASE`) are kept apart and never dropped. The score
is that of the strongest detection left: 1.0, 0.8 or 0.5 by priority, 0.9 for fixed phrases; 0 without any.

Defined results: a null text is empty: no words, no labels, score 0; rows may repeat; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retentia.llm.common import ascii_lower, table

# The phrases every scan reports, and their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BEFORE, AFTER = 12, 14
# No word holds it.
MARK = "@"
WEIGHTS = {0: 0.9, 1: 0.5, 2: 0.8, 3: 1.0}

# ---- names: label, anchor word, words before it, words after it (regular expressions over words)

LIC = "licen[sc]e"
# Name of a family, with the versions that have a label of their own.
FAMILIES = (
    ("gpl", "gnu", "", f" (?:gpl|general public {LIC})", ("1", "2", "3")),
    ("lgpl", "gnu", "", f" (?:lgpl|(?:lesser|library) general public {LIC})", ("2", "2.1", "3")),
    ("agpl", "gnu", "", f" (?:agpl|affero general public {LIC})", ("1", "3")),
    ("gfdl", "gnu", "", f" (?:fdl|free documentation {LIC})", ("1.1", "1.2", "1.3")),
    ("gpl", "gpl", "", "", ("1", "2", "3")),
    ("lgpl", "lgpl", "", "", ("2", "2.1", "3")),
    ("agpl", "agpl", "", "", ("1", "3")),
    ("apache", "apache", "", f"(?: software)? {LIC}", ("1", "1.1", "2")),
    ("mpl", "mozilla", "", f" public {LIC}", ("1", "1.1", "2")),
    ("epl", "eclipse", "", f" public {LIC}", ("1", "2")),
    ("edl", "eclipse", "", f" distribution {LIC}", ("1",)),
    ("eupl", "european", "", f" union public {LIC}", ("1", "1.1", "1.2")),
    ("cpl", "common", "", f" public {LIC}", ("1",)),
    ("cddl", "common", "", f" development and distribution {LIC}", ("1", "1.1")),
    ("cpal", "common", "", f" public attribution {LIC}", ("1",)),
    ("artistic", "artistic", "", f" {LIC}", ("1", "2")),
    ("osl", "open", "", f" software {LIC}", ("1", "2", "2.1", "3")),
    ("afl", "academic", "", f" free {LIC}", ("1.1", "1.2", "2", "2.1", "3")),
    ("ecl", "educational", "", f" community {LIC}", ("1", "2")),
    ("ofl", "sil", "", f" open font {LIC}", ("1", "1.1")),
    ("bsl", "boost", "", f" software {LIC}", ("1",)),
    ("busl", "business", "", f" source {LIC}", ("1", "1.1")),
    ("sspl", "server", "", f" side public {LIC}", ("1",)),
    ("elastic", "elastic", "", f" {LIC}", ("1", "2")),
    ("zpl", "zope", "", f" public {LIC}", ("1.1", "2", "2.1")),
    ("php", "php", "", f" {LIC}", ("3", "3.01")),
    ("python", "python", "", f"(?: software foundation)? {LIC}", ("2",)),
    ("lppl", "latex", "", f" project public {LIC}", ("1", "1.1", "1.2", "1.3")),
    ("ms-pl", "microsoft", "", f" public {LIC}", ()),
    ("ms-rl", "microsoft", "", f" reciprocal {LIC}", ()),
    ("qpl", "q", "", f" public {LIC}", ("1",)),
    ("ipl", "ibm", "", f" public {LIC}", ("1",)),
    ("npl", "netscape", "", f" public {LIC}", ("1", "1.1")),
    ("cecill", "cecill", "", f"(?: free software {LIC}(?: agreement)?)?", ("1", "1.1", "2", "2.1")),
    ("odbl", "open", "", f" database {LIC}", ("1",)),
    ("odc-by", "open", "", f" data commons attribution {LIC}", ("1",)),
    ("pddl", "public", "", f" domain dedication and {LIC}", ("1",)),
    ("ogl", "open", "", f" government {LIC}", ("1", "2", "3")),
    ("cdla-permissive", "community", "", f" data {LIC} agreement permissive", ("1", "2")),
    ("cdla-sharing", "community", "", f" data {LIC} agreement sharing", ("1",)),
    ("upl", "universal", "", f" permissive {LIC}", ("1",)),
    ("mit", "mit", "", f"(?: x11)? {LIC}", ()),
    ("mit", "expat", "", f" {LIC}", ()),
    ("isc", "isc", "", f" {LIC}", ()),
    ("zlib", "zlib", "", f"(?: libpng)? {LIC}", ()),
    ("bsd-2-clause", "bsd", "(?:2|two) clause (?:simplified )?", f" {LIC}", ()),
    ("bsd-3-clause", "bsd", "(?:3|three) clause (?:new |revised )?", f" {LIC}", ()),
    ("bsd-4-clause", "bsd", "(?:4|four) clause (?:original )?", f" {LIC}", ()),
    ("bsd-2-clause", "bsd", "simplified ", f" {LIC}", ()),
    ("bsd-3-clause", "bsd", "(?:new|revised|modified) ", f" {LIC}", ()),
    ("bsd-4-clause", "bsd", "original ", f" {LIC}", ()),
    ("bsd-2-clause", "bsd", "", f" 2 clause(?: {LIC})?", ()),
    ("bsd-3-clause", "bsd", "", f" 3 clause(?: {LIC})?", ()),
    ("bsd", "bsd", "", f"(?: style)? {LIC}", ()),
    ("unlicense", "unlicense", "", "", ()),
    ("wtfpl", "wtfpl", "", "", ("2",)),
    ("cc0", "cc0", "", "", ("1",)),
    ("cc0", "creative", "", " commons (?:zero|cc0)", ("1",)),
    ("cc-pdm", "creative", "", " commons public domain mark", ("1",)),
)

# The Creative Commons licenses: short form, and the words of the long form.
COMMONS = (
    ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
COMMONS_VERSIONS = ("1", "2", "2.5", "3", "4")

# Words by which a text is put under a license.
GRANT = (
    "(?:re)?(?:licen[sc]ed|released|distributed|available|published|provided|offered|covered|governed|shared|issued|usable|redistribut(?:ed|able))"
    "(?: to you)?(?: only)? (?:under|by|subject to|in accordance with) (?:the )?(?:(?:terms|conditions)(?: and conditions)? of (?:the )?)?"
)

# Statements of a license that name none: label, priority, anchor, other keywords, words before, words after.
STATEMENTS = (
    ("mit", 3, "permission", ("hereby",), "", " is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 3, "permission", (), "", " to use copy modify and or distribute this software for any purpose"),
    ("bsd", 3, "redistribution", (), "", " and use in source and binary forms with or without modification"),
    ("zlib", 3, "warranty", (), "this software is provided as is without any express or implied ", ""),
    ("gpl", 3, "gnu", (), "redistribute it and or modify it under the terms of the ", " general public licen[sc]e as published by the free software"),
    ("lgpl", 3, "gnu", (), "redistribute it and or modify it under the terms of the ", " (?:lesser|library) general public licen[sc]e as published"),
    ("agpl", 3, "gnu", (), "redistribute it and or modify it under the terms of the ", " affero general public licen[sc]e as published"),
    ("unlicense", 3, "public", ("unencumbered",), "this is free and unencumbered software released into the ", " domain"),
    ("public-domain", 3, "public", ("domain",), "(?:released|placed|dedicated|donated) (?:in|into|to) the ", " domain"),
    ("public-domain", 2, "public", ("domain",), "(?:is|are) in the ", " domain"),
    ("cc0", 3, "copyright", (), "to the extent possible under law .{0,40}waived all ", " and related"),
    ("all-rights-reserved", 3, "rights", ("reserved",), "all ", " (?:are )?reserved"),
    ("all-rights-reserved", 3, "rechte", ("vorbehalten",), "alle ", " vorbehalten"),
    ("all-rights-reserved", 3, "droits", (), "tous ", " r[ée]serv[ée]s"),
    ("all-rights-reserved", 3, "derechos", ("reservados",), "todos los ", " reservados"),
    ("proprietary", 2, "proprietary", (), "", " and confidential"),
    ("proprietary", 2, "proprietary", (), "", " licen[sc]e"),
    ("non-commercial", 2, "commercial", (), "(?:for )?non ?", " use only"),
    ("non-commercial", 2, "noncommercial", (), "(?:for )?", " use only"),
    ("no-redistribution", 2, "redistribute", (), "(?:may|must) not (?:copy or )?", ""),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    anchor: str
    needs: tuple[str, ...]
    before: str
    after: str

    @property
    def pattern(self) -> str:
        return f" {self.before}{MARK}{self.anchor}{self.after} "


def versioned(version: str) -> str:
    """The words of a version: 2, 2 0, v2, version 2 0, and what may be said about others."""
    major, _, minor = version.partition(".")
    tail = f" {minor}" if minor else "(?: 0)?"
    return f"(?: (?:v|ver|version|versions))? v?{major}{tail}(?: or (?:any )?later(?: versions?)?| only)?"


def signature_rules() -> list[Rule]:
    """All rules in their order: fixed phrases, then by family the grant, the name with a version and the bare name."""
    rules = []
    for label, phrase in BASE:
        words = phrase.split()
        at = next(k for k, w in enumerate(words) if w in ("mit", "apache", "cc"))
        needs = (words[at], *(w for w in words if w == "license"))
        rules.append(Rule(label, 0, words[at], needs, "".join(f"{w} " for w in words[:at]), "".join(f" {w}" for w in words[at + 1 :])))
    for label, priority, anchor, needs, before, after in STATEMENTS:
        rules.append(Rule(label, priority, anchor, (anchor, *needs), before, after))
    for label, anchor, before, after, versions in FAMILIES:
        # Names that cannot do without the word are looked for only where it is.
        needs = (anchor, "license") if after.endswith(f" {LIC}") and after.count("|") == 0 else (anchor,)
        for version in (*versions, ""):
            named = f"{label}-{version}" if version else label
            spelled = after + (versioned(version) if version else "")
            rules.append(Rule(named, 3, anchor, needs, GRANT + before, spelled))
            rules.append(Rule(named, 2 if version else 1, anchor, needs, before, spelled))
            rules.append(Rule(named, 3, "spdx", ("spdx",), "", f" licen[sc]e identifier {label.replace('-', ' ')}" + (versioned(version) if version else "")))
    for short, long in COMMONS:
        for version in (*COMMONS_VERSIONS, ""):
            named = f"cc-{short}-{version}" if version else f"cc-{short}"
            tail = (versioned(version) if version else "") + "(?: (?:international|unported|generic))?(?: licen[sc]e)?"
            for anchor, spelled in (("cc", f" {short.replace('-', ' ')}"), ("creative", f" commons {long}")):
                rules.append(Rule(named, 3, anchor, (anchor,), GRANT + "(?:a )?", spelled + tail))
                rules.append(Rule(named, 2 if version else 1, anchor, (anchor,), "", spelled + tail))
    return list(dict.fromkeys(rules))


RULES = signature_rules()
# Both spellings stand for the keyword of the rules.
SPELLINGS = ("license", "licence")


def _literal(text: str) -> str:
    """A SQL string that holds `text` as it is."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_array(rules: list[Rule]) -> str:
    """The rules as one constant array of structs."""
    rows = [
        f"named_struct('place', {k}, 'label', {_literal(r.label)}, 'priority', {r.priority}, 'anchor', {_literal(r.anchor)},"
        f" 'needs', array({', '.join(map(_literal, r.needs))}), 'pattern', {_literal(r.pattern)})"
        for k, r in enumerate(rules)
    ]
    return f"array({', '.join(rows)})"


def words(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATORS), ""), F.array().cast("array<string>"))


def keywords(rules: list[Rule]) -> list[str]:
    return sorted({w for r in rules for w in (r.anchor, *r.needs)} | set(SPELLINGS))


# Its natural order is that of the resolution: by first word, longest first, highest priority first, then by rule.
DETECTION = "struct<first int, back int, rank int, place int, label string>"


def _kept(found: str) -> str:
    """SQL: the sorted `found` without the dropped ones; two passes of running bounds over all of them.

    Forwards: the largest end so far of each priority. Backwards: the smallest start so far of each priority.
    """
    level = [f"if(d.rank = -{p}, greatest(s.m{p}, -d.back), s.m{p}) AS m{p}" for p in (1, 2, 3)]
    dropped = [f"(d.rank >= -{p} AND s.m{p} >= -d.back)" for p in (1, 2, 3)] + [f"(d.rank > -{p} AND s.m{p} >= d.first)" for p in (2, 3)]
    forward = (
        f"aggregate({found}, named_struct('out', CAST(array() AS array<struct<d {DETECTION}, stays boolean>>), 'm1', -1, 'm2', -1, 'm3', -1), (s, d) -> "
        f"named_struct('out', array_append(s.out, named_struct('d', d, 'stays', NOT ({' OR '.join(dropped)}))), {', '.join(f"'m{p}', " + x.rsplit(' AS ', 1)[0] for p, x in zip((1, 2, 3), level))}), s -> s.out)"
    )
    ahead = " OR ".join(f"(x.d.rank > -{p} AND t.m{p} <= -x.d.back)" for p in (2, 3))
    low = ", ".join(f"'m{p}', if(x.d.rank = -{p}, least(t.m{p}, x.d.first), t.m{p})" for p in (2, 3))
    return (
        f"array_sort(aggregate(reverse({forward}), named_struct('out', CAST(array() AS array<{DETECTION}>), 'm2', 2147483647, 'm3', 2147483647), (t, x) -> "
        f"named_struct('out', if(x.stays AND NOT ({ahead}), array_append(t.out, x.d), t.out), {low}), t -> t.out))"
    )


def scan(documents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """`documents` with __n_words, and __base and __detections: arrays of (first, last word from 0, priority, label)."""
    columns = documents.columns
    listed = ", ".join(map(_literal, keywords(rules)))
    step = documents.withColumn("__w", words(F.col("text")))
    step = step.withColumn("__present", F.expr(f"array_intersect(__w, array({listed}))"))
    step = step.withColumn("__known", F.expr("if(array_contains(__present, 'licence'), array_append(__present, 'license'), __present)"))
    step = step.withColumn(
        "__rules", F.expr(f"if(size(__known) = 0, array(), filter({rule_array(rules)}, r -> forall(r.needs, x -> array_contains(__known, x))))")
    )
    step = step.withColumn("__anchors", F.expr("array_distinct(transform(__rules, r -> r.anchor))"))
    # Windows of words around the anchors, with a space at both ends.
    lead = f"greatest(i - {BEFORE}, 0)"
    step = step.withColumn(
        "__places",
        F.expr(
            "if(size(__anchors) = 0, array(), transform(filter(sequence(0, size(__w) - 1), i -> array_contains(__anchors, __w[i])), i -> struct(i AS at, __w[i] AS word,"
            f" concat(' ', array_join(slice(__w, {lead} + 1, i - {lead}), ' '), if(i = 0, '', ' '), '{MARK}', array_join(slice(__w, i + 1, {AFTER}), ' '), ' ') AS near)))"
        ),
    )
    # Rule by rule, so that a pattern is compiled once a document.
    step = step.withColumn(
        "__hits",
        F.expr(
            "flatten(transform(__rules, r -> filter(transform(filter(__places, p -> p.word = r.anchor), p -> struct(p.at AS at,"
            " regexp_extract(p.near, r.pattern, 0) AS text, r.place AS place, r.label AS label, r.priority AS priority)), h -> h.text <> '')))"
        ),
    )
    # A match is ' before @anchor after ': its spaces on either side of the mark tell how many words lie there.
    part = "split_part(h.text, '@', {0})"
    size = f"(length({part}) - length(replace({part}, ' ', '')) - 1)"
    step = step.withColumn(
        "__found",
        F.expr(
            f"array_sort(transform(__hits, h -> struct(CAST(h.at - {size.format(1)} AS int) AS first, CAST(-(h.at + {size.format(2)}) AS int) AS back,"
            " -h.priority AS rank, h.place AS place, h.label AS label)))"
        ),
    )
    step = step.withColumn("__named", F.expr("filter(__found, d -> d.rank < 0)"))
    shown = "struct(d.first AS first, -d.back AS last, -d.rank AS priority, d.label AS label)"
    return step.select(
        *columns, F.size("__w").cast("long").alias("__n_words"), F.expr(f"transform(filter(__found, d -> d.rank = 0), d -> {shown})").alias("__base"),
        F.expr(f"transform(if(size(__named) < 2, __named, {_kept('__named')}), d -> {shown})").alias("__detections"),
    )


def licenses(documents: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections of every row."""
    found = scan(documents.select("doc_id", "text"), rules)

    def joined(*arrays: str) -> Column:
        names = F.concat(*[F.transform(a, lambda d: d["label"]) for a in arrays])
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    weight = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    priorities = F.concat(F.transform("__base", lambda d: d["priority"]), F.transform("__detections", lambda d: d["priority"]))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.size("__base").cast("long").alias("n_base"),
        F.array_min(F.transform("__base", lambda d: d["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("__base", lambda d: d["first"])).cast("long").alias("last_word"),
        joined("__base").alias("base_labels"), joined("__base", "__detections").alias("labels"),
        F.coalesce(F.array_max(F.transform(priorities, lambda p: weight[p])), F.lit(0.0)).alias("score"),
        F.size("__detections").cast("long").alias("n_detections"),
    )


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    def listed(texts):
        return "[" + ", ".join(map(quoted, texts)) + "]"

    rules = ", ".join(
        f"({k}, {quoted(r.label)}, {r.priority}, {quoted(r.anchor)}, {listed(r.needs)}, {quoted(r.pattern)})" for k, r in enumerate(RULES)
    )
    return rf"""
WITH rules(place, label, priority, anchor, needs, pattern) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
k AS (SELECT rid, w, list_intersect(list_distinct(w), {listed(keywords(RULES))}) AS seen FROM d),
spot AS (SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM k WHERE len(seen) > 0),
near AS (SELECT rid, i, word, ' ' || array_to_string(w[greatest(i - {BEFORE}, 1):i - 1], ' ') || CASE WHEN i = 1 THEN '' ELSE ' ' END || '@'
    || array_to_string(w[i:i + {AFTER - 1}], ' ') || ' ' AS near,
    CASE WHEN list_contains(seen, 'licence') THEN list_append(seen, 'license') ELSE seen END AS present
  FROM spot JOIN k USING (rid) WHERE word IN (SELECT anchor FROM rules)),
hit AS (SELECT rid, i, place, label, priority, regexp_extract(near, pattern) AS t FROM near JOIN rules ON word = anchor AND list_has_all(present, needs)),
det AS (SELECT rid, place, label, priority, i - 1 - (len(string_split(string_split(t, '@')[1], ' ')) - 2) AS a, i - 1 + (len(string_split(string_split(t, '@')[2], ' ')) - 2) AS b
  FROM hit WHERE t <> ''),
kept AS (SELECT * FROM det x WHERE priority > 0 AND NOT EXISTS (SELECT 1 FROM det y WHERE y.rid = x.rid AND y.priority > 0 AND (
    (y.a <= x.a AND y.b >= x.b AND y.priority >= x.priority AND (y.a < x.a OR y.b > x.b OR y.priority > x.priority OR y.place < x.place))
    OR (y.priority > x.priority AND y.a <= x.b AND y.b >= x.a)))),
base AS (SELECT rid, count(*) AS n, min(a) AS lo, max(a) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS names FROM det WHERE priority = 0 GROUP BY rid),
every AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS names, max(CASE priority WHEN 0 THEN 0.9 WHEN 1 THEN 0.5 WHEN 2 THEN 0.8 ELSE 1.0 END) AS score,
  count(*) FILTER (priority > 0) AS n FROM (SELECT * FROM kept UNION ALL SELECT * FROM det WHERE priority = 0) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(base.n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
  coalesce(base.names, '') AS base_labels, coalesce(every.names, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score, CAST(coalesce(every.n, 0) AS BIGINT) AS n_detections
FROM d LEFT JOIN base USING (rid) LEFT JOIN every USING (rid)
"""


QUERIES = {"op13_licenses": op13_licenses}
ORACLES = {"op13_licenses": _oracle()}
