"""License scans by ordered signature rules, with DataFrame functions only.

A text is brought to words, each between two spaces of its own, so that a signature needs no look-around and neighbouring matches share no character.
A signature is a line of word patterns; ``~word`` may be absent. Every rule has a label, a priority (1 is the strongest) and a place in the order of rules.

Two filters come before any signature: a text must hold one of a few stems, and of the rules only those run whose keyword (a plain word of the
signature) the text holds. All matches of a rule are located by marking them and counting the words between the marks. A detection is suppressed if its interval lies in that of a
detection with the same or a stronger priority; of equal intervals and priorities the first rule counts. What is left gives the labels. All of it happens within
the row of a text: nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAG, GRANT, TITLE, NOTICE, MENTION = 1, 2, 3, 4, 5
CONFIDENCE = {TAG: 1.0, GRANT: 0.95, TITLE: 0.85, NOTICE: 0.75, MENTION: 0.6}
BASE_CONFIDENCE = 0.5

# Phrases whose places are counted as they are, and their labels.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# Licenses by name. A name is searched as a title and after words of a grant.
NAMES = [
    ("mit", "mit licen[sc]e"),
    ("mit", "expat licen[sc]e"),
    ("mit-0", "mit no attribution licen[sc]e"),
    ("x11", "x11 licen[sc]e"),
    ("isc", "isc licen[sc]e"),
    ("zlib", "zlib ~libpng licen[sc]e"),
    ("libpng", "libpng licen[sc]e"),
    ("curl", "curl licen[sc]e"),
    ("bsd", "bsd ~style licen[sc]e"),
    ("bsd-1-clause", "bsd 1 clause ~licen[sc]e"),
    ("bsd-2-clause", "bsd 2 clause ~licen[sc]e"),
    ("bsd-2-clause", "2 clause bsd ~licen[sc]e"),
    ("bsd-2-clause", "simplified bsd licen[sc]e"),
    ("bsd-2-clause", "freebsd licen[sc]e"),
    ("bsd-3-clause", "bsd 3 clause ~licen[sc]e"),
    ("bsd-3-clause", "3 clause bsd ~licen[sc]e"),
    ("bsd-3-clause", "new bsd licen[sc]e"),
    ("bsd-3-clause", "(modified|revised) bsd licen[sc]e"),
    ("bsd-4-clause", "bsd 4 clause ~licen[sc]e"),
    ("bsd-4-clause", "original bsd licen[sc]e"),
    ("0bsd", "bsd zero clause ~licen[sc]e"),
    ("0bsd", "zero clause bsd ~licen[sc]e"),
    ("apache", "apache ~software licen[sc]e"),
    ("boost", "boost software licen[sc]e"),
    ("mozilla", "mozilla public licen[sc]e"),
    ("eclipse", "eclipse public licen[sc]e"),
    ("artistic", "artistic licen[sc]e"),
    ("python", "python software foundation licen[sc]e"),
    ("python", "psf licen[sc]e"),
    ("php", "php licen[sc]e"),
    ("ruby", "ruby licen[sc]e"),
    ("perl", "same terms as perl ~licen[sc]e"),
    ("vim", "vim licen[sc]e"),
    ("openssl", "openssl licen[sc]e"),
    ("openldap", "openldap public licen[sc]e"),
    ("postgresql", "postgresql licen[sc]e"),
    ("unicode", "unicode ~data ~files licen[sc]e"),
    ("unicode", "unicode licen[sc]e agreement"),
    ("ncsa", "ncsa ~open ~source licen[sc]e"),
    ("cddl", "common development and distribution licen[sc]e"),
    ("cpl", "common public licen[sc]e"),
    ("ipl", "ibm public licen[sc]e"),
    ("eupl", "european union public licen[sc]e"),
    ("ms-pl", "microsoft public licen[sc]e"),
    ("ms-rl", "microsoft reciprocal licen[sc]e"),
    ("osl", "open software licen[sc]e"),
    ("afl", "academic free licen[sc]e"),
    ("ecl", "educational community licen[sc]e"),
    ("ofl", "~sil open font licen[sc]e"),
    ("qpl", "q public licen[sc]e"),
    ("spl", "sun public licen[sc]e"),
    ("zpl", "zope public licen[sc]e"),
    ("lppl", "latex project public licen[sc]e"),
    ("w3c", "w3c ~software ~notice ~and licen[sc]e"),
    ("sleepycat", "sleepycat licen[sc]e"),
    ("intel", "intel open source licen[sc]e"),
    ("blueoak", "blue oak model licen[sc]e"),
    ("mulan", "mulan permissive software licen[sc]e"),
    ("upl", "universal permissive licen[sc]e"),
    ("busl", "business source licen[sc]e"),
    ("sspl", "server side public licen[sc]e"),
    ("elastic", "elastic licen[sc]e"),
    ("commons-clause", "commons clause licen[sc]e"),
    ("polyform", "polyform (noncommercial|strict|shield|perimeter) licen[sc]e"),
    ("confluent", "confluent community licen[sc]e"),
    ("llama", "llama ~[23] ~1 community licen[sc]e"),
    ("openrail", "~creative ~ml openrail ~m licen[sc]e"),
    ("wtfpl", "do what the f[a-z]+ you want to public licen[sc]e"),
    ("beerware", "beerware licen[sc]e"),
    ("unlicense", "unlicense"),
    ("odbl", "open database licen[sc]e"),
    ("odc-by", "open data commons attribution licen[sc]e"),
    ("pddl", "public domain dedication and licen[sc]e"),
    ("cdla", "community data licen[sc]e agreement"),
    ("ogl", "open government licen[sc]e"),
    ("gfdl", "~gnu free documentation licen[sc]e"),
    ("gpl", "~gnu general public licen[sc]e"),
    ("gpl", "gnu gpl"),
    ("lgpl", "~gnu (lesser|library) general public licen[sc]e"),
    ("agpl", "~gnu affero general public licen[sc]e"),
    ("cc", "creative commons licen[sc]e"),
    ("cc0-1.0", "creative commons zero ~licen[sc]e"),
    ("cc0-1.0", "cc0 ~1 ~0 ~universal"),
]

# Fixed values: (label, name, versions) of families whose versions have labels of their own.
FAMILIES = [
    ("apache", "apache ~software licen[sc]e", ["1.0", "1.1", "2.0"]),
    ("bsl", "boost software licen[sc]e", ["1.0"]),
    ("mpl", "mozilla public licen[sc]e", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse public licen[sc]e", ["1.0", "2.0"]),
    ("artistic", "artistic licen[sc]e", ["1.0", "2.0"]),
    ("cddl", "common development and distribution licen[sc]e", ["1.0", "1.1"]),
    ("eupl", "european union public licen[sc]e", ["1.0", "1.1", "1.2"]),
    ("osl", "open software licen[sc]e", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", "academic free licen[sc]e", ["1.2", "2.0", "2.1", "3.0"]),
    ("gfdl", "~gnu free documentation licen[sc]e", ["1.1", "1.2", "1.3"]),
    ("gpl", "~gnu general public licen[sc]e", ["1.0", "2.0", "3.0"]),
    ("gpl", "~gnu gpl", ["1.0", "2.0", "3.0"]),
    ("lgpl", "~gnu (lesser|library) general public licen[sc]e", ["2.0", "2.1", "3.0"]),
    ("lgpl", "~gnu lgpl", ["2.0", "2.1", "3.0"]),
    ("agpl", "~gnu affero general public licen[sc]e", ["1.0", "3.0"]),
    ("agpl", "~gnu agpl", ["1.0", "3.0"]),
]

# Parts of Creative Commons licenses, in short and in full, and their versions.
CC_PARTS = [("by", "attribution"), ("by-sa", "attribution sharealike"), ("by-nc", "attribution noncommercial"), ("by-nd", "attribution noderivs?"),
            ("by-nc-sa", "attribution noncommercial sharealike"), ("by-nc-nd", "attribution noncommercial noderivs?")]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# Identifiers that may follow "SPDX-License-Identifier:", besides those of families and Creative Commons.
TAGS = ["mit", "mit-0", "isc", "zlib", "curl", "0bsd", "bsd-1-clause", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "unlicense", "wtfpl", "ncsa",
        "postgresql", "openssl", "vim", "x11", "cc0-1.0", "ofl-1.1", "ms-pl", "ms-rl", "busl-1.1", "sspl-1.0", "odbl-1.0", "pddl-1.0", "psf-2.0", "upl-1.0"]

# Sentences of license texts and notices.
NOTICES = [
    ("mit", NOTICE, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", NOTICE, "permission to use copy modify and ~or distribute this software for any purpose"),
    ("bsd", NOTICE, "redistribution and use in source and binary forms"),
    ("zlib", NOTICE, "permission is granted to anyone to use this software for any purpose"),
    ("gpl", NOTICE, "this program is free software you can redistribute it and or modify it"),
    ("gpl", NOTICE, "is free software you can redistribute it"),
    ("unlicense", NOTICE, "free and unencumbered software released into the public domain"),
    ("public-domain", NOTICE, "(released|placed|dedicated) (into|in|to) the public domain"),
    ("proprietary", NOTICE, "(proprietary|confidential) and (proprietary|confidential) ~all rights reserved"),
    ("all-rights-reserved", NOTICE, "all rights reserved"),
    ("copyright", MENTION, "copyright ~c (19|20)[0-9]{2}"),
    ("gpl", MENTION, "gpl"),
    ("gpl-2.0", MENTION, "gplv2"),
    ("gpl-3.0", MENTION, "gplv3"),
    ("lgpl", MENTION, "lgpl"),
    ("agpl", MENTION, "agpl"),
]

GRANTED = "(licen[sc]ed|released|distributed|published|provided|available) under ~the ~terms ~of ~the"
TAGGED = "spdx licen[sc]e identifier"

# One of these is in every text that any rule matches; words stand between two spaces there.
STEMS = ["licen", "gpl", "copyright", "rights  reserved", "permission ", "redistribut", "public  domain", " bsd ", " cc  by ", " cc0 ", "creative  commons ", " perl "]
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    signature: str

    @property
    def words(self) -> list[tuple[str, bool]]:
        """(pattern of a word, whether it must be there)."""
        return [(w.removeprefix("~"), w[0] != "~") for w in self.signature.split()]

    @property
    def pattern(self) -> str:
        """A pattern over words that stand between two spaces each."""
        out = ""
        for word, needed in self.words:
            own = f" {word.replace('(', '(?:')} "
            out += own if needed else f"(?:{own})?"
        return out

    @property
    def keyword(self) -> str:
        """The longest word that every match holds as it is, with its spaces; else what a word begins with."""
        plain = [f" {w} " for w, needed in self.words if needed and re.fullmatch("[a-z0-9]+", w)]
        heads = [m[0] for w, needed in self.words if needed and (m := re.match("[a-z0-9]+", w))]
        own = [w for w in plain if len(w) > 3]
        return max(own or heads or plain, key=len)


def _versioned(name: str, version: str) -> str:
    major, minor = version.split(".")
    return f"{name} ~version v?{major} {'~' if minor == '0' else ''}{minor}"


def default_rules() -> list[Rule]:
    """All rules in order: tags, grants, titles, notices, mentions."""
    names = [(label, name) for label, name in NAMES]
    for label, name, versions in FAMILIES:
        names += [(f"{label}-{v}", _versioned(name, v)) for v in versions]
    cc = []
    for part, full in CC_PARTS:
        short = part.replace("-", " ")
        cc += [(f"cc-{part}-{v}", f"cc {short} {v.replace('.', ' ')}") for v in CC_VERSIONS]
        cc += [(f"cc-{part}-{v}", f"creative commons {full} {v.replace('.', ' ')}") for v in CC_VERSIONS]
        cc += [(f"cc-{part}", f"cc {short} licen[sc]e"), (f"cc-{part}", f"creative commons {full} licen[sc]e")]
    ids = TAGS + [f"{label}-{v}" for label, v in dict.fromkeys((label, v) for label, _, versions in FAMILIES for v in versions)]
    ids += [f"cc-{part}-{v}" for part, _ in CC_PARTS for v in CC_VERSIONS]
    rules = [Rule(i, TAG, f"{TAGGED} {re.sub('[-.]', ' ', i)}") for i in ids]
    rules += [Rule(label, GRANT, f"{GRANTED} {name}") for label, name in names + cc]
    rules += [Rule(label, TITLE, name) for label, name in names + cc]
    return rules + [Rule(*notice) for notice in NOTICES]


def _capitals_down(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def spaced_words(text: Column) -> Column:
    """The words of a text in their order, each between two spaces; without words nothing."""
    parted = F.btrim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS, "  "), F.lit(" "))
    return F.when(parted == "", F.lit("")).otherwise(F.concat(F.lit(" "), parted, F.lit(" ")))


_SPACES = "(octet_length({0}) - octet_length(replace({0}, ' ', ''))) div 2"
# Words before each piece. Parts of 256 keep the array that grows step by step short.
_STARTS = f"""
aggregate(pieces, named_struct('n', 0L, 'part', cast(array() AS array<bigint>), 'done', cast(array() AS array<array<bigint>>)),
    (a, p) -> named_struct('n', a.n + {_SPACES.format("p")},
        'part', if(size(a.part) < 256, concat(a.part, array(a.n)), array(a.n)),
        'done', if(size(a.part) < 256, a.done, concat(a.done, array(a.part)))),
    a -> concat(flatten(a.done), a.part))
"""
_RULE = "struct<rule: int, label: string, priority: int, pattern: string>"
_DETECTION = "struct<start: bigint, until: bigint, priority: int, rule: int, label: string>"


def _located(rules: str) -> str:
    """SQL for an array of all matches of the rules (an array expression) in ``norm``: start and until (words from 0, until without), priority, rule, label."""
    pieces = f"transform({rules}, r -> named_struct('r', r, 'pieces', split(regexp_replace(norm, r.pattern, concat('\\u0001', '$0', '\\u0002')), '\\u0001')))"
    hits = f"filter({pieces}, x -> size(x.pieces) > 1)"
    starts = f"transform({hits}, x -> named_struct('r', x.r, 'pieces', x.pieces, 'starts', {_STARTS.replace('pieces', 'x.pieces', 1)}))"
    words = _SPACES.format("split_part(get(x.pieces, k), '\\u0002', 1)")
    places = f"""transform(sequence(1, size(x.pieces) - 1), k -> named_struct('start', get(x.starts, k), 'until', get(x.starts, k) + {words},
        'priority', x.r.priority, 'rule', x.r.rule, 'label', x.r.label))"""
    return f"flatten(transform({starts}, x -> {places}))"


# In the order of starts, long before short, an interval lies in an earlier one if any of these ends no sooner; ends are kept for each priority.
_SUPPRESS = f"""
aggregate(transform(array_sort(transform(found, d -> named_struct('start', d.start, 'back', -d.until, 'priority', d.priority, 'rule', d.rule, 'label', d.label))),
        d -> named_struct('start', d.start, 'until', -d.back, 'priority', d.priority, 'rule', d.rule, 'label', d.label)),
    named_struct('ends', array_repeat(-1L, {MENTION}), 'part', cast(array() AS array<{_DETECTION}>), 'done', cast(array() AS array<array<{_DETECTION}>>)),
    (a, d) -> named_struct(
        'ends', transform(a.ends, (e, i) -> if(i + 1 = d.priority, greatest(e, d.until), e)),
        'part', if(array_max(slice(a.ends, 1, d.priority)) >= d.until, a.part, if(size(a.part) < 256, concat(a.part, array(d)), array(d))),
        'done', if(array_max(slice(a.ends, 1, d.priority)) >= d.until OR size(a.part) < 256, a.done, concat(a.done, array(a.part)))),
    a -> concat(flatten(a.done), a.part))
"""


def _rule_array(rules: list[tuple[str, int, str]]) -> Column:
    """(label, priority, pattern) in order, as one constant array."""
    made = [F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(p).alias("priority"), F.lit(pattern).alias("pattern")) for i, (label, p, pattern) in rules]
    return F.array(*made).cast(f"array<{_RULE}>")


def detections(docs: DataFrame, rules: list[Rule] | None = None, base: list[tuple[str, str]] = BASE) -> DataFrame:
    """doc_id, n_words, base (all places of the base phrases), found (detections that no other one contains) for each row of ``docs`` (doc_id, text).

    base and found are arrays of (start, until, priority, rule, label): words from 0, ``until`` without; rule is the place in ``rules``, or in
    ``base``; label. A missing or empty text has no words and nothing found. Texts of any length are searched as a whole. Repeated rows give repeated rows, a missing doc_id
    stays missing, and other columns, whatever their names, are left out.
    """
    rules = default_rules() if rules is None else rules
    by_keyword: dict[str, list] = {}
    for i, rule in enumerate(rules):
        by_keyword.setdefault(rule.keyword, []).append((i, (rule.label, rule.priority, rule.pattern)))
    groups = [F.struct(F.lit(k).alias("keyword"), _rule_array(v).alias("rules")) for k, v in by_keyword.items()]
    phrases = _rule_array([(i, (label, 0, Rule(label, 0, phrase).pattern)) for i, (label, phrase) in enumerate(base)])
    held = F.lit(False)
    for stem in STEMS:
        held = held | F.contains(F.lower("parted"), F.lit(stem))
    # (out of an array of one: what is made below is then made once)
    parted = docs.select("doc_id", F.explode(F.array(spaced_words(F.col("text")))).alias("parted"))
    counted = parted.select("doc_id", F.expr(_SPACES.format("parted")).cast("bigint").alias("n_words"), F.when(held, _capitals_down(F.col("parted"))).alias("norm"))
    gated = counted.select("doc_id", "n_words", F.explode(F.array(F.col("norm"))).alias("norm"))
    chosen = "flatten(transform(filter(_groups, g -> contains(norm, g.keyword)), g -> g.rules))"
    none = f"cast(array() AS array<{_DETECTION}>)"
    searched = gated.withColumn("_groups", F.array(*groups).cast(f"array<struct<keyword: string, rules: array<{_RULE}>>>")).withColumn("_phrases", phrases)
    made = F.struct(
        F.expr(f"if(norm IS NULL, {none}, {_located(chosen)})").alias("found"),
        F.expr(f"if(norm IS NULL, {none}, {_located('_phrases')})").alias("base"),
    )
    searched = searched.select("doc_id", "n_words", F.explode(F.array(made)).alias("_made")).select("doc_id", "n_words", "_made.*")
    return searched.select("doc_id", "n_words", "base", F.expr(f"if(size(found) = 0, found, {_SUPPRESS})").alias("found"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kept = rows.select("doc_id", "n_words", "base", F.explode(F.array("found")).alias("found"))
    sure = F.lit(0.0)
    for priority, confidence in CONFIDENCE.items():
        sure = F.greatest(sure, F.when(F.expr(f"exists(found, d -> d.priority = {priority})"), F.lit(confidence)).otherwise(F.lit(0.0)))
    return kept.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base.label", "found.label"))), ",").alias("labels"),
        F.greatest(sure, F.when(F.size("base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(F.lit(0.0))).alias("score"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql(rules: list[Rule] | None = None) -> str:
    """The same in SQL: rules as a table, every rule against every text with its keyword, containment by NOT EXISTS."""
    rules = default_rules() if rules is None else rules
    rows = ",\n".join(f"({i}, {_quoted(r.label)}, {r.priority}, {CONFIDENCE[r.priority]!r}::DOUBLE, {_quoted(r.keyword)}, {_quoted(r.pattern)})" for i, r in enumerate(rules))
    phrases = ",\n".join(f"({i}, {_quoted(label)}, {_quoted(Rule(label, 0, p).pattern)})" for i, (label, p) in enumerate(BASE))
    n = "((strlen({0}) - strlen(replace({0}, ' ', ''))) // 2)"
    return f"""
WITH rules(rule, label, priority, confidence, keyword, pattern) AS (VALUES {rows}),
phrases(rule, label, pattern) AS (VALUES {phrases}),
parted AS (
    SELECT row_number() OVER () AS row, doc_id,
        trim(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{SEPARATORS}', '  ', 'g'), ' ') AS t
    FROM documents
),
docs AS (SELECT row, doc_id, CASE WHEN t = '' THEN '' ELSE ' ' || t || ' ' END AS norm FROM parted),
tried AS (
    SELECT row, 'rule' AS kind, rule, label, priority, confidence,
        string_split(regexp_replace(norm, pattern, chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS pieces
    FROM docs JOIN rules ON contains(norm, keyword)
    UNION ALL
    SELECT row, 'base', rule, label, 0, 0, string_split(regexp_replace(norm, pattern, chr(1) || '\\0' || chr(2), 'g'), chr(1))
    FROM docs, phrases
),
pieces AS (
    SELECT row, kind, rule, label, priority, confidence, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k
    FROM tried WHERE len(pieces) > 1
),
found AS (
    SELECT row, kind, rule, label, priority, confidence, k,
        CAST(coalesce(sum({n.format("piece")}) OVER (PARTITION BY row, kind, rule ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
        {n.format("split_part(piece, chr(2), 1)")} AS words
    FROM pieces
),
spans AS (SELECT *, start + words AS until FROM found WHERE k > 1),
kept AS (
    SELECT * FROM spans a WHERE kind = 'rule' AND NOT EXISTS (
        SELECT 1 FROM spans b WHERE b.kind = 'rule' AND b.row = a.row AND b.priority <= a.priority AND b.start <= a.start AND b.until >= a.until
            AND (b.start < a.start OR b.until > a.until OR b.priority < a.priority OR b.rule < a.rule))
),
by_base AS (
    SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM spans WHERE kind = 'base' GROUP BY row
),
by_any AS (
    SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS sure
    FROM (SELECT row, label, confidence FROM kept UNION ALL SELECT row, label, {BASE_CONFIDENCE}::DOUBLE FROM spans WHERE kind = 'base') GROUP BY row
)
SELECT doc_id, CAST({n.format("norm")} AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(sure, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN by_base USING (row) LEFT JOIN by_any USING (row)
"""


OP11_SQL = oracle_sql()
