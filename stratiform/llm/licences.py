"""Licence notices in texts, by a positional index of their rarest words.

Notices and phrases are templates: words with places. The words of all templates are counted
over all documents, which gives their IDF. A file then looks up, for every template whose key
phrases it has the words of, the template's highest-IDF words it holds; each occurrence at word
``p`` of a word that stands at place ``q`` of the template votes for a notice starting at
``p - q``. Starts with enough votes are kept, and there the template's key phrases must stand
word for word. A phrase is a template that is its own key phrase, found from its rarest word
alone, so that every place of it is found.

Everything is DataFrame functions on a row's own arrays: two scans, and between them one small
aggregate, the document counts of the templates' words (at most as many rows as the templates
have words). Only they reach the driver. Texts do not move, and no step depends on how many
documents share a notice.

Defined results: a NULL or empty text has no words, no places, empty labels and score 0. Rows
that repeat a doc_id are judged each by itself, a NULL doc_id is kept, other columns are
ignored, and an empty table gives an empty result. Words of equal IDF are taken in the order of
their names. Overlapping places all count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and the labels they give.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Opening words of public licence notices, and what must stand in them word for word.
NOTICES = {
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["permission is hereby granted free of charge"]),
    "mit license": ("released under the mit license", ["mit license"]),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    "gpl-3.0": ("licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    "lgpl": ("under the terms of the gnu lesser general public license", ["lesser general public license"]),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["distribute this software for any purpose"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["cc by nc", "4 0"]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ["cc by sa", "4 0"]),
}
# Notices whose label is another's.
SAME_LABEL = {"mit license": "mit"}

RARE = 4
VOTES = 2

_LETTERS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def split_words(text: str) -> list[str]:
    return re.findall(_LETTERS, "".join(c.lower() if c.isascii() else c for c in text))


def _words(text: Column) -> Column:
    # lower() would make ASCII letters of these two signs; any other word sign does as well.
    for sign in ("K", "İ"):
        text = F.replace(text, F.lit(sign), F.lit("Å"))
    return F.regexp_extract_all(F.lower(text), F.lit(_LETTERS), F.lit(0))


@dataclass(frozen=True)
class Template:
    """Words with places; ``keys`` are ``(place, words)`` that must stand; the file's ``rare``
    rarest words vote, and a start needs ``votes``."""

    label: str
    words: list[str]
    keys: list[tuple[int, list[str]]] = field(default_factory=list)
    rare: int = RARE
    votes: int = VOTES
    base: bool = False

    @property
    def key_words(self) -> list[str]:
        return sorted({w for _, k in self.keys for w in k})


def phrase(text: str, label: str) -> Template:
    words = split_words(text)
    return Template(label, words, [(0, words)], rare=1, votes=1, base=True)


def notice(label: str, text: str, keys: Sequence[str]) -> Template:
    words = split_words(text)
    placed = []
    for key in map(split_words, keys):
        at = [i for i in range(len(words)) if words[i : i + len(key)] == key]
        if not key or not at:
            raise ValueError(f"{label}: the key phrase {key} must stand in the notice")
        placed.append((at[0], key))
    if not placed:
        raise ValueError(f"{label}: a notice needs a key phrase")
    return Template(label, words, placed, votes=min(VOTES, len(words)))


def templates(notices: Mapping = NOTICES, phrases: Mapping = PHRASES, same: Mapping = SAME_LABEL) -> list[Template]:
    return [phrase(t, label) for t, label in phrases.items()] + [notice(same.get(name, name), t, keys) for name, (t, keys) in notices.items()]


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _literal(t: Template, order: Mapping[str, int], idf: Mapping[str, float]) -> Column:
    total = sum(idf[w] for w in t.words)
    return F.struct(
        F.lit(t.label).alias("label"),
        F.lit(t.base).alias("base"),
        F.lit(t.rare).alias("rare"),
        F.lit(t.votes).alias("votes"),
        _strings(t.key_words).alias("key_words"),
        _strings(sorted(set(t.words), key=order.__getitem__)).alias("by_idf"),
        F.array(*[F.struct(F.lit(w).alias("word"), F.lit(q).alias("at"), F.lit(idf[w] / total).alias("share")) for q, w in enumerate(t.words)]).alias("posts"),
        F.array(*[F.struct(F.lit(at).alias("at"), _strings(k).alias("words")) for at, k in t.keys]).alias("keys"),
    )


def document_counts(words: DataFrame, vocabulary: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Documents in all, and those that hold each word; one row per word reaches the driver."""
    held = F.array_append(F.array_intersect(_strings(vocabulary), F.col("words")), F.lit(""))
    counts = {r["word"]: r["n"] for r in words.select(F.explode(held).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts.pop("", 0), counts


def _stands(words: Column, start: Column, key: Column) -> Column:
    at = start + key["at"]
    return F.when(at >= 0, F.slice(words, at + 1, F.size(key["words"])) == key["words"]).otherwise(False)


def scan_licences(docs: DataFrame, known: Sequence[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_words``; ``places``, an array of ``(label, base, start, share)`` with every
    place where a template was verified, ``share`` being the IDF-weighted part of the template's
    words that stand there; ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` of the
    phrases; ``labels`` of all; and ``score``, the largest share."""
    known = list(known) if known is not None else templates()
    vocabulary = sorted({w for t in known for w in t.words})
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), _words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("words"))
    n, counts = document_counts(words, vocabulary)
    idf = {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}

    text = F.col("words")
    rows = words.withColumn("held", F.array_intersect(_strings(vocabulary), text))
    # Templates whose key words the file has, each with the postings of its rarest words in the file.
    rows = rows.withColumn(
        "open",
        F.transform(
            F.filter(F.array(*[_literal(t, order, idf) for t in known]), lambda t: F.size(F.array_except(t["key_words"], F.col("held"))) == 0),
            lambda t: F.struct(
                *[t[c].alias(c) for c in ("label", "base", "votes", "posts", "keys")],
                F.filter(t["posts"], lambda p: F.array_contains(F.slice(F.array_intersect(t["by_idf"], F.col("held")), F.lit(1), t["rare"]), p["word"])).alias("looked_up"),
            ),
        ),
    )
    places = F.transform(text, lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("at"))))
    rows = rows.withColumn("seen", F.when(F.size("open") > 0, F.filter(places, lambda x: x.isNotNull())))
    rows = rows.withColumn(
        "open",
        F.transform(
            "open",
            lambda t: F.struct(
                *[t[c].alias(c) for c in ("label", "base", "votes", "posts", "keys")],
                F.array_sort(F.flatten(F.transform(t["looked_up"], lambda p: F.transform(F.filter(F.col("seen"), lambda s: s["word"] == p["word"]), lambda s: s["at"] - p["at"])))).alias("starts"),
            ),
        ),
    )
    verified = F.transform(
        "open",
        lambda t: F.transform(
            F.filter(
                F.array_distinct(F.filter(t["starts"], lambda s, i: F.get(t["starts"], i + t["votes"] - 1) == s)),
                lambda s: F.forall(t["keys"], lambda k: _stands(text, s, k)),
            ),
            lambda s: F.struct(
                t["label"].alias("label"),
                t["base"].alias("base"),
                s.cast("long").alias("start"),
                F.aggregate(t["posts"], F.lit(0.0), lambda sum_, p: sum_ + F.when(F.get(text, s + p["at"]) == p["word"], p["share"]).otherwise(0.0)).alias("share"),
            ),
        ),
    )
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.flatten(verified).alias("places"))
    rows = rows.withColumn("base_places", F.filter("places", lambda p: p["base"]))
    starts = F.transform("base_places", lambda p: p["start"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names("base_places").alias("base_labels"),
        names("places").alias("labels"),
        F.least(F.lit(1.0), F.round(F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)), 6)).alias("score"),
        "places",
    )


def oracle() -> str:
    """The same by joins: postings, votes and verified places as rows."""
    known = templates()
    literal = lambda w: "'" + w + "'"
    posts = ", ".join(f"({t}, {q}, {literal(w)})" for t, x in enumerate(known) for q, w in enumerate(x.words))
    keys = ", ".join(f"({t}, {at}, [{', '.join(map(literal, k))}])" for t, x in enumerate(known) for at, k in x.keys)
    heads = ", ".join(f"({t}, {literal(x.label)}, {x.base}, {x.rare}, {x.votes})" for t, x in enumerate(known))
    return rf"""
WITH heads AS (SELECT * FROM (VALUES {heads}) v(t, label, base, rare, votes)),
posts AS (SELECT * FROM (VALUES {posts}) v(t, place, word)),
keys AS (SELECT * FROM (VALUES {keys}) v(t, place, ws)),
files AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
),
seen AS (
  SELECT r, word, p - 1 AS p FROM (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM files)
  WHERE word IN (SELECT word FROM posts)
),
idf AS (
  SELECT v.word, count(DISTINCT r) AS df, ln(((SELECT count(*) FROM files) + 1) / (count(DISTINCT r) + 1)) + 1 AS idf
  FROM (SELECT DISTINCT word FROM posts) v LEFT JOIN seen USING (word) GROUP BY v.word
),
rare AS (
  SELECT r, t, word FROM (
    SELECT r, t, word, row_number() OVER (PARTITION BY r, t ORDER BY df, word) AS k
    FROM (SELECT DISTINCT r, word FROM seen) JOIN (SELECT DISTINCT t, word FROM posts) USING (word) JOIN idf USING (word)
  ) JOIN heads USING (t) WHERE k <= rare
),
starts AS (
  SELECT r, t, p - place AS s FROM seen JOIN rare USING (r, word) JOIN posts USING (t, word) JOIN heads USING (t)
  GROUP BY r, t, s, votes HAVING count(*) >= votes
),
verified AS (
  SELECT r, t, s FROM starts JOIN files USING (r) JOIN keys USING (t)
  GROUP BY r, t, s HAVING bool_and(s + place >= 0 AND list_slice(files.ws, s + place + 1, s + place + len(keys.ws)) = keys.ws)
),
shares AS (
  SELECT r, t, s, sum(CASE WHEN s + place >= 0 AND ws[s + place + 1] = word THEN idf ELSE 0 END) / sum(idf) AS share
  FROM verified JOIN files USING (r) JOIN posts USING (t) JOIN idf USING (word) GROUP BY r, t, s
),
found AS (
  SELECT r, count(*) FILTER (WHERE base) AS n_base, min(s) FILTER (WHERE base) AS first_word, max(s) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM shares JOIN heads USING (t) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, least(1.0::DOUBLE, round(coalesce(score, 0.0), 6)::DOUBLE) AS score
FROM files LEFT JOIN found USING (r)
"""
