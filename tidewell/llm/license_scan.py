r"""License scan: exact set-similarity join of text blocks with license templates.

A template is a set of words. It is found in a text block that contains at least
`threshold` of its words. The join prunes as set-similarity joins do:

* order: template words are ranked by how often they occur in the whole corpus, rarest
  first (one aggregation; only words of templates are counted);
* prefix: a block that holds `need = ceil(threshold * m)` of a template's m words must
  hold one of the `m - need + 1` rarest, so only places of these words are looked at;
* length: a block with fewer than `need` words is skipped;
* position: the place of a prefix word in the text says which blocks (or, for an ordered
  phrase, which single start) it can belong to.

Candidates are then verified by counting the shared words. The template side is a
parameter of a few hundred words, so its prefix index is part of the expression and the
join runs where the text is read: no shuffle, and no text is copied.

Blocks of a template of L words are the word ranges [k L, k L + 2 L): each run of L words
lies in one. An ordered template (a phrase) is found where its words stand consecutively;
its block is the run of L words at that start, with threshold 1.

Words are what remains between ASCII characters other than digits and letters, letters
A-Z in lower case; other characters count as letters. Defined cases: a null text is
empty; without words there is no finding; repeated rows are judged alike; whole texts of
any length. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col, lower_ascii

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    ordered: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def distinct(self) -> list[str]:
        return list(dict.fromkeys(self.words))

    @property
    def need(self) -> int:
        return len(self.distinct) if self.ordered else math.ceil(round(self.threshold * len(self.distinct), 9))


#: Fixed phrases and labels of the registered query.
PHRASES = (
    Template("gpl", "gnu general public license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("cc-by", "cc by", 1.0, True),
    Template("mit", "mit license", 1.0, True),
)

#: Opening sentences of widespread licenses, as words.
TEMPLATES = (
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
                    "gnu general public license as published by the free software foundation"),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met"),
    Template("cc-by", "this work is licensed under the creative commons attribution international license"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                    "hereby granted"),
    Template("public-domain", "this is free and unencumbered software released into the public domain"),
)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def ranked(docs: DataFrame, templates: Sequence[Template], text: str = "text") -> dict[str, int]:
    """Rank of every template word, rarest first; one row per template word reaches the driver."""
    vocabulary = sorted({w for t in templates for w in t.distinct})
    counted = (docs.select(F.explode(F.filter(words_of(col(text)), lambda w: w.isin(vocabulary))).alias("word"))
               .groupBy("word").agg(F.count("*").alias("n")).collect())
    counts = {r.word: r.n for r in counted}
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def _prefix(t: Template, rank: dict[str, int]) -> list[str]:
    return sorted(t.distinct, key=rank.__getitem__)[: len(t.distinct) - t.need + 1]


def _minus(n: int) -> Callable[[Column], Column]:
    return lambda x: x - n


def _labelled(label: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(F.lit(label).alias("label"), s.cast("long").alias("at"))


def _starts(t: Template, rank: dict[str, int]) -> Column:
    """Where an ordered template stands."""
    rare, size = _prefix(t, rank)[0], len(t.words)
    whole = F.array(*map(F.lit, t.words))
    at = F.transform(F.filter("hits", lambda h: h["w"] == rare), lambda h: h["i"])
    begins = [F.transform(at, _minus(o)) for o, w in enumerate(t.words) if w == rare]
    fits = F.filter(F.array_distinct(F.concat(*begins)), lambda s: (s >= 0) & (s + size <= F.size("words")))
    return F.filter(fits, lambda s: F.slice("words", s + 1, F.lit(size)) == whole)


def _blocks(t: Template, rank: dict[str, int]) -> Column:
    """Every block that reaches an unordered template's threshold: its first word and the share of the template's words in it."""
    stride, m = len(t.words), len(t.distinct)
    near = F.filter("hits", lambda h: h["w"].isin(_prefix(t, rank)))
    own = F.transform(near, lambda h: F.floor(h["i"] / stride).cast("int"))
    blocks = F.array_distinct(F.concat(own, F.filter(F.transform(own, lambda b: b - 1), lambda b: b >= 0)))
    long_enough = F.filter(blocks, lambda b: F.size("words") - b * stride >= t.need)
    whole = F.array(*map(F.lit, t.distinct))
    shared = F.transform(long_enough, lambda b: F.struct(
        (b * stride).cast("long").alias("at"), F.size(F.array_intersect(whole, F.slice("words", b * stride + 1, F.lit(2 * stride)))).alias("n")))
    enough = F.array_sort(F.filter(shared, lambda s: s["n"] >= t.need))
    return F.transform(enough, lambda s: F.struct(F.lit(t.label).alias("label"), s["at"].alias("at"), (s["n"] / F.lit(float(m))).alias("share")))


def scan(docs: DataFrame, phrases: Sequence[Template] = PHRASES, templates: Sequence[Template] = TEMPLATES,
         id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_words, places (label and first word of each phrase), found (label, first word
    and containment of every block that reaches a template's threshold, by template, then place)."""
    every = [*phrases, *templates]
    rank = ranked(docs, every, text)
    wanted = sorted({w for t in every for w in _prefix(t, rank)})
    rows = docs.select(col(id).alias("id"), words_of(col(text)).alias("words"))
    marked = F.transform("words", lambda w, i: F.when(w.isin(wanted), F.struct(i.alias("i"), w.alias("w"))))
    rows = rows.select("id", "words", F.filter(marked, lambda h: h.isNotNull()).alias("hits"))
    places = F.concat(*[F.transform(_starts(t, rank), _labelled(t.label)) for t in phrases])
    found = F.concat(*[_blocks(t, rank) for t in templates])
    any_hit = F.size("hits") > 0
    out = rows.select("id", F.size("words").cast("long").alias("n_words"),
                      F.coalesce(F.when(any_hit, places), F.array().cast("array<struct<label:string,at:bigint>>")).alias("places"),
                      F.coalesce(F.when(any_hit, found), F.array().cast("array<struct<label:string,at:bigint,share:double>>")).alias("found"))
    return out.withColumnRenamed("id", id)


def digests(scanned: DataFrame, id: str = "doc_id") -> DataFrame:
    at, base = F.col("places")["at"], F.col("places")["label"]
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.col("found")["share"]), F.lit(0.0)))
    return scanned.select(col(id), "n_words", F.size("places").cast("long").alias("n_base"),
                          F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                          joined(base).alias("base_labels"),
                          joined(F.concat(base, F.col("found")["label"])).alias("labels"), score.alias("score"))
