r"""Toxicity: maximum-scoring segment search over token log-odds.

1. Weights. From labelled texts, each word's log-odds between toxic and clean texts
   with an informative Dirichlet prior (the pooled corpus, `PRIOR` words strong, and
   `FLOOR` for each word). A word counts once per text, so that one text that repeats a
   word proves little. Words whose z-score reaches `MIN_Z` keep their log-odds; a word
   that doesn't takes the log-odds of its stem (its first `STEM` letters) if those
   reach it; every other word costs `DRIFT`.
2. Segments. One linear scan finds all maximal scoring segments (no segment can be
   extended or joined with a neighbour for a gain).
3. Calibration. Under the null model of clean texts a segment score x occurs about
   `K * n * exp(-lambda * x)` times in n words (Karlin-Altschul extreme-value law):
   lambda solves `sum p_i exp(lambda s_i) = 1` over the word scores of clean texts, K is
   the rate of positive segments in them. A segment is significant below `MAX_E`
   expected chance occurrences. A text's evidence is the sum of -ln E over its
   significant segments; `score = evidence / (evidence + cut)`, with the cut that
   separates the labelled texts best.

Learning uses at most about `per_class` labelled texts of each class, chosen by a hash
of the id, so the model (weights of words that these texts hold, a few constants) is bounded;
scoring covers whole texts of all rows, one pass, no shuffle.

Defined cases: null, empty and wordless texts score 0; a text is toxic if any of its
label rows says so; null labels and ids are not learned from; without both classes every
text scores 0; repeated rows count as they come.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col, hash_share, remainder, sample_share, staged

PRIOR, FLOOR, MIN_Z, DRIFT, MAX_E, STEM = 1000.0, 0.5, 3.5, -0.5, 0.1, 6
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    weights: Mapping[str, float]
    rate: float  # lambda
    scale: float  # K
    cut: float


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def marked_words(words: list[str], weights: Mapping[str, float]) -> list[tuple[int, float]]:
    """Positions and weights of the words that have one, their own or their stem's (`stem*`)."""
    get, out = weights.get, []
    for i, w in enumerate(words):
        x = get(w)
        if x is None and len(w) > STEM:
            x = get(w[:STEM] + "*")
        if x is not None:
            out.append((i, x))
    return out


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, score).

    `scores` lists the words that differ from `drift`, by position. One pass: a
    candidate joins an earlier one whose left sum is lower if its right sum is higher.
    """
    found: list[tuple[int, int, float, float]] = []  # first, end, left sum, right sum
    total, at = 0.0, 0
    for place, score in scores:
        total += drift * (place - at)
        at = place + 1
        if score <= 0:
            total += score
            continue
        first, left = place, total
        total += score
        while found:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= total:
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
        found.append((first, at, left, total))
    return [(first, end, right - left) for first, end, left, right in found]


def evidence_of(words: list[str], model: Model) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Summed -ln E and the significant segments as (first word, end, score, E)."""
    out = []
    for first, end, score in segments(marked_words(words, model.weights)):
        log_e = math.log(model.scale * max(1, len(words))) - model.rate * score
        if log_e <= math.log(MAX_E):
            out.append((first, end, score, math.exp(log_e)))
    return -sum(math.log(max(e, 1e-300)) for *_, e in out), out


def _solve_rate(null: list[tuple[float, float]]) -> float:
    """The positive root of sum p exp(rate * s) = 1; the mean score is negative, so there is one."""
    low, high = 1e-6, 1.0
    total = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in null)
    while total(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if total(middle) < 1 else (low, middle)
    return low


def _best_cut(evidence: list[tuple[float, int]]) -> float:
    """The evidence between two neighbours that labels most texts right; of equals the lowest."""
    evidence = sorted(evidence)
    right = sum(label for _, label in evidence)  # everything predicted toxic
    best, cut, last = -1, 1.0, 0.0
    for i, (e, label) in enumerate(evidence):
        if e > last and right > best:
            best, cut = right, (last + e) / 2
        right += 1 - 2 * label
        last = e
    return cut if right <= best else last + 1.0


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id: str = "doc_id", text: str = "text",
          label: str = "toxic", per_class: int = 10_000) -> Model:
    """`usable` is an expression over the labels' id column."""
    marks = (labels.select(col(id).alias("id"), col(label).cast("int").alias("toxic"), usable.alias("usable"))
             .where("usable and id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic")))
    shares = sample_share({r.toxic: r.n for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}, per_class)
    if not (shares.get(0) and shares.get(1)):
        return Model({}, 1.0, 1.0, 1.0)
    share = F.when(F.col("toxic") == 1, shares[1]).when(F.col("toxic") == 0, shares[0]).otherwise(0.0)
    chosen = marks.where(hash_share(F.col("id")) < share)  # about 2 * per_class rows: a proven bound
    sample = staged(docs.select(col(id).alias("id"), col(text).alias("text")).join(F.broadcast(chosen), "id").select("text", "toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(words_of(text))
                seen[toxic].update(words | {w[:STEM] + "*" for w in words if len(w) > STEM})
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([s[w] for w in names], pa.int64()) for s in seen)],
                                         names=["word", "clean", "toxic"])

    counts = staged(sample.mapInArrow(count, "word string, clean bigint, toxic bigint")
                    .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    n = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.count("*").alias("words")).first()
    if not (n.clean and n.toxic):
        return Model({}, 1.0, 1.0, 1.0)
    prior = (F.col("clean") + F.col("toxic")) / F.lit(n.clean + n.toxic) * PRIOR + FLOOR
    odds = lambda c: (F.col(c) + prior) / (F.lit(n[c] + PRIOR + FLOOR * n.words) - F.col(c) - prior)
    log_odds = F.log(odds("toxic") / odds("clean"))
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    ranked = (counts.withColumns({"w": log_odds, "z": log_odds / error}).where(F.abs("z") >= MIN_Z)
              .orderBy("word").collect())  # words of the sample
    weights = {r.word: r.w for r in ranked}

    marked = sum(r.clean for r in ranked)
    null = [(r.w, (r.clean + 0.5) / (n.clean + 0.5 * len(ranked))) for r in ranked]
    null.append((DRIFT, (n.clean - marked) / (n.clean + 0.5 * len(ranked))))
    rate = _solve_rate(null) if any(s > 0 for s, _ in null) else 1.0

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                found.append(len(segments(marked_words(words_of(text), weights))))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["n"])

    chance = sample.where("toxic = 0").mapInArrow(positives, "n bigint").agg(F.sum("n")).first()[0] or 0
    rough = Model(weights, rate, (chance + 1) / n.clean, 1.0)
    rows = _with_evidence(sample.select(F.col("toxic").alias("id"), "text"), rough, "int").select("id", "evidence")
    return Model(weights, rate, rough.scale, _best_cut([(r.evidence, r.id) for r in rows.collect()]))


def _with_evidence(rows: DataFrame, model: Model, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence, passages = [], []
            for text in batch.column(1).to_pylist():
                e, found = evidence_of(words_of(text), model)
                evidence.append(e)
                passages.append([{"first": a, "end": b, "score": s, "expected": x} for a, b, s, x in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(evidence, pa.float64()), pa.array(passages, PASSAGES)],
                                             names=["id", "evidence", "passages"])

    return rows.mapInArrow(run, f"id {kind}, evidence double, "
                                "passages array<struct<first: bigint, end: bigint, score: double, expected: double>>")


PASSAGES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))


def score_toxicity(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, score, predicted, evidence, passages (word ranges, score, expected chance count)."""
    rows = docs.select(col(id).alias("id"), col(text).alias("text"))
    scored = _with_evidence(rows, model, rows.schema["id"].dataType.simpleString())
    score = F.col("evidence") / (F.col("evidence") + F.lit(float(model.cut)))
    return scored.select(F.col("id").alias(id), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "evidence", "passages")


def held_out(id: str = "doc_id") -> Column:
    """Rows that learning never sees: crc32 of the id modulo 5 is 0."""
    return F.coalesce(remainder(col(id), 5) == 0, F.lit(False))
