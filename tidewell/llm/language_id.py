"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds the vectors of
its letters, each permuted (rolled) by its place: `roll(a, 2) * roll(b, 1) * c`. A text
is the bundle (sum) of its trigrams' vectors; a language is the bundle of the unit
vectors of its texts. The prediction is the language of largest cosine.

Letters are lower-cased; a to z keep their own symbol, all other letters share 37
symbols by code point, and a run of anything else is one blank. So there are 64^3
trigrams at most, and a task makes the vector of a trigram when it first meets it.

Learning uses at most about `per_language` texts of each language, chosen by a hash of
the id; everything else covers whole texts of all rows. The profiles are one row of
`DIM` numbers per language code, which is all that reaches the driver.

Defined cases: a null text or one without a letter is `und` with score 0; so is every
text if nothing could be learned. Equal cosines go to the smaller language code. Rows
with a null id are predicted but never learned from. Repeated rows count as they come.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col, hash_share, remainder, sample_share, text_slices

DIM = 512
SYMBOLS = 64
UNKNOWN = "und"
_SCALE = float(1 << 20)


def _symbol(cp: int) -> int:
    ch = chr(cp)
    if "a" <= ch <= "z":
        return cp - 96
    return 27 + cp % 37 if ch.isalpha() else 0


class Profiler:
    """Turns texts into bundles; one per task."""

    def __init__(self, dim: int = DIM, seed: int = 20):
        letters = np.random.default_rng(seed).choice(np.array([-1, 1], dtype=np.int8), (SYMBOLS, dim))
        self.first, self.second, self.third = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
        self.table = np.array([_symbol(c) for c in range(1 << 16)], dtype=np.uint8)
        self.row = np.full(SYMBOLS ** 3, -1, dtype=np.int32)
        self.vectors = np.empty((1024, dim), dtype=np.int8)
        self.n = 0

    def symbols(self, text: str) -> np.ndarray:
        """A blank, the letters with single blanks between runs, a blank."""
        cps = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        s = self.table[np.minimum(cps, 0xFFFF)]
        for at in np.flatnonzero(cps > 0xFFFF):
            s[at] = _symbol(int(cps[at]))
        s = np.concatenate([[0], s, [0]]).astype(np.int32)
        return s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]

    def rows(self, codes: np.ndarray) -> np.ndarray:
        new = codes[self.row[codes] < 0]
        if len(new):
            while self.n + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
            a, b, c = new // SYMBOLS ** 2, new // SYMBOLS % SYMBOLS, new % SYMBOLS
            self.vectors[self.n:self.n + len(new)] = self.first[a] * self.second[b] * self.third[c]
            self.row[new] = np.arange(self.n, self.n + len(new))
            self.n += len(new)
        return self.row[codes]

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        """texts x dim; a row of zeros without a letter."""
        out = np.zeros((len(texts), self.vectors.shape[1]), dtype=np.float32)
        for i, text in enumerate(texts):
            s = self.symbols(text or "")
            if len(s) < 3:
                continue
            codes, counts = np.unique((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], return_counts=True)
            rows = self.rows(codes)  # may grow the table of vectors
            out[i] = counts.astype(np.float32) @ self.vectors[rows].astype(np.float32)
        return out


def unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


def learn(docs: DataFrame, usable: Column, id: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = 5000) -> tuple[list[str], np.ndarray]:
    """Language codes in order and their unit profiles, from the rows where `usable` holds."""
    rows = docs.select(col(id).alias("id"), col(text).alias("text"), col(lang).alias("lang"), usable.alias("usable"))
    rows = rows.where("usable and lang is not null and text is not null and id is not null")
    shares = sample_share({r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}, per_language)
    if not shares:
        return [], np.zeros((0, DIM))
    share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(), defaultdict(lambda: np.zeros(DIM, dtype=np.int64))
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=object)
            for begin, end in text_slices(texts):
                whole = np.rint(unit(profiler.bundles(texts[begin:end])) * _SCALE).astype(np.int64)
                for code in set(langs[begin:end]):
                    sums[code] += whole[langs[begin:end] == code].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                                         names=["lang", "sums"])

    parts = rows.where(hash_share(F.col("id")) < share).select("text", "lang").mapInArrow(run, "lang string, sums array<bigint>")
    summed = parts.select("lang", F.posexplode("sums").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    profiles = {r.lang: [x.x for x in sorted(r.cells)] for r in
                summed.groupBy("lang").agg(F.collect_list(F.struct("at", "x")).alias("cells")).collect()}
    codes = sorted(profiles)
    return codes, unit(np.array([profiles[c] for c in codes], dtype=np.float64).reshape(len(codes), DIM))


def predicted(profiler: Profiler, texts: list[str | None], codes: list[str], profiles: np.ndarray) -> tuple[list[str | None], list[float]]:
    """The language of largest cosine and that cosine, not below 0; none for a text without a letter."""
    bundles = profiler.bundles(texts)
    known, cosines = bundles.any(axis=1), unit(bundles) @ profiles.T
    best = cosines.argmax(axis=1)
    scores = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0)
    return [codes[b] if k else None for b, k in zip(best, known)], scores.tolist()


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (the cosine, not below 0)."""
    codes, profiles = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler()
        for batch in batches:
            texts, langs, scores = batch.column(1).to_pylist(), [], []
            for begin, end in text_slices(texts):
                found = predicted(profiler, texts[begin:end], codes, profiles) if codes else ([None] * (end - begin), [0.0] * (end - begin))
                langs += [UNKNOWN if x is None else x for x in found[0]]
                scores += found[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["id", "lang_pred", "score"])

    rows = docs.select(col(id).alias("id"), col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id)


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows, all their columns, whose text `identify` gives a language; only `und` ones go. A null
    `lang` becomes the language identified, a value that is there stays. Where nothing could be
    learned, the rows whose text has a letter stay as they are. Only the text is handed to Python.
    """
    codes, profiles = model

    @F.arrow_udf("string")
    def named(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        profiler = Profiler()
        for column in columns:
            langs: list[str] = []
            texts = column.to_pylist()
            for begin, end in text_slices(texts):
                langs += predicted(profiler, texts[begin:end], codes or [UNKNOWN], profiles if codes else np.ones((1, DIM)))[0]
            # An empty string tells a text with a letter, where nothing is learned, from one without.
            yield pa.array([None if x is None else x if codes else "" for x in langs], pa.string())

    once = named.asNondeterministic()  # the filter below doesn't compute it again
    with_name = docs.select(F.struct("*").alias("row"), once(col(text)).alias("named")).where("named is not null")
    filled = {lang: F.coalesce(F.col("row").getField(lang), F.nullif("named", F.lit("")))} if lang in docs.columns else {}
    return with_name.select(*[filled.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def held_out(id: str = "doc_id") -> Column:
    """Rows that learning never sees: crc32 of the id modulo 4 is 2."""
    return F.coalesce(remainder(col(id), 4) == 2, F.lit(False))
