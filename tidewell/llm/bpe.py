r"""Byte-level BPE: encoding texts by a rank table, and decoding ids.

The pattern cuts texts into pieces inside the JVM.

Common pieces. Distinct pieces of the corpus are counted, and the `COMMON` most frequent
ones (a bounded number; pieces of equal count are taken or left together) are merged by
higher-order functions: a fold over the piece's bytes that merges, at each step, the
adjacent pair of lowest rank, leftmost first, until no pair has a rank. Ranks come from
a literal map, an array of buckets by crc32, so a look-up costs the same for any
vocabulary. The result, a few megabytes, goes to all tasks.

Other pieces. A corpus has no bound on its distinct pieces, so they cannot go to all
tasks, and joining every occurrence to them would shuffle more than the texts. A task
merges those it meets itself, once for each distinct piece of a batch, remembers them (at
most `CACHE`, then it starts anew), with the same rule: short pieces all at once as arrays,
long ones on a heap, so that a piece of any length takes n log n steps. The README has the figures that led to this division.

Ids are carried as little-endian unsigned 32-bit integers in one binary value per text;
decoding concatenates the tokens' bytes.

Defined cases: a null text is the empty text and has no ids; whole texts are encoded;
special tokens do not exist, their strings are ordinary text; repeated rows are encoded
alike.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col, ragged, staged

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

CACHE = 50_000
#: Pieces merged beforehand, and the longest of them in bytes.
COMMON, LONGEST = 20_000, 48
#: Pieces of so many bytes at most are merged together, without a heap.
SHORT = 64
_BUCKETS, _NONE = 1 << 16, 1 << 40

#: White space as the Unicode property has it; Java's `\s` alone is ASCII only.
WHITE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def java_pattern(pattern: str) -> str:
    """The pattern with Unicode white space spelt out for Java."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two in (r"\s", r"\S"):
            if two == r"\s":
                out.append(WHITE if inside else f"[{WHITE}]")
            else:
                assert not inside, r"\S within a class is not supported"
                out.append(f"[^{WHITE}]")
            i += 2
        elif two[0] == "\\":
            out.append(two)
            i += 2
        else:
            inside = two[0] == "[" or (inside and two[0] != "]")
            out.append(two[0])
            i += 1
    return "".join(out)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank; a vocabulary file holds tens of thousands of lines, whatever the corpus."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class Merger:
    """The merges of many short pieces at once, as numpy arrays; the rest on a heap.

    A pair of adjacent tokens is looked up by their ids in a sorted table of all pairs
    that some token can be cut into; a token's id is its rank.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values(), default=0) + 1
        keys, values = array("q"), array("q")  # a pair makes one token, so no key comes twice
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    values.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys, self.values = np.array(keys, dtype=np.int64)[order], np.array(values, dtype=np.int64)[order]
        self.single = np.array([ranks.get(bytes([i]), 0) for i in range(256)], dtype=np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, 4 bytes each."""
        out: list[bytes] = [b""] * len(pieces)
        short = [i for i, p in enumerate(pieces) if len(p) <= SHORT and len(self.keys)]
        for i in set(range(len(pieces))) - set(short):
            out[i] = np.array(merge(pieces[i], self.ranks), dtype="<u4").tobytes()
        names = np.array([i for i in short if pieces[i]], dtype=np.int64)
        ids = self.single[np.frombuffer(b"".join(pieces[i] for i in names.tolist()), dtype=np.uint8)]
        owner = np.repeat(names, np.fromiter((len(pieces[i]) for i in names.tolist()), dtype=np.int64, count=len(names)))
        held = np.full(len(ids), _NONE, dtype=np.int64)  # rank of each token with the next of its piece
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        held[inside] = self._ranks(ids[inside], ids[inside + 1])
        while len(ids):
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lengths = np.diff(np.concatenate([begins, [len(ids)]]))
            least = np.minimum.reduceat(held, begins)
            done = least == _NONE
            if done.any():
                flat, ends = ids.astype("<u4").tobytes(), begins + lengths
                for b, e in zip(begins[done].tolist(), ends[done].tolist()):
                    out[owner[b]] = flat[4 * b: 4 * e]
                stay = np.repeat(~done, lengths)
                ids, owner, held = ids[stay], owner[stay], held[stay]
                least, lengths = least[~done], lengths[~done]
                if not len(ids):
                    break
            at = np.flatnonzero(held == np.repeat(least, lengths))
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]  # the leftmost of each piece
            ids[at] = least
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            held[at] = _NONE
            ids, owner, held = ids[keep], owner[keep], held[keep]
            at = at - np.arange(len(at))
            after = at[(at + 1 < len(ids))]
            after = after[owner[after + 1] == owner[after]]
            held[after] = self._ranks(ids[after], ids[after + 1])
            before = at[at > 0] - 1
            before = before[owner[before] == owner[before + 1]]
            held[before] = self._ranks(ids[before], ids[before + 1])
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0: merged into one before it
    previous = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two parts has been merged since
        end[i], end[middle] = stop, 0
        if stop < n:
            previous[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (before := previous[i]) >= 0 and (r := ranks.get(piece[before:stop])) is not None:
            heapq.heappush(heap, (r, before, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The rank table as a literal: an array of buckets, each a short array of (token, rank)."""
    buckets: list[list[dict]] = [[] for _ in range(_BUCKETS)]
    for token, rank in ranks.items():
        buckets[zlib.crc32(token) % _BUCKETS].append({"token": base64.b64encode(token).decode(), "rank": rank})
    # A function of a literal: Spark folds it to the array itself while it plans.
    return F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<token:binary,rank:int>>>")


def folded(pieces: DataFrame, ranks: dict[bytes, int], piece: str = "piece") -> DataFrame:
    """Adds `ids`, an array: the ranked merges of each piece as a fold over its bytes."""
    none = F.lit(1 << 30)

    def encoded(buckets: Column) -> Column:
        def rank(token: Column) -> Column:
            bucket = F.get(buckets, (F.crc32(token) % _BUCKETS).cast("int"))
            return F.coalesce(F.get(F.filter(bucket, lambda e: e["token"] == token), F.lit(0))["rank"], none)

        def merged(state: Column) -> Column:
            """The leftmost pair of lowest rank becomes one part; the ranks beside it are looked up anew."""
            parts, held = state["parts"], state["held"]
            at = (F.array_position(held, F.array_min(held)) - 1).cast("int")
            pair = F.concat(F.get(parts, at), F.get(parts, at + 1))
            joined = F.concat(F.slice(parts, F.lit(1), at), F.array(pair), F.slice(parts, at + 3, F.size(parts)))
            nothing = F.array().cast("array<int>")
            before = F.when(at > 0, F.array(rank(F.concat(F.get(parts, at - 1), pair)))).otherwise(nothing)
            after = F.when(at + 2 < F.size(parts), F.array(rank(F.concat(pair, F.get(parts, at + 2))))).otherwise(nothing)
            ranked = F.concat(F.slice(held, F.lit(1), F.greatest(at - 1, F.lit(0))), before, after, F.slice(held, at + 3, F.size(held)))
            return F.struct(joined.alias("parts"), ranked.alias("held"))

        def step(state: Column, _: Column) -> Column:
            return F.when(F.coalesce(F.array_min(state["held"]), none) < none, merged(state)).otherwise(state)

        last = F.size("parts") - 2
        pairs = F.transform(F.sequence(F.lit(0), last), lambda i: rank(F.concat(F.get("parts", i), F.get("parts", i + 1))))
        begun = F.struct(F.col("parts"), F.when(last >= 0, pairs).otherwise(F.array().cast("array<int>")).alias("held"))
        return F.transform(F.aggregate(F.col("parts"), begun, step)["parts"], rank)

    data = F.col(piece).cast("binary")
    with_bytes = pieces.withColumn("parts", F.transform(F.sequence(F.lit(1), F.length(data)), lambda i: F.substring(data, i, F.lit(1))))
    # Bound to a lambda variable, the map stands in the plan once.
    return with_bytes.select(*pieces.columns, F.get(F.transform(F.array(rank_map(ranks)), encoded), F.lit(0)).alias("ids"))


def common_pieces(pieces: DataFrame, ranks: dict[bytes, int], most: int = COMMON) -> dict[str, bytes]:
    """The most frequent pieces and their ids; `pieces` has one array of pieces per row."""
    counts = staged(pieces.select(F.explode("pieces").alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))
                    .where((F.col("n") > 1) & (F.octet_length("piece") <= LONGEST)))
    held, cut = 0, 1
    for r in counts.groupBy("n").agg(F.count("*").alias("pieces")).orderBy(F.desc("n")).toLocalIterator():
        held += r.pieces
        if held > most:
            cut = r.n
            break
    chosen = folded(counts.where(F.col("n") > cut).select("piece"), ranks)
    return {r.piece: np.array(r.ids, dtype="<u4").tobytes() for r in chosen.collect()}  # at most `most` rows


def _pieces(docs: DataFrame, pattern: str, id: str, text: str) -> DataFrame:
    whole = F.coalesce(col(text), F.lit(""))
    return docs.select(col(id).alias("id"), F.regexp_extract_all(whole, F.lit(java_pattern(pattern)), F.lit(0)).alias("pieces"))


def _encoder(rows: DataFrame, ranks: dict[bytes, int]) -> Batches:
    """From batches of (id, pieces) to batches of (id, ids)."""
    common, merger = common_pieces(rows.select("pieces"), ranks), Merger(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(common)
        for batch in batches:
            for begin, end in piece_slices(batch.column(1)):
                part = batch.slice(begin, end - begin)
                lists = part.column(1)
                offsets = np.asarray(lists.offsets, dtype=np.int64)
                words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
                codes = np.asarray(words.indices, dtype=np.int64)
                if len(known) > len(common) + CACHE:
                    known = dict(common)
                distinct = words.dictionary.to_pylist()
                new = [w for w in distinct if w not in known]
                for at in range(0, len(new), 20_000):  # the arrays stay small
                    known.update(zip(new[at:at + 20_000], merger.merge([w.encode() for w in new[at:at + 20_000]])))
                ids = [known[w] for w in distinct]
                lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
                flat = np.frombuffer(b"".join(ids), dtype="<u4")
                each = lengths[codes]
                out = flat[ragged((np.cumsum(lengths) - lengths)[codes], each)]
                cuts = np.concatenate([[0], np.cumsum(each)])[offsets - offsets[0]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    names=["id", "ids"])

    return run


def _decoder(ranks: dict[bytes, int]) -> Batches:
    """From batches of (id, ids) to batches of (id, ids, decoded)."""
    pieces = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if b is None else b"".join(map(pieces.__getitem__, np.frombuffer(b, dtype="<u4").tolist()))
                   for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=["id", "ids", "decoded"])

    return run


def _mapped(rows: DataFrame, run: Batches, columns: str, id: str) -> DataFrame:
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {columns}").withColumnRenamed("id", id)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, ids (binary, 4 bytes per token)."""
    rows = _pieces(docs, pattern, id, text)
    return _mapped(rows, _encoder(rows, ranks), "ids binary", id)


def decode(encoded: DataFrame, ranks: dict[bytes, int], id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per input row: id, ids, decoded (binary); a null stays null."""
    return _mapped(encoded.select(col(id).alias("id"), col(ids).alias("ids")), _decoder(ranks), "ids binary, decoded binary", id)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What `decode` gives for what `encode` gives; both steps in one Python worker, so a task has one and not two."""
    rows = _pieces(docs, pattern, id, text)
    encoded, decoded = _encoder(rows, ranks), _decoder(ranks)
    return _mapped(rows, lambda batches: decoded(encoded(batches)), "ids binary, decoded binary", id)


def piece_slices(lists: pa.ListArray, most: int = 200_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` pieces, one row at least."""
    offsets, begin, n = np.asarray(lists.offsets, dtype=np.int64), 0, len(lists)
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1)
        yield begin, min(end, n)
        begin = end


def digests(decoded: DataFrame, id: str = "doc_id") -> DataFrame:
    return decoded.select(col(id), (F.length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
