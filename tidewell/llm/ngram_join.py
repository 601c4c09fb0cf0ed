r"""Exact n-gram Jaccard join with prefix filters under several global token orders.

Sets. A text's tokens are its distinct shingles of `WIDTH` words (64-bit fingerprints of
the lower-cased words; a shorter text is one token). Texts with equal sets form a class;
the join runs between classes, so copies are never expanded into pairs.

Candidates. If |A n B| >= t |A u B|, the first `|A| - ceil(t |A|) + 1` tokens of both
under one common order of all tokens share a token. The first order is by frequency,
rarest first: counts of all tokens are kept in a table of `2^bits` counters (its size
is bounded whatever the corpus; tokens that share a counter are ranked by their sum),
ties by fingerprint. Only prefix tokens are shuffled. Pairs must also pass the length filter and
the positional filter. The other orders are by seeded hashes: a set carries, for each of `ORDERS`, its
prefix as a bitmap of `BITS` bits, and beside these one of `ODD` bits that tell whether an odd number of
its tokens falls on them. A candidate pair goes before any text is fetched if its bitmaps do not meet
under every order, or if the last ones differ in more bits than two linked sets have tokens that
only one holds. A bitmap may let a pair pass, but never drops one that links.

Hot tokens. Tokens that the very same sets hold name the same pairs, so they become one that stands
for them all: near copies of a long text share hundreds of such. A token's sets are never paired off at once. In a round, each token names one of
its sets, in turn any or one of the component of most sets, chosen by a hash that changes with the
round; each set is compared with one that its tokens name, where a token counts the more the fewer
sets it has, if that lies in another component. So a round has at most one pair for each set. Links
give components, and tokens whose sets lie in one component are done. The first round takes all
tokens that several sets share; the next, up to `ROUNDS`, those of more than `FEW` sets, in each
round four times as many as in the one before, of which the last has linked one set in twenty.
Only what is then left in several components is joined with itself, across components: a pair
within one is known to be connected. Rows carry the parities into that join, and the `EARLIER`
tokens of their set that stand before theirs, so it gives out only pairs that pass them, at the
first token they share. So a large group of near copies costs some comparisons for each row, and
no link between different components is lost. Components, not all links, are the result.

Texts meet only for candidate pairs, by joins on the id of one text of each class: all texts are dealt
for the first round, for the sets that later rounds can ask for, which are kept, and for the last
join, and not even these times where at most `SMALL` pairs ask, which are counted and broadcast. Tokens are
counted by aggregations, which tasks begin before the shuffle, and joined back without a hint,
so Spark can split a hot one. Tokens that are known from their counters to have less than 2^12
places are counted by windows, which cost one shuffle less.

Defined cases: null, empty and wordless texts have no tokens and link with nothing; a
null id has a set size, but no component and no links; rows that share an id are one
node, linked by either text; texts of any length are read whole.
"""

from __future__ import annotations

import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import LOWER, UPPER, checkpointed, col, staged
from tidewell.llm.graph import components

WIDTH = 5
#: The threshold as a fraction of whole numbers: 100 * common >= 75 * union.
SHARE = (75, 100)
#: Rounds in which each set is compared with one set; tokens of at most `FEW` sets take part in the first alone.
ROUNDS, FEW = 8, 4
#: Tokens before its own that a row carries into the last join; a pair that shares one of them is given out there.
EARLIER = 16
#: Seeded orders beside the first, the bits in which a set carries its prefix under each, and those of its parities.
ORDERS, BITS, ODD = 2, 512, 1024
#: Class of a counter below 2^12.
LIGHT = 23
#: So many pairs, and what is known of their sets (some 300 bytes each), are handed to all tasks.
SMALL = 50_000
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MASK = (1 << 64) - 1
_CHUNK = 1 << 16


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Token sets of texts; one per task."""

    def __init__(self):
        self.bytes = mixed(np.arange(256, dtype=np.uint64), 77)
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        """Powers of an odd number and of its inverse, modulo 2^64."""
        odd = 0xD1342543DE82EF95
        self.power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, odd, dtype=np.uint64))])
        self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, pow(odd, -1, 1 << 64), dtype=np.uint64))])

    def words(self, text: str | None) -> bytes:
        return b" ".join((text or "").encode().translate(_FOLD).split())

    def word_prints(self, joined: bytes) -> np.ndarray:
        """One fingerprint per word: polynomial over the word's bytes, then mixed."""
        data = np.frombuffer(joined, dtype=np.uint8)
        if len(data) >= len(self.power):
            self.grow(2 * len(data))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.bytes[data] * self.power[: len(data)])])
        spaces = np.flatnonzero(data == 32)
        begins, ends = np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(data)]])
        return mixed((sums[ends] - sums[begins]) * self.inverse[begins], 3)

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The sorted distinct tokens of each text."""
        begin = 0
        while begin < len(texts):
            held, parts = 0, []
            while begin < len(texts) and (not parts or held < 1 << 18):
                parts.append(self.words(texts[begin]))
                held += len(parts[-1])
                begin += 1
            counts = [p.count(b" ") + 1 if p else 0 for p in parts]
            filled = b" ".join(p for p in parts if p)
            w = self.word_prints(filled) if filled else np.zeros(0, dtype=np.uint64)
            placed = [mixed(w, 10 + j) for j in range(WIDTH)]
            whole = sum((placed[j][j: len(w) - WIDTH + 1 + j] for j in range(1, WIDTH)), placed[0][: max(0, len(w) - WIDTH + 1)])
            at = 0
            for n in counts:
                if n >= WIDTH:
                    yield np.unique(whole[at: at + n - WIDTH + 1])
                elif n:
                    short = sum((placed[j][at + j: at + j + 1] for j in range(1, n)), placed[0][at: at + 1])
                    yield mixed(short, 100 + n)
                else:
                    yield np.zeros(0, dtype=np.uint64)
                at += n


def set_print(tokens: np.ndarray) -> int | None:
    """A fingerprint of a whole set; none for an empty one."""
    return int(mixed(tokens, 5).sum(dtype=np.uint64).view(np.int64)) if len(tokens) else None


def prefix_length(n: int) -> int:
    return n - (SHARE[0] * n + SHARE[1] - 1) // SHARE[1] + 1


#: Columns that carry a set's bitmaps, 64 bits each: first those of the orders, then the parities.
WORDS = [f"b{i}" for i in range((ORDERS * BITS + ODD) // 64)]
PARITIES = WORDS[ORDERS * BITS // 64:]


def bitmaps(tokens: np.ndarray) -> np.ndarray:
    """The prefixes under the seeded orders, `BITS` bits each, and the `ODD` parities of the whole set, as 64-bit words."""
    n, held = prefix_length(len(tokens)), np.zeros((ORDERS, BITS), dtype=bool)
    for seed in range(ORDERS):
        ranked = mixed(tokens, 200 + seed)
        held[seed, (np.partition(ranked, n - 1)[:n] % np.uint64(BITS)).astype(np.int64)] = True
    odd = np.bincount((mixed(tokens, 300) % np.uint64(ODD)).astype(np.int64), minlength=ODD) % 2 == 1
    return np.packbits(np.concatenate([held.ravel(), odd]), bitorder="little").view("<i8")


def _few_differ(x: str, y: str, n_x: Column, n_y: Column) -> Column:
    """Whether parities differ in no more places than so many tokens as two linked sets of these sizes may
    not share; `x` and `y` stand before the columns' names."""
    odd = reduce(Column.__add__, [F.bit_count(F.col(x + w).bitwiseXOR(F.col(y + w))) for w in PARITIES])
    least = F.ceil((n_x + n_y) * SHARE[0] / (SHARE[0] + SHARE[1]))  # tokens that linked sets share
    return odd <= n_x + n_y - 2 * least


def _may_link(x: str, y: str) -> Column:
    """Whether two sets' bitmaps share a bit under each of the seeded orders, and their parities allow a link."""
    met = _few_differ(x, y, F.col(x + "n"), F.col(y + "n"))
    for seed in range(ORDERS):
        own = WORDS[seed * BITS // 64:(seed + 1) * BITS // 64]
        met = met & (reduce(Column.bitwiseOR, [F.col(x + w).bitwiseAND(F.col(y + w)) for w in own]) != 0)
    return met


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact comparison."""
    if SHARE[1] * min(len(a), len(b)) < SHARE[0] * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return SHARE[1] * common >= SHARE[0] * (len(a) + len(b) - common)


def frequency_classes(texts: DataFrame, bits: int) -> np.ndarray:
    """For each counter the logarithmic class of the number of tokens counted in it: 2^bits bytes."""
    shift, chunks = np.uint64(64 - bits), max(1, (1 << bits) // _CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, shingler = np.zeros(1 << bits, dtype=np.uint32), Shingler()
        for batch in batches:
            for tokens in shingler.sets(batch.column(0).to_pylist()):
                np.add.at(counters, (tokens >> shift).astype(np.int64), 1)
        for i in range(chunks):
            part = counters[i * _CHUNK: (i + 1) * _CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())],
                                                 names=["chunk", "counts"])

    def add(i: int, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(min(1 << bits, _CHUNK), dtype=np.uint64)
        for batch in parts:
            for packed in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(packed), dtype=np.uint32)
        classes = (2 * np.log2(total + 1.0)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([classes.tobytes()], pa.binary())], names=["chunk", "counts"])

    def added(key: tuple, parts: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(add(key[0].as_py(), iter(parts.to_batches()))))

    counted = texts.mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(added, "chunk int, counts binary")
    classes = np.zeros(1 << bits, dtype=np.uint8)
    for r in counted.collect():  # 2^bits bytes in all
        part = np.frombuffer(r.counts, dtype=np.uint8)
        classes[r.chunk * _CHUNK: r.chunk * _CHUNK + len(part)] = part
    return classes


def token_sets(docs: DataFrame, classes: np.ndarray, kind: str) -> DataFrame:
    """(id, n, set, print, prefix, light, bitmaps) of every row, `print` a hash of the text; prefix, how many of
    its tokens are light, and bitmaps only where the task meets the set first in a row with an id."""
    shift = np.uint64(65 - int(len(classes)).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, met = Shingler(), set()
        for batch in batches:
            sizes, prints, prefixes, light, bits = [], [], [], [], []
            nothing = np.zeros(len(WORDS), dtype=np.int64)
            named = batch.column(0).is_valid().to_pylist()
            for known, tokens in zip(named, shingler.sets(batch.column(1).to_pylist())):
                sizes.append(len(tokens))
                prints.append(set_print(tokens))
                new = known and len(tokens) and prints[-1] not in met
                if new:
                    if len(met) > 200_000:
                        met.clear()
                    met.add(prints[-1])
                    rank = (classes[(tokens >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (mixed(tokens, 9) >> np.uint64(8))
                    first = np.argsort(rank)[: prefix_length(len(tokens))]
                prefixes.append(tokens[first].tobytes() if new else None)
                light.append(int((rank[first] >> np.uint64(56) <= LIGHT).sum()) if new else None)
                bits.append(bitmaps(tokens) if new else nothing)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), batch.column(2),
                                              pa.array(prefixes, pa.binary()), pa.array(light, pa.int32()),
                                              *map(pa.array, np.array(bits, dtype=np.int64).reshape(-1, len(WORDS)).T)],
                                             names=["id", "n", "set", "print", "prefix", "light", *WORDS])

    hashed = docs.select("*", F.xxhash64(col(docs.columns[1])).alias("_print"))
    return hashed.mapInArrow(run, f"id {kind}, n bigint, set bigint, print bigint, prefix binary, light int, " + ", ".join(f"{w} bigint" for w in WORDS))


def prefix_tokens(sets: DataFrame) -> DataFrame:
    """(token, set, n, at, light): the prefix tokens, their places, and whether they are light."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column(2).to_pylist()
            lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 8
            tokens = np.frombuffer(b"".join(raw), dtype=np.int64)
            at = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            of_row = lambda i: np.repeat(np.asarray(batch.column(i)), lengths)  # noqa: B023, E731
            columns = [tokens, of_row(0), of_row(1).astype(np.int32), at.astype(np.int32), at < of_row(3)]  # the rarest stand first
            for begin in range(0, len(tokens), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[begin:begin + 100_000]) for c in columns], names=["token", "set", "n", "at", "light"])

    rows = sets.where("prefix is not null and id is not null").select("set", "n", "prefix", "light")
    return rows.mapInArrow(run, "token bigint, set bigint, n int, at int, light boolean")


def shared_tokens(sets: DataFrame) -> DataFrame:
    """(token, set, n, at, many, c, weight, held) of the tokens of several sets; each set is its own component yet.

    `token` names the sets that hold it, so tokens of the same sets become one, which stands first among them in
    each set; `many` of the set's rows went into it. Should two lists of sets ever get one name, they are taken together.
    """
    tokens, hashed = prefix_tokens(sets), F.xxhash64("set")
    of_token = {"low": F.min("set"), "high": F.max("set"), "held": F.count("*"),
                "upper": F.sum(F.shiftright(hashed, 32)), "lower": F.sum(hashed.bitwiseAND(F.lit(0xFFFFFFFF)))}
    by_token = Window.partitionBy("token")
    light = tokens.where("light").select("*", *[c.over(by_token).alias(name) for name, c in of_token.items()])
    heavy = tokens.where("not light")
    heavy = heavy.join(heavy.groupBy("token").agg(*[c.alias(name) for name, c in of_token.items()]), "token").select(*light.columns)
    shared = light.union(heavy).where("low < high").withColumn("token", F.xxhash64(*of_token))
    one = shared.groupBy("token", "set").agg(F.min("n").alias("n"), F.min("at").alias("at"), F.count("*").alias("many"), F.max("held").alias("held"))
    return staged(one.select("token", "set", "n", "at", "many", F.col("set").alias("c"), F.lit(1).cast("long").alias("weight"), "held"))


def _near_in_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * SHARE[1] >= F.greatest(a, b) * SHARE[0]


def marks_of(sets: DataFrame) -> DataFrame:
    """(set, n, bitmaps), a row for each set that takes part."""
    return staged(sets.where("prefix is not null").select("set", "n", *WORDS).dropDuplicates(["set"]))


def texts_of(wanted: DataFrame, docs: DataFrame, sets: DataFrame, small: bool = False) -> DataFrame:
    """(set, text) of the sets in `wanted`, one text for each. `docs`: id, text; `sets`: id, set, print."""
    few = F.broadcast if small else lambda df: df
    holders = sets.where("id is not null").join(few(wanted), "set", "left_semi").groupBy("set").agg(F.min(F.struct("id", "print")).alias("of"))
    # Of the texts that share an id, the one meant.
    return docs.withColumn("print", F.xxhash64("text")).join(few(holders.select("set", "of.*")), ["id", "print"]).select("set", "text")


def verified(pairs: DataFrame, marks: DataFrame, texts: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """The pairs (a, b) of sets that are similar; `pairs` is written, `texts` gives the texts of wanted sets."""
    small = pairs.count() <= SMALL
    few = F.broadcast if small else lambda df: df
    of = lambda side: marks.select(F.col("set").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", *WORDS)])
    known = of("b").join(few(of("a").join(few(pairs), "a")), "b")
    pairs = staged(known.where(_may_link("a_", "b_")).select("a", "b"))
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
    texts = texts(wanted, small)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, known = Shingler(), OrderedDict()

        def tokens_of(name: int, text: str) -> np.ndarray | None:
            """None for a text that is not of the set `name`."""
            if name in known:
                known.move_to_end(name)
                return known[name]
            tokens = next(shingler.sets([text]))
            if set_print(tokens) != name:
                return None
            known[name] = tokens
            if len(known) > 64:
                known.popitem(last=False)
            return tokens

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for x, y, text_x, text_y in zip(a, b, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                left, right = tokens_of(x, text_x), tokens_of(y, text_y)
                keep.append(left is not None and right is not None and similar(left, right))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(texts.select(F.col("set").alias("b"), F.col("text").alias("right")), "b")
            .join(texts.select(F.col("set").alias("a"), F.col("text").alias("left")), "a"))
    return both.select("a", "b", "left", "right").mapInArrow(compare, "a bigint, b bigint")


def _reached(links: DataFrame) -> DataFrame:
    """(set, c, weight): the component of each linked set, and its size."""
    found = checkpointed(components(links).withColumnsRenamed({"node": "set", "component": "c"}))
    return found.join(found.groupBy("c").agg(F.count("*").alias("weight")), "c")


def _in_several(tokens: DataFrame, reached: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """The rows of tokens whose sets lie in several components, with their component `c`, its size `weight`,
    how many sets the token has, `held`, and how many of them the links in `new` have met, `moved`."""
    marked = (tokens.join(reached, "set", "left")
              .withColumns({"c": F.coalesce("c", "set"), "weight": F.coalesce("weight", F.lit(1)), "met": F.lit(None).cast("boolean")}))
    if new is not None:
        met = new.select(F.explode(F.array("a", "b")).alias("set")).distinct()
        marked = marked.drop("met").join(met.withColumn("met", F.lit(True)), "set", "left")
    several = marked.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"),
                                          F.count("*").alias("held"), F.count("met").alias("moved")).where("low < high")
    return staged(marked.join(several.select("token", "held", "moved"), "token").select(*tokens.columns, "c", "weight", "held", "moved"))


def _one_each(tokens: DataFrame, turn: int) -> DataFrame:
    """(a, b): each set with one that its tokens name, those of few sets above all, if it is in another component.

    Where the rows carry parities, only sets that these allow to link are named.
    """
    first = F.lit(0).cast("long") if turn % 2 else -F.col("weight")
    known = [c for c in PARITIES if c in tokens.columns]
    order = F.struct(first.alias("w"), (F.xxhash64(F.lit(turn), "set") if turn else F.col("set")).alias("h"), "set", "n", "c", *known)
    chosen = tokens.groupBy("token").agg(F.min(order).alias("p"))
    may = (F.col("c") != F.col("p.c")) & _near_in_size(F.col("n"), F.col("p.n"))
    if known:
        may = may & _few_differ("", "p.", F.col("n"), F.col("p.n"))
    named = (tokens.join(chosen, "token").where(may)
             .groupBy("set", F.col("p.set").alias("other")).agg((-F.sum(F.col("many") * F.floor(F.lit(1 << 20) / F.col("held")))).alias("votes")))
    best = named.groupBy("set").agg(F.min(F.struct("votes", "other")).alias("p"))
    return best.select(F.least("set", "p.other").alias("a"), F.greatest("set", "p.other").alias("b")).distinct()


def _with_earlier(tokens: DataFrame) -> DataFrame:
    """Adds `earlier`: the last `EARLIER` tokens of the row's set that stand before its own."""
    return tokens.withColumn("earlier", F.collect_list("token").over(Window.partitionBy("set").orderBy("at", "token").rowsBetween(-EARLIER, -1)))


def _across(tokens: DataFrame) -> DataFrame:
    """(a, b): sets of different components that share a token and pass the filters that the rows allow.

    Sets that share many tokens meet at each of them, but are given out only where neither's earlier tokens
    hold one they share: the first that they share, in the order of either, is always such a place.
    """
    x, y = tokens.alias("x"), tokens.alias("y")
    need = F.ceil((F.col("x.n") + F.col("y.n")) * SHARE[0] / (SHARE[0] + SHARE[1]))
    bound = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    pair = ((F.col("x.token") == F.col("y.token")) & (F.col("x.set") < F.col("y.set")) & (F.col("x.c") != F.col("y.c"))
            & _near_in_size(F.col("x.n"), F.col("y.n")) & (bound >= need))
    pair = pair & _few_differ("x.", "y.", F.col("x.n"), F.col("y.n")) & ~F.arrays_overlap("x.earlier", "y.earlier")
    return x.join(y, pair).select(F.col("x.set").alias("a"), F.col("y.set").alias("b"))


def near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id."""
    rows = docs.select(col(id).alias("id"), col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    bits = max(16, min(24, (16 * max(1, rows.count())).bit_length()))
    sets = staged(token_sets(rows, frequency_classes(rows.select("text"), bits), kind))

    marks = marks_of(sets)
    every_text = lambda wanted, small: texts_of(wanted, rows, sets, small)
    texts = every_text

    parities = marks.select("set", *PARITIES)

    hot, aside, links, reached = shared_tokens(sets), [], None, None
    for turn in range(ROUNDS):
        new = staged(verified(staged(_one_each(hot, turn)), marks, texts))
        found = new.count()
        if found:
            links = new if links is None else links.union(new)
            reached = _reached(links)
            hot = _in_several(hot.drop("c", "weight", "held", "moved"), reached, new)
        again = F.col("held") > FEW << 2 * turn
        if turn:
            again = again & (F.col("moved") * 20 >= F.col("held") if found else F.lit(False))
        aside.append(hot.where(~again).select("token", "set", "n", "at"))
        hot = hot.where(again)
        if not turn:
            hot = staged(hot.join(parities, "set"))
            bodies = staged(texts_of(hot.select("set").distinct(), rows, sets))
            texts = lambda wanted, small: bodies.join(F.broadcast(wanted) if small else wanted, "set", "left_semi")  # noqa: B023, E731
        if hot.isEmpty():
            break
    left_over = reduce(DataFrame.unionByName, [*aside, hot.select("token", "set", "n", "at")])
    left_over = left_over.withColumn("c", F.col("set")) if reached is None else _in_several(left_over, reached)
    left_over = _with_earlier(left_over.select("token", "set", "n", "at", "c")).join(parities, "set")
    across = staged(_across(left_over).distinct())
    every = staged(verified(across, marks, every_text))
    every = every if links is None else links.union(every)

    members = sets.where("id is not null and set is not null").select("id", "set")
    of_sets = components(every).withColumnsRenamed({"node": "set", "component": "c"})
    joined = members.join(of_sets, "set", "left").select("id", F.coalesce("c", "set").alias("c"))
    # Checkpointed, so that the join deals both sides itself and Spark can split a hot component.
    least = checkpointed(joined.groupBy("c").agg(F.min("id").alias("component_id")))
    named = joined.join(least, "c").select("id", "component_id")
    final = components(named, "id", "component_id").withColumnsRenamed({"node": "id", "component": "component_id"})  # an id in two classes joins them
    return (sets.select("id", "n").join(final, "id", "left")
            .select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))



def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, all columns, whose id is the smallest of its component; one row of each such id
    (of several the one of smallest hash), and every row with a null id."""
    found = staged(near_copies(docs, id, text).select(F.col(id).alias("id"), "component_id").where("id is not null"))
    gone = found.where("component_id <> id").select("id").distinct()
    again = found.where("component_id = id").groupBy("id").count().where("count > 1").select("id")
    rows = docs.select(F.struct("*").alias("row"), col(id).alias("key"))  # the columns of `docs` clash with nothing
    once = rows.join(gone.union(again).withColumnRenamed("id", "key"), "key", "left_anti")
    several = rows.join(again.withColumnRenamed("id", "key"), "key", "left_semi")
    whole = lambda row: F.xxhash64(*[row.getField(c) for c in docs.columns])
    first = several.groupBy("key").agg(F.min_by("row", whole(F.col("row"))).alias("row"))  # rows of one hash are the same
    return once.select("row").union(first.select("row")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
