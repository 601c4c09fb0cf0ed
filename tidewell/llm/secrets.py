r"""Secret scans through a trigram inverted index; DataFrame functions only.

1. From each rule's regular expression a Boolean trigram query is derived: an OR of sets
   of trigrams (of the lower-cased text), one of which any matching text must hold whole.
2. The index holds, for each trigram that some query names, the postings (id) of the
   texts that contain it. Postings of one text are combined in the task that read it, so
   one short row per text is shuffled to intersect them.
3. Only candidate texts are matched with the rule itself. A rule without a mandatory
   trigram, such as a bare run of hex digits, scans all texts.

Candidates return to their texts by a join on the id without a hint: Spark broadcasts
them if they are measured to be small, else both sides are dealt by id.

Matches are leftmost and non-overlapping for each rule; one whose decisive group is too
short is dropped, but its characters count as consumed. Positions are code points, end
exclusive. Starts come from the lengths of what `split` leaves between the matches.

Defined cases: a null text is empty and has no spans; a null id cannot be posted, so its
text is matched with all rules; texts that share an id are candidates together; repeated
rows give repeated results; whole texts count, of any length.
"""

from __future__ import annotations

import re
import re._constants as parsed
import re._parser as parser
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col

Query = frozenset[frozenset[str]]
ANYTHING: Query = frozenset([frozenset()])
#: Alternatives that a derived query or a set of literal strings may have before it is made weaker.
MOST = 24


@dataclass(frozen=True)
class Rule:
    """`least` characters are needed in `group` of a match. `pattern` must mean the same to Java and Python."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    #: A block of lines in which other rules may match: `redact` replaces it before these cut it.
    block: bool = False


#: Fixed rules of the registered query.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)

#: From the header of a key to its END line, if no other run of five dashes comes first; else through
#: lines of headers, the base64 lines (line breaks may be written as backslash and n) that follow, and one
#: shorter last line: with its padding, or with what ends the line.
_BREAK = r"(?:\x20|\x09)*+(?:\r?\n|\r|(?:\\r)?\\n)(?:\x20|\x09)*+"
_PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:"
    r"[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----|"
    rf"(?:{_BREAK}[A-Za-z-]++:\x20[^\r\n\\]*+)*+(?:{_BREAK})?+"
    rf"(?:(?:{_BREAK}|\x20++)?+[A-Za-z0-9+/]{{40,}}+={{0,2}}+)*+"
    rf"(?:(?:{_BREAK}|\x20++)?+[A-Za-z0-9+/]{{1,39}}+(?:={{1,2}}+|\x20*+(?:\r?\n|\r|(?:\\r)?\\n|[\"'`]|$)))?+)"
)


def without_possessives(pattern: str) -> str:
    """The same language for engines that have no possessive repeats and do not backtrack: they only save steps here."""
    return re.sub(r"([*+?}])\+", r"\1", pattern)


#: Further kinds of credentials with a recognisable form.
MORE = (
    Rule("private_key", _PRIVATE_KEY, block=True),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{20,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("url_password", r"[a-z]{2,12}://[A-Za-z0-9._-]+:[^\x20\x09-\x0D@/]{6,}@"),
)


# ---- from a regular expression to a trigram query -------------------------------------


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _either(queries: Sequence[Query]) -> Query:
    every = frozenset().union(*queries)
    least = frozenset(q for q in every if not any(other < q for other in every))
    return least if len(least) <= MOST else ANYTHING


def _both(a: Query, b: Query) -> Query:
    joined = _either([frozenset(x | y for x in a for y in b)])
    return joined if joined != ANYTHING else a if a != ANYTHING else b


def _of_strings(strings: frozenset[str]) -> Query:
    return _either([frozenset([_trigrams(s)]) for s in strings]) if strings else ANYTHING


def _analyse(node) -> tuple[frozenset[str] | None, Query]:
    """All strings the expression can stand for, if few, else None; and what any match must hold."""
    strings, query = frozenset([""]), ANYTHING
    for op, value in node:
        own, needed = _element(op, value)
        if own is not None and len(own) * len(strings) <= MOST:
            strings = frozenset(a + b for a, b in product(strings, own))
            continue
        query = _both(query, _of_strings(strings))
        query = _both(query, needed)
        strings, exact = own if own is not None else frozenset([""]), own is not None
        if not exact:
            query = _both(query, _analysed_rest(node, op, value))
            return None, query
    return strings, _both(query, _of_strings(strings)) if query != ANYTHING else _of_strings(strings)


def _analysed_rest(node, op, value) -> Query:
    at = next(i for i, x in enumerate(node) if x[0] is op and x[1] is value)
    return _analyse(list(node)[at + 1:])[1]


def _element(op, value) -> tuple[frozenset[str] | None, Query]:
    if op is parsed.LITERAL:
        return frozenset([chr(value).lower()]), ANYTHING
    if op is parsed.IN:
        chars = set()
        for kind, x in value:
            if kind is parsed.LITERAL:
                chars.add(chr(x).lower())
            elif kind is parsed.RANGE and x[1] - x[0] < 8:
                chars.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None, ANYTHING
        return (frozenset(chars) if len(chars) <= 8 else None), ANYTHING
    if op is parsed.SUBPATTERN:
        return _analyse(value[-1])
    if op is parsed.BRANCH:
        parts = [_analyse(x) for x in value[1]]
        every = frozenset().union(*(s for s, _ in parts)) if all(s is not None for s, _ in parts) else None
        return every, _either([q for _, q in parts])
    if op in (parsed.MAX_REPEAT, parsed.MIN_REPEAT):
        low, high, inner = value
        own, needed = _analyse(inner)
        if low == 0:
            return (own | {""} if own is not None and high == 1 else None), ANYTHING
        if low == high == 1:
            return own, needed
        return None, needed if own is None else _of_strings(own)
    if op is parsed.AT:
        return frozenset([""]), ANYTHING
    return None, ANYTHING


def trigram_query(pattern: str) -> Query:
    """The sets of trigrams of which any text that matches must hold one; `ANYTHING` if none can be told."""
    return _analyse(parser.parse(pattern))[1]


# ---- index and candidates -------------------------------------------------------------


def postings(docs: DataFrame, trigrams: Sequence[str], id: str = "doc_id", text: str = "text") -> DataFrame:
    """(trigram number, id) for every text that holds the trigram, letters in either case."""
    rows = docs.select(col(id).alias("id"), F.lower(col(text)).alias("low")).where("id is not null")
    held = F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)])
    return rows.select("id", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, Query], trigrams: Sequence[str]) -> DataFrame:
    """(id, flag of each rule) for the ids whose postings satisfy a query."""
    number, words = {t: i for i, t in enumerate(trigrams)}, range(-(-len(trigrams) // 62))
    bit = F.when(F.col("trigram") >= 0, F.expr("shiftleft(1L, trigram % 62)"))
    masks = index.groupBy("id").agg(*[F.coalesce(F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w, bit)), F.lit(0).cast("long"))
                                      .alias(f"m{w}") for w in words])
    flags = []
    for name, query in queries.items():
        met = F.lit(False)
        for need in query:
            whole = F.lit(True)
            for w in words:
                bits = sum(1 << (number[t] % 62) for t in need if number[t] // 62 == w)
                whole = whole & (F.col(f"m{w}").bitwiseAND(F.lit(bits).cast("long")) == F.lit(bits).cast("long"))
            met = met | whole
        flags.append(met.alias(name))
    found = masks.select("id", *flags)
    return found.where(" or ".join(f"`{name}`" for name in queries))


# ---- matches --------------------------------------------------------------------------


def running(values: Column, block: int = 128) -> Column:
    """Running sums of an array: within blocks from the block's own start, so long arrays stay cheap."""
    add, zero = lambda a, b: a + b, F.lit(0).cast("long")
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(block))

    def of_block(start: Column) -> Column:
        before = F.aggregate(F.slice(values, F.lit(1), start - 1), zero, add)
        own = F.slice(values, start, F.lit(block))
        sums: Callable[[Column], Column] = lambda base: F.transform(
            own, lambda _, i: base + F.aggregate(F.slice(own, F.lit(1), i + 1), zero, add))
        return F.element_at(F.transform(F.array(before), sums), 1)

    return F.flatten(F.transform(starts, of_block))


def _matched(df: DataFrame, rules: Sequence[Rule], wanted: dict[str, Column]) -> DataFrame:
    """Adds, for each rule, its matches, their decisive groups and what lies between."""
    for n, r in enumerate(rules):
        some = F.when(wanted[r.kind], F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)))
        df = df.withColumn(f"whole{n}", F.coalesce(some, F.array().cast("array<string>")))
    extra = {}
    for n, r in enumerate(rules):
        any_match = F.size(f"whole{n}") > 0
        extra[f"between{n}"] = F.when(any_match, F.split("text", F.lit(r.pattern), -1))
        if r.group:
            extra[f"group{n}"] = F.when(any_match, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group)))
    return df.withColumns(extra)


def _long_enough(n: int, r: Rule) -> Callable[[Column], Column]:
    decisive = f"group{n}" if r.group else f"whole{n}"
    return lambda i: F.length(F.get(F.col(decisive), i)) >= r.least


def _steps(n: int) -> Column:
    """For each match, its distance from the start of the match before (the first: from the text's)."""
    whole, between = F.col(f"whole{n}"), F.col(f"between{n}")
    return F.transform(F.sequence(F.lit(0), F.size(whole) - 1),
                       lambda i: F.length(F.get(between, i)).cast("long") + F.coalesce(F.length(F.get(whole, i - 1)), F.lit(0)))


def _spans(n: int, r: Rule) -> Column:
    whole, some = F.col(f"whole{n}"), F.size(f"whole{n}") > 0
    spans = F.transform(running(F.col(f"steps{n}")), lambda s, i: F.struct(
        s.alias("start"), F.lit(n).alias("place"), (s + F.length(F.get(whole, i))).alias("end"),
        F.lit(r.kind).alias("kind"), _long_enough(n, r)(i).alias("valid")))
    kept = F.transform(F.filter(spans, lambda s: s["valid"]), lambda s: s.dropFields("valid"))
    return F.when(some, kept).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:bigint,place:int,end:bigint,kind:string>>"


def _gated(docs: DataFrame, rules: Sequence[Rule], id: str, text: str, carry: bool) -> tuple[DataFrame, dict[str, Column]]:
    """Rows (`row`: all input columns if carried, else the id) with id and text; for each rule, whether to match it."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    gated = {k: q for k, q in queries.items() if q != ANYTHING and frozenset() not in q}
    kept = F.struct("*") if carry else F.struct(col(id).alias("id"))
    rows = docs.select(kept.alias("row"), col(id).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    wanted = {r.kind: F.lit(True) for r in rules}
    if gated:
        trigrams = sorted({t for q in gated.values() for need in q for t in need})
        found = candidates(postings(rows, trigrams, "id", "text"), {f"want_{k}": q for k, q in gated.items()}, trigrams)
        rows = rows.join(found, "id", "left")
        wanted |= {k: F.coalesce(F.col(f"`want_{k}`"), F.col("id").isNull()) for k in gated}
    return rows, wanted


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, spans (start, place of the rule in the list, end, kind), by start, then rule."""
    rows, wanted = _gated(docs, rules, id, text, carry=False)
    places = range(len(rules))
    found = _matched(rows, rules, wanted).withColumns({f"steps{n}": F.when(F.size(f"whole{n}") > 0, _steps(n)) for n in places})
    arrays = found.select("row", *[_spans(n, r).alias(f"s{n}") for n, r in enumerate(rules)])
    return arrays.select(F.col("row.id").alias(id), F.array_sort(F.concat(*[f"s{n}" for n in places])).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(scanned: DataFrame, base: Sequence[Rule] = BASE, id: str = "doc_id") -> DataFrame:
    own = F.filter("spans", lambda s: s["place"] < len(base))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(col(id), *[count(r.kind).alias(f"n_{r.kind}") for r in base],
                          F.sha2(listed(own).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: Sequence[Rule] = BASE + MORE, id: str = "doc_id", text: str = "text",
           length: str | None = None) -> DataFrame:
    """The same rows and columns; each secret in the text is replaced by its kind in brackets.
    `length` names a column that holds the number of characters, to follow.

    Rules of blocks apply first, then the others in their order, each to the text that the
    earlier ones left, so overlapping secrets end in one mark.
    """
    rows, wanted = _gated(docs, rules, id, text, carry=True)
    for r in sorted(rules, key=lambda r: not r.block):
        rows = _matched(rows, [r], wanted)
        marked = F.zip_with("whole0", "group0" if r.group else "whole0",
                            lambda w, g: F.when(F.length(g) >= r.least, F.lit(f"[{r.kind}]")).otherwise(w))
        new = F.array_join(F.zip_with("between0", marked, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")
        rows = rows.withColumn("text", F.when(F.size("whole0") > 0, new).otherwise(F.col("text")))
    new = F.when(F.col("row").getField(text).isNotNull(), F.col("text"))
    rows = rows.select("row", new.alias("new"))
    changed = {text: F.col("new")}
    if length:
        kind = docs.schema[length].dataType
        changed[length] = F.when(F.col("new").eqNullSafe(F.col("row").getField(text)), F.col("row").getField(length)).otherwise(F.length("new").cast(kind))
    return rows.select(*[changed.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns])
