r"""URL filter: all rules at once in a bit-parallel wildcard automaton.

A URL is canonicalised to host + path (scheme, query and fragment fall away, the
host is lower-cased). Rules become globs over that string:

* `*` stands for any run of bytes without `/`, `**` for any run at all;
* a rule (host, path) is the two globs `host path**` and `*.host path**`.

All globs are packed into one row of 64-bit words (Shift-And): state i of a glob
means that its first i literal bytes are matched. One byte c moves all states of all
globs together, `D = ((D << 1) & B[c]) | (D & S[c])`, where B marks the states whose
literal is c and S those that may stay because a wildcard follows them. Words carry
their top bit into the next, so a glob may cross words. Each URL is read once; a batch
of URLs advances byte by byte as numpy arrays, so the work is bytes x words, whatever
the number of globs that share a prefix.

Defined cases: a null url or one without `://` has empty host and path; it fits no
rule and goes to the fallback globs like any other. Equal rows give equal results,
very long URLs are read whole, other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col, lower_ascii


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


#: Fixed rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

#: What to block where no rule fits: hosts and paths that hold link farms, logins and traps.
FALLBACK_BLOCK = ("*spam*", "*spam*/**", "*casino*", "*casino*/**", "*porn*", "*porn*/**",
                  "**/wp-login.php**", "**/cgi-bin/**", "**/calendar/*/*/*/**")


class Automaton:
    """Globs packed into masks; `matches` tells for each text which globs fit it whole."""

    def __init__(self, globs: Sequence[str]):
        literals: list[int | None] = []  # one state each; None: the state before a glob's first literal
        stays: list[str] = []  # wildcard that follows the state
        self.final: list[int] = []
        for glob in globs:
            literals.append(None)
            stays.append("")
            for part in re.findall(rb"\*+|[^*]", glob.encode()):
                if part.startswith(b"*"):
                    stays[-1] = max(stays[-1], part.decode()[:2])
                else:
                    literals.append(part[0])
                    stays.append("")
            self.final.append(len(literals) - 1)
        self.words = max(1, -(-len(literals) // 64))
        self.step = np.zeros((256, self.words), dtype=np.uint64)
        self.stay = np.zeros((256, self.words), dtype=np.uint64)
        self.start = np.zeros(self.words, dtype=np.uint64)
        for i, (literal, wild) in enumerate(zip(literals, stays)):
            word, bit = i // 64, np.uint64(1 << (i % 64))
            if literal is None:
                self.start[word] |= bit
            else:
                self.step[literal, word] |= bit
            if wild:
                self.stay[:, word] |= bit
            if wild == "*":
                self.stay[ord("/"), word] &= ~bit

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix, texts x globs."""
        n = len(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=n)
        order = np.argsort(-lengths, kind="stable")
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        active = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), side="left")
        state = np.tile(self.start, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        for at, k in enumerate(active):
            c, now = data[begins[:k] + at], state[:k]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:k] = (moved & self.step[c]) | (now & self.stay[c])
        found = np.empty((n, len(self.final)), dtype=bool)
        for g, i in enumerate(self.final):
            found[order, g] = (state[:, i // 64] >> np.uint64(i % 64)) & one
        return found


def canonical(urls: DataFrame, url: str) -> DataFrame:
    """Adds host and path."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(col(url), F.lit(""))
    return urls.select("*", lower_ascii(F.regexp_extract(text, whole, 1)).alias("host"),
                       F.regexp_extract(text, whole, 2).alias("path"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, fallback_block: Sequence[str] = FALLBACK_BLOCK,
               id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    The longest fitting rule decides (of equals the first). Where none fits, `rule` is
    null and a url is blocked if one of `fallback_block` fits it, else allowed.
    """
    best_first = sorted(rules, key=lambda r: -len(r.name))
    globs = [g for r in best_first for g in r.globs()] + list(fallback_block)
    n, automaton = len(best_first), Automaton(globs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2048):
                part = batch.slice(begin, 2048)
                texts = [(h + p).encode() for h, p in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                found = automaton.matches(texts)
                fits = np.column_stack([found[:, : 2 * n].reshape(len(texts), n, 2).any(axis=2),
                                        np.ones(len(texts), dtype=bool)])
                first, blocked = fits.argmax(axis=1), found[:, 2 * n:].any(axis=1)
                names = [best_first[i].name if i < n else None for i in first]
                verdicts = [best_first[i].verdict if i < n else "block" if b else "allow"
                            for i, b in zip(first, blocked)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(names, pa.string()),
                     pa.array(verdicts, pa.string())], names=["id", "host", "path", "rule", "verdict"])

    rows = canonical(pages.select(col(id).alias("id"), col(url).alias("url")), "url").select("id", "host", "path")
    kind = rows.schema["id"].dataType.simpleString()
    judged = rows.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", id)
