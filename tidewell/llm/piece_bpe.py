r"""Encoding and decoding by a vocabulary of scored pieces with merges (the BPE kind of a sentencepiece model).

What is computed. A text gets a blank in front, blanks become `▁`, and starting from single
characters the adjacent pair whose concatenation is the piece of highest score is merged,
leftmost first, until no pair is a piece. A character that is no piece becomes its bytes.

How. Merging one pair after the other is not done over texts. A sequence of pieces is the
result of the merges if and only if every two neighbours are compatible, that is, if merging
the two of them alone gives these two again. So a word is read from left to right:

* one pass of an Aho-Corasick automaton finds the longest piece that begins at each place;
* the longest piece is taken if it is compatible with the one before, else the next shorter
  piece that is its prefix, and so on;
* where none fits, the place is marked as failed in a bitfield and the piece before is
  replaced by its next shorter prefix. A failed place is never entered again, so a word of
  any length takes steps in proportion to its length.

Compatibility is found by merging the two pieces anew: each goes through its own merges,
of which those that change its part at the border are kept with the lowest score on the way
there; whichever side waits for less goes on, and if at any time the two parts at the border
score higher than that, they would merge and the pieces don't go together. Answers are
remembered (at most `PAIRS`). Pieces that their own merges do not give can never occur and
take no part.

No piece holds a blank after another character, so a text falls into words (a run of blanks
and what follows it) that are encoded on their own; a task remembers those it has met last (about
`CACHE` to twice as many). Nothing is shuffled or sent to the driver: an encoding is
one pass over the texts, and a task that is lost is simply run again.

Defined cases: a null text is the empty text, which has the end id alone; whole texts are
encoded, long ones in cuts between words; strings of control pieces are ordinary text; a
`▁` in a text is a blank, as the library has it; repeated rows are encoded alike. Decoding
drops the blank in front; bytes that form no character become U+FFFD; null ids stay null.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import col

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

BLANK = "▁"
#: Words and pairs of pieces that a task remembers, and the longest such word.
CACHE, PAIRS, LONGEST = 200_000, 500_000, 40
#: Characters after which a long text is cut at the next word.
CUT = 1 << 18
_WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_NEXT_WORD = re.compile(f"(?<=[^{BLANK}]){BLANK}")


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says; some megabytes at most, whatever the corpus."""

    scores: dict[str, float]
    ids: dict[str, int]
    bytes: list[int]  # the ids of the 256 byte pieces, or empty
    surface: list[bytes | None] = field(repr=False)  # what an id decodes to; None: a byte piece
    shorter: dict[str, str | None] = field(repr=False)  # of pieces that occur, the longest such piece that is a proper prefix
    unknown: int = 0
    end: int = 2


def read_vocabulary(path: str) -> Vocabulary:
    """The library reads the file; only models that leave texts as they are, apart from blanks, are taken."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "\tA  é ﬁ　x ​"
    if model.Normalize(probe) != BLANK + probe.replace(" ", BLANK):
        raise ValueError("the model normalises texts; only identity models are supported")
    scores, ids, in_bytes, surface = {}, {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            in_bytes[int(piece[3:5], 16)] = i
            surface.append(None)
        elif model.is_control(i):
            surface.append(b"")
        elif model.is_unknown(i):
            surface.append(" ⁇ ".encode())
        else:
            surface.append(piece.replace(BLANK, " ").encode())
            scores[piece], ids[piece] = model.get_score(i), i
    if any(_NEXT_WORD.search(p) or any(c not in ids for c in p) for p in scores):
        raise ValueError("a piece spans two words or holds a character that is no piece")
    occur = {p for p in ids if len(p) == 1 or merged(p, scores) == [p]}
    shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in occur), None) for p in occur}
    return Vocabulary(scores, ids, in_bytes if any(in_bytes) else [], surface, shorter, model.unk_id(), model.eos_id())


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The merges by definition, for short strings: highest score first, leftmost of equals."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def border(piece: str, scores: dict[str, float], last: bool) -> tuple[list[str], list[float]]:
    """The last (else first) part of a piece before and after each of its merges that changes it, and
    for each of these parts the lowest score among the merges up to the next; minus infinity for the whole."""
    parts, held, lowest, least = list(piece), [], [], float("inf")
    end = -1 if last else 0
    held.append(parts[end])
    while len(parts) > 1:
        ranked = [(-scores.get(parts[i] + parts[i + 1], -float("inf")), i) for i in range(len(parts) - 1)]
        score, i = min(ranked)
        least = min(least, -score)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if parts[end] != held[-1]:
            held.append(parts[end])
            lowest.append(least)
            least = float("inf")
    return held, [*lowest, -float("inf")]


class Encoder:
    """Encodes words; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.v, self.ends, self.starts = vocabulary, {}, {}
        self.pairs: dict[str, dict[str, bool]] = defaultdict(dict)
        self.known = 0
        self.codes = {p: _codes([i]) for p, i in vocabulary.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for p in vocabulary.ids:
            if p in vocabulary.shorter:
                self.automaton.add_word(p, len(p) - 1)
        if len(self.automaton):
            self.automaton.make_automaton()
        self.odd = re.compile(f"[^{re.escape(''.join(c for c in vocabulary.ids if len(c) == 1))}]")

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two together gives the two again."""
        scores = self.v.scores
        if left not in self.ends:
            self.ends[left] = border(left, scores, True)
        if right not in self.starts:
            self.starts[right] = border(right, scores, False)
        (lefts, wait_left), (rights, wait_right) = self.ends[left], self.starts[right]
        i = j = 0
        while True:
            score = scores.get(lefts[i] + rights[j])
            a, b = wait_left[i], wait_right[j]
            if a >= b:  # of equal scores the merge on the left comes first
                if score is not None and score > a:
                    return False
                if a == -float("inf"):
                    return True
                i += 1
            else:
                if score is not None and score >= b:
                    return False
                j += 1

    def segment(self, word: str) -> list[str]:
        """The pieces of a string all of whose characters are pieces."""
        shorter = self.v.shorter
        if word in shorter:
            return [word]
        size = len(word)
        ends = [0] * size
        for last, back in self.automaton.iter(word):
            ends[last - back] = last + 1  # a later end is a longer piece
        failed = None  # the bitfield: places from which no way leads to the end, once there are any
        taken: list[str] = []
        at, piece, after = 0, word[:ends[0]], None
        while at < size:
            while piece is not None:
                if failed is None or not failed[at + len(piece)]:
                    if after is None:
                        break
                    fits = after.get(piece)
                    if fits is None:
                        fits = after[piece] = self.compatible(taken[-1], piece)
                        self.known += 1
                    if fits:
                        break
                piece = shorter[piece]
            if piece is not None:
                taken.append(piece)
                after = self.pairs[piece]
                at += len(piece)
                if at < size:
                    piece = word[at:ends[at]]
            else:
                failed = failed or bytearray(size + 1)
                failed[at] = 1
                at -= len(taken[-1])
                piece = shorter[taken.pop()]
                after = self.pairs[taken[-1]] if taken else None
        if self.known > PAIRS:
            self.pairs.clear()
            self.known = 0
        return taken

    def word(self, word: str) -> bytes:
        """Ids of any string, 4 bytes each; characters that are no pieces part it, as nothing merges with them."""
        if self.odd.search(word) is None:
            return b"".join(map(self.codes.__getitem__, self.segment(word)))
        out, begin = [], 0
        for m in self.odd.finditer(word):
            i = m.start()
            if begin < i:
                out += map(self.codes.__getitem__, self.segment(word[begin:i]))
            out.append(_codes([self.v.bytes[b] for b in word[i].encode()] if self.v.bytes else [self.v.unknown]))
            begin = i + 1
        if begin < len(word):
            out += map(self.codes.__getitem__, self.segment(word[begin:]))
        return b"".join(out)


def _codes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<i4").tobytes()


class _Words(dict):
    """Word to its ids, 4 bytes each; made when first asked for. Words asked for since the last
    `turn` but one are remembered."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encode, self.before = encoder.word, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word) or self.encode(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


def cuts(text: str) -> Iterator[str]:
    """The text with its blanks marked, in stretches that begin with a word."""
    text = BLANK + text.replace(" ", BLANK) if text else ""
    begin = 0
    while len(text) - begin > CUT and (m := _NEXT_WORD.search(text, begin + CUT)):
        yield text[begin:m.start()]
        begin = m.start()
    yield text[begin:]


def _encoder(vocabulary: Vocabulary, end: bool) -> Batches:
    """From batches of (id, text) to batches of (id, ids)."""
    last = np.array([vocabulary.end] if end else [], dtype="<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(Encoder(vocabulary))
        for batch in batches:
            texts = batch.column(1)
            begin = 0
            while begin < len(texts):  # the ids of some millions of characters at a time
                stop, held, out, lengths = begin, 0, [], []
                while stop < len(texts) and held < 4 * CUT:
                    parts = []
                    whole = texts[stop].as_py() or ""
                    for stretch in cuts(whole):
                        parts.append(b"".join(map(words.__getitem__, _WORD.findall(stretch))))
                        if len(words) > CACHE:
                            words.turn()
                    parts.append(last)
                    out += parts
                    lengths.append(sum(map(len, parts)) // 4)
                    held += len(whole)
                    stop += 1
                flat = pa.array(np.frombuffer(b"".join(out), dtype="<i4"))
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, stop - begin), pa.ListArray.from_arrays(offsets, flat)],
                                                 names=["id", "ids"])
                begin = stop

    return run


def text_of(ids: list[int], surface: list[bytes | None], values: dict[int, int]) -> str:
    """What ids decode to; `values`: byte piece to byte."""
    out, held = [], bytearray()
    for i in [*ids, -1]:
        if i in values:
            held.append(values[i])
            continue
        if held:  # a run of bytes: characters, and U+FFFD for each byte of none
            at = 0
            while at < len(held):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(held[at:at + n]).decode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    at += 1
            held.clear()
        if i >= 0:
            out.append(surface[i].decode())
    return "".join(out)


def _decoder(vocabulary: Vocabulary) -> Batches:
    """From batches of (id, ids) to batches of (id, ids, decoded)."""
    values = {i: b for b, i in enumerate(vocabulary.bytes)}
    surface = vocabulary.surface
    plain = [bytes([values[i]]) if s is None else s for i, s in enumerate(surface)]
    silent = [i for i, s in enumerate(surface) if s == b""]  # end a run of bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, out = batch.column(1), []
            for row in lists:
                if not row.is_valid:
                    out.append(None)
                    continue
                numbers = row.values.to_numpy(zero_copy_only=False).tolist()
                try:
                    text = b"".join(map(plain.__getitem__, numbers)).decode()
                except UnicodeDecodeError:
                    text = None
                inside = numbers[:-1]
                if text is None or any(i in inside for i in silent):
                    text = text_of(numbers, surface, values)
                out.append(without_front(text, numbers, vocabulary))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=["id", "ids", "decoded"])

    return run


def without_front(text: str, numbers: list[int], vocabulary: Vocabulary) -> str:
    """Without the blank that encoding put in front: that of the first piece that shows."""
    first = next((i for i in numbers if vocabulary.surface[i] != b""), vocabulary.unknown)
    front = None if first == vocabulary.unknown else vocabulary.surface[first]
    return text[1:] if front and front.startswith(b" ") else text


def _mapped(rows: DataFrame, run: Batches, columns: str, id: str) -> DataFrame:
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {columns}").withColumnRenamed("id", id)


def encode(docs: DataFrame, vocabulary: Vocabulary, id: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """One row per input row: id, ids (array of int); `end` adds the end id."""
    return _mapped(docs.select(col(id).alias("id"), col(text).alias("text")), _encoder(vocabulary, end), "ids array<int>", id)


def decode(encoded: DataFrame, vocabulary: Vocabulary, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per input row: id, ids, decoded (string)."""
    return _mapped(encoded.select(col(id).alias("id"), col(ids).alias("ids")), _decoder(vocabulary), "ids array<int>, decoded string", id)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id: str = "doc_id", text: str = "text", end: bool = True) -> DataFrame:
    """What `decode` gives for what `encode` gives; both steps in one Python worker, so a task has one and not two."""
    encoded, decoded = _encoder(vocabulary, end), _decoder(vocabulary)
    return _mapped(docs.select(col(id).alias("id"), col(text).alias("text")), lambda batches: decoded(encoded(batches)),
                   "ids array<int>, decoded string", id)


def digests(decoded: DataFrame, id: str = "doc_id") -> DataFrame:
    return decoded.select(col(id), F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
