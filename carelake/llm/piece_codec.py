"""SentencePiece encoding and decoding of merge-type (BPE) models.

The library merges, again and again, the neighbouring pair whose joined piece
scores best, the leftmost of equals. Here a text is encoded without playing the
merges over it: the result is the only sequence of pieces in which every two
neighbours are compatible, that is, merging the text of the two gives just
these two. It is found from left to right by backtracking: take the longest
piece that begins here (all matches come from one Aho-Corasick pass), check it
against the piece before by re-merging the two, else try the next shorter one;
where none fits, mark the position as failed in a bitfield, take the last piece
back and go on with a shorter one. Each position fails once at most.

A text is first cut where no piece of the vocabulary spans the two characters,
so the parts are independent, and encodings of short parts are kept (a bounded
number for each worker). Runs of blanks are merged directly: their pieces have
one score, and ties would make compatibility depend on more than two neighbours.

Characters without a piece become byte pieces. Decoding joins the pieces, turns
the blank mark into a blank, drops the one the encoder put in front, and reads
byte pieces as UTF-8 (one replacement character for each byte that isn't).

Defined results: null text is empty; the empty text has no pieces (an end id
only); null ids decode to the empty text; control ids decode to nothing, the
unknown id to its own mark; repeated rows, empty tables and extra columns pass.
"""

from __future__ import annotations

import gc
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import ROW, map_arrow, slices, unpack

BLANK = "▁"
UNKNOWN_MARK = " ⁇ "
KEPT_PARTS = 500_000
KEPT_LENGTH = 48
KEPT_PAIRS = 1_000_000
# Letters that the part pattern may cut after: ASCII and Latin with marks.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


class _Kept(dict):
    """Results by key, computed when missing; emptied when full."""

    def __init__(self, make, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest = make, most, longest

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class PieceModel:
    """Vocabulary of a merge-type model, with encoder and decoder."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(lib.get_piece_size())
        reserved = {i for i in every if lib.is_unknown(i) or lib.is_control(i) or lib.is_byte(i)}
        self.ids = {lib.id_to_piece(i): i for i in every if i not in reserved}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(lib.id_to_piece(i)[1:-1], 16): i for i in every if lib.is_byte(i)}
        self.unknown, self.end = lib.unk_id(), lib.eos_id()
        if any(lib.is_unused(i) for i in every):
            raise ValueError("unused pieces are not supported")
        self._pieces = [b""] * len(every)
        for p, i in self.ids.items():
            self._pieces[i] = p.replace(BLANK, " ").encode()
        for b, i in self.bytes.items():
            self._pieces[i] = bytes([b])
        self._pieces[self.unknown] = UNKNOWN_MARK.encode()
        self._is_byte = {i: b for b, i in self.bytes.items()}
        self._opens = {i for p, i in self.ids.items() if p.startswith(BLANK)}
        self._nothing = {i for i in reserved if lib.is_control(i)}
        self.halves: dict[str, tuple[str, str]] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            # Pieces that no merges make stand for nothing; blank runs are merged directly.
            if len(p) > 1 and p.strip(BLANK) and self.merge(p, self.halves) == [p]:
                self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        # The next shorter piece (or character) that a piece begins with, by length.
        self._shorter = {p: next(k for k in range(len(p) - 1, 0, -1) if k == 1 or p[:k] in self.automaton) for p in self.automaton.keys()}
        # Parts come before wholes, so a pair's merges can be undone in order.
        self._in_order = all(self.score.get(h, 0) > self.score[p] for p, hs in self.halves.items() for h in hs if len(h) > 1)
        self._spines = _Kept(self._spine, KEPT_PAIRS, 1 << 20), _Kept(lambda p: self._spine(p, 1), KEPT_PAIRS, 1 << 20)
        self._fits = _Kept(self._compatible, KEPT_PAIRS, 2)
        self._kept = _Kept(self._part_ids, KEPT_PARTS, KEPT_LENGTH)
        self._parts = self._part_pattern()

    def _part_pattern(self) -> re.Pattern:
        spans = {(a, b) for p in self.ids for a, b in zip(p, p[1:])}
        before_blank = all(a == BLANK for a, b in spans if b == BLANK)
        no_newline = all("\n" not in pair for pair in spans)
        letter = re.compile(f"[{_LETTERS}]")
        after_letters = not any(letter.match(a) and (b < "\x80" and not b.isalpha()) for a, b in spans)
        if not before_blank:
            return re.compile(r"[\s\S]+")
        own = r"\n" if no_newline else ""
        rest = f"{BLANK}*[^{BLANK}{own}]+|{BLANK}+" + (r"|\n+" if no_newline else "")
        words = f"{BLANK}?[{_LETTERS}]+(?=[\\x00-@\\[-`{{-\\x7f{BLANK}]|\\Z)|" if after_letters else ""
        return re.compile(words + rest)

    def _spine(self, piece: str, side: int = 0) -> list[tuple[str, float]]:
        """What stands at the left (0) or right (1) end of a piece while it is
        merged, the character first, with the score of the merge that takes it."""
        spine, taken = [], -float("inf")
        while True:
            spine.append((piece, taken))
            if len(piece) == 1:
                return spine[::-1]
            taken = self.score[piece]
            piece = self.halves[piece][side]

    def _compatible(self, pair: tuple[str, str]) -> bool:
        """Would merging the text of the two pieces give just these two? Both
        are re-merged from their characters, step by step in order of score; no
        step may offer the two facing parts a merge that comes first."""
        if not self._in_order:
            return self.merge(pair[0] + pair[1]) == list(pair)
        ends, begins = self._spines[1][pair[0]], self._spines[0][pair[1]]
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = ends[i], begins[j]
            joined = self.score.get(a + b)
            # Of equal scores the leftmost goes first: a's own merge, then a with b, then b's own.
            if joined is not None and joined > a_taken and joined >= b_taken:
                return False
            if a_taken >= b_taken:
                if a_taken == -float("inf"):
                    return True
                i += 1
            else:
                j += 1

    def merge(self, text: str, halves: dict[str, tuple[str, str]] | None = None) -> list[str]:
        """The pieces by playing the merges, best score first, leftmost of
        equals. ``halves`` notes what the whole text was merged from last."""
        part = list(text)
        right = list(range(1, len(part) + 1))
        left = list(range(-1, len(part) - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            joined = part[i] + part[j]
            if joined in self.score:
                heapq.heappush(heap, (-self.score[joined], i, joined, j))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, joined, j = heapq.heappop(heap)
            if part[i] is None or part[j] is None or right[i] != j or part[i] + part[j] != joined:
                continue
            if halves is not None and joined == text:
                halves[text] = part[i], part[j]
            part[i], part[j] = joined, None
            right[i] = right[j]
            if right[i] < len(part):
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [p for p in part if p is not None]

    def split(self, text: str) -> list[str]:
        """The pieces of one part by backtracking."""
        n = len(text)
        if n > 1 and BLANK * 2 in text:
            return self.merge(text)
        # By position the longest match (matches come by their end); one character is always a symbol.
        longest = [1] * n
        for last, length in self.automaton.iter(text):
            longest[last - length + 1] = length
        longest.append(0)
        failed, fits, shorter = bytearray(n + 1), self._fits, self._shorter
        pieces: list[str] = []
        at, length = 0, longest[0]
        while at < n:
            while length:
                piece = text[at:at + length]
                if not failed[at + length] and (not pieces or fits[pieces[-1], piece]):
                    break
                length = shorter.get(piece, 0)
            if length:
                pieces.append(piece)
                at += length
                length = longest[at]
            else:
                failed[at] = 1
                piece = pieces.pop()
                at -= len(piece)
                length = shorter.get(piece, 0)
        return pieces

    def _part_ids(self, part: str) -> bytes:
        out = []
        for piece in self.split(part):
            if piece in self.ids:
                out.append(self.ids[piece])
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return struct.pack(f"<{len(out)}i", *out)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit numbers, without an end id."""
        if not text:
            return b""
        return b"".join(map(self._kept.__getitem__, self._parts.findall(BLANK + text.replace(" ", BLANK))))

    def decode(self, ids: list[int]) -> str:
        while ids and ids[0] in self._nothing:
            ids = ids[1:]
        raw = b"".join(map(self._pieces.__getitem__, ids))
        if ids and ids[0] in self._opens:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_bytes(ids)

    def _decode_bytes(self, ids: list[int]) -> str:
        """Some byte pieces are no UTF-8: each such byte is one replacement."""
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                at += size
            run.clear()

        for k, i in enumerate(ids):
            if i in self._is_byte:
                run.append(self._is_byte[i])
            else:
                flush()
                piece = self._pieces[i].decode()
                out.append(piece[1:] if not k and i in self._opens else piece)
        flush()
        return "".join(out)


@lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    """One model for each worker and file; the file is opened on the worker."""
    return PieceModel(path)


def encode(docs: DataFrame, model: str, text: str = "text", carry: list[str] | None = None, end: bool = True) -> DataFrame:
    """The carried columns (by default all) and ``ids`` (array of int)."""
    carry = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema[ROW], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_model(model)
        tail = np.array([pieces.end] * end, dtype="<i4").tobytes()
        gc.disable()  # very many short-lived tuples and no cycles
        try:
            for batch in slices(batches):
                parts = [pieces.encode(t) + tail for t in batch.column("text").to_pylist()]
                ends = np.cumsum([0, *[len(p) // 4 for p in parts]], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(ROW), ids], names=[ROW, "ids"])
        finally:
            gc.enable()

    return unpack(map_arrow(rows, run, schema), ["ids"])


def decode(rows: DataFrame, model: str, ids: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (by default all) and ``decoded``."""
    carry = rows.columns if carry is None else carry
    own = rows.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), F.col(ids).alias("ids"))
    schema = T.StructType([own.schema[ROW], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_model(model)
        for batch in slices(batches):
            texts = [pieces.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(texts, pa.string())], names=[ROW, "decoded"])

    return unpack(map_arrow(own, run, schema), ["decoded"])
