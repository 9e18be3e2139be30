"""Chat formatting by a finite-state machine over roles.

A template is data: the marks around each role's text, whether the text counts
for the loss, and the machine (which role may follow which). A turn becomes
segments: mark, escaped text, mark. Text segments of roles with ``loss`` carry
the loss flag, marks never do. Inside a text every control string of the
template and every escape character gets an escape character in front, so texts
cannot imitate marks and the formatted conversation can be read back exactly. A
role the template does not know is written with its name, and fails validation.

A turn's segments depend on the turn alone, so they are made where the turn is.
Only the machine needs the order: turns are sorted by range of (conversation,
turn), so one very long conversation spreads over many tasks. Each task runs the
machine from every state at once over its share of each conversation, which
gives a map from state to state; maps of neighbouring shares are composed in a
table of one row per task and conversation; the state before each share then
settles the validity of its turns.

Defined results: null text is empty; a null role is the role named "" (unknown);
null conversation ids form one conversation; turns with equal numbers follow by
role, then hash of the text, then text; null turn numbers come first; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import map_arrow, materialise, slices

ESCAPE = "\\"


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    loss: bool
    follows: tuple[str, ...]  # roles (or START) that may come right before


@dataclass(frozen=True)
class Template:
    """Marks and machine; ``other`` marks a turn of any further role: its three
    marks stand before the name, between name and text, and after the text."""

    roles: dict[str, Role]
    other: tuple[str, str, str]
    ends: tuple[str, ...]     # roles that may come last
    start: str = "START"

    def __post_init__(self):
        marks = [m for r in self.roles.values() for m in (r.before, r.after) if m] + list(self.other)
        if len(set(marks)) != len(marks) or any(ESCAPE in m for m in marks):
            raise ValueError("marks must differ and have no escape character")
        for a in marks:
            for b in marks:
                if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"marks {a!r} and {b!r} overlap")
        for r in self.roles.values():
            if not r.before or not r.after:
                raise ValueError("every role needs both marks")

    @property
    def controls(self) -> list[str]:
        return [m for r in self.roles.values() for m in (r.before, r.after)] + list(self.other)

    @property
    def states(self) -> list[str]:
        """START, the roles, and FAILED."""
        return [self.start, *self.roles, "FAILED"]

    def step(self, state: int, role: str) -> int:
        """The machine: the state after a turn; FAILED is never left."""
        names = self.states
        ok = role in self.roles and state < len(names) - 1 and names[state] in self.roles[role].follows
        return names.index(role) if ok else len(names) - 1


# Fixed values of the default template: marks in square brackets; a system turn
# only first, then user and assistant by turns, the assistant last.
DEFAULT = Template(
    roles={
        "system": Role("[SYS]", "[/SYS]", False, ("START",)),
        "user": Role("[INST]", "[/INST]", False, ("START", "system", "assistant")),
        "assistant": Role("<s>", "</s>", True, ("user",)),
    },
    other=("[ROLE]", "[TEXT]", "[/TEXT]"),
    ends=("assistant",),
)


def escaped(text: Column, template: Template = DEFAULT) -> Column:
    special = "|".join(re.escape(c) for c in [ESCAPE, *template.controls])
    return F.regexp_replace(text, f"({special})", r"\\$1")


def read_back(formatted: str, template: Template = DEFAULT) -> list[tuple[str, str]]:
    """(role, text) by turn from a formatted conversation."""
    by_mark = {r.before: name for name, r in template.roles.items()}
    ends = {r.before: r.after for r in template.roles.values()}
    token = re.compile(r"\\(" + "|".join(re.escape(c) for c in [ESCAPE, *template.controls]) + ")|("
                       + "|".join(re.escape(c) for c in sorted(template.controls, key=len, reverse=True)) + ")")
    turns, text, role, name_next, stop, at = [], [], None, False, None, 0
    for m in token.finditer(formatted):
        text.append(formatted[at:m.start()])
        at = m.end()
        if m[1] is not None:
            text.append(m[1])
        elif stop is None:
            if "".join(text):
                raise ValueError("text outside of turns")
            text, name_next = [], m[2] == template.other[0]
            role, stop = (None, template.other[1]) if name_next else (by_mark[m[2]], ends[m[2]])
        elif m[2] != stop:
            raise ValueError(f"{m[2]!r} inside a turn")
        elif name_next:
            role, text, name_next, stop = "".join(text), [], False, template.other[2]
        else:
            turns.append((role, "".join(text)))
            text, stop = [], None
    if stop is not None or formatted[at:]:
        raise ValueError("the conversation ends inside a turn")
    return turns


def unescaped(text: str, template: Template = DEFAULT) -> str:
    return re.sub(r"\\(" + "|".join(re.escape(c) for c in [ESCAPE, *template.controls]) + ")", lambda m: m[1], text)


def _segments(template: Template) -> Column:
    """The segments of one turn: an array of (text, loss)."""
    segment = lambda text, loss: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    body = escaped(F.col("text"), template)
    a, b, c = (F.lit(x) for x in template.other)
    unknown = F.array(segment(a, False), segment(escaped(F.col("role"), template), False), segment(b, False),
                      segment(body, False), segment(c, False))
    out = None
    for name, r in template.roles.items():
        own = F.array(segment(F.lit(r.before), False), segment(body, r.loss), segment(F.lit(r.after), False))
        out = F.when(F.col("role") == name, own) if out is None else out.when(F.col("role") == name, own)
    return out.otherwise(unknown)


def _machine(template: Template):
    """For each task: a row for each conversation with the map of states its
    share makes, and where in it each state first fails (-1: nowhere)."""
    n = len(template.states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, first, turns = None, None, 0
        states, fails = [], []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([own[0]], pa.int64()), pa.array([first], pa.int64()), pa.array([turns], pa.int64()),
                 pa.array([states], pa.list_(pa.int32())), pa.array([fails], pa.list_(pa.int64()))],
                names=["conv_id", "first", "turns", "states", "fails"])

        for batch in slices(batches, 4096):
            for conv, key, role in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "key", "role"))):
                if own != (conv, key >> 33):
                    if own is not None:
                        yield row()
                    own, first, turns = (conv, key >> 33), key, 0
                    states, fails = list(range(n)), [-1] * n
                states = [template.step(s, role) for s in states]
                fails = [turns if f < 0 and s == n - 1 else f for f, s in zip(fails, states)]
                turns += 1
        if own is not None:
            yield row()

    return run


_ENTERED = "conv_id long, first long, turns long, turns_before long, leaves int, failed_at long"


def _compose(template: Template):
    """Walks the shares of each conversation in order: one state and one count."""
    failed = len(template.states) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, before = (), 0, 0
        for batch in slices(batches, 4096):
            out = []
            for conv, first, turns, states, fails in zip(*(c.to_pylist() for c in batch.columns)):
                if own != (conv,):
                    own, state, before = (conv,), 0, 0
                at = before + fails[state] if state != failed and fails[state] >= 0 else None
                state = states[state]
                out.append((conv, first, turns, before, state, at))
                before += turns
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                                             names=[x.split()[0] for x in _ENTERED.split(", ")])

    return run


def format_conversations(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), role, text, ``segments``
    (array of text, loss), ``valid`` (conversation keeps to the machine) and
    ``failed_at`` (turn_no of the first turn out of order; the number of turns
    if the last role may not be last; else null)."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    # Range partitions split a long conversation; equal rows are interchangeable
    # and numbered before, so that very many of them split, too.
    ranged = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order, "text", "copy")
    written = materialise(ranged.sortWithinPartitions(*order, "text", "copy").drop("copy")
                          .select("*", F.monotonically_increasing_id().alias("key")), "chat-turns")
    share = F.shiftright("key", 33)  # the range partition
    ordered = written.select("conv_id", "key", "role").repartition(share).sortWithinPartitions("key")
    shares = map_arrow(ordered, _machine(template), "conv_id long, first long, turns long, states array<int>, fails array<long>")
    entered = materialise(map_arrow(shares.repartition("conv_id").sortWithinPartitions("conv_id", "first"), _compose(template), _ENTERED),
                          "chat-shares")
    ends = [template.states.index(r) for r in template.ends]
    verdict = entered.groupBy(F.col("conv_id").alias("c")).agg(
        F.coalesce(F.min("failed_at"), F.when(~F.max_by("leaves", "first").isin(ends), F.max(F.col("turns_before") + F.col("turns")))).alias("failed_at"))
    # A conversation's turns in a share are consecutive, from the share's first key.
    places = entered.drop("failed_at").join(verdict, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        F.col("conv_id").alias("p"), F.shiftright("first", 33).alias("at"), "first", "turns_before", "failed_at")
    joined = written.join(materialise(places, "chat-places"), F.col("conv_id").eqNullSafe(F.col("p")) & (share == F.col("at")))
    return joined.select("conv_id", (F.col("turns_before") + F.col("key") - F.col("first")).alias("turn_no"), "role", "text",
                         _segments(template).alias("segments"), F.col("failed_at").isNull().alias("valid"), "failed_at")


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, valid boolean")


def digest_conversations(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Per conversation, read back from its segments: the digest of roles and
    texts, the length and digest of the text under the loss flag. A digest of a
    whole conversation is one chain, so a conversation's turns pass through one
    task, in order and one turn at a time: memory holds a turn, not a
    conversation."""
    rows = formatted.select("conv_id", "turn_no", F.col("segments.text").alias("texts"), F.col("segments.loss").alias("losses"), "valid")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, begun = None, False

        def close(done):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            names = [x.split()[0] for x in DIGEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(done, kinds)], names=names)

        for batch in slices(batches, 256):
            for conv, texts, losses, valid in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "texts", "losses", "valid"))):
                if not begun or conv != own:
                    if begun:
                        yield close((own, turns, said.hexdigest(), loss_chars, lost.hexdigest(), chars, ok))
                    own, begun, ok = conv, True, valid
                    turns = loss_chars = chars = 0
                    said, lost = hashlib.sha256(), hashlib.sha256()
                turn = "".join(texts)
                chars += len(turn)
                for role, text in read_back(turn, template):
                    turns += 1
                    said.update(f"{role}\n{text}\n".encode())
                for text, loss in zip(texts, losses):
                    if loss:
                        plain = unescaped(text, template)
                        loss_chars += len(plain)
                        lost.update(plain.encode())
        if begun:
            yield close((own, turns, said.hexdigest(), loss_chars, lost.hexdigest(), chars, ok))

    return map_arrow(ordered, run, DIGEST)
