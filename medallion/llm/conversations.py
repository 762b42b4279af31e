"""Conversation structure repair by scalar big-integer weights (operator 13).

A conversation's rows, by turn, are edited at least cost until the role initials read
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 3, Delete 4 (the only edit of a blank or
duplicate row), Insert of an empty user or assistant message 3; a truncated row that is not deleted
adds 3. Of equally cheap ways the one whose edits' initials come first in ASCII order counts.

*Weights.* A path through the graph of (rows consumed, state of the pattern) has one integer: its
high digits are the cost, its low digits, base 8 and of one fixed width, are the edits' initials
from the left (D < I < K < R as 1 to 4), with zeros behind the last one. Adding an edit adds one number, and the
smallest integer is the cheapest path and, among these, the one first in ASCII order, so an ordinary
minimum per node decides everything. Two paths into a node never need a second look: the
letters fix the cost, so of two equally dear ones neither can be the beginning of the other, and what
follows can't turn their order.

*Long conversations.* After each block of rows the letters which all live paths share are final: they are
replayed, their rows leave memory (and go into the running hash), and the weights are written
anew for the undecided rest. So work grows with the rows, and what a task holds is the undecided
stretch, one block, and a 16-byte digest per distinct message.

Rows are dealt by conversation and sorted inside the shuffle, which spills; a conversation is worked off by one
task because its edits and its hash depend on all rows before, but it is streamed, never collected.

Defined cases: NULL role or text is one space (so such a text is blank, such a role is never kept);
NULL conv_id is a conversation of its own; NULL turns come first and don't count for gaps; an
empty role has no initial and is never kept. Rows with the same turn are ordered by role, then text;
equal rows are duplicates of the first. A row marked ``dropped`` only names its conversation. A conversation
without rows has zeros, an empty audit and the hash of the empty string; an empty table gives no rows. Texts of any length are
used whole. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import session

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {v: k for k, v in DIGIT.items()}
BITS = 3
BLOCK = 128  # rows between two looks for final letters; any number gives the same result
# A state can do what any other does next for at most this much more: two insertions (to after a), and
# the deletion of the one s that only the start may keep. A path dearer than that is never the cheapest.
SLACK = 2 * INSERT + DELETE

# States of the pattern: nothing yet, after s, after u, after a. NEXT[state] maps an initial to the next state.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


def wanted(state: int) -> str:
    """The initial that an inserted or reroled message has in this state."""
    return "a" if state == AFTER_U else "u"


class Weights:
    """Paths as (weight, letters so far) for one fixed width of letters."""

    def __init__(self, width: int):
        self.width = width
        self.high = BITS * width

    def start(self, cost: int, letters: str) -> tuple[int, int]:
        w = cost << self.high
        for p, c in enumerate(letters):
            w += DIGIT[c] << BITS * (self.width - 1 - p)
        return w, len(letters)

    def add(self, path: tuple[int, int], cost: int, letter: str) -> tuple[int, int]:
        w, p = path
        return w + (cost << self.high) + (DIGIT[letter] << BITS * (self.width - 1 - p)), p + 1

    def read(self, path: tuple[int, int]) -> tuple[int, str]:
        w, p = path
        return w >> self.high, "".join(LETTER[(w >> BITS * (self.width - 1 - i)) & 7] for i in range(p))


def least(*paths: tuple[int, int] | None) -> tuple[int, int] | None:
    return min((p for p in paths if p is not None), default=None)


def insert_edges(at: list, weights: Weights) -> list:
    """Best paths after any number of insertions: more than one u and one a never pay."""
    def ins(path):
        return None if path is None else weights.add(path, INSERT, "I")

    out = list(at)
    out[AFTER_U] = least(at[AFTER_U], ins(at[START]), ins(at[AFTER_S]), ins(at[AFTER_A]))
    out[AFTER_A] = least(at[AFTER_A], ins(out[AFTER_U]))
    return out


def row_edges(at: list, weights: Weights, initial: str, extra: int, delete_only: bool) -> list:
    """Best paths after one row, which is deleted, kept or given another role."""
    out = [None if p is None else weights.add(p, DELETE, "D") for p in at]
    if delete_only:
        return out
    for state, path in enumerate(at):
        if path is None:
            continue
        to = NEXT[state].get(initial)
        if to is not None:
            out[to] = least(out[to], weights.add(path, KEEP + extra, "K"))
        to = NEXT[state][wanted(state)]
        out[to] = least(out[to], weights.add(path, REROLE + extra, "R"))
    return out


class Conversation:
    """Rows go in one by one; repaired messages come out as soon as their edits are final."""

    def __init__(self, out: Callable[[str, str, str], None]):
        self.out = out  # called with (edit, role, text) per repaired message
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.distinct = 0
        self.lo = self.hi = None
        self.seen: set[bytes] = set()
        self.before: str | None = None
        self.rows: list[tuple[str, str]] = []  # not yet replayed
        self.block: list[tuple[str, int, bool]] = []  # not yet weighed
        self.live: list = [(0, ""), None, None, None]  # per state: cost, undecided letters
        self.audit: list[str] = []
        self.state = START

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.distinct += turn != self.hi
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        initial = role[:1]
        if self.before is not None:
            self.illegal += (self.before + initial) not in LEGAL
        self.before = initial
        head = role.encode("utf-8", "surrogatepass")
        digest = hashlib.md5(b"%d:%b" % (len(head), head) + text.encode("utf-8", "surrogatepass")).digest()
        bare = text.rstrip(SPACES)
        extra, gone = 0, False
        if not bare:
            self.blank += 1
            gone = True
        elif digest in self.seen:
            self.duplicate += 1
            gone = True
        elif bare[-1] not in ".!?":
            self.truncated += 1
            extra = TRUNCATED
        self.seen.add(digest)
        self.rows.append((role, text))
        self.block.append((initial, extra, gone))
        if len(self.block) == BLOCK:
            self._weigh()
            known = [letters for _, letters in filter(None, self.live)]
            self._settle(os.path.commonprefix(known))

    def _weigh(self, last: bool = False) -> None:
        live = self.live
        weights = Weights(max(len(x[1]) for x in live if x) + 3 * len(self.block) + 3)
        at = [None if x is None else weights.start(*x) for x in live]
        for initial, extra, gone in self.block:
            at = row_edges(insert_edges(at, weights), weights, initial, extra, gone)
        if last:
            at = insert_edges(at, weights)
            at = [least(at[START], at[AFTER_A]), None, None, None]
        self.block = []
        live = [None if x is None else weights.read(x) for x in at]
        most = min(x[0] for x in live if x) + SLACK
        self.live = [x if x and x[0] <= most else None for x in live]

    def _settle(self, letters: str) -> None:
        """Replays final letters; the rows they consume are let go."""
        used = 0
        for c in letters:
            if c == "D":
                used += 1
            elif c == "K":
                role, text = self.rows[used]
                used += 1
                self.state = NEXT[self.state][role[:1]]
                self.out(c, role, text)
            else:
                initial = wanted(self.state)
                self.state = NEXT[self.state][initial]
                text = "" if c == "I" else self.rows[used][1]
                used += c == "R"
                self.out(c, ROLE[initial], text)
        self.audit.append(letters)
        self.rows = self.rows[used:]
        self.live = [None if x is None else (x[0], x[1][len(letters):]) for x in self.live]

    def close(self) -> dict:
        self._weigh(last=True)
        cost, letters = self.live[START]
        self._settle(letters)
        gaps = 0 if self.lo is None else self.hi - self.lo + 1 - self.distinct
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": cost, "audit": "".join(self.audit)}


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "dropped")))


def _conversations(batches: Iterator[pa.RecordBatch], out: Callable) -> Iterator[tuple]:
    """(conv_id, summary) per conversation of a sorted partition."""
    current, conv = None, None
    for conv_id, turn, role, text, dropped in _columns(batches):
        if conv is None or conv_id != current:
            if conv is not None:
                yield current, conv.close()
            current, conv = conv_id, Conversation(out)
        if not dropped:
            conv.add(turn, role, text)
    if conv is not None:
        yield current, conv.close()


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _summaries(id_type: pa.DataType) -> Callable:
    schema = pa.schema([("conv_id", id_type), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, first, rows = hashlib.sha256(), True, []

        def out(edit: str, role: str, text: str) -> None:
            nonlocal first
            hashed.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False

        for conv_id, s in _conversations(batches, out):
            rows.append((conv_id, *(s[c] for c in _COUNTS), s["audit"], hashed.hexdigest()))
            hashed, first = hashlib.sha256(), True
            if len(rows) == 1000:
                yield _batch(rows, schema)
                rows = []
        if rows:
            yield _batch(rows, schema)
    return run


def _messages(id_type: pa.DataType) -> Callable:
    schema = pa.schema([("conv_id", id_type), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()),
                        ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # messages come out while their conversation is still read, so each row is fed by itself
        ready: list[tuple] = []
        conv, current, position = None, None, 0

        def out(edit: str, role: str, text: str) -> None:
            nonlocal position
            ready.append((current, position, edit, role, text))
            position += 1

        for conv_id, turn, role, text, dropped in _columns(batches):
            if conv is None or conv_id != current:
                if conv is not None:
                    conv.close()
                current, conv, position = conv_id, Conversation(out), 0
            if not dropped:
                conv.add(turn, role, text)
            if len(ready) >= 1000:
                yield _batch(ready, schema)
                ready.clear()
        if conv is not None:
            conv.close()
        if ready:
            yield _batch(ready, schema)
    return run


def _sorted(df: DataFrame) -> tuple[DataFrame, str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    session(df)
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in df.columns else F.lit(False)
    rows = df.select(F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), dropped.alias("dropped"))
    kind = rows.schema["conv_id"].dataType
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"),
            kind.simpleString(), to_arrow_type(kind))


def repair_summary(df: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the hash of the repaired messages
    (``role:text``, joined by newlines). ``df`` has conv_id, turn, role, text and, where given, a boolean ``dropped``."""
    rows, kind, arrow = _sorted(df)
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    return rows.mapInArrow(_summaries(arrow), f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def repair_messages(df: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position from 0, edit (K, R or I), role and text."""
    rows, kind, arrow = _sorted(df)
    return rows.mapInArrow(_messages(arrow), f"conv_id {kind}, position bigint, edit string, role string, text string")


def damaged(df: DataFrame) -> DataFrame:
    """Rows after damage by crc32(``conv_id:turn``) % 20: 0 drops the row (it stays as a marker,
    ``dropped``), 1 empties the text, 2 removes its ``[.!?]``, 3 repeats the row, 4 sets the role
    user. NULLs count as one space."""
    def plain(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(20))
    text = (F.when(code <= 1, F.lit("")).when(code == 2, F.regexp_replace(plain("text"), "[.!?]", ""))
            .otherwise(plain("text")))
    rows = df.select("conv_id", "turn", F.when(code == 4, F.lit("user")).otherwise(plain("role")).alias("role"),
                     text.alias("text"), (code == 0).alias("dropped"),
                     F.explode(F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy"))
    return rows.drop("__copy")
