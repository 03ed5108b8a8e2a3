"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation should read system?, then user and assistant by turns. Its rows
pass one by one; four states tell what the repaired rows so far end in
(nothing, system, user, assistant), and each keeps its cheapest edits as a
path in a tree of backpointers with reference counts. Paths that no state
holds any more are freed; as soon as all states share an ancestor, the edits
above it are settled and leave, so memory holds the unsettled rows only.

Of equally cheap paths the one with the smallest letters (D, I, K, R) wins.
Paths of the same number of rows are never prefixes of each other, so the
order of the complete unsettled suffixes is one rank a state, carried along: a
tie is decided by the rank of the parents and then by the letters added.

Spark brings each conversation's rows together in order (a spilling sort) and
streams them through the search; a conversation of any length passes without
being held. Only repeats need the whole conversation: they are found before,
by a pre-aggregated count over (conversation, role, digest of the text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1  # for a truncated row that stays
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: State -> state that a row of a role leads to.
NEXT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: State -> state after one inserted row.
FILL = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
BLANK = " \t\n\x0b\x0c\r"


class Node:
    """One edit of a path. ``refs`` counts its children and the states that end in it."""

    __slots__ = ("parent", "edit", "kids", "refs")

    def __init__(self, parent: Node | None, edit: tuple | None):
        self.parent, self.edit, self.kids, self.refs = parent, edit, [], 0
        if parent is not None:
            parent.kids.append(self)
            parent.refs += 1


class Repair:
    """The search over one conversation; ``settled`` gets every edit (letter, role, turn, text) in order."""

    def __init__(self, settled: Callable[[tuple], None]):
        self.settled = settled
        self.root = Node(None, None)
        self.root.refs = 1
        self.live = {NOTHING: (0, 0, self.root)}  # state -> cost, rank, last edit
        self.cost = 0

    def row(self, role: str, turn: int | None, text: str, delete: bool, truncated: bool) -> None:
        """Extend the paths by a row; ``delete``: it may not stay."""
        best: dict[int, tuple] = {}

        def offer(to: int, cost: int, rank: int, letters: str, state: int) -> None:
            if to not in best or (cost, rank, letters) < best[to][:3]:
                best[to] = (cost, rank, letters, state)

        first = role[:1]
        for state, (cost, rank, _) in self.live.items():
            offer(state, cost + COST[DELETE], rank, DELETE, state)  # an insertion before it comes later as cheaply
            if delete:
                continue
            filled = FILL[state]
            for at, paid, letters in ((state, cost, ""), (filled, cost + COST[INSERT], INSERT)):
                paid += TRUNCATED * truncated
                to = NEXT.get(first, {}).get(at)
                if to is not None:
                    offer(to, paid, rank, letters + KEEP, state)
                offer(FILL[at], paid + COST[REROLE], rank, letters + REROLE, state)
        self._drop_beaten(best)
        order = sorted(best, key=lambda to: best[to][1:3])
        live = {}
        for rank, to in enumerate(order):
            cost, _, letters, state = best[to]
            node = self.live[state][2]
            if letters[0] == INSERT:
                node = Node(node, (INSERT, ROLE[FILL[state]], None, ""))
            node = Node(node, (letters[-1], ROLE[to] if letters[-1] == REROLE else role, turn, text))
            node.refs += 1
            live[to] = (cost, rank, node)
        old, self.live = self.live, live
        for _, _, node in old.values():
            self._release(node)
        self._settle()

    @staticmethod
    def _drop_beaten(best: dict[int, tuple]) -> None:
        """Drop states that another one can replace at less cost whatever follows."""
        inf = float("inf")
        cost = {s: best[s][0] if s in best else inf for s in range(4)}
        answered = min(cost[ASSISTANT], cost[USER] + COST[INSERT])
        if cost[USER] > cost[ASSISTANT] + COST[INSERT]:
            best.pop(USER, None)
        if cost[ASSISTANT] > cost[USER] + COST[INSERT]:
            best.pop(ASSISTANT, None)
        if cost[SYSTEM] > answered:
            best.pop(SYSTEM, None)
        if cost[NOTHING] > answered + COST[DELETE]:
            best.pop(NOTHING, None)

    def _release(self, node: Node) -> None:
        node.refs -= 1
        while not node.refs and node.parent is not None:
            up = node.parent
            up.kids.remove(node)
            up.refs -= 1
            node.parent, node = None, up

    def _settle(self) -> None:
        while self.root.refs == 1 and self.root.kids:
            self.root = self.root.kids[0]
            self.root.parent = None
            self.settled(self.root.edit)

    def unsettled(self) -> int:
        """Number of edits held."""
        n, todo = 0, [self.root]
        while todo:
            node = todo.pop()
            n += len(node.kids)
            todo += node.kids
        return n

    def close(self) -> int:
        """Settle the cheapest whole path and return its cost."""
        ends = {NOTHING: "", ASSISTANT: "", USER: INSERT, SYSTEM: INSERT * 2}
        cost, _, letters, state = min(
            (cost + COST[INSERT] * len(ends[s]), rank, ends[s], s) for s, (cost, rank, _) in self.live.items())
        node = self.live[state][2]
        node.refs += 1
        for _, _, other in self.live.values():
            self._release(other)
        self._settle()
        for _ in letters:
            state = FILL[state]
            self.settled((INSERT, ROLE[state], None, ""))
        return cost



def ordered_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies, repeat`` of each conversation together, by turn (nulls first), role and text.

    ``copies`` is how often the row stands there (0: it only names its
    conversation); ``repeat``: role and text stand at a smaller turn as well.
    """
    digest = F.sha2(F.col("text").cast("binary"), 256)
    seen = (rows.where("copies > 0").groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), digest.alias("_d"))
            .agg(F.min(F.struct("turn")).alias("_first"), F.max(F.struct("turn")).alias("_last"))
            .where(~F.col("_first").eqNullSafe(F.col("_last"))))
    rows = rows.withColumn("_h", digest)
    both = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_h") == F.col("_d")), "left")
    later = F.coalesce(F.struct("turn") > F.col("_first"), F.lit(False))
    return (both.select("conv_id", "turn", "role", "text", "copies", later.alias("repeat"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))


def conversation_rows(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The columns that the operator reads; a null role or text reads as one blank."""
    return df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
                     F.lit(1).alias("copies"))


class Conversation:
    """Faults and search of one conversation, fed row by row."""

    def __init__(self, settled: Callable[[tuple], None]):
        self.search = Repair(settled)
        self.low = self.high = self.before = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, repeat: bool) -> None:
        bare = text.strip(BLANK)
        same = (turn, role, text) == self.last
        blank = not bare
        duplicate = not blank and (repeat or same)
        truncated = not blank and not duplicate and bare[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.before, self.last = role[:1], (turn, role, text)
        self.search.row(role, turn, text, blank or duplicate, truncated)

    def gaps(self) -> int:
        return min(self.high - self.low + 1 - self.turns, (1 << 63) - 1) if self.turns else 0


def _streamed(batches: Iterator[pa.RecordBatch], begin: Callable, finish: Callable, full: Callable) -> Iterator[pa.RecordBatch]:
    """Feed sorted rows to one conversation after another; ``full`` yields a batch when one is due."""
    now, key = None, None
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "repeat")]
        for conv, turn, role, text, copies, repeat in zip(*cols):
            if now is None or conv != key:
                if now is not None:
                    finish(key, now)
                now, key = begin(conv), conv
            for _ in range(copies):
                now.add(turn, role, text, repeat)
        yield from full(False)
    if now is not None:
        finish(key, now)
    yield from full(True)


def _key_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def repaired_turns(rows: DataFrame) -> DataFrame:
    """Every edit in order: ``conv_id, step, edit, turn, role, text``.

    ``rows`` has the columns of ``conversation_rows``. Kept (K) and reroled (R)
    rows carry the role they end up with, inserted ones (I) a null turn and an
    empty text, deleted ones (D) the row that goes. Without D, role and text in
    the order of ``step`` are the repaired conversation. Rows of a null conv_id
    are one conversation; an empty table gives no rows.
    """
    key = _key_type(rows)
    out_type = f"conv_id {key}, step long, edit string, turn long, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = None

        def begin(conv):
            step = iter(range(1 << 62))
            return Conversation(lambda e: out.append((conv, next(step), e[0], e[2], e[1], e[3])))

        def finish(conv, now):
            now.search.close()

        def full(end):
            if len(out) > (0 if end else 4096):
                arrays = [pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()))]
                out.clear()
                yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "step", "edit", "turn", "role", "text"])

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv_id").type
                yield b

        yield from _streamed(typed(), begin, finish, full)

    return ordered_rows(rows).mapInArrow(run, out_type)


def repair_audit(rows: DataFrame) -> DataFrame:
    """One row a conversation: its faults, the cost and letters of its edits, the digest of the repaired rows.

    ``rows`` has the columns of ``conversation_rows``. Columns: ``conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Rows
    that stand at one turn are taken by role and text, so equal rows are
    neighbours and all but the first are duplicates. A conversation whose rows
    all have ``copies`` 0 gets zeros, an empty audit and the digest of nothing.
    """
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out_type = f"conv_id {_key_type(rows)}, " + ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = None

        def begin(conv):
            letters, sha, any_row = [], hashlib.sha256(), False

            def settled(edit):
                nonlocal any_row
                letters.append(edit[0])
                if edit[0] != DELETE:
                    sha.update(f"{chr(10) if any_row else ''}{edit[1]}:{edit[3]}".encode())
                    any_row = True

            now = Conversation(settled)
            now.letters, now.sha = letters, sha
            return now

        def finish(conv, now):
            cost = now.search.close()
            out.append((conv, now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal, cost, "".join(now.letters), now.sha.hexdigest()))

        def full(end):
            if len(out) > (0 if end else 4096):
                arrays = [pa.array(c, t) for c, t in zip(zip(*out), (kind, *[pa.int64()] * 6, pa.string(), pa.string()))]
                out.clear()
                yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", *names, "audit", "repaired_sha256"])

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv_id").type
                yield b

        yield from _streamed(typed(), begin, finish, full)

    return ordered_rows(rows).mapInArrow(run, out_type)


def damaged(df: DataFrame) -> DataFrame:
    """``conversation_rows`` with seeded faults: by crc32 of ``conv_id:turn`` modulo 20 a row goes (0), loses its text (1) or
    its sentence ends (2), stands twice (3) or becomes the user's (4). Nulls read as one blank."""
    word = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(word.cast("binary")) % 20
    rows = conversation_rows(df)
    return rows.withColumn("_kind", kind).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


def repair_digest(conversations: DataFrame) -> DataFrame:
    """``repair_audit`` of the damaged table."""
    return repair_audit(damaged(conversations))
