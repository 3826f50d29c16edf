"""Conversation repair by a Viterbi search whose survivors coalesce.

A conversation is well formed when its roles' initials read ``(s?(ua)+)?``. The
cheapest edits that get there are found row by row over four states (nothing yet,
after system, after user, after assistant); ties go to the ASCII-least string of
edits.

* **Survivors.** Each state keeps its cheapest path. A path is a chain of nodes, one
  per row, that shares its beginning with the others (backpointer tree); a node
  knows what stands on it and goes when the last of that goes.
* **Coalescence.** Once all survivors have one ancestor in common, the edits up to it
  are final: they are appended to the audit, their rows are hashed and dropped. Memory
  holds the rows that are still open, not the conversation.
* **Dominance.** A survivor goes as soon as another can do whatever it may still do at
  a strictly lower cost (``FOLLOW``). Without this the path that deletes everything
  would keep the tree open for ever.
* **Ties** compare the complete open suffixes of two paths. Inserts stand before the
  row's own edit, so each path ends in a row's edit and none is a prefix of another;
  their order is then settled by the order of their parents and the last step, and is
  kept as a rank per survivor instead of comparing the suffixes anew.

Spark shuffles the rows by conversation and sorts them; a task streams over its
sorted rows batch by batch and holds one conversation's open rows and 16 bytes per
distinct row (to know repeats). A conversation's audit and hash follow the order of its rows, so
one conversation is one task's stream however long it is; rows that alternate
without end between two equally cheap readings stay open until they end.

Defined cases: a null in any column reads as one space, but a null turn sorts first and
doesn't count for gaps, and a null conv_id is a conversation of its own; texts of any
length are used whole; repeated rows are duplicates; of rows with one turn the order
is by role, then text; a conversation without rows left has zeros, an empty audit and
the hash of nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
# fixed values of the task: costs of the edits
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: States: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state that an insert or a new role leads to.
TURNED = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Inserts that end a conversation in each state, and their cost.
ENDING = {EMPTY: "", SYSTEM: INSERT * 2, USER: INSERT, ASSISTANT: ""}
#: FOLLOW[y][x]: what it costs at most, from state y, to do as any path from state x does. An
#: insert or two reach another state; a system row that has no place any more is deleted (4).
FOLLOW = {
    EMPTY: {SYSTEM: 0, USER: 3, ASSISTANT: 6},
    SYSTEM: {EMPTY: 6, USER: 3, ASSISTANT: 6},
    USER: {EMPTY: 7, SYSTEM: 3, ASSISTANT: 3},
    ASSISTANT: {EMPTY: 4, SYSTEM: 0, USER: 3},
}
LEGAL = {"su", "ua", "au"}
OUTPUT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, rows long, most_open long"
)


def steps(initial: str, truncated: bool, must_go: bool) -> list[tuple[int, int, str, int]]:
    """(from, to, edits, cost) of one row, the best for each pair of states. Two inserts
    are the most that can help: a third leads to a state that one reaches."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    more = TRUNCATED_COST if truncated else 0
    for first in range(4):
        state = first
        for inserts in range(3):
            cost, done = inserts * COST[INSERT], INSERT * inserts
            options = [(state, done + DELETE, cost + COST[DELETE])]
            if not must_go:
                if (state, initial) in NEXT:
                    options.append((NEXT[state, initial], done + KEEP, cost + COST[KEEP] + more))
                options.append((TURNED[state], done + REROLE, cost + COST[REROLE] + more))
            for to, edits, price in options:
                best[first, to] = min(best.get((first, to), (price, edits)), (price, edits))
            state = TURNED[state]
    return [(a, b, edits, price) for (a, b), (price, edits) in best.items()]


STEPS = {(i, t, g): steps(i, t, g) for i in ("s", "u", "a", "") for t in (False, True) for g in (False, True)}


@dataclass(slots=True, eq=False)
class Node:
    """One row's edits on some path. ``children`` are the nodes that stand on it; a node
    without any that is no survivor goes."""

    parent: "Node | None"
    edits: str
    row: tuple[str, str] | None
    survivor: bool = True
    children: list["Node"] = field(default_factory=list)


@dataclass
class Repair:
    """One conversation's search: feed rows in order, then finish."""

    audit: list[str] = field(default_factory=list)
    digest: object = field(default_factory=hashlib.sha256)
    open: int = 0
    most_open: int = 0

    def __post_init__(self):
        self.root = Node(None, "", None)
        # state -> (cost, rank among the survivors, node)
        self.alive: dict[int, tuple[int, int, Node]] = {EMPTY: (0, 0, self.root)}
        self.state, self.lines = EMPTY, 0

    def feed(self, role: str, text: str, truncated: bool, must_go: bool) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        best: dict[int, tuple[int, int, str, Node]] = {}
        for first, to, edits, price in STEPS[initial, truncated, must_go]:
            if first in self.alive:
                cost, rank, node = self.alive[first]
                option = (cost + price, rank, edits)
                if to not in best or option < best[to][:3]:
                    best[to] = (*option, node)
        kept = [
            to for to in best
            if not any(best[y][0] + follow[to] < best[to][0] for y, follow in FOLLOW.items() if y in best and y != to)
        ]
        before, self.alive = self.alive, {}
        for rank, to in enumerate(sorted(kept, key=lambda s: best[s][1:3])):
            cost, _, edits, parent = best[to]
            node = Node(parent, edits, (role, text))
            parent.children.append(node)
            self.alive[to] = (cost, rank, node)
        for _, _, node in before.values():
            node.survivor = False
            self._drop(node)
        self.open += 1
        self._settle()
        self.most_open = max(self.most_open, self.open)

    def _drop(self, node: Node) -> None:
        """Remove what no survivor stands on."""
        while not node.children and not node.survivor and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            node = parent

    def _settle(self) -> None:
        """Emit the edits that all survivors share: the root moves down while it has one child."""
        while not self.root.survivor and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self._emit(self.root)
            self.root.parent = self.root.row = None
            self.open -= 1

    def _emit(self, node: Node) -> None:
        for edit in node.edits:
            if edit == DELETE:
                continue
            if edit == KEEP:
                self.state = NEXT[self.state, node.row[0][:1]]
                self._line(f"{node.row[0]}:{node.row[1]}")
            else:
                self.state = TURNED[self.state]
                self._line(f"{ROLE[self.state]}:{node.row[1] if edit == REROLE else ''}")
        self.audit.append(node.edits)

    def _line(self, line: str) -> None:
        if self.lines:
            self.digest.update(b"\n")
        self.digest.update(line.encode("utf-8", "surrogatepass"))
        self.lines += 1

    def finish(self) -> tuple[int, str, str]:
        """(cost, audit, hash of the repaired conversation)."""
        ends = [(cost + len(ENDING[s]) * COST[INSERT], rank, s, node) for s, (cost, rank, node) in self.alive.items()]
        cost, _, last, node = min(ends, key=lambda e: e[:2])
        chain = []
        while node is not self.root:
            chain.append(node)
            node = node.parent
        for node in reversed(chain):
            self._emit(node)
        self._emit(Node(None, ENDING[last], ("", "")))
        return cost, "".join(self.audit), self.digest.hexdigest()


class Conversation:
    """Counts and repair of one conversation, fed in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = None
        self.turns = self.rows = 0
        self.before: str | None = None
        self.seen: set[bytes] = set()
        self.repair = Repair()

    def feed(self, turn: int | None, role: str, text: str, last: str) -> None:
        """``last``: the text's last character that isn't white space ('' if it has none)."""
        self.rows += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        blank = last == ""
        name = hashlib.blake2b(f"{len(role)}:{role}:{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        duplicate = not blank and name in self.seen
        self.seen.add(name)
        truncated = not blank and not duplicate and last not in ".!?"
        self.counts["blank"] += blank
        self.counts["duplicate"] += duplicate
        self.counts["truncated"] += truncated
        self.repair.feed(role, text, truncated, blank or duplicate)

    def result(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        c = self.counts
        return (self.conv_id, gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], *self.repair.finish(), self.rows, self.repair.most_open)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(``conv_id:turn``) % 20 names;
    a dropped row stays as a mark (``gone``) so that its conversation isn't lost."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    named = F.concat(F.coalesce(conv.cast("string"), space), F.lit(":"), F.coalesce(turn.cast("string"), space))
    kind = F.crc32(named.cast("binary")) % 20

    def changed(kind: Column) -> Column:
        return F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)

    rows = conversations.select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind != 0, changed(kind)).alias("text"), (kind == 0).alias("gone"), F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation (``OUTPUT``) for rows conv_id, turn, role, text, gone."""
    tables.ship(rows.sparkSession)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        done: list[tuple] = []
        size = 0
        for batch in tables.each(batches):
            for conv, turn, role, text, last, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        done.append(now.result())
                        size += len(done[-1][7])
                    now = Conversation(conv)
                if not gone:
                    now.feed(turn, role, text, last)
                if len(done) >= 1000 or size > 1 << 22:
                    yield batch_of(done)
                    done, size = [], 0
        if now is not None:
            done.append(now.result())
        yield batch_of(done)

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        fields = [x.split() for x in OUTPUT.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kinds[kind]) for k, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])

    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    told = rows.select("conv_id", "turn", "role", "text", last.alias("last"), "gone")
    laid = told.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return laid.mapInArrow(streamed, OUTPUT)
