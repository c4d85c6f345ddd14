"""Conversation structure repair by iterative-deepening A*.

Rows of a conversation are kept, given the role user or assistant, or deleted, and rows without text
are inserted, so that the roles read an optional system turn and then pairs of user and assistant.
Four grammar states (nothing yet, after system, after user, after assistant) say what may follow.
The search is depth first, edits in ASCII order of their initials (D, I, K, R), under a cost bound that
rises until a path is accepted; the first one is the cheapest and, of those, the ASCII-least.  A
table holds the budget with which each state failed, for all later bounds too, so no state is
searched twice with one budget; the cost that deletions and truncated rows have at least prunes.

A long conversation is searched in segments.  An insertion belongs to the row after it, so a
segment's edits end with one of a row, no edit string of it starts another, and the cheapest whole path is put
together from the costs between the states at its ends.

Work on Spark: faults are SQL functions and a window; each conversation's rows then pass in order,
as two bytes a row and without their texts, to the search; a second pass meets the found edits
with the texts, which stream by.  The edits and the hash of a conversation are one value each, so the
rows of one conversation pass through one task, in order; of a conversation of any length that
task holds two bytes a row and its edits, never its texts.

Results for odd input: null roles and texts are one blank, and so are null ids and turns in the
damage's key; rows without a conv_id are one conversation; turns sort nulls first, equal turns by role and
then by the MD5 of the text; a role that does not begin with s, u or a never fits; a conversation
without rows has no edits; no rows give no rows.  Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What edits cost.  Fixed values.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Grammar states; a state after a row is also the number of its role's initial in ROLES.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = " sua"
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)
#: Faults of rows; the first two must be deleted.
FINE, CUT, BLANK, DUPLICATE = range(4)
SEGMENT_ROWS = 64
#: Segments whose answers are kept while one conversation is searched.
REMEMBERED = 4096
NO_WAY = 1 << 60

ROW_BYTES = "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32(conv_id:turn) % 20; a dropped row stays, marked.

    0 drops the row, 1 empties its text, 2 removes its [.!?], 3 repeats it, 4 sets the role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), blank)
    text = F.when(fault.isin(0, 1), "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), blank))
    times = F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1)))
    return conversations.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), (fault == 0).alias("dropped"), times.alias("times")
    ).drop("times")


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, dropped, fault), the first fault of each row that is not dropped."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    light = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), "dropped", blank.alias("is_blank"), ended.alias("ended"))
    same = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy("turn")
    fault = F.when(F.col("is_blank"), BLANK).when(F.row_number().over(same) > 1, DUPLICATE).when(F.col("ended"), FINE).otherwise(CUT)
    return light.repartition("conv_id").select("conv_id", "turn", "role", "digest", "dropped", fault.alias("fault"))


# -- the search -------------------------------------------------------------------------------


class Search:
    """The cheapest edits of some rows from one grammar state to another.

    `kinds` and `faults` are bytes, one a row: the place of the role's initial in ROLES (0: none),
    and the fault.  With `goal` None the rows are the last of their conversation.
    """

    def __init__(self, kinds: bytes, faults: bytes, goal: int | None):
        self.kinds, self.faults, self.goal = kinds, faults, goal
        self.rest = [0]
        for fault in reversed(faults):
            self.rest.append(self.rest[-1] + (DELETE if fault >= BLANK else TRUNCATED if fault == CUT else 0))
        self.rest.reverse()
        self.failed: dict[tuple[int, int], int] = {}

    def run(self, state: int) -> tuple[int, str]:
        """(cost, edits), or a cost of NO_WAY."""
        most = DELETE * len(self.faults) + 2 * INSERT
        for bound in range(self.rest[0], most + 1):
            path: list[str] = []
            if self.reach(0, state, bound, path):
                return bound, "".join(reversed(path))
        return NO_WAY, ""

    def accepts(self, state: int) -> bool:
        return state in (START, ASSISTANT) if self.goal is None else state == self.goal

    def reach(self, row: int, state: int, budget: int, path: list[str]) -> bool:
        """Whether the goal can be reached within the budget; path then holds the edits, last first."""
        if budget < self.rest[row] or budget <= self.failed.get((row, state), -1):
            return False
        if row == len(self.faults):
            if self.accepts(state):
                return True
            edits = ((INSERT, "I", row, NEXT[state]),) if self.goal is None else ()
        else:
            edits = self.edits(row, state)
        for cost, initial, then, after in edits:
            if self.reach(then, after, budget - cost, path):
                path.append(initial)
                return True
        self.failed[row, state] = budget
        return False

    def edits(self, row: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        """The edits possible at a row, in ASCII order: cost, initial, next row, next state."""
        yield DELETE, "D", row + 1, state
        yield INSERT, "I", row, NEXT[state]
        fault, kind = self.faults[row], self.kinds[row]
        if fault < BLANK:
            cut = TRUNCATED if fault == CUT else 0
            if kind and (kind == NEXT[state] or (kind == SYSTEM and state == START)):
                yield cut, "K", row + 1, kind
            yield REROLE + cut, "R", row + 1, NEXT[state]


def between(kinds: bytes, faults: bytes, known: dict) -> list[list[tuple[int, str]]]:
    """For each state before some rows and each after them, the cheapest edits; `known` has recent answers."""
    if (kinds, faults) in known:
        return known[kinds, faults]
    found = [[(NO_WAY, "")] * 4 for _ in range(4)]
    for goal in range(4):
        search = Search(kinds, faults, goal)
        for state in range(4):
            if goal >= USER or state <= goal and state in (START, goal):
                found[state][goal] = search.run(state)
    if len(known) >= REMEMBERED:
        known.clear()
    known[kinds, faults] = found
    return found


def cheapest_edits(kinds: bytes, faults: bytes, segment: int = SEGMENT_ROWS) -> tuple[int, str]:
    """(cost, edits) of a whole conversation."""
    starts = list(range(0, max(len(kinds), 1), segment))
    last = Search(kinds[starts[-1] :], faults[starts[-1] :], None)
    if len(starts) == 1:
        return last.run(START)
    known: dict = {}
    parts = [(bytes(kinds[i : i + segment]), bytes(faults[i : i + segment])) for i in starts[:-1]]
    costs = [[last.run(state)[0] for state in range(4)]]
    for part in reversed(parts):
        after = costs[-1]
        costs.append([min(cost + after[goal] for goal, (cost, _) in enumerate(row)) for row in between(*part, known)])
    costs.reverse()
    state, edits = START, []
    for k, part in enumerate(parts):
        ways = [(path, goal) for goal, (cost, path) in enumerate(between(*part, known)[state]) if cost + costs[k + 1][goal] == costs[k][state]]
        path, state = min(ways)
        edits.append(path)
    return costs[0][START], "".join(edits) + last.run(state)[1]


# -- whole tables -----------------------------------------------------------------------------


class Conversation:
    """What is known of a conversation while its rows pass."""

    def __init__(self) -> None:
        self.kinds, self.faults = bytearray(), bytearray()
        self.illegal, self.turns = 0, 0
        self.first = self.last = None

    def add(self, turn: int | None, role: str, fault: int) -> None:
        kind = max(ROLES.find(role[:1]), 0) if role[:1] else 0
        if self.kinds and (self.kinds[-1], kind) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
            self.illegal += 1
        self.kinds.append(kind)
        self.faults.append(fault)
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn

    def values(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        cost, audit = cheapest_edits(bytes(self.kinds), bytes(self.faults))
        n = self.faults.count
        return gaps, n(BLANK), n(DUPLICATE), n(CUT), self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    schema = ROW_BYTES.format(id=rows.schema["conv_id"].dataType.simpleString())
    ordered = with_faults(rows).sortWithinPartitions("conv_id", "turn", "role", "digest", "fault")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        def finished():
            return (current, *conversation.values())

        current, conversation, done = None, None, []
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv_id", "turn", "role", "dropped", "fault"))
            for conv_id, turn, role, dropped, fault in zip(*columns):
                if conversation is None or conv_id != current:
                    if conversation is not None:
                        done.append(finished())
                    current, conversation = conv_id, Conversation()
                if not dropped:
                    conversation.add(turn, role, fault)
            if done:
                yield _batch(done, names, batch.schema.field("conv_id").type)
                done = []
        if conversation is not None:
            yield _batch([finished()], names, batch.schema.field("conv_id").type)

    return ordered.select("conv_id", "turn", "role", "dropped", "fault").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    columns = dict(zip(names, zip(*rows)))
    types = {"conv_id": id_type, "audit": pa.string(), "edit": pa.string(), "role": pa.string(), "text": pa.string(), "repaired_sha256": pa.string()}
    return pa.record_batch({name: pa.array(values, types.get(name, pa.int64())) for name, values in columns.items()})


def _edited(conv_ids, audit_rows, roles, texts, state: dict) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of the repaired rows that these ordered rows give; state goes on."""
    for conv_id, audit, role, text in zip(conv_ids, audit_rows, roles, texts):
        if audit is not None:
            yield from _inserted(state)
            state.update(conv_id=conv_id, audit=audit, at=0, grammar=START)
            yield conv_id, "", "", ""
            continue
        yield from _inserted(state)
        edit = state["audit"][state["at"]]
        state["at"] += 1
        if edit == "R":
            state["grammar"] = NEXT[state["grammar"]]
            yield conv_id, edit, ROLE_NAMES[state["grammar"]], text
        elif edit == "K":
            state["grammar"] = ROLES.index(role[0])
            yield conv_id, edit, role, text


def _inserted(state: dict) -> Iterator[tuple]:
    """The insertions before the next row, or before the end."""
    while state and state["audit"][state["at"] : state["at"] + 1] == "I":
        state["at"] += 1
        state["grammar"] = NEXT[state["grammar"]]
        yield state["conv_id"], "I", ROLE_NAMES[state["grammar"]], ""


def _with_texts(rows: DataFrame, audited: DataFrame, run: Callable, schema: str) -> DataFrame:
    """The rows of each conversation in order, after the row with its audit."""
    texts = rows.where("not dropped").select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", F.md5("text").alias("digest"))
    head = audited.select("conv_id", "audit", *(F.lit(None).cast(t).alias(c) for c, t in (("turn", "bigint"), ("role", "string"), ("text", "string"), ("digest", "string"))))
    both = head.union(texts).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "digest")
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The rows after repair: conv_id, position (from 0), edit (K, R or I), role, text."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, position bigint, edit string, role string, text string"

    def run(batches):
        state, position, kind = {}, 0, None

        def placed(events):
            nonlocal position
            for conv_id, edit, role, text in events:
                if edit:
                    yield conv_id, position, edit, role, text
                position = position + 1 if edit else 0

        names = ["conv_id", "position", "edit", "role", "text"]
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for k in range(0, batch.num_rows, 1024):
                columns = [batch[c].slice(k, 1024).to_pylist() for c in ("conv_id", "audit", "role", "text")]
                if out := list(placed(_edited(*columns, state))):
                    yield _batch(out, names, kind)
        if out := list(placed(_inserted(state))):
            yield _batch(out, names, kind)

    return _with_texts(rows, audited, run, schema)


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the hash of a conversation's repaired role:text, newline-joined."""
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"

    def run(batches):
        state, kind = {}, None
        current, digest, some = None, None, False
        names = ["conv_id", "repaired_sha256"]

        def hashed(events):
            nonlocal current, digest, some
            for conv_id, edit, role, text in events:
                if not edit:
                    if digest is not None:
                        yield current, digest.hexdigest()
                    current, digest, some = conv_id, hashlib.sha256(), False
                    continue
                digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                some = True

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for k in range(0, batch.num_rows, 1024):
                columns = [batch[c].slice(k, 1024).to_pylist() for c in ("conv_id", "audit", "role", "text")]
                if out := list(hashed(_edited(*columns, state))):
                    yield _batch(out, names, kind)
        out = list(hashed(_inserted(state)))
        if digest is not None:
            yield _batch([*out, (current, digest.hexdigest())], names, kind)

    return _with_texts(rows, audited, run, schema)
