"""Repair of turn structure: a suffix-shared automaton over the role and fault signatures of conversations.

A conversation is a word with one letter for each row: its role, and whether it is whole, truncated
or to be deleted. Edits turn roles into `(s?(ua)+)?`. What an ending costs depends on nothing before
it but the state of that grammar, so endings are shared: a node of the automaton is a distinct
ending, and for each node and state the least cost to go and the first edit of the best audit are
computed once. Signatures come sorted by their reversed letters, so that equal endings are
neighbours and the nodes of one signature are all that is held; a range is cut by conversation too,
so a signature that a third of them share is many tasks' work.

Rows are streamed: one pass over narrow rows makes signatures, one over the texts applies the audits.
A conversation's digest is defined over its whole repaired text, so its rows pass one task in
order; held of it are its signature and audit, which are a row of the result anyway.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.batches import keep, small_batches

WHITE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
LETTERS = "DIKR"  # ascending, as ties go to the least
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a. What u or a leads to from each:
_ONWARD = (2, 2, 3, 2)
_ROLE_TO = ("", "", "user", "assistant")
_KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_NEVER = 1 << 60
MUST_GO = "x"


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped, after damage by crc32 of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 makes it the
    user's. Nulls stand for one space in that key, in roles and in texts; a null turn stays null.
    Dropped rows stay, marked, so that their conversations are known.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        (fault == 0).alias("dropped"),
        times.alias("copy"),
    ).drop("copy")


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def _narrow(rows: DataFrame) -> DataFrame:
    """Rows without texts, each with its place in the order and its first fault (b, d, t or none), by conversation."""
    stripped = F.rtrim(F.col("text"), F.lit(WHITE))
    cut = rows.select(
        "conv_id",
        "turn",
        _initial(F.col("role")).alias("initial"),
        "role",
        F.md5(F.col("text").cast("binary")).alias("digest"),
        "dropped",
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    same = Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(F.asc_nulls_first("turn"))
    numbered = cut.repartition("conv_id").withColumn("nth", F.row_number().over(same))
    fault = F.when(F.col("blank"), "b").when(F.col("nth") > 1, "d").when(F.col("truncated"), "t").otherwise("")
    placed = numbered.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest", "nth")
    return placed.select("conv_id", "turn", "initial", "dropped", fault.alias("fault"))


def letter(initial: str, fault: str) -> str:
    """A row's letter: x if it must go, its role's initial (o for a role of no grammar) if whole, in upper case if truncated."""
    if fault in ("b", "d"):
        return MUST_GO
    own = initial if initial in _KEPT else "o"
    return own.upper() if fault == "t" else own


_SIGNED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, signature string"


class _Signer:
    """Counts and letters of one conversation whose rows come in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.letters, self.before = conv_id, [], None
        self.faults = {"b": 0, "d": 0, "t": 0, "": 0}
        self.illegal = self.turns = 0
        self.least = self.last = None

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self.letters.append(letter(initial, fault))
        self.faults[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last, self.turns = turn, self.turns + 1

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return self.conv_id, gaps, self.faults["b"], self.faults["d"], self.faults["t"], self.illegal, "".join(self.letters)


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    names = [f.split() for f in fields.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(names)], [n for n, _ in names])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for conv_id, turn, initial, dropped, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv_id != now.conv_id:
                done += [now.row()] if now else []
                now = _Signer(conv_id)
            if not dropped:
                now.add(turn, initial, fault)
        if done:
            yield _batch(done, _SIGNED)
    if now:
        yield _batch([now.row()], _SIGNED)


class SuffixAutomaton:
    """Endings of signatures as nodes, of which those of the latest signature are held.

    Node k is its ending of k letters: costs to go from the four states, and the first edit for
    each, two bits a state. A node is made once as long as signatures come in order of their
    reversed letters.
    """

    def __init__(self):
        self.costs, self.edits = array("q"), bytearray()
        self.reversed, self.made = "", 0
        self._push((0, _NEVER, _NEVER, 0), (0, 0, 0, 0))

    def _push(self, base: tuple, firsts: tuple) -> None:
        """A node from its best costs without a leading insertion; each way of inserting is longer by one at most two times."""
        best = list(zip(base, firsts))
        for _ in range(2):
            best = [min(own, (INSERT + best[_ONWARD[q]][0], 1)) for q, own in enumerate(best)]
        self.costs.extend(c for c, _ in best)
        self.edits.append(sum(e << (2 * q) for q, (_, e) in enumerate(best)))
        self.made += 1

    def _extend(self, sign: str) -> None:
        after = self.costs[-4:]
        base, firsts = [], []
        for q in range(4):
            ways = [(DELETE + after[q], 0)]
            if sign != MUST_GO:
                extra = TRUNCATED if sign.isupper() else 0
                to = _KEPT.get(sign.lower(), (None,) * 4)[q]
                if to is not None:
                    ways.append((extra + after[to], 2))
                ways.append((REROLE + extra + after[_ONWARD[q]], 3))
            cost, first = min(ways)
            base.append(cost)
            firsts.append(first)
        self._push(tuple(base), tuple(firsts))

    def repair(self, signature: str) -> tuple[int, str]:
        """Least cost and its ASCII-least audit."""
        turned = signature[::-1]
        if turned != self.reversed:
            common = 0
            for a, b in zip(turned, self.reversed):
                if a != b:
                    break
                common += 1
            del self.costs[4 * (common + 1) :], self.edits[common + 1 :]
            for sign in turned[common:]:
                self._extend(sign)
            self.reversed = turned
        audit, state, left = [], 0, len(signature)
        while left or state not in (0, 3):
            edit = self.edits[left] >> (2 * state) & 3
            audit.append(LETTERS[edit])
            if edit in (1, 3):
                state = _ONWARD[state]
            elif edit == 2:
                state = _KEPT[turned[left - 1].lower()][state]
            left -= edit != 1
        return self.costs[4 * len(signature)], "".join(audit)


_REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, before, found = SuffixAutomaton(), None, (0, "")
    for batch in batches:
        rows = []
        for *figures, signature in zip(*(c.to_pylist() for c in batch.columns)):
            if signature != before:
                before, found = signature, automaton.repair(signature)
            rows.append((*figures, *found))
        yield _batch(rows, _REPAIRED)


class _Repairer:
    """Applies an audit to the rows of a conversation as they pass."""

    def __init__(self, figures: tuple):
        self.figures, self.audit = figures, figures[-1]
        self.at = self.state = 0
        self.sha, self.first = hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = _ONWARD[self.state]
            self._write(_ROLE_TO[self.state], "")

    def add(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _KEPT[role[0]][self.state]
            self._write(role, text)
        elif edit == "R":
            self.state = _ONWARD[self.state]
            self._write(_ROLE_TO[self.state], text)

    def row(self) -> tuple:
        self._insert()
        return *self.figures, self.sha.hexdigest()


_RESULT = f"{_REPAIRED}, repaired_sha256 string"


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation: its figures first, then its rows in order."""
    now = None
    for batch in small_batches(batches):
        done = []
        for is_row, role, text, *figures in zip(*(batch.column(c).to_pylist() for c in ["is_row", "role", "text", *[f.split()[0] for f in _REPAIRED.split(", ")]])):
            if is_row:
                now.add(role, text)
            else:
                done += [now.row()] if now else []
                now = _Repairer(tuple(figures))
        if done:
            yield _batch(done, _RESULT)
    if now:
        yield _batch([now.row()], _RESULT)


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id, figures, cost, audit and repaired_sha256 of every conversation in `rows`.

    `rows` has conv_id, turn, role, text and dropped, as `damage` leaves them. Rows are taken by turn,
    nulls first; those of one turn by role, then by md5 of the text. A role whose initial is not s, u or a
    (an empty one too) can be changed or deleted, not kept. Rows without a conv_id are one
    conversation. A conversation whose rows are all dropped has zeros, no audit and the digest of
    nothing. Extra columns are not looked at; an empty table gives no rows.
    """
    signed = keep(_narrow(rows).mapInArrow(_signatures, _SIGNED), "signatures")
    turned = signed.withColumn("turned", F.reverse("signature"))
    ranged = turned.repartitionByRange("turned", "conv_id").sortWithinPartitions("turned").drop("turned")
    figures = ranged.mapInArrow(_audits, _REPAIRED)
    empty = {c: F.lit(None).cast(t) for c, t in [("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "string")]}
    left = rows.where("NOT dropped").select("conv_id", "turn", "role", "text", F.md5(F.col("text").cast("binary")).alias("digest"), F.lit(1).alias("is_row"))
    stream = left.unionByName(figures.withColumns(empty).withColumn("is_row", F.lit(0)), allowMissingColumns=True)
    placed = stream.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", F.asc_nulls_first("turn"), "role", "digest")
    return placed.drop("digest", "turn").mapInArrow(_applied, _RESULT)
