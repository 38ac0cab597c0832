"""Conversation structure repair over a suffix-shared automaton.

Every row of a conversation becomes one letter: its role's initial and its first
fault. A conversation is then a word, its signature. Repairs are edits (Keep, Rerole,
Delete, Insert) that make the role initials read ``(s?(ua)+)?``.

Signatures are minimised from the end: equal ones collapse, and the distinct ones are
sorted by their reversal, so that those with a common ending are neighbours. A task
walks them as an incremental automaton is built, keeping the nodes of the current
ending on a stack. A node holds, for each grammar state, the least cost to go, the
next edit of the best audit and where it leads. It is computed when the ending first
comes up and then serves every conversation that ends so; a task repeats no more than
the nodes of one ending that its neighbour task shares.

Two edits of one row that start with the same letter lead to states of one node, so the
order of the audits of that node's states decides a tie: comparing audits never walks them.

Texts stay out of all this. Rows are sorted by conversation in spilling shuffles and
streamed: once to spell the signatures, once, behind the audit, to digest the repaired
conversation. A digest is sequential, so one conversation ends in one task, which
holds a letter for each of its rows but never their texts.

Defined cases: rows come by turn (nulls first), then role, then text; a null role or
text is one space, as is a null id or turn where the damage is drawn; rows without a
conversation id form one conversation; repeated rows are rows of their own, of which
all but the first are duplicates; a role that starts with none of ``s u a`` can only be
reroled or deleted; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import Scratch

#: What each edit costs, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: Grammar states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a role's initial leads to.
MOVES = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ACCEPTED = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}

#: Letter of a row that must go; the others are role initials, in capitals if truncated.
GONE = "-"
OTHER = "x"

#: Role initials that may follow each other.
LEGAL = ("su", "ua", "au")

FAULTS = ("blank", "duplicate", "truncated")
VISIBLE = r"[^\x20\x09-\x0D]"


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: rows after damage drawn by checksum; dropped ones are not present."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = (
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    )
    times = F.when(draw == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"),
        (draw != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def _said(role: str = "role", text: str = "text") -> Column:
    """Digest of a role and its text."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.col(text)), 256)


def marked(rows: DataFrame) -> DataFrame:
    """Add ``said``, ``initial`` and ``fault``.

    A row repeats an earlier one if the same was first said at a smaller turn. Only what
    is said at several turns is joined back, so a common text costs a grouped minimum.
    Rows that also share the turn are neighbours in the order and are told apart there.
    """
    rows = rows.withColumn("said", _said())
    place = F.struct("turn")
    firsts = (
        rows.where("present")
        .groupBy("conv_id", "said")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select(F.col("conv_id").alias("_c"), F.col("said").alias("_s"), F.col("first.turn").alias("_first"), F.lit(True).alias("_again"))
    )
    joined = rows.join(firsts, rows["conv_id"].eqNullSafe(F.col("_c")) & (rows["said"] == F.col("_s")), "left")
    last = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.rlike("text", F.lit(VISIBLE)), FAULTS[0])
        .when(F.col("_again") & ~F.col("turn").eqNullSafe(F.col("_first")), FAULTS[1])
        .when(~last.isin(".", "!", "?"), FAULTS[2])
    )
    return joined.select(*rows.columns, F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _in_order(frame: DataFrame, *before: str) -> DataFrame:
    """All rows of a conversation in one task, in its order."""
    return frame.repartition("conv_id").sortWithinPartitions("conv_id", *before, "turn", "role", "text")


def signatures(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, signature`` of the rows of ``marked``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["gaps", *FAULTS, "illegal"]

    class Reading:
        def __init__(self, conv_id):
            self.conv_id, self.letters, self.faults = conv_id, [], dict.fromkeys(FAULTS, 0)
            self.low = self.turn = self.said = self.initial = None
            self.turns = self.illegal = 0

        def add(self, turn, said, initial, fault):
            if fault != FAULTS[0] and said == self.said and turn == self.said_at:
                fault = FAULTS[1]  # the same row again
            self.said, self.said_at = said, turn
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn, self.turns = turn, self.turns + 1
            if fault:
                self.faults[fault] += 1
            if self.initial is not None:
                self.illegal += self.initial + initial not in LEGAL
            self.initial = initial
            letter = initial if initial in tuple("sua") else OTHER
            self.letters.append(GONE if fault in FAULTS[:2] else letter.upper() if fault else letter)

        def row(self):
            gaps = self.turn - self.low + 1 - self.turns if self.turns else 0
            return (self.conv_id, gaps, *self.faults.values(), self.illegal, "".join(self.letters))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(done):
            types = [schema[0], *[pa.int64()] * len(names), pa.string()]
            columns = zip(*(r.row() for r in done))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *names, "signature"]
            )

        now, done, schema = None, [], []
        for batch in batches:
            schema = [batch.schema.field("conv_id").type]
            for conv_id, turn, said, initial, fault, present in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now)
                    now = Reading(conv_id)
                if present:
                    now.add(turn, said, initial, fault)
            if done:
                yield packed(done)
                done = []
        if now is not None:
            yield packed([now])

    ordered = _in_order(rows).select("conv_id", "turn", "said", "initial", "fault", "present")
    counts = ", ".join(f"{c} long" for c in names)
    return ordered.mapInArrow(spell, f"conv_id {kind}, {counts}, signature string")


#: Of a node: per grammar state the cost to go, the next edit as (letter, state after it), and
#: the rank of its audit among the node's four.
Node = tuple[tuple[int, ...], tuple[tuple[str, int] | None, ...], tuple[int, ...]]


def _node(options: list[list[tuple[int, str, int, int]]], ended: bool) -> Node:
    """Close the ``(cost, letter, rank after, state after)`` options of each state over insertions."""
    best = [min(own, default=None) for own in options]
    if ended:
        best = [(0, "", 0, k) if k in ACCEPTED else None for k in MOVES]
    for _ in MOVES:  # an insertion costs, so a chain of them visits a state once
        for state, moves in MOVES.items():
            for role in ROLES:
                after = moves.get(role)
                if after is not None and best[after] is not None:
                    offer = (best[after][0] + INSERT, "I", 0, after)
                    if best[state] is None or offer[:2] < best[state][:2]:
                        best[state] = offer
    # An audit that starts with an insertion compares by what follows it at this very node.
    def spelt(state):
        _, letter, rank, after = best[state]
        return (letter, *spelt(after)) if letter == "I" else (letter, rank)

    order = sorted({spelt(k) for k in MOVES})
    return (
        tuple(b[0] for b in best),
        tuple((b[1], b[3]) if b[1] else None for b in best),
        tuple(order.index(spelt(k)) for k in MOVES),
    )


END = _node([[] for _ in MOVES], ended=True)


def grown(letter: str, after: Node) -> Node:
    """The node of an ending with one more row, ``letter``, in front."""
    costs, _, ranks = after
    initial, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
    options = []
    for state, moves in MOVES.items():
        own = [(DELETE + costs[state], "D", ranks[state], state)]
        if letter != GONE:
            to = moves.get(initial)
            if to is not None:
                own.append((extra + costs[to], "K", ranks[to], to))
            own += [
                (REROLE + extra + costs[moves[r]], "R", ranks[moves[r]], moves[r]) for r in ROLES if r in moves
            ]
        options.append(own)
    return _node(options, ended=False)


class Endings:
    """The nodes of the current ending, longest last, each with the cost it has in common.

    Costs matter only relative to each other, so there are few different nodes: a row in
    front of an equal node is a step that is computed once and then looked up.
    """

    def __init__(self):
        self.word, self.nodes, self.base, self.steps = "", [END], array("q", [0]), {}

    def move_to(self, word: str) -> int:
        """Go to the node of ``word``, read from its end, and return its cost.

        Nodes of the ending it shares with the word before stay.
        """
        low, high = 0, min(len(word), len(self.word))
        while low < high:  # longest common part, by halving
            middle = (low + high + 1) // 2
            if word[:middle] == self.word[:middle]:
                low = middle
            else:
                high = middle - 1
        del self.nodes[low + 1 :], self.base[low + 1 :]
        for letter in word[low:]:
            after = self.nodes[-1]
            step = self.steps.get((letter, after))
            if step is None:
                costs, edits, ranks = grown(letter, after)
                step = min(costs), (tuple(c - min(costs) for c in costs), edits, ranks)
                self.steps[letter, after] = step
            self.nodes.append(step[1])
            self.base.append(self.base[-1] + step[0])
        self.word = word
        return self.base[-1] + self.nodes[-1][0][START]

    def audit(self) -> str:
        out, state, k = [], START, len(self.nodes) - 1
        while True:
            edit = self.nodes[k][1][state]
            if edit is None:
                return "".join(out)
            out.append(edit[0])
            state = edit[1]
            k -= edit[0] != "I"


def audits(words: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of every distinct ``signature``: the cheapest edits, ASCII-least of equals."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for batch in batches:
            backward = batch.column("backward").to_pylist()
            found = [(endings.move_to(w), endings.audit()) for w in backward]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w[::-1] for w in backward], pa.string()),
                    pa.array([c for c, _ in found], pa.int64()),
                    pa.array([a for _, a in found], pa.string()),
                ],
                names=["signature", "cost", "audit"],
            )

    distinct = words.select("signature").distinct().select(F.reverse("signature").alias("backward"))
    ordered = distinct.repartitionByRange("backward").sortWithinPartitions("backward")
    return ordered.mapInArrow(walk, "signature string, cost long, audit string")


class Repair:
    """Digest of a conversation's repaired rows, one row at a time."""

    def __init__(self, values: dict):
        self.values, self.audit = values, values["audit"]
        self.at, self.state, self.digest, self.first = 0, START, hashlib.sha256(), True

    def _say(self, role: str, text: str) -> None:
        self.digest.update((role + ":" + text if self.first else "\n" + role + ":" + text).encode())
        self.first = False

    def _other(self) -> str:
        """Role that an insertion or a new role must give here."""
        role = next(r for r in ROLES if r in MOVES[self.state])
        self.state = MOVES[self.state][role]
        return ROLES[role]

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._say(self._other(), "")

    def add(self, role: str, text: str) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.state = MOVES[self.state][role[0]]
            self._say(role, text)
        elif edit == "R":
            self._say(self._other(), text)

    def row(self) -> dict:
        self._inserted()
        return self.values | {"repaired_sha256": self.digest.hexdigest()}


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """``plans (conv_id, ..., audit)`` with ``repaired_sha256`` of the rows of ``damaged``."""
    own = [c for c in plans.columns if c != "conv_id"]
    both = (
        rows.where("present").select("conv_id", "turn", "role", "text").withColumn("plan", F.lit(None).cast(plans.select(F.struct(*own)).schema[0].dataType))
        .unionByName(plans.select("conv_id", F.struct(*own).alias("plan")), allowMissingColumns=True)
        .withColumn("row", F.col("plan").isNull())
    )
    schema = ", ".join(f"`{c}` {plans.schema[c].dataType.simpleString()}" for c in plans.columns)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, types = None, None
        for batch in batches:
            kept = batch.schema.field("plan").type
            types = pa.schema([batch.schema.field("conv_id"), *kept, pa.field("repaired_sha256", pa.string())])
            done = []
            for conv_id, plan, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "plan", "role", "text"))):
                if plan is not None:
                    if now is not None:
                        done.append(now.row())
                    now = Repair({"conv_id": conv_id} | plan)
                else:
                    now.add(role, text)
            if done:
                yield pa.RecordBatch.from_pylist(done, types)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], types)

    ordered = _in_order(both, "row").select("conv_id", "plan", "role", "text")
    return ordered.mapInArrow(digest, f"{schema}, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows (conv_id, turn, role, text, present)``.

    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. A conversation without present rows has zeros, an empty audit
    and the digest of an empty string.
    """
    scratch = Scratch(rows.sparkSession, "turn-repair")
    rows = scratch.stored(rows, "rows")
    spelt = scratch.stored(signatures(marked(rows)), "signatures")
    plans = spelt.join(audits(spelt), "signature").select(
        "conv_id", "gaps", *FAULTS, "illegal", "cost", "audit"
    )
    return repaired(rows, plans)
