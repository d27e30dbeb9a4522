"""Conversation structure repair: the cheapest edits by Viterbi with survivor coalescence.

A conversation is to be a system row or none, then pairs of a user and an assistant row, or nothing at all.  Rows are
kept, given another role or deleted, and rows without text are inserted.  The decoder keeps, for each state of that
structure, the cheapest way so far (of equal ones that whose edit letters come first in ASCII).  The ways share a tree
of backpointers with reference counts.  A way that cannot become the cheapest any more is let go, and as soon as all
survivors share an ancestor, the edits up to it are certain and leave the decoder.  So a task holds what is unresolved,
not a conversation, and a conversation of any length passes as a stream.

Equal costs are decided by the whole unresolved letters: the survivors are kept in the order of these, which further
letters don't change, as no survivor's letters are the beginning of another's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.texts import sliced

# States by the role that came last, costs of the edits, ends of a sentence.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SENTENCE_ENDS = (b".", b"!", b"?")
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The role that follows a state, and pairs of initials that may stand side by side.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}
#: States after 0, 1 and 2 inserted rows; a third would only repeat a state.
INSERTED = {START: (START, USER, ASSISTANT), SYSTEM: (SYSTEM, USER, ASSISTANT), USER: (USER, ASSISTANT), ASSISTANT: (ASSISTANT, USER)}
#: By how much the cheapest rest from one state can be dearer than from another, whatever follows.
DEARER = {
    (START, SYSTEM): 0, (START, ASSISTANT): 0, (START, USER): 2, (SYSTEM, START): 4, (SYSTEM, ASSISTANT): 4, (SYSTEM, USER): 2,
    (USER, START): 5, (USER, SYSTEM): 2, (USER, ASSISTANT): 2, (ASSISTANT, START): 3, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): 2,
}
SOUND, BLANK, DUPLICATE, CUT = range(4)


class Node:
    """Edits of one row (inserted rows before it, then the row's own) in the tree of backpointers."""

    __slots__ = ("edits", "kids", "parent", "payload", "state")

    def __init__(self, parent: Node | None, edits: str, state: int, payload: tuple | None):
        self.parent, self.edits, self.state, self.payload = parent, edits, state, payload
        self.kids = 0  # references: nodes that point here, and one for a survivor
        if parent is not None:
            parent.kids += 1


class Decoder:
    """Rows one by one; ``push`` and ``finish`` yield ``(letter, role, payload)`` of the edits that have become certain.

    The role is None for deleted rows, the payload None for inserted ones.
    """

    def __init__(self):
        root = Node(None, "", START, None)
        root.kids = 1
        self.root = root
        # Survivors by state: cost, place in the order of letters, node.
        self.ways: dict[int, tuple[int, int, Node]] = {START: (0, 0, root)}
        self.cost = 0
        self.unresolved = 0

    def push(self, initial: str, fault: int, payload: tuple) -> Iterator[tuple]:
        best: dict[int, tuple[int, int, str, int]] = {}
        extra = TRUNCATED if fault == CUT else 0
        must_go = fault in (BLANK, DUPLICATE)
        for state, (cost, place, _) in self.ways.items():
            for inserted, before in enumerate(INSERTED[state]):
                paid, letters = cost + INSERT * inserted, "I" * inserted
                ways = [(before, paid + DELETE, letters + "D")]
                if not must_go:
                    after = NEXT[before]
                    ways.append((after, paid + REROLE + extra, letters + "R"))
                    if initial == ROLES[after][0]:
                        ways.append((after, paid + KEEP + extra, letters + "K"))
                    elif before == START and initial == "s":
                        ways.append((SYSTEM, paid + KEEP + extra, letters + "K"))
                for target, price, edits in ways:
                    found = (price, place, edits, state)
                    if target not in best or found < best[target]:
                        best[target] = found
        alive = {q: w for q, w in best.items() if not any(p != q and best[p][0] + DEARER[p, q] < w[0] for p in best)}
        places = {q: i for i, q in enumerate(sorted(alive, key=lambda q: alive[q][1:3]))}
        old, self.ways = self.ways, {}
        for q, (price, _, edits, state) in alive.items():
            node = Node(old[state][2], edits, q, payload)
            node.kids = 1
            self.ways[q] = (price, places[q], node)
        self.unresolved += 1
        for _, _, node in old.values():
            self._release(node)
        yield from self._certain()

    def finish(self) -> Iterator[tuple]:
        """The remaining edits; ``cost`` is then that of the whole conversation."""
        ends = []
        for state, (cost, place, _) in self.ways.items():
            for inserted, after in enumerate(INSERTED[state]):
                if after in (START, ASSISTANT):
                    ends.append((cost + INSERT * inserted, place, "I" * inserted, state))
        self.cost, _, letters, state = min(ends)
        last = self.ways[state][2]
        for q, (_, _, node) in self.ways.items():
            if q != state:
                self._release(node)
        self.ways = {state: (self.cost, 0, last)}
        yield from self._certain()
        for after in INSERTED[state][1 : 1 + len(letters)]:
            yield "I", ROLES[after], None

    @staticmethod
    def _release(node: Node | None) -> None:
        """Drop a reference; nodes that nothing refers to any more drop theirs."""
        while node is not None:
            node.kids -= 1
            if node.kids:
                return
            parent, node.parent = node.parent, None
            node = parent

    def _certain(self) -> Iterator[tuple]:
        """Edits down to the last node that all survivors share; it becomes the root."""
        node = shared = next(iter(self.ways.values()))[2]
        if len(self.ways) > 1:
            if self.root.kids > 1:
                return
            # All survivors are below one child of the root: go up from one of them to find how far.
            shared = None
            while node is not self.root:
                if node.kids > 1:
                    shared = node
                node = node.parent
            if shared is None:
                return
            node = shared
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        before = self.root.state
        for node in reversed(path):
            for after in INSERTED[before][1 : len(node.edits)]:
                yield "I", ROLES[after], None
                before = after
            letter, (role, _) = node.edits[-1], node.payload
            yield letter, None if letter == "D" else role if letter == "K" else ROLES[node.state], node.payload
            before = node.state
        self.unresolved -= len(path)
        shared.parent = None
        self.root = shared


class Conversation:
    """Counts of one conversation, and its edits as they become certain."""

    def __init__(self):
        self.decoder = Decoder()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns = 0
        self.first_turn = self.last_turn = None
        self.initial, self.digest = None, None

    def push(self, turn: int | None, role: str, text: bytes, digest: bytes, seen: bool) -> Iterator[tuple]:
        again = seen or (digest == self.digest and turn == self.last_turn)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            if self.first_turn is None:
                self.first_turn = turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.last_turn, self.initial, self.digest = turn, initial, digest
        whole = text.rstrip()
        fault = BLANK if not whole else DUPLICATE if again else SOUND if whole.endswith(SENTENCE_ENDS) else CUT
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == CUT
        yield from self.decoder.push(initial, fault, (role, text))

    @property
    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


_OWN = ["_conv", "_turn", "_role", "_text", "_digest", "_seen"]


def in_order(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows of each conversation together and by turn, with a mark for those whose role and text came at an earlier turn.

    The marks come from an aggregate over (conversation, digest), so that no task remembers the texts it has seen.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").cast("bigint").alias("_turn"), blank(role).alias("_role"), blank(text).alias("_text")
    )
    rows = rows.withColumn("_digest", F.unhex(F.md5(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"))))
    place = F.struct(F.col("_turn").isNotNull().alias("known"), F.col("_turn").alias("turn"))
    first = rows.groupBy("_conv", "_digest").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where("_first <> _last")
    first = first.select(F.col("_conv").alias("_c"), F.col("_digest").alias("_d"), "_first")
    marked = rows.join(first, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_digest") == F.col("_d")), "left")
    marked = marked.select(*_OWN[:-1], F.coalesce(place != F.col("_first"), F.lit(False)).alias("_seen"))
    return marked.repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text")


def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``(conversation, id, edits)`` for the edits that each row makes certain, and ``(conversation, id, None)`` at its end."""
    now, own = None, None
    for batch in batches:
        for part in sliced([batch]):
            ids, turns, roles, texts, digests, seen = (c.to_pylist() for c in part.columns)
            for k, conv in enumerate(ids):
                if now is None or conv != own:
                    if now is not None:
                        yield now, own, now.decoder.finish()
                        yield now, own, None
                    now, own = Conversation(), conv
                yield now, own, now.push(turns[k], roles[k], texts[k], digests[k], seen[k])
    if now is not None:
        yield now, own, now.decoder.finish()
        yield now, own, None


def _as_bytes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_text", F.col("_text").cast("binary"))


def repaired(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every edit of every conversation: ``conv``, place (from 0, in order), edit (K, R, D or I), role and text.

    K keeps a row, R gives it the named role, D deletes it (role and text NULL), I inserts a row with empty text.  NULL
    roles and texts count as one space, which no structure takes as a role and which is a blank text.  Rows are taken
    by turn (NULL first), then role, then text; rows of a NULL conversation are one conversation.  A repeated row is a
    duplicate of the first.  An empty table gives an empty one; further columns are not read.
    """
    rows = in_order(conversations, conv, turn, role, text)
    kind = rows.schema["_conv"].dataType.simpleString()
    schema = f"`{conv}` {kind}, place bigint, edit string, role string, text binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch: list[tuple] = []
        place, type_ = 0, None

        def out() -> pa.RecordBatch:
            columns = zip(*batch, strict=True)
            types = [type_, pa.int64(), pa.string(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[conv, "place", "edit", "role", "text"])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal type_
            for given in batches:
                type_ = given.schema.field(0).type
                yield given

        for _, own, edits in walk(typed()):
            if edits is None:
                place = 0
                continue
            for letter, new_role, payload in edits:
                batch.append((own, place, letter, new_role, None if letter == "D" else payload[1] if payload else b""))
                place += 1
            if len(batch) >= 1024:
                yield out()
                batch = []
        if batch:
            yield out()

    return _as_bytes(rows).mapInArrow(run, schema).withColumn("text", F.col("text").cast("string"))


def summaries(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: faults found, cost and letters of the cheapest edits, digest of the repaired rows.

    Rows are read as by ``repaired``.  gaps, blank, duplicate, truncated and illegal are counted before the repair; of a
    row's faults the first counts.  repaired_sha256 is that of the repaired ``role:text``, joined by newlines.  It is made
    as edits become certain: as a digest follows the order of the rows, one task streams a conversation and holds only
    what is unresolved.
    """
    rows = in_order(conversations, conv, turn, role, text)
    kind = rows.schema["_conv"].dataType.simpleString()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = [conv, *counts, "audit", "repaired_sha256"]
    schema = f"`{conv}` {kind}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        type_ = None

        def out() -> pa.RecordBatch:
            types = [type_, *[pa.int64()] * len(counts), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal type_
            for given in batches:
                type_ = given.schema.field(0).type
                yield given

        audit, digest, empty = bytearray(), hashlib.sha256(), True
        for now, own, edits in walk(typed()):
            if edits is not None:
                for letter, new_role, payload in edits:
                    audit += letter.encode()
                    if letter != "D":
                        digest.update(b"" if empty else b"\n")
                        digest.update(f"{new_role}:".encode())
                        digest.update(payload[1] if payload else b"")
                        empty = False
                continue
            found.append((own, now.gaps, now.blank, now.duplicate, now.truncated, now.illegal, now.decoder.cost, audit.decode(), digest.hexdigest()))
            audit, digest, empty = bytearray(), hashlib.sha256(), True
            if len(found) >= 1024:
                yield out()
                found = []
        if found:
            yield out()

    return _as_bytes(rows).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the damage that a checksum of conversation and turn names.

    Of ``crc32(conv_id:turn) % 20``, 0 drops a row, 1 empties its text, 2 removes ``. ! ?`` from it, 3 repeats it with the
    same turn, 4 makes it a user's.  NULLs stand as one space, also in the checksum.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.expr("if(kind = 3, 2, 1)").alias("times"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """A summary of every conversation of ``conversations`` after ``damaged``; one that lost all rows has zeros and no edits."""
    found = summaries(damaged(conversations))
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    whole = ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").withColumnRenamed("_id", "conv_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return whole.fillna(0, counts).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}).select(
        "conv_id", *counts, "audit", "repaired_sha256"
    )
