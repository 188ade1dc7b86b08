"""Cheapest repair of conversations over a suffix-shared automaton.

A repaired conversation has the role initials ``(s?(ua)+)?``. Rows can be kept (0), given
the other role (Rerole, 2) or left out (Delete, 3; blank rows and repeated ones must be),
and empty user or assistant rows can be inserted anywhere (2); a truncated row that stays
costs 1 more. Of the cheapest ways the one whose edit initials sort first is taken.

A row's signature is one letter: its role, and whether it must go or is truncated. Equal
signatures of whole conversations are one, so copies are worked out once. The distinct
ones are range-sorted by their reversal: those with equal ends lie side by side, and a
task keeps the automaton's nodes of the current end on a stack. Every distinct end is one
node; for each grammar state it holds the cost to go and the first edit of the best way,
whose rest is the node after it. Two ways from one node differ in their first edit, so
ties are settled there.

Conversations of any length spread over tasks: rows are range-sorted by conversation and
turn and packed into blocks of at most ``BLOCK_ROWS`` rows. A block in the middle of a
conversation is worked out for each state that it may leave in; only those 16 costs a
block come together to choose the states at the block ends.

Rules: NULL role or text counts as one space; a NULL id is a conversation of its own.
Rows stand by turn, NULL first, rows of one turn by a hash of role and text. A role that
does not begin with s, u or a, or is empty, cannot be kept. A role and text seen earlier
(by MD5) are a duplicate; rows that are equal in everything are told apart and all but
one are duplicates. An empty table gives empty results. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sentilake.llm.common import slices
from sentilake.session import materialize

#: What the edits cost.
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
SPACES = r"\x20\x09-\x0D"

#: Grammar states: nothing yet, after system, after user, after assistant. The first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: Role that must come next in a state (other than system at the start), and where it leads.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (USER, USER, ASSISTANT, USER)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEVER = 1 << 50


# The automaton

class Node(NamedTuple):
    """Cost to go and first edit (empty at the end) for each grammar state."""

    cost: list[int]
    edit: list[str]


def end_node(leave: int | None) -> Node:
    """The end of a conversation, or of a block that is left in the state ``leave``."""
    if leave is not None:
        return Node([0 if q == leave else NEVER for q in range(4)], [""] * 4)
    return with_inserts([0 if q in ACCEPTING else NEVER for q in range(4)], [""] * 4)


def with_inserts(cost: list[int], edit: list[str]) -> Node:
    """The node, when rows may also be inserted before what it stands for."""
    best = list(cost)
    for _ in range(3):  # states lie at most three inserts apart
        best = [min(c, INSERT + best[NEXT_STATE[q]]) for q, c in enumerate(best)]
    first = []
    for q, c in enumerate(best):
        ways = [edit[q]] if cost[q] == c else []
        if c < NEVER and INSERT + best[NEXT_STATE[q]] == c:
            ways.append("I")
        first.append(min(ways))
    return Node([min(c, NEVER) for c in best], first)


def before(symbol: str, after: Node) -> Node:
    """The node of a row in front of the node ``after``."""
    role, late = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    cost, edit = [], []
    for q in range(4):
        ways = [(DELETE + after.cost[q], "D")]
        if role != "d":
            if (q, role) in KEPT:
                ways.append((late + after.cost[KEPT[q, role]], "K"))
            ways.append((RETYPE + late + after.cost[NEXT_STATE[q]], "R"))
        c, e = min(ways)
        cost.append(min(c, NEVER)), edit.append(e)
    return with_inserts(cost, edit)


def follow(symbols: str, nodes: list[Node], state: int) -> str:
    """The edits from the front: ``nodes`` has the end first, then one node per symbol from the last."""
    edits, left = [], len(symbols)
    while True:
        edit = nodes[left].edit[state]
        if not edit:
            return "".join(edits)
        edits.append(edit)
        if edit == "I":
            state = NEXT_STATE[state]
            continue
        if edit != "D":
            state = KEPT[state, symbols[-left].lower()] if edit == "K" else NEXT_STATE[state]
        left -= 1


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct ``(last, symbols)`` sorted by the reversed symbols, to costs and edits.

    Entry ``q`` for the last block of a conversation, ``4 * q + leave`` for others. For
    equal costs ``rank`` tells which of the states to leave in has the edits that sort
    first.
    """
    stacks: dict[int | None, list[Node]] = {}
    known = {True: "", False: ""}
    for batch in slices(batches, 1024):
        rows = []
        for last, symbols in zip(*(batch.column(c).to_pylist() for c in ("last", "symbols"))):
            ends = (None,) if last else range(4)
            shared, seen = 0, known[last]
            for a, b in zip(reversed(seen), reversed(symbols)):
                if a != b:
                    break
                shared += 1
            known[last] = symbols
            for leave in ends:
                nodes = stacks.setdefault(leave, [end_node(leave)])
                del nodes[shared + 1 :]
                for symbol in reversed(symbols[: len(symbols) - shared]):
                    nodes.append(before(symbol, nodes[-1]))
            cost, edits = [], []
            for q in range(4):
                for leave in ends:
                    top = stacks[leave][-1].cost[q]
                    cost.append(top)
                    edits.append(follow(symbols, stacks[leave], q) if top < NEVER else None)
            width = len(ends)
            rank = [0] * len(cost)
            for q in range(4):
                own = sorted(range(width), key=lambda r: (edits[q * width + r] is None, edits[q * width + r] or ""))
                for place, r in enumerate(own):
                    rank[q * width + r] = place
            rows.append((last, symbols, cost, rank, edits))
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("last", "symbols", "cost", "rank", "edits"), map(list, zip(*rows)))), SOLVED)


SOLVED = pa.schema([("last", pa.bool_()), ("symbols", pa.string()), ("cost", pa.list_(pa.int64())),
                    ("rank", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))])


def choose(blocks: pa.Table) -> pa.Table:
    """Entry of ``cost`` and ``edits`` for each block of one conversation, and the conversation's cost."""
    at = sorted(range(blocks.num_rows), key=lambda i: (blocks.column("part")[i].as_py(), blocks.column("no")[i].as_py()))
    cost, rank = blocks.column("cost").to_pylist(), blocks.column("rank").to_pylist()
    to_go, ways = cost[at[-1]], []
    for i in reversed(at[:-1]):
        way = [min((cost[i][4 * q + r] + to_go[r], rank[i][4 * q + r], r) for r in range(4)) for q in range(4)]
        to_go = [min(w[0], NEVER) for w in way]
        ways.append([w[2] for w in way])
    state, entry = START, {}
    for i, way in zip(at[:-1], reversed(ways)):
        entry[i] = 4 * state + way[state]
        state = way[state]
    entry[at[-1]] = state
    return pa.table({
        "part": blocks.column("part"), "no": blocks.column("no"), "entry": pa.array([entry[i] for i in range(blocks.num_rows)], pa.int32()),
        "total": pa.array([to_go[START]] * blocks.num_rows, pa.int64())})


# Rows and blocks

def conversation_key(id: Column) -> Column:
    """NULL first; never NULL."""
    return F.coalesce(F.concat(F.lit("="), id.cast("string")), F.lit(""))


def blocks_of(rows: DataFrame, id: str, turn: str, role: str, text: str) -> DataFrame:
    """Consecutive rows of a conversation, in order, with what their summary needs."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    given = rows.select(F.col(id).alias("id"), conversation_key(F.col(id)).alias("key"), F.col(turn).cast("long").alias("turn"),
                        plain(role).alias("role"), plain(text).alias("text"))
    given = given.withColumns({"digest": F.unhex(F.md5(F.concat(F.md5("role"), F.md5("text")))), "row": F.monotonically_increasing_id()})
    # Written so that a row keeps its number.
    given = materialize(given, "repair_rows")
    first = given.groupBy("key", "digest").agg(F.min(F.struct("turn", "row")).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("key", "digest", F.col("first.row").alias("first_row"))
    found = given.join(first, ["key", "digest"], "left")
    blank = ~F.col("text").rlike(f"[^{SPACES}]")
    repeated = F.coalesce(F.col("row") != F.col("first_row"), F.lit(False))
    cut = ~F.col("text").rlike(rf"[.!?][{SPACES}]*\z")
    fault = F.when(blank, 1).when(repeated, 2).when(cut, 3).otherwise(0)
    order = ["key", "turn", "digest", "row"]
    placed = found.withColumn("fault", fault).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    packed = placed.select("key", "id", "turn", "role", "text", "fault").mapInArrow(
        pack, f"key string, id {kind}, part int, no int, symbols string, roles array<string>, texts array<string>, faults array<long>,"
              " illegal long, low long, high long, turns long, first_turn long, last_turn long, first_role string, last_role string")
    return materialize(packed, "repair_blocks")


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, no, key, block, size = TaskContext.get().partitionId(), 0, None, [], 0

    def packed() -> dict:
        roles, turns = [r[2] for r in block], [r[1] for r in block if r[1] is not None]
        faults = [r[4] for r in block]
        initials = [r[:1] for r in roles]
        return {
            "key": key, "id": block[0][0], "part": part, "no": no, "symbols": "".join(map(symbol, initials, faults)), "roles": roles,
            "texts": [r[3] for r in block], "faults": [faults.count(f) for f in (1, 2, 3)],
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
            "first_turn": block[0][1], "last_turn": block[-1][1], "first_role": initials[0], "last_role": initials[-1]}

    for batch in slices(batches):
        ready = []
        for own, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if block and (own != key or len(block) >= BLOCK_ROWS or size >= BLOCK_BYTES):
                ready.append(packed())
                block, size, no = [], 0, no + 1
            key = own
            block.append(row)
            size += len(row[3])
        if ready:
            yield rows_to_batch(ready, batch.schema.field("id").type)
    if block:
        yield rows_to_batch([packed()], batch.schema.field("id").type)


def symbol(initial: str, fault: int) -> str:
    if fault in (1, 2):
        return "d"
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if fault == 3 else known


def rows_to_batch(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    texts, numbers = pa.list_(pa.string()), pa.int64()
    types = {"key": pa.string(), "id": kind, "part": pa.int32(), "no": pa.int32(), "symbols": pa.string(), "roles": texts,
             "texts": texts, "faults": pa.list_(numbers), "first_role": pa.string(), "last_role": pa.string()}
    return pa.RecordBatch.from_pylist(rows, pa.schema([(name, types.get(name, numbers)) for name in rows[0]]))


class Repair(NamedTuple):
    """``summary``: a row per conversation; ``blocks``: its rows with their edits, in order of ``part, no``."""

    summary: DataFrame
    blocks: DataFrame


def repair(rows: DataFrame, *, id="conv_id", turn="turn", role="role", text="text") -> Repair:
    """``summary(key, id, gaps, blank, duplicate, truncated, illegal, cost)`` and
    ``blocks(key, id, part, no, alone, state, edits, roles, texts)``; ``state`` is the
    grammar state in which a block begins, ``alone`` tells a conversation of one block."""
    blocks = blocks_of(rows, id, turn, role, text)
    in_order = W.partitionBy("key").orderBy("part", "no")
    narrow = blocks.drop("roles", "texts").withColumns({
        "last": F.lead("no").over(in_order).isNull(), "alone": F.count("*").over(W.partitionBy("key")) == 1,
        "seam": F.concat(F.lag("last_role").over(in_order), F.col("first_role")),
        "same_turn": F.coalesce(F.lag("last_turn").over(in_order) == F.col("first_turn"), F.lit(False))})
    narrow = materialize(narrow, "repair_narrow")
    # Signatures with equal ends go to one task, and lie side by side there.
    backwards = F.reverse("symbols")
    solved = narrow.select("last", "symbols").distinct().repartitionByRange("last", backwards).sortWithinPartitions(
        "last", backwards).mapInArrow(solve, "last boolean, symbols string, cost array<long>, rank array<long>, edits array<string>")
    solved = materialize(solved, "repair_solved")
    priced = narrow.select("key", "part", "no", "last", "alone", "symbols").join(solved, ["last", "symbols"])
    many = priced.where("not alone").select("key", "part", "no", "cost", "rank").groupBy("key").applyInArrow(
        choose, "part int, no int, entry int, total long")
    single = priced.where("alone").select("part", "no", F.lit(START).alias("state"), F.col("edits")[START].alias("edits"), F.col("cost")[START].alias("total"))
    state = F.when(F.col("last"), F.col("entry")).otherwise(F.floor(F.col("entry") / 4)).cast("int")
    several = priced.where("not alone").join(many, ["part", "no"]).select(
        "part", "no", state.alias("state"), F.get("edits", F.col("entry")).alias("edits"), "total")
    ways = materialize(single.union(several), "repair_ways")
    done = blocks.select("key", "id", "part", "no", "roles", "texts").join(
        narrow.select("part", "no", "alone").join(ways.drop("total"), ["part", "no"]), ["part", "no"])
    gaps = F.coalesce(F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - F.col("same_turn").cast("int")), F.lit(0))
    seams = F.count_if(~F.col("seam").isin("su", "ua", "au"))
    fault = lambda k: F.sum(F.col("faults")[k])
    summary = narrow.join(ways.select("part", "no", "total"), ["part", "no"]).groupBy("key").agg(
        F.first("id").alias("id"), gaps.alias("gaps"), fault(0).alias("blank"), fault(1).alias("duplicate"), fault(2).alias("truncated"),
        (F.sum("illegal") + seams).alias("illegal"), F.max("total").alias("cost"))
    return Repair(summary, done)


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of each edit, deletions included, with their old role."""
    rows = zip(roles, texts)
    for edit in edits:
        if edit == "I":
            yield edit, NEXT_ROLE[state], ""
            state = NEXT_STATE[state]
            continue
        role, text = next(rows)
        if edit == "K":
            state = KEPT[state, role[0]]
        elif edit == "R":
            role, state = NEXT_ROLE[state], NEXT_STATE[state]
        yield edit, role, text


def repaired_rows(blocks: DataFrame) -> DataFrame:
    """The repaired conversations: ``(id, part, no, place, edit, role, text)``, in order of ``part, no, place``."""
    kind = blocks.schema["id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            for row in batch.to_pylist():
                out = [e for e in apply_edits(row["edits"], row["state"], row["roles"], row["texts"]) if e[0] != "D"]
                n = len(out)
                edit, role, text = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["id"]] * n, batch.schema.field("id").type), pa.array([row["part"]] * n, pa.int32()),
                     pa.array([row["no"]] * n, pa.int32()), pa.array(range(n), pa.int32()),
                     *(pa.array(c, pa.string()) for c in (edit, role, text))], names=["id", "part", "no", "place", "edit", "role", "text"])

    return blocks.select("id", "part", "no", "state", "edits", "roles", "texts").mapInArrow(
        rows, f"id {kind}, part int, no int, place int, edit string, role string, text string")


def transcripts(blocks: DataFrame) -> DataFrame:
    """``(key, audit, repaired_sha256)``: all edits, and the hash of the repaired ``role:text`` lines.

    A hash of a whole is taken from front to end, so the blocks of one conversation pass
    through one task, one at a time; only their edits add up there.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, edits, hashed, lines = None, [], None, 0
        names = ["key", "audit", "repaired_sha256"]

        def closed() -> tuple:
            return key, "".join(edits), hashed.hexdigest()

        for batch in slices(batches, 16):
            ready = []
            for row in batch.to_pylist():
                if row["key"] != key:
                    if key is not None:
                        ready.append(closed())
                    key, edits, hashed, lines = row["key"], [], hashlib.sha256(), 0
                edits.append(row["edits"])
                for edit, role, text in apply_edits(row["edits"], row["state"], row["roles"], row["texts"]):
                    if edit != "D":
                        hashed.update(("\n" if lines else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                        lines += 1
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*ready)], names=names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.string()) for c in closed()], names=names)

    columns = ["key", "state", "edits", "roles", "texts"]
    schema = "key string, audit string, repaired_sha256 string"
    whole = blocks.where("alone").select(*columns).mapInArrow(read, schema)
    in_order = blocks.where("not alone").repartition("key").sortWithinPartitions("key", "part", "no")
    return whole.union(in_order.select(*columns).mapInArrow(read, schema))
