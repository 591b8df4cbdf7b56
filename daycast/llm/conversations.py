"""Conversation structure repair: cheapest edits by a checkpointed dynamic programme.

A conversation is legal if its role initials read ``(s?(ua)+)?``. Each row is kept
(0), given the role user or assistant (3) or deleted (4; blank and repeated rows
must be), empty user or assistant rows may be inserted (3), and a truncated row that
stays costs 3 more. Of the cheapest edit sequences the ASCII-least one is taken.

Four automaton states (nothing yet, system, user, assistant) make the cost-to-go of a
row a vector of four numbers, computed backwards. Vectors are stored at checkpoints
only: between blocks whose lengths grow by ``BASE`` rows each, so that ``n`` rows have
O(sqrt n) blocks of O(sqrt n) rows without ``n`` being known; a block's inner vectors
are computed again when its edits are emitted going forward.

Rows are dealt by *range* of (conversation, turn, ...) and sorted, so a conversation of
any size spreads over tasks, each holding one block. One that lies inside a task in one
block (nearly all) is repaired there. The blocks of the others are written: each carries
its 4 x 4 cost matrix (min-plus), a backward pass over the matrices gives the vector
behind every block, blocks are then walked in parallel from each of the four states, and
a forward pass over the small results picks the states that occur. That pass also hashes
the repaired text; a digest is sequential, so it reads one conversation's blocks in one
task, but as a stream: memory holds one block and the edit string.

Copies are found by one row per distinct (conversation, role, text), pre-aggregated
before the shuffle; it travels beside the rows and marks the first occurrence.

Defined results: null role or text count as one space (so a null text is blank); rows
are taken by turn (nulls first), ties by role, text (its first 64 characters, then its
digest) and place in the input; gaps ignore null turns;
a null ``conv_id`` is a conversation of its own; other columns are ignored; an empty
table gives an empty result; roles with other initials are never legal as they are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.common import cut, partitions_for

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BASE = 256                # rows of a stream's first block
BLOCK_BYTES = 8 << 20     # a block is also closed when its texts reach this
ROWS_PER_TASK = 200_000
SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60
# States: 0 nothing yet, 1 system, 2 user, 3 assistant.
NEXT_ROLE = (2, 2, 3, 2)  # the state that a user (from 0, 1, 3) or assistant (from 2) row leads to
ROLE_OF = {2: "user", 3: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL_PAIRS = ("su", "ua", "au")

_steps: dict = {}
_picks: dict = {}


def _code(initial: str, forced: bool, truncated: bool) -> int:
    """A row as one byte: 0 must be deleted, else 1 + 2 * initial + truncated."""
    return 0 if forced else 1 + 2 * "sua".find(initial or "?") + truncated + 2


def _kept_state(code: int, state: int) -> int:
    """The state a kept row leads to, or -1."""
    initial = (code - 1) // 2 - 1  # -1 other, 0 s, 1 u, 2 a
    if initial == 0:
        return 1 if state == 0 else -1
    if initial > 0 and NEXT_ROLE[state] == initial + 1:
        return initial + 1
    return -1


def _base(code: int, after: tuple) -> list[int]:
    """Costs from each state when the row is handled now, without inserts before it."""
    out = []
    extra = TRUNCATED if code and (code - 1) % 2 else 0
    for state in range(4):
        best = DELETE + after[state]
        if code:
            best = min(best, REROLE + extra + after[NEXT_ROLE[state]])
            kept = _kept_state(code, state)
            if kept >= 0:
                best = min(best, KEEP + extra + after[kept])
        out.append(best)
    return out


def _closed(costs: list[int]) -> tuple:
    """Costs when rows may be inserted first."""
    user, assistant = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + user), min(costs[1], INSERT + user), user, assistant


def _step(code: int, after: tuple) -> tuple[int, tuple]:
    """(what all costs share, the rest) before a row, from the rest behind it."""
    found = _steps.get((code, after))
    if found is None:
        costs = _closed(_base(code, after))
        low = min(costs)
        found = _steps[code, after] = low, tuple(min(c - low, NEVER) for c in costs)
    return found


def _pick(code: int, state: int, after: tuple) -> tuple[str, int]:
    """ASCII-least tight edits (D, I, K, R) that handle one row from a state."""
    found = _picks.get((code, state, after))
    if found is None:
        costs = _closed(_base(code, after))
        extra = TRUNCATED if code and (code - 1) % 2 else 0
        edits, s = "", state
        while True:
            if DELETE + after[s] == costs[s]:
                edits += "D"
            elif INSERT + costs[NEXT_ROLE[s]] == costs[s]:
                edits, s = edits + "I", NEXT_ROLE[s]
                continue
            elif (kept := _kept_state(code, s)) >= 0 and KEEP + extra + after[kept] == costs[s]:
                edits, s = edits + "K", kept
            else:
                edits, s = edits + "R", NEXT_ROLE[s]
            break
        found = _picks[code, state, after] = edits, s
    return found


def _vectors(codes: bytes, behind: tuple) -> tuple[int, list[tuple]]:
    """Cost shared before the first row, and the vector behind every row (normalised)
    with the one before the first row in front."""
    low = min(behind)
    total, v = low, tuple(min(c - low, NEVER) for c in behind)
    out = [v]
    for code in reversed(codes):
        more, v = _step(code, v)
        total += more
        out.append(v)
    out.reverse()
    return total, out


def _matrix(codes: bytes) -> list[int]:
    """Cost from each state before the block to each state behind it."""
    columns = []
    for state in range(4):
        total, vectors = _vectors(codes, tuple(0 if s == state else NEVER for s in range(4)))
        columns.append([min(total + c, NEVER) for c in vectors[0]])
    return [columns[t][s] for s in range(4) for t in range(4)]


def _walk(codes: bytes, vectors: list[tuple], state: int) -> tuple[list[str], int]:
    """Edits of each row (inserts before it included) from a state."""
    edits = []
    for code, after in zip(codes, vectors[1:]):
        e, state = _pick(code, state, after)
        edits.append(e)
    return edits, state


def _repaired(edits, roles, texts, state: int) -> list[tuple[str, str]]:
    """(role, text) of the rows that edits leave or insert; ``edits`` per row, and a
    closing entry of inserts only may follow."""
    out = []
    for i, e in enumerate(edits):
        for kind in e:
            if kind == "D":
                continue
            if kind == "K":
                out.append((roles[i], texts[i]))
                state = 1 if state == 0 and roles[i][:1] == "s" else NEXT_ROLE[state]
                continue
            state = NEXT_ROLE[state]
            out.append((ROLE_OF[state], texts[i] if kind == "R" else ""))
    return out


class _Rows:
    """Rows of one conversation's block, as they come."""

    def __init__(self):
        self.codes, self.roles, self.texts = bytearray(), [], []
        self.blank = self.duplicate = self.truncated = self.illegal = self.size = 0
        self.low = self.high = self.seen_turn = None
        self.turns = 0

    def add(self, turn, role, text, first):
        solid = text.strip(SPACE)
        cut_off = bool(solid) and solid[-1] not in ".!?"
        blank, repeated = not solid, bool(solid) and not first
        truncated = cut_off and first
        self.blank += blank
        self.duplicate += repeated
        self.truncated += truncated
        if self.roles:
            self.illegal += (self.roles[-1][:1] + role[:1]) not in LEGAL_PAIRS
        if turn is not None:
            self.low = turn if self.low is None else self.low
            if turn != self.seen_turn:
                self.turns += 1
            self.high = self.seen_turn = turn
        self.codes.append(_code(role[:1], blank or repeated, truncated))
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)


COUNTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
DONE = f"{COUNTS}, audit string, repaired_sha256 string, part bigint, last boolean, roles array<string>, texts array<string>"
OPEN = ("seg int, blk int, codes binary, low bigint, high bigint, turns bigint, matrix array<bigint>")


def _digest(lines, running=None):
    running = running or hashlib.sha256()
    running.update("\n".join(f"{r}:{t}" for r, t in lines).encode())
    return running


def _whole(rows: _Rows, texts: bool) -> dict:
    """The result of a conversation that lies in one block."""
    total, vectors = _vectors(bytes(rows.codes), AT_END)
    edits, state = _walk(rows.codes, vectors, 0)
    edits.append("I" * (AT_END[state] // INSERT))
    lines = _repaired(edits, rows.roles, rows.texts, 0)
    return {"gaps": rows.high - rows.low + 1 - rows.turns if rows.turns else 0, "blank": rows.blank,
            "duplicate": rows.duplicate, "truncated": rows.truncated, "illegal": rows.illegal,
            "cost": total + vectors[0][0], "audit": "".join(edits), "repaired_sha256": _digest(lines).hexdigest(),
            "part": 0, "last": True, "roles": [r for r, _ in lines] if texts else [], "texts": [t for _, t in lines] if texts else []}


def _fields(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64()),
          "array<array<string>>": pa.list_(pa.list_(pa.string()))}


def _batch(rows: list[dict], key_type: pa.DataType, schema: str) -> pa.RecordBatch:
    columns = [("conv_id", key_type), *[(x.split()[0], _ARROW[x.split()[1]]) for x in schema.split(", ")]]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in columns], [n for n, _ in columns])


def _stream(batches: Iterator[pa.RecordBatch], names) -> Iterator[tuple]:
    """Rows of sorted batches, a small slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            yield from zip(*[part.column(n).to_pylist() for n in names])


def _flushed(rows: Iterator[tuple[int, dict]], key_type, schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of (size, row), bounded in rows and size."""
    held, size = [], 0
    for n, row in rows:
        held.append(row)
        size += n
        if len(held) >= 2000 or size > BLOCK_BYTES:
            yield _batch(held, key_type, schema)
            held, size = [], 0
    if held:
        yield _batch(held, key_type, schema)


def _blocks(texts: bool, base: int, key_type: pa.DataType):
    """Sorted rows of a task -> results of whole conversations, blocks of the others."""
    def emit(batches):
        seg = TaskContext.get().partitionId()
        key, rows, made, done, whole_so_far = None, None, 0, 0, False
        nothing = marked = object()

        def block():
            nonlocal made, done
            done += 1
            made += 1
            return rows.size, {
                "conv_id": key, "part": None, "last": None, "seg": seg, "blk": done, "codes": bytes(rows.codes), "blank": rows.blank,
                "duplicate": rows.duplicate, "truncated": rows.truncated, "illegal": rows.illegal, "low": rows.low,
                "high": rows.high, "turns": rows.turns, "matrix": _matrix(bytes(rows.codes)), "roles": rows.roles, "texts": rows.texts}

        names = ["conv_id", "turn", "role", "text", "uid", "gone", "mark"]
        for conv, turn, role, text, uid, gone, mark in _stream(batches, names):
            if rows is None or conv != key:
                if rows is not None:
                    # the first conversation of a task may have begun in the one before
                    yield (rows.size if texts else 0, {"conv_id": key, **_whole(rows, texts)}) if whole_so_far and not made else block()
                whole_so_far = rows is not None
                key, rows, made, marked = conv, _Rows(), 0, nothing
            if mark:
                marked = uid
                continue
            if gone:
                continue
            if len(rows.codes) >= base * (made + 1) or rows.size > BLOCK_BYTES:
                yield block()
                rows = _Rows()
            rows.add(turn, role, text, uid == marked)
        if rows is not None:
            yield block()  # may go on in the next task

    def run(batches):
        yield from _flushed(emit(batches), key_type, f"{DONE}, {OPEN}")
    return run


def _vectors_behind(key_type):
    """Blocks of a conversation from its last to its first -> the vector behind each."""
    def emit(batches):
        key, v, begun = None, AT_END, False
        for conv, seg, blk, matrix in _stream(batches, ["conv_id", "seg", "blk", "matrix"]):
            if not begun or conv != key:
                key, v, begun = conv, AT_END, True
            yield 0, {"conv_id": conv, "seg": seg, "blk": blk, "behind": list(v)}
            v = tuple(min(min(matrix[4 * s + t] + v[t] for t in range(4)), NEVER) for s in range(4))

    def run(batches):
        yield from _flushed(emit(batches), key_type, "seg int, blk int, behind array<bigint>")
    return run


WALKED = ("seg int, blk int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, low bigint, high bigint, turns bigint, "
          "first string, final string, exits array<bigint>, costs array<bigint>, edits array<array<string>>, roles array<string>, texts array<string>")


def _walked(key_type):
    """A block and the vector behind it -> its edits and last state from each state."""
    names = ["conv_id", "seg", "blk", "codes", "blank", "duplicate", "truncated", "illegal", "low", "high", "turns", "roles", "texts", "behind"]

    def emit(batches):
        for values in _stream(batches, names):
            row = dict(zip(names, values))
            total, vectors = _vectors(row["codes"], tuple(row["behind"]))
            walks = [_walk(row["codes"], vectors, s) for s in range(4)]
            roles = row["roles"]
            yield sum(map(len, row["texts"])), row | {
                "edits": [e for e, _ in walks], "exits": [s for _, s in walks], "costs": [total + c for c in vectors[0]],
                "first": roles[0][:1] if roles else None, "final": roles[-1][:1] if roles else None}

    def run(batches):
        yield from _flushed(emit(batches), key_type, WALKED)
    return run


def _joined(texts: bool, key_type):
    """Walked blocks of a conversation in order -> its parts; the last has the sums."""
    names = ["conv_id", *_fields(WALKED)]

    def emit(batches):
        key, row, begun = None, None, False

        def start(conv):
            return {"conv_id": conv, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "part": 0}, {
                "state": 0, "audit": [], "hash": hashlib.sha256(), "lines": 0, "low": None, "high": None, "turns": 0, "final": None, "first": True}

        def finish():
            edits = "I" * (AT_END[at["state"]] // INSERT)
            add([edits], [], [])
            gaps = at["high"] - at["low"] + 1 - at["turns"] if at["turns"] else 0
            return 0, row | {"gaps": gaps, "audit": "".join(at["audit"]), "repaired_sha256": at["hash"].hexdigest(), "last": True,
                             "roles": at["out"][0], "texts": at["out"][1]}

        def add(edits, roles, texts_in):
            lines = _repaired(edits, roles, texts_in, at["state"])
            if lines and at["lines"]:
                at["hash"].update(b"\n")
            _digest(lines, at["hash"])
            at["lines"] += len(lines)
            at["audit"].append("".join(edits))
            at["out"] = ([r for r, _ in lines], [t for _, t in lines]) if texts else ([], [])

        for values in _stream(batches, names):
            b = dict(zip(names, values))
            if not begun or b["conv_id"] != key:
                if begun:
                    yield finish()
                key, begun = b["conv_id"], True
                row, at = start(key)
                row["cost"] = b["costs"][0]
            state = at["state"]
            add(b["edits"][state], b["roles"], b["texts"])
            at["state"] = b["exits"][state]
            for name in ("blank", "duplicate", "truncated", "illegal"):
                row[name] += b[name]
            if b["roles"]:
                row["illegal"] += at["final"] is not None and at["final"] + b["first"] not in LEGAL_PAIRS
                at["final"] = b["final"]
            if b["turns"]:
                at["turns"] += b["turns"] - (at["high"] == b["low"])
                at["low"] = b["low"] if at["low"] is None else at["low"]
                at["high"] = b["high"]
            if texts:
                yield sum(map(len, at["out"][1])), {"conv_id": key, "part": row["part"], "last": False, "roles": at["out"][0], "texts": at["out"][1]}
                row["part"] += 1
        if begun:
            yield finish()

    def run(batches):
        yield from _flushed(emit(batches), key_type, DONE)
    return run


def repair(rows: DataFrame, gone: str | None = None, texts: bool = True, base: int = BASE,
           rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Repair every conversation of ``rows`` (conv_id, turn, role, text).

    Returns parts in order (conv_id, part): ``roles`` and ``texts`` of the repaired
    rows (left empty without ``texts``), and on the part that is ``last`` the counts, the
    cost, the edits (``audit``) and the sha256 of the repaired ``role:text`` lines.
    Rows whose ``gone`` column is true count as lost: they only keep their id."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = rows.sparkSession
    kind = rows.schema["conv_id"].dataType
    key, key_type = kind.simpleString(), to_arrow_type(kind)
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    lost = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    given = cut(rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.when(~lost, text).alias("text"), lost.alias("gone"),
        F.when(~lost, F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("h"),
        F.substring(text, 1, 64).alias("head"), F.monotonically_increasing_id().alias("uid")))
    order = ["turn", "role", "head", "h", "uid"]
    firsts = (given.where("NOT gone").groupBy("conv_id", "h")
              .agg(F.min(F.struct("turn", "uid", "role", "head")).alias("f"))
              .select("conv_id", "f.turn", "f.role", F.lit(None).cast("string").alias("text"), F.lit(False).alias("gone"),
                      "h", "f.head", "f.uid", F.lit(True).alias("mark")))
    both = given.withColumn("mark", F.lit(False)).unionByName(firsts)
    n = partitions_for(spark, given.count(), rows_per_task)
    dealt = (both.repartitionByRange(n, "conv_id", *order)
             .sortWithinPartitions("conv_id", *order, F.desc("mark"))
             .select("conv_id", "turn", "role", "text", "uid", "gone", "mark"))
    found = cut(dealt.mapInArrow(_blocks(texts, base, key_type), f"conv_id {key}, {DONE}, {OPEN}"))
    blocks = found.where("seg IS NOT NULL")
    behind = (blocks.select("conv_id", "seg", "blk", "matrix").repartition("conv_id")
              .sortWithinPartitions("conv_id", F.desc("seg"), F.desc("blk"))
              .mapInArrow(_vectors_behind(key_type), f"conv_id {key}, seg int, blk int, behind array<bigint>"))
    walked = (blocks.join(behind.drop("conv_id"), ["seg", "blk"])
              .mapInArrow(_walked(key_type), f"conv_id {key}, {WALKED}"))
    joined = (walked.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "blk")
              .mapInArrow(_joined(texts, key_type), f"conv_id {key}, {DONE}"))
    return found.where("seg IS NULL").select("conv_id", *_fields(DONE)).unionByName(joined)


def damage(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by crc32 of ``conv_id:turn`` modulo 20: 0 loses the row
    (``gone``), 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes its
    role user. Nulls count as one space."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    base = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
                       (F.crc32(key.cast("binary")) % 20).alias("c"))
    return base.select(
        "conv_id", "turn", F.when(F.col("c") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("c") == 1, F.lit("")).when(F.col("c") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("c") == 0).alias("gone"),
        F.explode(F.when(F.col("c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def repair_report(rows: DataFrame) -> DataFrame:
    """Damage, repair, and one row per conversation."""
    return repair(damage(rows), gone="gone", texts=False).where("last").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
