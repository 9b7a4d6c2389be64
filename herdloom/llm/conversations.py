"""Repair of the structure of conversations by the cheapest edits, with an audit of what was done.

A conversation must come to ``(s?(ua)+)?`` in the initials of its roles. A dynamic programme over its
rows has four states: nothing yet, after the system's row, after the user's, after the assistant's. The
best edits up to a row are a node that links to the edits before it, so prefixes are shared; a node knows
its ancestors 1, 2, 4, ... edits back and the rolling hash of its prefix, and equal prefixes are one node,
found by hash and verified edit by edit as they grow. Of equally cheap edits the least in ASCII wins,
found by a search for the longest common prefix over the ancestors. At one row equally cheap prefixes are
never one the beginning of the other (more inserts would cost more), so the better one stays better.

Rows are put in order over all conversations, without their texts, and cut into ranges; a conversation
that crosses ranges is a few stretches, each with the best edits from every state to every state, which
are put together like numbers. So no task holds a conversation's rows but for its own range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.llm.base import arrow_schema, prepare, stored

# Cost of edits, white space, and what a row must end with.
RETURN, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Next state by state and initial of a role; states: start, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ACCEPTED = (START, AFTER_A)
#: Role that an insert or a changed role takes in a state, and the state then.
FILLED = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
LEGAL = frozenset(["su", "ua", "au"])
BASE, MODULUS = 1_000_003, (1 << 61) - 1


class Prefixes:
    """Edit prefixes as nodes; node 0 is the empty one. Equal prefixes are the same node."""

    def __init__(self):
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [()]
        self.known: dict[int, int] = {}

    def extend(self, node: int, edit: str) -> int:
        hashed = (self.hash[node] * BASE + ord(edit)) % MODULUS
        place = hashed
        while (found := self.known.get(place)) is not None:
            # A hash alone proves nothing: its prefix is equal if its last edit and all before it are.
            if self.edit[found] == edit and self.up[found][0] == node:
                return found
            place += MODULUS
        ancestors, k = [node], 0
        while k < len(self.up[ancestors[k]]):
            ancestors.append(self.up[ancestors[k]][k])
            k += 1
        new = self.known[place] = len(self.edit)
        self.edit.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append(hashed)
        self.up.append(tuple(ancestors))
        return new

    def ancestor(self, node: int, depth: int) -> int:
        steps, k = self.depth[node] - depth, 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps, k = steps >> 1, k + 1
        return node

    def same(self, a: int, b: int) -> bool:
        return self.hash[a] == self.hash[b] and a == b

    def less(self, a: int, b: int) -> bool:
        """Whether the edits of ``a`` come before those of ``b`` in ASCII."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.edit[x] < self.edit[y]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


Best = list[tuple[int, int] | None]


def _offer(best: Best, prefixes: Prefixes, state: int, cost: int, node: int, edit: str) -> None:
    """Take the prefix ``node`` and ``edit`` for a state if it is cheaper, or as cheap and less."""
    held = best[state]
    if held is None or cost < held[0]:
        best[state] = (cost, prefixes.extend(node, edit))
    elif cost == held[0]:
        new = prefixes.extend(node, edit)
        if new != held[1] and prefixes.less(new, held[1]):
            best[state] = (cost, new)


def inserted(best: Best, prefixes: Prefixes) -> Best:
    """``best`` with rows inserted where that is better; more than two in a row never are."""
    out = list(best)
    for state in (START, AFTER_S, AFTER_A):
        if best[state]:
            _offer(out, prefixes, AFTER_U, best[state][0] + INSERT, best[state][1], "I")
    if out[AFTER_U]:
        _offer(out, prefixes, AFTER_A, out[AFTER_U][0] + INSERT, out[AFTER_U][1], "I")
    return out


def followed(best: Best, prefixes: Prefixes, initial: str, gone: bool, truncated: bool) -> Best:
    """Best edits after one more row, which must be deleted if ``gone``."""
    best, out = inserted(best, prefixes), [None] * 4
    more = TRUNCATED if truncated else 0
    for state, held in enumerate(best):
        if held is None:
            continue
        cost, node = held
        _offer(out, prefixes, state, cost + DELETE, node, "D")
        if gone:
            continue
        after = STEPS.get((state, initial)) if initial else state
        if after is not None:
            _offer(out, prefixes, after, cost + more, node, "K")
        _offer(out, prefixes, FILLED[state][1], cost + RETURN + more, node, "R")
    return out


class Segment:
    """What rows of one conversation in order amount to; from the start alone, or from every state."""

    def __init__(self, whole_start: bool):
        self.prefixes = Prefixes()
        self.starts = [START] if whole_start else list(range(4))
        self.best = {s: [(0, 0) if t == s else None for t in range(4)] for s in self.starts}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.first = self.last = None

    def add(self, turn, initial: str, copies: int, blank: bool, truncated: bool, fresh: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        for copy in range(copies):
            duplicate = not blank and (copy > 0 or not fresh)
            short = truncated and not blank and not duplicate
            self.blank += blank
            self.duplicate += duplicate
            self.truncated += short
            self.illegal += self.last is not None and self.last + initial not in LEGAL
            self.first, self.last = initial if self.first is None else self.first, initial
            for start in self.starts:
                self.best[start] = followed(self.best[start], self.prefixes, initial, blank or duplicate, short)

    def row(self) -> dict:
        costs, audits = [], []
        for start in range(4):
            for end in range(4):
                held = self.best[start][end] if start in self.best else None
                costs.append(-1 if held is None else held[0])
                audits.append("" if held is None else self.prefixes.text(held[1]))
        names = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first", "last")
        return {name: getattr(self, name) for name in names} | {"costs": costs, "audits": audits}


def wrapped(n: int) -> int:
    """A number as 64 bits hold it."""
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def together(segments: list[dict]) -> dict:
    """Result of a conversation from its segments in order."""
    out = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal"), 0)
    best: list[tuple[int, str] | None] = [(0, ""), None, None, None]
    turns, first_turn, last_turn, last = 0, None, None, None
    for s in segments:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            out[name] += s[name]
        out["illegal"] += last is not None and last + s["first"] not in LEGAL
        last = s["last"]
        if s["turns"]:
            turns += s["turns"] - (s["first_turn"] == last_turn)
            first_turn, last_turn = s["first_turn"] if first_turn is None else first_turn, s["last_turn"]
        reached: list[tuple[int, str] | None] = [None] * 4
        for end in range(4):
            ways = [
                (best[start][0] + s["costs"][4 * start + end], best[start][1] + s["audits"][4 * start + end])
                for start in range(4)
                if best[start] is not None and s["costs"][4 * start + end] >= 0
            ]
            reached[end] = min(ways, default=None)
        best = reached
    closed = [best[START], best[AFTER_A]]
    for state, edits in ((AFTER_U, "I"), (AFTER_S, "II"), (START, "II")):
        if best[state] is not None:
            closed.append((best[state][0] + INSERT * len(edits), best[state][1] + edits))
    out["cost"], out["audit"] = min(c for c in closed if c is not None)
    if turns:
        out["gaps"] = wrapped(last_turn - first_turn + 1 - turns)
    return out


def damaged(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with the faults that the checksum of a row's key deals it."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))), F.lit(20))
    rows = df.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), fault.alias("fault"))
    bare = F.regexp_replace("text", "[.!?]", "")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, bare).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, 2).otherwise(1)
    return rows.filter("fault <> 0").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies")
    )


def undamaged(df: DataFrame) -> DataFrame:
    """The same columns for rows as they are."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return df.select("conv_id", "turn", name("role"), name("text"), F.lit(1).alias("copies"))


def _text_key() -> Column:
    return F.unhex(F.sha2("text", 256)).alias("text_key")


def judged(rows: DataFrame) -> DataFrame:
    """Different rows with their number of copies and their faults, without texts.

    ``fresh``: the role and text stand in no row before. Both come from groupings that add up within
    tasks, so a row repeated without end is one row per task.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    known = rows.select(
        "conv_id", "turn", "role", _text_key(), "copies",
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )
    once = known.groupBy("conv_id", "turn", "role", "text_key").agg(
        F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated")
    )
    once = stored(once, "turns-once")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = once.groupBy("conv_id", "role", "text_key").agg(F.min(turn).alias("first"), F.count("*").alias("n"))
    again = first.filter("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("o"), F.col("text_key").alias("k"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("o")) & (F.col("text_key") == F.col("k"))
    fresh = F.coalesce(turn == F.col("first"), F.lit(True))
    return once.join(again, same, "left").withColumn("fresh", fresh).drop("c", "o", "k", "first")


ORDER = ("conv_id", "turn", "role", "text_key")
SEGMENT = (
    "conv_id bigint, whole boolean, turn bigint, role string, text_key binary, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, first string, last string, "
    "costs array<bigint>, audits array<string>"
)
RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)


def _rows_of(batch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


def _record(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def segments(rows: DataFrame) -> DataFrame:
    """Segments of conversations, cut where the ranges of all rows in order end.

    A conversation that neither begins nor ends a range is whole; its audit stands first in ``audits``.
    """
    prepare(rows.sparkSession)
    schema = arrow_schema(SEGMENT)
    columns = [*ORDER, "copies", "blank", "truncated", "fresh"]

    def run(batches):
        held, key, out, number = None, None, [], 0

        def finished(whole):
            row = held.row() | dict(zip(ORDER, key)) | {"whole": whole}
            if whole:
                result = together([row])
                row |= {"costs": [result["cost"], result["gaps"]], "audits": [result["audit"]]}
            return row

        for batch in batches:
            for conv, turn, role, text_key, copies, blank, truncated, fresh in _rows_of(batch):
                if held is None or conv != key[0]:
                    if held is not None:
                        out.append(finished(number > 1))
                    held, key, number = Segment(number > 0), (conv, turn, role, text_key), number + 1
                held.add(turn, role[:1], copies, blank, truncated, fresh)
            if len(out) >= 256:
                yield _record(out, schema)
                out = []
        if held is not None:
            out.append(finished(False))
        if out:
            yield _record(out, schema)

    ordered = rows.select(*columns).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.mapInArrow(run, SEGMENT)


def audits(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Result of every conversation of ``df`` from its rows: faults, cost and audit."""
    cut = stored(segments(stored(judged(rows), "turns-judged")), "turns-segments")
    whole = cut.filter("whole").select(
        "conv_id", F.col("costs")[1].alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"),
    )
    schema = arrow_schema(RESULT)

    def combine(table: pa.Table) -> pa.Table:
        parts = table.to_pylist()
        parts.sort(key=lambda s: (s["turn"] is not None, s["turn"] or 0, s["role"].encode(), s["text_key"]))
        return pa.Table.from_batches([_record([together(parts) | {"conv_id": parts[0]["conv_id"]}], schema)])

    crossing = cut.filter("not whole").groupBy("conv_id").applyInArrow(combine, RESULT)
    found = whole.union(crossing).withColumnRenamed("conv_id", "c")
    every = df.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in found.columns[1:-1]]
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit): rows of every conversation after its edits.

    Rows of a conversation come in order and in one partition, sorted there and read as a stream, so a
    task holds some rows and one audit however long a conversation is. Inserted rows have no turn.
    """
    prepare(rows.sparkSession)
    ddl = "conv_id bigint, place bigint, turn bigint, role string, text string, edit string"
    schema = arrow_schema(ddl)
    nothing = F.lit(None)
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), nothing.cast("bigint").alias("turn"), F.lit("").alias("role"),
        nothing.cast("binary").alias("text_key"), F.lit(0).alias("copies"), F.col("audit").alias("text"),
    )
    bodies = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", _text_key(), "copies", "text")
    ordered = heads.union(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER[1:])

    def run(batches):
        conv, audit, at, state, place = None, "", 0, START, 0
        out: list[tuple] = []

        def put(turn, role, text, edit):
            nonlocal place
            out.append((conv, place, turn, role, text, edit))
            place += 1

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                role, state = FILLED[state]
                put(None, role, "", "I")
                at += 1

        for batch in batches:
            for new, kind, turn, role, _, copies, text in _rows_of(batch):
                if kind == 0:
                    inserts()
                    conv, audit, at, state, place = new, text, 0, START, 0
                    continue
                for _ in range(copies):
                    inserts()
                    edit, at = audit[at], at + 1
                    if edit == "K":
                        state = STEPS[state, role[:1]] if role else state
                        put(turn, role, text, "K")
                    elif edit == "R":
                        changed, state = FILLED[state]
                        put(turn, changed, text, "R")
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return ordered.mapInArrow(run, ddl)


def text_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, digest): SHA-256 of ``role:text`` of all rows of a conversation, one per line.

    Takes what ``repaired`` returns, as it comes; the digest of a conversation grows row by row.
    """
    ddl = "conv_id bigint, digest string"
    schema = arrow_schema(ddl)

    def run(batches):
        conv, digest = None, None
        for batch in batches:
            out = []
            for new, place, _, role, text, _ in _rows_of(batch):
                if place == 0:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = new, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv, digest.hexdigest()), schema)], schema=schema)

    return rows.mapInArrow(run, ddl)


def repair(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired rows and one result per conversation for conversations as they are.

    Rows go by turn, NULL first, then by role and the SHA-256 of the text; equal rows are told apart by
    their number only. A NULL role or text is one blank; a role that is empty has no initial and, kept,
    changes nothing. Rows without ``conv_id`` are one conversation. Only the four named columns are read.
    """
    rows = undamaged(df)
    found = stored(audits(df, rows), "turns-audits")
    return repaired(rows, found), found


def repair_damaged(df: DataFrame) -> DataFrame:
    """Result per conversation after ``damaged``, with the digest of what it is repaired to.

    Every ``conv_id`` of ``df`` has a row; without rows left it has zeros, no audit and the digest of
    nothing. Rows in order as in ``repair``.
    """
    rows = damaged(df)
    found = stored(audits(df, rows), "turns-audits")
    digests = text_digests(repaired(rows, found)).withColumnRenamed("conv_id", "c")
    joined = found.join(digests, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    empty = hashlib.sha256(b"").hexdigest()
    return joined.withColumn("repaired_sha256", F.coalesce("digest", F.lit(empty))).drop("digest")
