"""Repair of conversation structure by a scan of min-plus matrices.

A conversation is in order when the initials of its roles read ``(s?(ua)+)?``: an automaton of four states.  What may
be done to a turn is a 4 x 4 matrix from state to state; its elements are the cheapest (cost, audit) pairs, an
audit being the initials of the edits.  Elements are compared by cost and then by audit, and chained by adding costs and
joining audits.  Audits of equal cost between the same states over the same turns are never beginnings of each
other, since a longer one holds more insertions and each of those costs; so the order survives chaining and the product is
associative.  Insertions stand in every turn's matrix as their closure.

Rows are dealt by ranges of (conversation, turn).  A task repairs the conversations that lie wholly within it by a
balanced product of their matrices.  The first and the last conversation of a task, and any of more than ``LONG_ROWS``
rows or ``LONG_CHARS`` characters, may go on elsewhere or grow too large for a task: their rows are written as they
are, cut into blocks of ``BLOCK`` turns, each block is multiplied out, and ``FAN_IN`` neighbouring products at a time are
multiplied in rounds until one is left.  The audit then tells each row its edit.  Only the digest of the repaired text
passes through one task per conversation, as a stream of rows, since SHA-256 is a chain by definition.

Faults of a turn, the first that holds: ``blank``, no character but spaces; ``duplicate``, role and text were in an
earlier row of the conversation; ``truncated``, the last character that is no space does not end a sentence.

Edge cases: null role and text are one space each; a null turn comes before all others and counts in no gap; rows of equal turn
follow by role, then by a hash of the text, then by text, and equal rows are neighbours; rows without ``conv_id`` are one
conversation; a conversation without rows left gets zeros, an empty audit and the digest of the empty string; very long
texts and conversations are taken whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewake.llm.common import shared_dir, small_batches

LONG_ROWS, LONG_CHARS = 20_000, 1 << 24
BLOCK, FAN_IN_BITS = 1024, 4
SPACES = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Moves of the automaton by a role's initial: before all turns 0, after the system's 1, the user's 2, the assistant's 3.
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ROLES = {"u": "user", "a": "assistant"}
STATES, ENDS = 4, (0, 3)
LEGAL = frozenset({"su", "ua", "au"})

Element = tuple[int, str]
Matrix = list[list[Element | None]]


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = []
    for row in a:
        line: list[Element | None] = []
        for j in range(STATES):
            best = None
            for k in range(STATES):
                x, y = row[k], b[k][j]
                if x is not None and y is not None:
                    cost = x[0] + y[0]
                    if best is None or cost <= best[0]:
                        found = (cost, x[1] + y[1])
                        if best is None or found < best:
                            best = found
            line.append(best)
        out.append(line)
    return out


def _empty() -> Matrix:
    return [[None] * STATES for _ in range(STATES)]


def _offer(matrix: Matrix, i: int, j: int, found: Element) -> None:
    if matrix[i][j] is None or found < matrix[i][j]:
        matrix[i][j] = found


def _closure() -> Matrix:
    """Any number of insertions, none included: steps are added until nothing gets cheaper."""
    step, out = _empty(), _empty()
    for initial in ROLES:
        for i, j in MOVES[initial].items():
            _offer(step, i, j, (INSERT, "I"))
    for i in range(STATES):
        out[i][i] = step[i][i] = (0, "")
    while (more := product(out, step)) != out:
        out = more
    return out


INSERTIONS = _closure()
_turns: dict[tuple[str, bool, bool], Matrix] = {}


def turn_matrix(initial: str, must_go: bool, truncated: bool) -> Matrix:
    """All edits of a turn, then any insertions."""
    key = (initial if initial in MOVES else "", must_go, truncated)
    if key not in _turns:
        edits, more = _empty(), TRUNCATED if truncated else 0
        for i in range(STATES):
            _offer(edits, i, i, (DELETE, "D"))
        if not must_go:
            for i, j in MOVES.get(initial, {}).items():
                _offer(edits, i, j, (KEEP + more, "K"))
            for role in ROLES:
                for i, j in MOVES[role].items():
                    _offer(edits, i, j, (REROLE + more, "R"))
        _turns[key] = product(edits, INSERTIONS)
    return _turns[key]


def multiplied(matrices: list[Matrix]) -> Matrix:
    """The product in order, halves at a time, so that audits are joined a logarithm of times."""
    while len(matrices) > 1:
        paired = [product(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)]
        matrices = paired + (matrices[-1:] if len(matrices) % 2 else [])
    return matrices[0]


def cheapest(matrix: Matrix | None) -> Element:
    """The best way from before all turns to a state in which a conversation may end; no turns need no edits."""
    whole = product(INSERTIONS, matrix) if matrix else INSERTIONS
    return min(whole[0][j] for j in ENDS if whole[0][j] is not None)


def edits(audit: str) -> Iterator[tuple[list[str], str | None, str | None]]:
    """For each row the roles inserted before it, its edit, and its role where it gets a new one; at last the insertions behind all rows, without an edit."""
    left = sum(x != "D" for x in audit)
    at = 0 if left % 2 else 1
    before: list[str] = []
    for letter in audit:
        if letter == "D":
            yield before, "D", None
            before = []
            continue
        role = ("", "user", "assistant")[0 if at == 0 else 1 + (at - 1) % 2]
        at += 1
        if letter == "I":
            before.append(role)
        else:
            yield before, letter, role if letter == "R" else None
            before = []
    yield before, None, None


def lines_of(before: list[str], edit: str | None, role: str | None, own_role: str | None, text: str | None) -> list[str]:
    out = [f"{x}:" for x in before]
    if edit in ("K", "R"):
        out.append(f"{own_role if role is None else role}:{text}")
    return out


def _facts(rows: Iterable[tuple]) -> tuple[list[Matrix], dict[str, int], str, str]:
    """Matrices of turns and counts; a row is ``initial, blank, duplicate, cut``."""
    matrices, n, first, last = [], {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}, None, None
    for initial, blank, duplicate, cut in rows:
        truncated = cut and not blank and not duplicate
        n["blank"] += blank
        n["duplicate"] += duplicate and not blank
        n["truncated"] += truncated
        if last is not None:
            n["illegal"] += last + initial not in LEGAL
        first, last = initial if first is None else first, initial
        matrices.append(turn_matrix(initial, blank or duplicate, truncated))
    return matrices, n, first, last


RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_RESULT_TYPES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROW_TYPES = "chunk int, place long, turn long, role string, text string, bare boolean, cut boolean, present boolean"
_ROW = ["chunk", "place", "turn", "role", "text", "bare", "cut", "present"]


def _repaired_here(rows: list[tuple]) -> tuple:
    """The result of a whole conversation from ``turn, role, text, blank, cut, present``."""
    rows = [r for r in rows if r[5]]
    turns = {r[0] for r in rows if r[0] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen: set[tuple[str, str]] = set()
    facts = []
    for _, role, text, blank, cut, _ in rows:
        facts.append((role[:1], blank, (role, text) in seen, cut))
        seen.add((role, text))
    matrices, n, _, _ = _facts(facts)
    cost, audit = cheapest(multiplied(matrices) if matrices else None)
    out = []
    for row, (before, edit, role) in zip([*rows, (None,) * 6], edits(audit), strict=True):
        out += lines_of(before, edit, role, row[1], row[2])
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *n.values(), cost, audit, digest)


def _in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations within this task, rows of those that may go on elsewhere or are long."""
    chunk = TaskContext.get().partitionId()
    names = ["conv_id", "done", *RESULT, *_ROW]
    types = [pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.bool_()]
    out: list[tuple] = []
    held: list[tuple] = []
    now, first, raw, place, chars = None, True, True, 0, 0

    def as_rows(rows: list[tuple]) -> None:
        nonlocal place
        for turn, role, text, blank, cut, present in rows:
            out.append((now, False, *[None] * 8, chunk, place, turn, role, text, blank, cut, present))
            place += present

    def batch_of() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
        out.clear()
        return made

    begun, size = False, 0
    for batch in batches:
        for conv, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not begun or conv != now:
                if begun:
                    if not raw:
                        out.append((now, True, *_repaired_here(held), *[None] * 8))
                    held, first = [], False
                begun, now, raw, place, chars = True, conv, first, 0, 0
            chars += len(row[2] or "")
            size += len(row[2] or "")
            if raw:
                as_rows([tuple(row)])
            else:
                held.append(tuple(row))
                if len(held) > LONG_ROWS or chars > LONG_CHARS:
                    as_rows(held)
                    held, raw = [], True
            if len(out) >= 4096 or size > 1 << 22 and out:
                size = 0
                yield batch_of()
    if begun and not raw:
        as_rows(held)
    if out:
        yield batch_of()


def _elements(matrix: Matrix) -> list[dict | None]:
    return [None if x is None else {"cost": x[0], "audit": x[1]} for line in matrix for x in line]


def _matrix(elements: list) -> Matrix:
    flat = [None if x is None else (x["cost"], x["audit"]) for x in elements]
    return [flat[i * STATES : (i + 1) * STATES] for i in range(STATES)]


_NODE = "conv string, number long, first string, last string, blank long, duplicate long, truncated long, illegal long, matrix array<struct<cost:long,audit:string>>"


def _block_node(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    matrices, n, first, last = _facts(zip(rows["initial"], rows["blank"].tolist(), rows["duplicate"].tolist(), rows["cut"].tolist(), strict=True))
    return pd.DataFrame([{"conv": key[0], "number": key[1], "first": first, "last": last, **n, "matrix": _elements(multiplied(matrices))}])


def _merged_node(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("number")
    sums = {k: int(nodes[k].sum()) for k in ("blank", "duplicate", "truncated", "illegal")}
    firsts, lasts = nodes["first"].tolist(), nodes["last"].tolist()
    sums["illegal"] += sum(a + b not in LEGAL for a, b in zip(lasts, firsts[1:], strict=False))
    matrix = multiplied([_matrix(m) for m in nodes["matrix"]])
    return pd.DataFrame([{"conv": key[0], "number": key[1], "first": firsts[0], "last": lasts[-1], **sums, "matrix": _elements(matrix)}])


def _best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [cheapest(_matrix(m)) for m in batch.column("matrix").to_pylist()]
        kept = [batch.column(n) for n in ("conv", "blank", "duplicate", "truncated", "illegal")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())], ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


def _row_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = ["conv", "row", "head", "edit", "new_role"], [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    for batch in batches:
        for conv, audit in zip(batch.column("conv").to_pylist(), batch.column("audit").to_pylist(), strict=True):
            rows = []
            for i, (before, edit, role) in enumerate(edits(audit)):
                if before or edit in ("K", "R"):
                    rows.append((conv, i, "\n".join(f"{x}:" for x in before) if before else None, edit, role))
                if len(rows) >= 8192:
                    yield made(rows)
                    rows = []
            if rows:
                yield made(rows)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a conversation over its rows in order, which arrive as a stream."""
    now, digest, out = None, None, []
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["conv", "repaired_sha256"])
    for batch in batches:
        for conv, block in zip(batch.column("conv").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if conv != now:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256(block.encode())
            else:
                digest.update(b"\n" + block.encode())
        if len(out) >= 4096:
            yield made(out)
            out = []
    if digest is not None:
        out.append((now, digest.hexdigest()))
    if out:
        yield made(out)


def _across_tasks(raw: DataFrame) -> DataFrame:
    """Results of the conversations whose rows were written as they are."""
    spark = raw.sparkSession
    raw = raw.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), *_ROW)
    rows = raw.filter("present").drop("present")
    identity = F.sha2(F.concat_ws("\0", "role", "text"), 256)
    placed = rows.select("conv", "chunk", "place", identity.alias("identity"), F.substring("role", 1, 1).alias("initial"), F.col("bare").alias("blank"), "cut")
    at = F.struct("chunk", "place")
    first = placed.groupBy("conv", "identity").agg(F.min(at).alias("first"))
    top = rows.agg(F.max("chunk"), F.max("place")).first()
    last_block = (top[1] or 0) // BLOCK
    bits = last_block.bit_length()
    facts = placed.join(first, ["conv", "identity"]).select("conv", (F.shiftleft(F.col("chunk").cast("long"), bits) + F.expr(f"place div {BLOCK}")).alias("number"), "place", "initial", "blank", "cut", (at > F.col("first")).alias("duplicate"))
    nodes = facts.groupBy("conv", "number").applyInPandas(_block_node, _NODE)
    width = (((top[0] or 0) << bits) + last_block).bit_length()
    for _ in range(0, width, FAN_IN_BITS):
        nodes = nodes.withColumn("above", F.shiftright("number", FAN_IN_BITS)).groupBy("conv", "above").applyInPandas(_merged_node, _NODE)
    path = shared_dir(spark, "conversations-audits")
    nodes.mapInArrow(_best, "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string").write.parquet(path)
    best = spark.read.parquet(path)

    sizes = rows.groupBy("conv", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edited = best.select("conv", "audit").mapInArrow(_row_edits, "conv string, row long, head string, edit string, new_role string")
    numbered = rows.join(before.drop("n"), ["conv", "chunk"]).select("conv", (F.col("before") + F.col("place")).alias("row"), "role", "text")
    own = F.when(F.col("edit").isNotNull() & (F.col("edit") != "D"), F.concat(F.coalesce("new_role", "role"), F.lit(":"), F.col("text")))
    blocks = edited.join(numbered, ["conv", "row"], "left").select("conv", "row", F.concat_ws("\n", "head", own).alias("block"))
    digests = blocks.repartition("conv").sortWithinPartitions("conv", "row").mapInArrow(_digests, "conv string, repaired_sha256 string")

    shown = F.when(F.col("present"), F.col("turn"))
    gaps = raw.groupBy("conv").agg((F.max(shown) - F.min(shown) + 1 - F.count_distinct(shown)).alias("gaps"))
    out = gaps.join(best, "conv", "left").join(digests, "conv", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in RESULT[:6]}
    out = out.withColumns({**zero, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})
    return out.select(F.when(F.col("conv") != "", F.col("conv").cast("long")).alias("conv_id"), *RESULT)


def repaired(turns: DataFrame, present: str | None = None) -> DataFrame:
    """``conv_id`` and what was found, done and left for every conversation of ``turns``: ``conv_id, turn, role, text``.

    Rows for which the column ``present`` is false are no turns; they keep a conversation's identifier in the result.
    """
    spark = turns.sparkSession
    there = F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)
    said = lambda c: F.when(there, F.coalesce(F.col(c).cast("string"), F.lit(" ")))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"), there.alias("present"))
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.withColumns({"bare": F.coalesce(ended == "", F.lit(False)), "cut": F.coalesce(~F.substring(ended, -1, 1).isin(".", "!", "?"), F.lit(False)), "mark": F.xxhash64("text")})
    ranges = ["conv_id", "turn", "role", "mark"]
    dealt = rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges, "text").select("conv_id", "turn", "role", "text", "bare", "cut", "present")
    path = shared_dir(spark, "conversations-done")
    with small_batches(spark):
        dealt.mapInArrow(_in_tasks, f"conv_id long, done boolean, {_RESULT_TYPES}, {_ROW_TYPES}").write.parquet(path)
    out = spark.read.parquet(path)
    return out.filter("done").select("conv_id", *RESULT).unionByName(_across_tasks(out.filter("not done")))


def damaged(conversations: DataFrame) -> DataFrame:
    """Every twentieth turn is lost, emptied, stripped of its marks, doubled or given to the user, as a checksum of its key tells."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") != 0).alias("present"), copies.alias("copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "present")


_MOVES = ", ".join(f"('{initial}', {i}, {j})" for initial in MOVES for i, j in MOVES[initial].items())
_INSERTED = ", ".join(f"({i}, {j}, {x[0]}, '{x[1]}')" for i, line in enumerate(INSERTIONS) for j, x in enumerate(line) if x is not None)
SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), fated AS (
  SELECT *, xor(list_reduce(range(8 * len(k)), lambda acc, i: xor(xor(acc, CASE WHEN i % 8 = 0 THEN ord(k[i // 8 + 1]) ELSE 0 END) >> 1, 3988292384 * (xor(acc, CASE WHEN i % 8 = 0 THEN ord(k[i // 8 + 1]) ELSE 0 END) & 1)), 4294967295::BIGINT), 4294967295) % 20 AS fate FROM keyed
), rows_left AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated WHERE fate <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM rows_left
), facts AS (
  SELECT conv_id, rn, turn, role, text, role[1] AS initial, bare = '' AS blank, bare <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS duplicate, bare NOT IN ('') AND bare[-1] NOT IN ('.', '!', '?') AS cut FROM numbered
), found AS (
  SELECT *, cut AND NOT duplicate AS truncated, lag(initial) OVER (PARTITION BY conv_id ORDER BY rn) || initial AS pair FROM facts
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM found GROUP BY conv_id
), moves(initial, a, b) AS (VALUES {_MOVES}), inserted(a, b, cost, audit) AS (VALUES {_INSERTED}),
edits AS (
  SELECT conv_id, rn, a, b, {DELETE} AS cost, 'D' AS audit FROM found, (VALUES {", ".join(f"({i}, {i})" for i in range(STATES))}) s(a, b)
  UNION ALL SELECT conv_id, rn, a, b, {KEEP} + CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END, 'K' FROM found JOIN moves USING (initial) WHERE NOT blank AND NOT duplicate
  UNION ALL SELECT conv_id, rn, a, b, {REROLE} + CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END, 'R' FROM found, moves WHERE moves.initial IN ('u', 'a') AND NOT blank AND NOT duplicate
), steps AS (
  SELECT conv_id, rn, e.a, i.b, min(struct_pack(cost := e.cost + i.cost, audit := e.audit || i.audit)) AS x FROM edits e JOIN inserted i ON e.b = i.a GROUP BY ALL
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS rn, b AS state, struct_pack(cost := cost, audit := audit) AS x FROM (SELECT DISTINCT conv_id FROM conversations), inserted WHERE a = 0
  UNION ALL
  SELECT w.conv_id, s.rn, s.b, min(struct_pack(cost := w.x.cost + s.x.cost, audit := w.x.audit || s.x.audit)) FROM walk w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.rn = w.rn + 1 AND s.a = w.state GROUP BY w.conv_id, s.rn, s.b
), best AS (
  SELECT w.conv_id, min(x) AS x FROM walk w LEFT JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.rn = coalesce(c.n, 0) AND state IN (0, 3) GROUP BY w.conv_id
), letters AS (
  SELECT conv_id, p, x.audit[p] AS letter, len(replace(x.audit, 'D', '')) % 2 AS odd, len(replace(x.audit[1:p], 'I', '')) AS rn, len(replace(x.audit[1:p], 'D', '')) AS q FROM (SELECT conv_id, x, unnest(range(1, len(x.audit) + 1)) AS p FROM best)
), repaired AS (
  SELECT l.conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (q + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS digest
  FROM letters l LEFT JOIN found f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.rn = f.rn WHERE letter <> 'D' GROUP BY l.conv_id
)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(b.x.cost AS BIGINT) AS cost, b.x.audit AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON b.conv_id IS NOT DISTINCT FROM r.conv_id
"""
