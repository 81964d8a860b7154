"""Repair of conversations: the cheapest edits after which a system turn may come first and user and assistant then take turns.

Rows are put in order once, by ranges of (conversation, turn, role, text), so that many tasks share a long conversation.
Faults, repeats and costs then need narrow rows alone. For the edits of one conversation a task holds one byte a row, as the
audit itself does, and state-cost vectors at every sqrt(n)-th row: a backward pass leaves these checkpoints, a forward pass
computes the vectors of one block at a time from the checkpoint behind it and takes, of the edits that keep to the least
cost, the one whose letter comes first. The digest of the repaired text is taken while the texts stream past in order.

Defined results: null counts as one space in role and text, and in the text of conv_id and turn that damage goes by; a null
conv_id is a conversation of its own; rows of one turn go by role, then text; rows without a turn come first; repeated rows
are duplicates; a conversation without rows has zeros, an empty audit and the digest of the empty string; an empty table
gives an empty result; extra columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle

SPACE = " \t\n\x0b\x0c\r"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
#: What the repaired roles so far end with: nothing, the system turn, a user or an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The turn that an inserted or renamed row takes, by state; and the state that keeping a row leads to, by its role's initial.
TURN = (USER, USER, ASSISTANT, USER)
KEEP = ({NOTHING: SYSTEM}, {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = ("s", "u", "a")
LEGAL = {(0, 1), (1, 2), (2, 1)}
Costs = tuple[int, int, int, int]


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults by crc32("conv_id:turn") modulo 20: 0 drops the row, 1 empties its text, 2 takes its sentence ends,
    3 repeats it, 4 makes it a user's."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    text = part("text")
    return (
        conversations.withColumn("__kind", F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20)
        .where("__kind != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("__kind") == 4, "user").otherwise(part("role")).alias("role"),
            F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("__kind") == 3, 2).otherwise(1))).alias("__copy"),
        )
        .drop("__copy")
    )


def in_order(rows: DataFrame) -> DataFrame:
    """The rows with seq, a number that rises in a conversation by turn (nulls first), role and text. Equal rows are told
    apart by where they were read, so that many of them can lie in several ranges."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "__row")]
    text = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    placed = rows.select("conv_id", F.col("turn").cast("long"), text("role"), text("text"), F.monotonically_increasing_id().alias("__row"))
    return settle(placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__row").withColumn("seq", F.monotonically_increasing_id()), "turns-in-order")


def _fault(first: Column) -> Column:
    """First fault of a row, given the number of the first row with its role and text, null where there's no other."""
    return F.when(F.col("end") == "", BLANK).when(F.col("seq") > first, DUPLICATE).when(~F.col("end").isin(".", "!", "?"), TRUNCATED).otherwise(FINE)


def faults(placed: DataFrame) -> DataFrame:
    """conv_id, seq, turn and code (four times the first fault plus the number of the role's initial) of each row."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    role = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    rows = placed.select("conv_id", "seq", "turn", role.alias("initial"), trimmed.substr(F.lit(-1), F.lit(1)).alias("end"), F.sha2(F.concat_ws(":", F.sha2("role", 256), "text"), 256).alias("digest"))
    repeated = rows.where("end != ''").groupBy(F.col("conv_id").alias("__conv"), F.col("digest").alias("__digest")).agg(F.min("seq").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    same = rows["conv_id"].eqNullSafe(repeated["__conv"]) & (rows["digest"] == repeated["__digest"])
    return rows.join(repeated, same, "left").select("conv_id", "seq", "turn", (_fault(F.col("__first")) * 4 + F.col("initial")).cast("int").alias("code"))


def before(costs: Costs, code: int) -> Costs:
    """Least costs by state before a row, given those behind it."""
    fault, initial = divmod(code, 4)
    least = [DELETE + c for c in costs]
    if fault not in (BLANK, DUPLICATE):
        more = CUT * (fault == TRUNCATED)
        for state in range(4):
            least[state] = min(least[state], REROLE + more + costs[TURN[state]])
        for state, then in KEEP[initial].items():
            least[state] = min(least[state], more + costs[then])
    return inserted(least)


def inserted(least: list[int]) -> Costs:
    """The costs where turns may come in first."""
    user, assistant = min(least[USER], INSERT + least[ASSISTANT]), min(least[ASSISTANT], INSERT + least[USER])
    return min(least[NOTHING], INSERT + user), min(least[SYSTEM], INSERT + user), user, assistant


#: Behind the last row nothing may be open but a whole pair of turns.
END: Costs = inserted([0, 1 << 60, 1 << 60, 0])


def tight_edits(codes: bytes) -> tuple[int, str]:
    """Least cost of a conversation's rows and, of its cheapest edits, those whose letters come first in ASCII: Delete,
    Insert, Keep, Rerole."""
    n = len(codes)
    size = isqrt(n) + 1
    costs, checkpoints = END, {}
    for i in range(n - 1, -1, -1):
        if (i + 1) % size == 0:
            checkpoints[i + 1] = costs
        costs = before(costs, codes[i])
    total, state, letters = costs[NOTHING], NOTHING, []
    for low in range(0, n, size):
        high = min(n, low + size)
        block = [checkpoints.get(high, END)]
        for i in range(high - 1, low - 1, -1):
            block.append(before(block[-1], codes[i]))
        for i in range(low, high):
            here, behind = block[high - i], block[high - i - 1]
            fault, initial = divmod(codes[i], 4)
            more = CUT * (fault == TRUNCATED)
            while here[state] != DELETE + behind[state] and here[state] == INSERT + here[TURN[state]]:
                letters.append("I")
                state = TURN[state]
            if here[state] == DELETE + behind[state]:
                letters.append("D")
            elif state in KEEP[initial] and here[state] == more + behind[KEEP[initial][state]]:
                letters.append("K")
                state = KEEP[initial][state]
            else:
                letters.append("R")
                state = TURN[state]
    while END[state]:
        letters.append("I")
        state = TURN[state]
    return total, "".join(letters)


class Repaired:
    """Digest of a repaired conversation, from its audit and then its rows in order."""

    def __init__(self, audit: str):
        self.letters, self.state, self.sha, self.mark = iter(audit), NOTHING, hashlib.sha256(), b""

    def _say(self, role: str, text: str) -> None:
        self.sha.update(self.mark + f"{role}:{text}".encode())
        self.mark = b"\n"

    def _turn(self, text: str) -> None:
        self.state = TURN[self.state]
        self._say(ROLES[self.state], text)

    def row(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == "I":
                self._turn("")
                continue
            if letter == "R":
                self._turn(text)
            elif letter == "K":
                self.state = KEEP[INITIALS.index(role[0])][self.state]
                self._say(role, text)
            return

    def done(self) -> str:
        for _ in self.letters:
            self._turn("")
        return self.sha.hexdigest()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _gathered(rows: Iterator[list], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _schema(kind: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", kind), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])


def decide(coded: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row a conversation with its faults, cost and audit; conversations without coded rows get zeros."""
    every = conversations.select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("seq"), F.lit(None).cast("long").alias("turn"), F.lit(-1).alias("code"))
    rows = coded.unionByName(every).repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    head = ", ".join([f"conv_id {coded.schema['conv_id'].dataType.simpleString()}", *(f"{c} long" for c in COUNTS), "audit string"])

    def one(rows: Iterator[tuple]) -> list:
        codes, least, most, last, turns, illegal = bytearray(), None, None, None, 0, 0
        for _, _, turn, code in rows:
            if code < 0:
                continue
            illegal += bool(codes) and (codes[-1] % 4, code % 4) not in LEGAL
            codes.append(code)
            if turn is not None:
                least, turns = (turn, 1) if least is None else (least, turns + (turn != last))
                most = last = turn
        seen = [sum(codes.count(4 * fault + k) for k in range(4)) for fault in (BLANK, DUPLICATE, TRUNCATED)]
        cost, audit = tight_edits(bytes(codes))
        return [0 if least is None else most - least + 1 - turns, *seen, illegal, cost, audit]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        kind = head.schema.field("conv_id").type
        rows = _streamed(x for part in ([head], batches) for x in part)
        yield from _gathered(([conv, *one(own)] for conv, own in groupby(rows, lambda r: r[0])), _schema(kind))

    return rows.mapInArrow(work, head)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost, audit and digest of the repaired text for each conv_id of conversations, of which
    rows (conv_id, turn, role, text) are what there is to repair."""
    placed = in_order(rows)
    decided = settle(decide(faults(placed), conversations), "audits")
    texts = placed.select("conv_id", "seq", "role", "text", *(F.lit(None).cast(decided.schema[c].dataType).alias(c) for c in (*COUNTS, "audit")))
    audits = decided.select("conv_id", F.lit(-1).cast("long").alias("seq"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), *COUNTS, "audit")
    stream = texts.unionByName(audits).repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    head = ", ".join([f"conv_id {decided.schema['conv_id'].dataType.simpleString()}", *(f"{c} long" for c in COUNTS), "audit string, repaired_sha256 string"])

    def one(rows: Iterator[tuple]) -> list:
        first = next(rows)
        repaired = Repaired(first[-1])
        for row in rows:
            repaired.row(row[2], row[3])
        return [first[0], *first[4:], repaired.done()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return
        schema = _schema(head.schema.field("conv_id").type).append(pa.field("repaired_sha256", pa.string()))
        rows = _streamed(x for part in ([head], batches) for x in part)
        yield from _gathered((one(own) for _, own in groupby(rows, lambda r: r[0])), schema)

    return stream.mapInArrow(work, head)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of all conversations after damage."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair(damage(conversations), conversations)


#: Faults, then the backward and the forward pass as recursions over the numbers of the rows.
OP13_SQL = r"""
WITH RECURSIVE poly AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(b))
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations
), coded AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INT) + 1])), 4294967295) % 20 AS kind
  FROM keyed, poly
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE kind != 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged
), flawed AS (
  SELECT *, CASE WHEN trimmed = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    left(role, 1) AS one, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prior
  FROM placed
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (prior IS NOT NULL AND prior || one NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flawed GROUP BY conv_id
), raw AS (
  SELECT conv_id, n AS i, 0 AS b0, 6 AS b1, 3 AS b2, 0 AS b3 FROM counted
  UNION ALL
  SELECT conv_id, i - 1, least(c0, 3 + least(c2, 3 + c3)), least(c1, 3 + least(c2, 3 + c3)), least(c2, 3 + c3), least(c3, 3 + c2) FROM (
    SELECT r.conv_id, r.i,
      CASE WHEN fault IN ('b', 'd') THEN 4 + b0 ELSE least(4 + b0, m + 3 + b2, CASE one WHEN 's' THEN m + b1 WHEN 'u' THEN m + b2 ELSE 999999999 END) END AS c0,
      CASE WHEN fault IN ('b', 'd') THEN 4 + b1 ELSE least(4 + b1, m + 3 + b2, CASE one WHEN 'u' THEN m + b2 ELSE 999999999 END) END AS c1,
      CASE WHEN fault IN ('b', 'd') THEN 4 + b2 ELSE least(4 + b2, m + 3 + b3, CASE one WHEN 'a' THEN m + b3 ELSE 999999999 END) END AS c2,
      CASE WHEN fault IN ('b', 'd') THEN 4 + b3 ELSE least(4 + b3, m + 3 + b2, CASE one WHEN 'u' THEN m + b2 ELSE 999999999 END) END AS c3
    FROM raw r JOIN (SELECT *, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS m FROM flawed) f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i)
), costs AS (
  SELECT conv_id, i, [b0, b1, b2, b3] AS b FROM raw
), steps AS (
  SELECT r.conv_id, r.i, r.b, e.b AS after, f.one, f.fault, f.role, f.text, CASE WHEN f.fault = 't' THEN 3 ELSE 0 END AS m
  FROM costs r LEFT JOIN costs e ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i + 1 LEFT JOIN flawed f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 1 AS s, '' AS audit, '' AS said, b[1] AS cost, false AS over FROM costs WHERE i = 0
  UNION ALL
  SELECT conv_id, CASE WHEN e IN ('I', 'X') THEN i ELSE i + 1 END,
    CASE WHEN e IN ('D', 'X') THEN s WHEN e = 'K' AND one = 's' THEN 2 WHEN s = 3 THEN 4 ELSE 3 END,
    audit || CASE WHEN e = 'X' THEN '' ELSE e END,
    said || CASE WHEN e IN ('D', 'X') THEN '' ELSE CASE WHEN said = '' THEN '' ELSE chr(10) END || CASE WHEN e = 'K' THEN role WHEN s = 3 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END END,
    cost, e = 'X'
  FROM (
    SELECT w.*, t.one, t.role, t.text, CASE
      WHEN t.after IS NULL THEN CASE WHEN t.b[w.s] = 0 THEN 'X' ELSE 'I' END
      WHEN t.b[w.s] = 4 + t.after[w.s] THEN 'D'
      WHEN t.b[w.s] = 3 + t.b[CASE WHEN w.s = 3 THEN 4 ELSE 3 END] THEN 'I'
      WHEN (t.one = 's' AND w.s = 1 AND t.b[w.s] = t.m + t.after[2]) OR (t.one = 'u' AND w.s != 3 AND t.b[w.s] = t.m + t.after[3]) OR (t.one = 'a' AND w.s = 3 AND t.b[w.s] = t.m + t.after[4]) THEN 'K'
      ELSE 'R' END AS e
    FROM walk w JOIN steps t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i WHERE NOT w.over)
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT ids.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, CAST(coalesce(w.cost, 0) AS BIGINT) AS cost, coalesce(w.audit, '') AS audit, sha256(coalesce(w.said, '')) AS repaired_sha256
FROM ids LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN (SELECT * FROM walk WHERE over) w ON w.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
