"""Cheapest repair of conversation structure with Four-Russians block tables.

The role initials of a repaired conversation read ``(s?(ua)+)?``. Every row is kept (0), given the
role user or assistant (3) or deleted (4; blank and repeated rows must be); empty user or assistant
turns are inserted anywhere (3); a truncated row that is not deleted adds 3. Of the cheapest repairs
the one with the ASCII-least string of initials (D, I, K, R) is taken.

What the rows after a place cost is a vector over the four states of the pattern. Less its minimum
it is one of a few vectors, so a row is a transition between them, and ``tables`` holds the
transitions of every block of ``BLOCK`` rows. A conversation is cut into segments of at most
``SEGMENT`` rows; tasks look up each segment's blocks from the right for all vectors at once; the
segments' transitions chain, from a conversation's last one back, to the vector at the right end of
each. From there a segment's rows are expanded backwards to the vector behind each row, and the
trace goes forward: with the cost of all that follows known, the least initial that keeps the
least cost is right, whatever ties.

Repeated rows are found by the smallest place for each (conversation, role, text), folded before the
shuffle; places come from one distributed sort. So no task holds a conversation: the last step
streams its rows in order, with one byte for each row of a segment.

Faults, the first that fits: ``blank`` (no character but white space), ``duplicate`` (role and text
seen earlier in the conversation), ``truncated`` (the last such character is none of ``.!?``).

Defined results: a null role or text is one space; rows go by turn, role, SHA-256 of the text (nulls
first), fully equal rows are neighbours; rows without conv_id are one conversation; a role whose
initial is none of s, u, a (or that is empty) cannot be kept as it is; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm import common

BLOCK = 4              # rows in a looked-up block
SEGMENT = 4096         # rows whose transitions are looked up together
CHANGE, DELETE, INSERT, CUT = 3, 4, 3, 3
SPACE = " \t\n\x0b\f\r"
#: States: nothing yet, after system, after user, after assistant.
NEXT_INSERTED = (2, 2, 3, 2)
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NAMES = {2: b"user", 3: b"assistant"}
END = (0, 2 * INSERT, INSERT, 0)
SYMBOLS = 8            # initial (s, u, a, other) and whether the row is truncated; "x" must go
FORCED = ord("x")


def _before(after: tuple, symbol: int) -> tuple:
    """Costs before a row, from those after it."""
    initial, extra = "sua."[symbol // 2], CUT * (symbol % 2)
    out = [min([DELETE + after[s], CHANGE + extra + after[NEXT_INSERTED[s]]]
               + ([extra + after[KEPT[s][initial]]] if initial in KEPT[s] else [])) for s in range(4)]
    for _ in range(3):
        out = [min(out[s], INSERT + out[NEXT_INSERTED[s]]) for s in range(4)]
    return tuple(out)


class Tables:
    """Normalised vectors, and the transitions of every row and every block between them."""

    def __init__(self, block: int = BLOCK):
        self.vectors = [END]
        place, step = {END: 0}, []
        for v in self.vectors:                  # grows while it is walked
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(v, symbol)
                least = min(costs)
                rest = tuple(c - least for c in costs)
                if rest not in place:
                    place[rest] = len(self.vectors)
                    self.vectors.append(rest)
                row.append((place[rest], least))
            step.append(row)
        self.step = [[s[0] for s in row] for row in step]
        one, paid = (np.array([[s[i] for s in row] for row in step], np.int64) for i in (0, 1))
        self.one, self.paid = one, paid
        self.block, self.block_paid = one, paid
        for _ in range(block - 1):              # one more row in front of each block
            to = one[self.block]                                        # vector, code of the rest, symbol in front
            cost = self.block_paid[:, :, None] + paid[self.block]
            self.block, self.block_paid = (x.transpose(0, 2, 1).reshape(len(one), -1) for x in (to, cost))
        self.width = block
        self.edits = [[[self._edit(v, symbol, s) for s in range(4)] for symbol in range(SYMBOLS)] for v in range(len(self.vectors))]

    def _edit(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """Initials spent on a row in ``state`` when ``after`` follows it, and the state behind it."""
        behind, initial, extra = self.vectors[after], "sua."[symbol // 2], CUT * (symbol % 2)
        here, out = _before(behind, symbol), ""
        while True:
            if here[state] == DELETE + behind[state]:
                return out + "D", state
            if here[state] == INSERT + here[NEXT_INSERTED[state]]:
                out, state = out + "I", NEXT_INSERTED[state]
                continue
            if initial in KEPT[state] and here[state] == extra + behind[KEPT[state][initial]]:
                return out + "K", KEPT[state][initial]
            return out + "R", NEXT_INSERTED[state]

    def segment(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Vector before the symbols, and its cost, for each vector after them; whole blocks by lookup."""
        live = np.frombuffer(symbols, np.uint8).astype(np.int64) - ord("0")
        head = len(live) % self.width
        codes = live[head:].reshape(-1, self.width) @ SYMBOLS ** np.arange(self.width - 1, -1, -1)
        at, cost = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for code in codes[::-1].tolist():
            cost += self.block_paid[at, code]
            at = self.block[at, code]
        for symbol in live[:head][::-1].tolist():
            cost += self.paid[at, symbol]
            at = self.one[at, symbol]
        return at, cost

    def trace(self, symbols: bytes, after: int, state: int) -> list[str]:
        """Initials for each row of a segment entered in ``state`` with the vector ``after`` behind it."""
        behind = [after]
        for c in reversed(symbols):
            behind.append(behind[-1] if c == FORCED else self.step[behind[-1]][c - 48])
        out = []
        for c, v in zip(symbols, reversed(behind[:-1])):
            if c == FORCED:
                out.append("D")
            else:
                spent, state = self.edits[v][c - 48][state]
                out.append(spent)
        return out


@cache
def tables() -> Tables:
    return Tables()


def _segments(batches):
    """(conv_id, segment, symbols) with the vector and cost before the segment for each vector after it."""
    t = tables()
    for batch in batches:
        found = [t.segment(s.as_py().replace(b"x", b"")) for s in batch.column(2)]
        yield pa.record_batch([*batch.columns, pa.array([f[0].tolist() for f in found], pa.list_(pa.int64())),
                               pa.array([f[1].tolist() for f in found], pa.list_(pa.int64()))], names=["conv_id", "segment", "symbols", "before", "paid"])


_CHAINED = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("symbols", pa.binary()), ("after", pa.int64()), ("least", pa.int64())])


def _chain(batches):
    """Segments of each conversation from the last back: the vector after each, and the least cost from it on."""
    conv, at, cost, t = _NO, 0, 0, tables()
    for batch in batches:
        after, least = [], []
        for r in range(batch.num_rows):
            c = batch.column(0)[r].as_py()
            if c != conv:
                conv, at, cost = c, 0, 0
            after.append(at)
            cost += batch.column(4)[r].as_py()[at] + DELETE * batch.column(2)[r].as_py().count(b"x")
            at = batch.column(3)[r].as_py()[at]
            least.append(cost + t.vectors[at][0])
        yield pa.record_batch([*batch.columns[:3], pa.array(after, pa.int64()), pa.array(least, pa.int64())], schema=_CHAINED)


_NO = object()
EDITS = ("conv_id long, step long, edit string, turn long, was_role binary, role binary, text binary, fault string, least long")
_EDITS = pa.schema([("conv_id", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("was_role", pa.binary()),
                    ("role", pa.binary()), ("text", pa.binary()), ("fault", pa.string()), ("least", pa.int64())])


def _traced(batches):
    """One row for each edit, in order, from a stream of segments, each followed by its rows."""
    t, conv, state, step, least, out = tables(), _NO, 0, 0, 0, []
    spent, symbols = iter(()), iter(())

    def insert():
        nonlocal state, step
        state = NEXT_INSERTED[state]
        out.append((conv, step, "I", None, None, NAMES[state], b"", None, least))
        step += 1

    def end():
        while state in (1, 2):
            insert()

    for batch in batches:
        columns = [batch.column(n) for n in ("conv_id", "turn", "role", "text", "blank", "symbols", "after", "least")]
        for r in range(batch.num_rows):
            c, turn, role, text, blank, marks, after, cost = (x[r].as_py() for x in columns)
            if c != conv:
                end()
                conv, state, step, least = c, 0, 0, cost
            if marks is not None:               # a segment: trace it, its rows follow
                spent, symbols = iter(t.trace(marks, after, state)), iter(marks)
                continue
            symbol, letters = next(symbols), next(spent)
            fault = ("blank" if blank else "duplicate") if symbol == FORCED else "truncated" if symbol % 2 else None
            for _ in letters[1:]:
                insert()
            edit, new = letters[-1], None
            if edit == "R":
                state = NEXT_INSERTED[state]
                new = NAMES[state]
            elif edit == "K":
                state, new = KEPT[state][chr(role[0])], role
            out.append((conv, step, edit, turn, role, new, text, fault, least))
            step += 1
        yield _batch(out, _EDITS)
        out.clear()
    end()
    yield _batch(out, _EDITS)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def repair(turns: DataFrame) -> DataFrame:
    """The edits of every conversation of ``turns`` (conv_id, turn, role, text), in order within partitions.

    One row for each edit: conv_id, step (from 0), edit (K, R, D, I), turn and was_role of the row (null if
    inserted), role and text after the edit (role null if deleted), fault, and the conversation's
    least cost. Rows of a conversation are in one partition in order of step.
    """
    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    rows = rows.select("*", F.sha2("text", 256).alias("key"), (trimmed == "").alias("blank"),
                       (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).cast("int").alias("cut"))
    rows, _ = common.numbered(rows, [F.col(c) for c in ("conv_id", "turn", "role", "key")], "repair-rows", "at")
    rows = rows.withColumn("segment", F.call_function("div", F.col("at"), F.lit(SEGMENT)))
    first = rows.where(~F.col("blank")).groupBy("conv_id", "role", "key").agg(F.min("at").alias("first"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 2).when(initial == "a", 4).otherwise(6) + F.col("cut")
    symbol = F.when(F.col("first").isNull(), "x").otherwise(code.cast("string"))
    segments = (rows.select("conv_id", "segment", "at", "role", "cut").join(first.select("first"), F.col("at") == F.col("first"), "left")
                .groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list(F.struct("at", symbol.alias("symbol")))).alias("sorted"))
                .select("conv_id", "segment", F.array_join("sorted.symbol", "").cast("binary").alias("symbols")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    looked_up = segments.mapInArrow(_segments, "conv_id long, segment long, symbols binary, before array<long>, paid array<long>")
    chained = (looked_up.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.col("segment").desc())
               .mapInArrow(_chain, "conv_id long, segment long, symbols binary, after long, least long"))
    chained = common.stored(chained, "repair-segments")
    own = rows.select("conv_id", "segment", "at", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "blank")
    both = chained.unionByName(own, allowMissingColumns=True)
    return (both.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "segment", F.col("at").asc_nulls_first())
            .mapInArrow(_traced, EDITS))


_DIGEST = pa.schema([("conv", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _digested(batches):
    """One row for each conversation of a stream of edits; a conversation's text passes through the hash only."""
    conv, now = _NO, None

    def row():
        turns = now["last"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
        return (conv, turns, *(now[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")), now["audit"].decode(), now["hash"].hexdigest())

    for batch in batches:
        out = []
        columns = [batch.column(n) for n in ("conv_id", "edit", "turn", "was_role", "role", "text", "fault", "least")]
        for r in range(batch.num_rows):
            c, edit, turn, was, role, text, fault, least = (x[r].as_py() for x in columns)
            if c != conv:
                if conv is not _NO:
                    out.append(row())
                conv = c
                now = {"low": turn, "last": None, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": least,
                       "audit": bytearray(), "hash": hashlib.sha256(), "initial": None, "any": False}
            now["audit"] += edit.encode()
            if fault:
                now[fault] += 1
            if was is not None:
                initial = was.decode()[:1]
                if now["initial"] is not None and now["initial"] + initial not in ("su", "ua", "au"):
                    now["illegal"] += 1
                now["initial"] = initial
                if turn is not None and turn != now["last"]:        # rows come by turn
                    now["low"] = turn if now["turns"] == 0 else now["low"]
                    now["last"], now["turns"] = turn, now["turns"] + 1
            if role is not None:
                now["hash"].update((b"\n" if now["any"] else b"") + role + b":")
                now["hash"].update(text)
                now["any"] = True
        yield _batch(out, _DIGEST)
    yield _batch([row()] if conv is not _NO else [], _DIGEST)


def digest(turns: DataFrame, every: DataFrame) -> DataFrame:
    """Per conv_id of ``every``: counts of faults, cost, audit and hash of the repaired conversation.

    A conversation's hash is one chain over its whole text, so its rows pass one task; they are not held.
    """
    found = repair(turns).mapInArrow(_digested, "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                                "audit string, repaired_sha256 string")
    ids = every.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with seeded damage: one in twenty each dropped, emptied, without end marks, repeated, or made user's."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("kind")).where("kind <> 0")
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


_MOVES = "(VALUES " + ", ".join(f"({s}, {n}, {t}, '{'I' * n}', {names})" for s, row in enumerate(
    ([(0, 0), (1, 2), (2, 3), (3, 2)], [(0, 1), (1, 2), (2, 3)], [(0, 2), (1, 3), (2, 2)], [(0, 3), (1, 2), (2, 3)]))
    for n, t in row for names in [str([("user:", "assistant:")[(s == 2) ^ (i % 2)] for i in range(n)]) + "::VARCHAR[]"]) + ") v(st, ins, mid, letters, lines)"
_KEEPS = "(VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) k(st, initial, nxt)"
_ENDS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL = rf"""
WITH RECURSIVE crc_table AS (SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS f
                             FROM (SELECT unnest(range(256)) AS i)),
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS t,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kinds AS (SELECT base.*, xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex(encode(k)), '..'), lambda h: ('0x' || h)::BIGINT),
                                                     lambda c, b: xor(c >> 8, f[xor(c & 255, b) + 1]))) % 20 AS d FROM base, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
                   CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t,
                   unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE d <> 0),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) AS cid, left(role, 1) AS initial, rtrim(t, {_ENDS}) AS cut,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(t)) AS rk FROM damaged),
faults AS (SELECT *, cut = '' AS blank, cut <> '' AND row_number() OVER (PARTITION BY cid, role, t ORDER BY rk) > 1 AS duplicate,
                  lag(initial) OVER (PARTITION BY cid ORDER BY rk) AS was FROM ranked),
marked AS (SELECT *, NOT blank AND NOT duplicate AND right(cut, 1) NOT IN ('.', '!', '?') AS truncated FROM faults),
counts AS (SELECT cid, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                  count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
                  count(*) FILTER (was IS NOT NULL AND was || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(rk) AS n FROM marked GROUP BY cid),
walk(cid, rk, st, best) AS (
  SELECT cid, 0::BIGINT, 0, {{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}} FROM counts
  UNION ALL
  SELECT cid, rk, st, min(best) FROM (
    SELECT w.cid, m.rk, o.st, {{'c': w.best.c + 3 * v.ins + o.c, 'a': w.best.a || v.letters || o.a, 'l': list_concat(list_concat(w.best.l, v.lines), o.l)}} AS best
    FROM walk w JOIN marked m ON m.cid = w.cid AND m.rk = w.rk + 1 JOIN {_MOVES} ON v.st = w.st,
    LATERAL (SELECT v.mid AS st, 4 AS c, 'D' AS a, []::VARCHAR[] AS l
             UNION ALL SELECT k.nxt, 3 * m.truncated::INT, 'K', [m.role || ':' || m.t] FROM {_KEEPS} WHERE k.st = v.mid AND k.initial = m.initial AND NOT m.blank AND NOT m.duplicate
             UNION ALL SELECT CASE v.mid WHEN 2 THEN 3 ELSE 2 END, 3 + 3 * m.truncated::INT, 'R', [CASE v.mid WHEN 2 THEN 'assistant:' ELSE 'user:' END || m.t]
                       WHERE NOT m.blank AND NOT m.duplicate) o) GROUP BY cid, rk, st),
ended AS (SELECT cid, min({{'c': best.c + CASE st WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, 'a': best.a || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                            'l': list_concat(best.l, CASE st WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE []::VARCHAR[] END)}}) AS best
          FROM walk JOIN counts USING (cid) WHERE rk = n GROUP BY cid)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended USING (cid)
"""
