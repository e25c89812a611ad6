"""Repair of conversation structure by Four-Russians block tables.

The rows of a conversation, in order, are edited at least cost so that the role
initials read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 2,
Delete 3 (required for blank and duplicate rows), Insert an empty user or
assistant message 2; a truncated row that stays adds 1.  Among the cheapest
edits the one with the ASCII-least string of initials is taken.

A row matters to the cost only by its symbol (four role classes, truncated or
not, or "must go"), and the cost of finishing from the four states of the
pattern matters only up to a common offset.  Few such normalised vectors exist,
so the vector to the left of any ``BLOCK`` symbols is looked up by (vector to
their right, symbols).  Costs are taken from the end to the front in blocks; the
trace goes forward, expanding one block at a time backward into its single
vectors, so at each row it sees every edit that is still on a cheapest path and
can take the least letter.

Spark's part: rows get their place by a range sort; repeats are found by a
grouped hash; symbols are gathered in chunks of ``CHUNK`` rows, one byte a row.
Only these chunks pass through one task per conversation, first backward, then
forward, with one vector or state carried; texts are dealt by (conversation,
chunk) when the edits are applied.

Defined results: null roles and texts count as one space; rows without a
conversation id form one conversation; null turns come first and are left out of
gaps; rows of equal turn are ordered by role, then by the MD5 of the text; a
role's class is its first character; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, ship, store, with_position

BLOCK = 4
CHUNK = 4096
SPACES = " \t\n\x0b\x0c\r"

# States of the pattern: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
# Role classes of a row: s, u, a, any other.
CLASSES = "sua"
CLEAN, TRUNCATED, DUPLICATE, BLANK = range(4)
MUST_GO = 8                       # symbol: class, + 4 if truncated, or this
_MADE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)     # the state after an inserted or reroled message
_KEPT = ({0: AFTER_S, 1: AFTER_U}, {1: AFTER_U}, {2: AFTER_A}, {1: AFTER_U})
_TAIL = ("", "II", "I", "")
_ROLE = {AFTER_U: "user", AFTER_A: "assistant"}


def _closed(base: list[int]) -> tuple[int, ...]:
    """Costs of finishing once insertions before the next row are allowed."""
    u = min(base[AFTER_U], 2 + base[AFTER_A])
    a = min(base[AFTER_A], 2 + base[AFTER_U])
    return (min(base[START], 2 + u), min(base[AFTER_S], 2 + u), u, a)


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs of finishing from before a row, given those from behind it."""
    base = [3 + c for c in after]
    if symbol != MUST_GO:
        extra, kind = symbol // 4, symbol % 4
        for q in range(4):
            base[q] = min(base[q], 2 + extra + after[_MADE[q]])
            if kind in _KEPT[q]:
                base[q] = min(base[q], extra + after[_KEPT[q][kind]])
    return _closed(base)


def _letters(after: tuple[int, ...], symbol: int, q: int) -> tuple[str, int]:
    """The least letters that take state ``q`` over a row on a cheapest path."""
    here, out = _before(after, symbol), ""
    while True:
        if 3 + after[q] == here[q]:
            return out + "D", q
        if 2 + here[_MADE[q]] == here[q]:
            out, q = out + "I", _MADE[q]
            continue
        extra, to = symbol // 4, _KEPT[q].get(symbol % 4)
        if to is not None and extra + after[to] == here[q]:
            return out + "K", to
        return out + "R", _MADE[q]


class Tables:
    """Every normalised cost vector, its steps over one symbol and over one block."""

    def __init__(self, block: int = BLOCK):
        end = _closed([0, 99, 99, 0])
        ids, self.vectors, steps, offsets = {}, [], [], []

        def number(v):
            low = min(v)
            v = tuple(c - low for c in v)
            if v not in ids:
                ids[v] = len(self.vectors)
                self.vectors.append(v)
            return ids[v], low

        self.end = number(end)[0]
        for v in self.vectors:                     # grows while it is read
            found = [number(_before(v, s)) for s in range(MUST_GO + 1)]
            steps.append([f[0] for f in found])
            offsets.append([f[1] for f in found])
        self.step, self.cost = np.array(steps, np.int16), np.array(offsets, np.int32)
        self.path = [[[_letters(v, s, q) for q in range(4)] for s in range(MUST_GO + 1)] for v in self.vectors]
        # A block's code is its symbols as digits, the leftmost first.
        self.block, self.digits = block, MUST_GO + 1
        to, cost = self.step, self.cost
        for _ in range(block - 1):
            n = to.shape[1]
            first = np.repeat(np.arange(self.digits), n)
            rest_to, rest_cost = np.tile(to, self.digits), np.tile(cost, self.digits)
            to, cost = self.step[rest_to, first], rest_cost + self.cost[rest_to, first]
        self.to, self.paid = to.tolist(), cost.tolist()
        self.single = self.step.tolist()
        self.power = self.digits ** np.arange(block - 1, -1, -1)

    def back(self, symbols: np.ndarray, right: int) -> tuple[int, int, list[int]]:
        """(vector, offset) to the left of ``symbols``, and the vectors to the
        right of each block, the leftmost block first."""
        odd = len(symbols) % self.block
        codes = (symbols[odd:].reshape(-1, self.block) @ self.power).tolist()
        v, total, rights = right, 0, []
        for code in reversed(codes):
            rights.append(v)
            total += self.paid[v][code]
            v = self.to[v][code]
        rights.reverse()
        for s in symbols[:odd][::-1].tolist():
            total += int(self.cost[v, s])
            v = self.single[v][s]
        return v, total, rights

    def trace(self, symbols: np.ndarray, right: int, q: int) -> tuple[list[str], int]:
        """The letters of every row, from state ``q``, and the state behind."""
        _, _, rights = self.back(symbols, right)
        odd, out = len(symbols) % self.block, []
        pieces = [symbols[:odd]] if odd else []
        pieces += list(symbols[odd:].reshape(-1, self.block))
        if odd:
            # What is to the right of the odd rows is to the left of the first block.
            rights = [self.back(symbols[odd:], right)[0], *rights]
        for piece, v in zip(pieces, rights, strict=True):
            behind = []
            for s in piece[::-1].tolist():         # one block, expanded backward
                behind.append(v)
                v = self.single[v][s]
            for s, v in zip(piece.tolist(), reversed(behind), strict=True):
                letters, q = self.path[v][s][q]
                out.append(letters)
        return out, q


@functools.lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def symbols_of(codes: bytes) -> np.ndarray:
    """Row codes (4 * fault + class) to table symbols."""
    return np.minimum(np.frombuffer(codes, np.uint8), MUST_GO).astype(np.int64)


# --- the rows -----------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The contract's faults, put into conversations(conv_id, turn, role, text)."""
    blank = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                                F.coalesce("text", blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("lot", F.crc32(key.cast("binary")) % 20).where(F.col("lot") != 0)
    lot = F.col("lot")
    text = F.when(lot == 1, "").when(lot == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(lot == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(lot == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), copies.alias("copy")).drop("copy")


def _code() -> Column:
    """4 * fault + class, repeats not yet known."""
    kind = F.substring("role", 1, 1)
    cls = F.lit(3)
    for i, c in enumerate(CLASSES):
        cls = F.when(kind == c, i).otherwise(cls)
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(F.length(body) == 0, BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN)
    return 4 * fault + cls


def place(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Stored rows with their place over all conversations, chunk, code and the
    hash by which repeats are found."""
    blank = F.lit(" ")
    slim = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    slim = slim.withColumn("lot", F.md5(F.col("text").cast("binary"))) \
        .withColumn("same", F.unhex(F.md5(F.concat_ws(
            ":", F.coalesce(F.col("conv_id").cast("string"), blank), F.length("role"), "role", "lot").cast("binary")))) \
        .withColumn("code", _code().cast("int"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("lot")]
    placed = with_position(slim, order, "repair-rows")
    return placed.drop("lot").withColumn("chunk", F.floor(F.col("position") / chunk))


# --- chunks of symbols, one conversation after the other -----------------------

_CHUNKS = "conv_id bigint, chunk bigint, codes binary, back int, cost bigint, last boolean"
_TRACED = ("conv_id bigint, chunk bigint, state int, edits array<string>, cost bigint, "
           "blank bigint, duplicate bigint, truncated bigint, illegal bigint")


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a conversation, the last first -> the same with the vector to
    their right and the cost of all that follows their left edge."""
    t = tables()
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary()), ("back", pa.int32()),
                        ("cost", pa.int64()), ("last", pa.bool_())])
    current, v, total = (), t.end, 0
    for batch in batches:
        out = []
        for conv, chunk, packed in zip(*_columns(batch, "conv_id", "chunk", "packed"), strict=True):
            last = (conv,) != current
            if last:
                current, v, total = (conv,), t.end, 0
            x = np.sort(np.array(packed, np.int64))
            again, x = x[x & 16 != 0] >> 5, x[x & 16 == 0]
            codes = (x & 15).astype(np.uint8)
            repeat = np.isin(x >> 5, again) & (codes < 4 * BLANK)
            codes[repeat] = 4 * DUPLICATE + codes[repeat] % 4
            codes = codes.tobytes()
            left, paid, _ = t.back(symbols_of(codes), v)
            total += paid
            out.append((conv, chunk, codes, v, total + t.vectors[left][START], last))
            v = left
        yield _emit(out, schema)


def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a conversation in order -> the edits of every row, and counts."""
    t = tables()
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("state", pa.int32()), ("edits", pa.list_(pa.string())),
                        ("cost", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                        ("illegal", pa.int64())])
    allowed = np.zeros((4, 4), bool)
    for pair in ("su", "ua", "au"):
        allowed[CLASSES.index(pair[0]), CLASSES.index(pair[1])] = True
    current, q, before = (), START, None
    for batch in batches:
        out = []
        for conv, chunk, codes, right, cost, last in zip(
                *_columns(batch, "conv_id", "chunk", "codes", "back", "cost", "last"), strict=True):
            first = (conv,) != current
            if first:
                current, q, before = (conv,), START, None
            row = np.frombuffer(codes, np.uint8)
            cls = row % 4 if before is None else np.append(np.uint8(before), row % 4)
            edits, to = t.trace(symbols_of(codes), right, q)
            if last:
                edits[-1] += _TAIL[to]
            n = np.bincount(row // 4, minlength=4)
            out.append((conv, chunk, q, edits, cost if first else 0, int(n[BLANK]), int(n[DUPLICATE]),
                        int(n[TRUNCATED]), int((~allowed[cls[:-1], cls[1:]]).sum())))
            q, before = to, int(row[-1] % 4)
        yield _emit(out, schema)


def trace(placed: DataFrame) -> DataFrame:
    """Rows from ``place`` -> stored chunks with the edits of their rows."""
    ship(placed.sparkSession)
    first = placed.groupBy("same").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = placed.select("same", "conv_id", "chunk", "position").join(first, "same").where(F.col("position") > F.col("first"))
    shifted = F.shiftleft("position", 5)
    packed = placed.select("conv_id", "chunk", (shifted + F.col("code")).alias("x")).unionByName(
        again.select("conv_id", "chunk", (shifted + 16).alias("x")))
    # At most two numbers for each of a chunk's rows.
    chunks = packed.groupBy("conv_id", "chunk").agg(F.collect_list("x").alias("packed"))
    back = chunks.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk")).mapInArrow(backward, _CHUNKS)
    return store(back.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(forward, _TRACED), "repair-traced")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's edits, then its rows in order -> one row per edit."""
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("step", pa.int64()), ("edit", pa.string()),
                        ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    q, edits, step = START, iter(()), 0
    for batch in batches:
        out = []
        for conv, chunk, state, letters, turn, role, text, code in zip(*_columns(
                batch, "conv_id", "chunk", "state", "edits", "turn", "role", "text", "code"), strict=True):
            if letters is not None:
                q, edits, step = state, iter(letters), 0
                continue
            for letter in next(edits):
                if letter == "I":
                    q = _MADE[q]
                    out.append((conv, chunk, step, "I", None, _ROLE[q], ""))
                elif letter == "D":
                    out.append((conv, chunk, step, "D", turn, role, text))
                else:
                    q = _MADE[q] if letter == "R" else _KEPT[q][code % 4]
                    out.append((conv, chunk, step, letter, turn, _ROLE[q] if letter == "R" else role, text))
                step += 1
        if out:
            yield _emit(out, schema)


def repair(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """rows(conv_id, turn, role, text) -> (edits, report).

    ``edits`` holds one row per edit in the order (conv_id, chunk, step): its
    letter, and the message kept, reroled, inserted or (letter D) taken out.
    ``report`` holds one row per conversation: counts of faults and gaps, the
    cost and the string of all letters.
    """
    placed = place(rows, chunk)
    traced = trace(placed)
    texts = placed.select("conv_id", "chunk", F.col("position").alias("at"), "turn", "role", "text", "code")
    heads = traced.select("conv_id", "chunk", F.lit(-1).cast("bigint").alias("at"), "state", "edits")
    dealt = heads.unionByName(texts, allowMissingColumns=True).repartition("conv_id", "chunk") \
        .sortWithinPartitions("conv_id", "chunk", "at")
    edits = store(dealt.mapInArrow(
        _apply, "conv_id bigint, chunk bigint, step bigint, edit string, turn bigint, role string, text string"), "repair-edits")
    pieces = F.array_sort(F.collect_list(F.struct("chunk", F.array_join("edits", "").alias("letters"))))
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    report = traced.groupBy("conv_id").agg(*sums, F.array_join(F.transform(pieces, lambda x: x["letters"]), "").alias("audit"))
    # Turns further apart than a long can say leave no number: 0.
    span = F.try_subtract(F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1).cast("bigint")), F.count("turn"))
    turns = placed.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"))
    report = report.join(turns.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return edits, report


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits sorted by conversation and place -> SHA-256 of the repaired messages."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    current, sha, begun = (), hashlib.sha256(), False
    for batch in batches:
        out = []
        for conv, edit, role, text in zip(*_columns(batch, "conv_id", "edit", "role", "text"), strict=True):
            if (conv,) != current:
                if current:
                    out.append((current[0], sha.hexdigest()))
                current, sha, begun = (conv,), hashlib.sha256(), False
            if edit != "D":
                sha.update((("\n" if begun else "") + role + ":" + text).encode())
                begun = True
        if out:
            yield _emit(out, schema)
    if current:
        yield _emit([(current[0], sha.hexdigest())], schema)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_input(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    edits, report = repair(damage(given))
    digests = edits.select("conv_id", "chunk", "step", "edit", "role", "text").repartition("conv_id") \
        .sortWithinPartitions("conv_id", "chunk", "step").mapInArrow(_digest, "conv_id bigint, repaired_sha256 string")
    wanted = given.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    out = wanted.alias("w").join(report.alias("r"), F.col("w.conv_id").eqNullSafe(F.col("r.conv_id")), "left") \
        .join(digests.alias("d"), F.col("w.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    return out.select(
        "w.conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
