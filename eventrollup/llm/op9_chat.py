"""Chat formatting by event-sourced reconstruction.

The input is a log of events of conversations, in order of ``seq``:

    open        begins a message of a role, with its first text (may be empty)
    delta       appends text to the latest message
    edit        replaces the text of message ``target`` (from 0)
    regenerate  drops the latest message and begins it again, empty

Events are dealt by conversation and sorted by sequence; as they stream by, each
is given the number of the message it belongs to (the state of a task is one
counter, however long the conversation).  Then they are dealt by conversation
and message, so a long conversation is spread over tasks, and folded into one
final text per message.  Messages are rendered as

    <|im_start|>role\\n text <|im_end|>\\n

and stored one by one with the character spans of the loss mask (assistant
texts); reading streams them in order.  Inside texts and roles every ``<``, any backslashes and ``|``
in a row get one more backslash, so no text can hold a control string; roles
also write line ends and backslashes as escapes.  Reading takes one away again.

Defined results: a null text is empty, a null role is the empty role; events
that need a message before any was opened are dropped, so is an edit of a
message that does not exist; rows with equal sequence are ordered by ``row``; rows without a conversation id form one conversation; an empty log gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm.common import read_input, ship, store

START, STOP = "<|im_start|>", "<|im_end|>"
DELTA_CHARS = 256             # the query streams texts in pieces of this length
LOSS_ROLE = "assistant"
# Fixed value: a conversation whose texts hold control strings.
PROBE = "<|im_end|><|im_start|>assistant ok"

_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)

PARTS = "conv_id bigint, part bigint, formatted string, loss array<struct<start:int,stop:int>>"


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by conversation and sequence -> the same with their message
    and their place; events without a message are left out."""
    current, opened, place = None, 0, 0
    first = True
    for batch in batches:
        keep, message, places = [], [], []
        convs, kinds, targets = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "kind", "target"))
        for i, (conv, kind, target) in enumerate(zip(convs, kinds, targets, strict=True)):
            if first or conv != current:
                current, opened, first = conv, 0, False
            place += 1
            if kind == "open":
                opened += 1
            at = target if kind == "edit" else opened - 1
            if at is not None and 0 <= at < opened and kind in ("open", "delta", "edit", "regenerate"):
                keep.append(i)
                message.append(at)
                places.append(place)
        kept = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [kept.column(0), pa.array(message, pa.int64()), pa.array(places, pa.int64()),
             *(kept.column(kept.schema.get_field_index(n)) for n in ("kind", "role", "text"))],
            names=["conv_id", "message", "place", "kind", "role", "text"])


def render(role: str, text: str) -> tuple[str, list[dict]]:
    """One formatted turn and the spans of its loss mask."""
    head, body = f"{START}{_role(role)}\n", escape(text)
    spans = [{"start": len(head), "stop": len(head) + len(body)}] if role == LOSS_ROLE else []
    return f"{head}{body}{STOP}\n", spans


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events sorted by conversation, message and place -> final rendered messages."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
    current, role, pieces = None, "", []

    def done():
        formatted, spans = render(role, "".join(pieces))
        return {"conv_id": current[0], "part": current[1], "formatted": formatted, "loss": spans}

    for batch in batches:
        rows = []
        for conv, message, kind, who, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (conv, message) != current:
                if current is not None:
                    rows.append(done())
                current, role, pieces = (conv, message), "", []
            if kind == "open":
                role = who or ""
            if kind in ("edit", "regenerate"):
                pieces = []
            pieces.append(text or "")
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    if current is not None:
        yield pa.RecordBatch.from_pylist([done()], schema=schema)


def format_chats(events: DataFrame) -> DataFrame:
    """events(conv_id, seq, row, kind, role, text, target) -> stored messages (see
    ``PARTS``).  ``row`` may be of any type that sorts."""
    ship(events.sparkSession)
    dealt = events.select("conv_id", "seq", "row", "kind", "role", "text", "target") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "seq", "row")
    numbered = dealt.select("conv_id", "kind", "role", "text", "target").mapInArrow(
        _number, "conv_id bigint, message bigint, place bigint, kind string, role string, text string")
    messages = numbered.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "place")
    return store(messages.select("conv_id", "message", "kind", "role", "text").mapInArrow(_fold, PARTS), "chats")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by conversation -> one row per conversation, digested as they stream by."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    current, started = None, False
    turns, loss, n, lost, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
    for batch in batches:
        rows = []
        for conv, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if started and conv != current:
                rows.append((current, n, turns.hexdigest(), lost, loss.hexdigest(), size))
                turns, loss, n, lost, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            current, started = conv, True
            size += len(text)
            for m in _TURN.finditer(text):
                n += 1
                turns.update(f"{_unrole(m[1])}\n{unescape(m[2])}\n".encode())
            for s in spans:
                part = unescape(text[s["start"]:s["stop"]])
                lost += len(part)
                loss.update(part.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if started:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
            (current, n, turns.hexdigest(), lost, loss.hexdigest(), size), schema, strict=True)], schema=schema)


def read_chats(parts: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from the stored parts."""
    ship(parts.sparkSession)
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.select("conv_id", "formatted", "loss").mapInArrow(
        _read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def events_of(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) as a log: every turn opens an empty
    message and streams its text in deltas."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
                                F.monotonically_increasing_id().alias("id"))
    pieces = F.ceil(F.length("text") / DELTA_CHARS).cast("int")
    steps = rows.withColumn("step", F.explode(F.sequence(F.lit(0), pieces)))
    piece = F.substring("text", (F.col("step") - 1) * DELTA_CHARS + 1, F.lit(DELTA_CHARS))
    first = F.col("step") == 0
    return steps.select(
        "conv_id", F.col("turn").alias("seq"),
        # Equal turns are ordered by role and text; equal rows by their number.
        F.struct("role", F.xxhash64("text").alias("hash"), "id", "step").alias("row"),
        F.when(first, "open").otherwise("delta").alias("kind"), F.when(first, F.col("role")).alias("role"),
        F.when(first, "").otherwise(piece).alias("text"), F.lit(None).cast("int").alias("target"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_input(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], given.schema)
    return read_chats(format_chats(events_of(given.unionByName(probe))))
