"""Operator 9: chat formatting from an event log of streamed deltas, edits and regenerations."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The template: a turn is OPEN role \n text CLOSE. Assistant texts are under the loss mask.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Strings that steer chat models; none may survive whole inside a text.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_ROLE = re.compile(r"((?:\\.|[^\\\n])*)\n", re.S)
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    """Double every backslash, then break each control string by one after its first character."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render_turn(role: str, text: str) -> tuple[str, tuple[int, int]]:
    """One turn, and the span of its text that the loss covers (empty for other roles)."""
    name = escape(role).replace("\n", "\\\n")
    head, body = f"{OPEN}{name}\n", escape(text)
    begin = len(head)
    return f"{head}{body}{CLOSE}", (begin, begin + len(body) if role == LOSS_ROLE else begin)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    out = []
    for part in formatted.split(OPEN)[1:]:
        role = _ROLE.match(part)[1]
        out.append((unescape(role), unescape(part[len(role) + 1 : -len(CLOSE)])))
    return out


def events_of(conversations: DataFrame, chunk: int = 400) -> DataFrame:
    """An event log of finished turns: each text streamed in deltas of `chunk` characters.

    (conv_id, message, tie, copy, seq, role, kind, payload): messages are in order of turn, rows that share a turn in
    order of a hash of role and text, and repeated rows are messages of their own. Null text is empty. Assistant texts start with a draft that is generated anew, and
    user texts with a version that an edit replaces, as live logs have.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.transform(F.sequence(F.lit(0), F.expr(f"cast((greatest(char_length(t), 1) - 1) div {chunk} as int)")), lambda i: F.expr("t").substr(i * chunk + 1, F.lit(chunk)))

    def event(kind: str, payload):
        return F.struct(F.lit(kind).alias("kind"), payload.cast("string").alias("payload"))

    deltas = F.transform(parts, lambda p: event("delta", p))
    first = F.col("t").substr(F.lit(1), F.lit(40))
    before = (
        F.when(F.col("role") == "assistant", F.array(event("delta", first), event("regenerate", F.lit(None))))
        .when(F.col("role") == "user", F.array(event("delta", first), event("edit", F.lit(""))))
        .otherwise(F.array().cast("array<struct<kind:string,payload:string>>"))
    )
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("message"), F.xxhash64("role", text).alias("tie"), F.monotonically_increasing_id().alias("copy"), "role", text.alias("t"))
    return rows.select("conv_id", "message", "tie", "copy", "role", F.posexplode(F.concat(before, deltas)).alias("seq", "e")).select("conv_id", "message", "tie", "copy", F.col("seq").cast("long").alias("seq"), "role", "e.kind", "e.payload")


def fold(kind: str, payload: str | None, parts: list[str]) -> None:
    """Apply one event to the text so far."""
    if kind == "delta":
        parts.append(payload or "")
    elif kind == "edit":  # the author's new wording
        parts[:] = [payload or ""]
    elif kind == "regenerate":  # what was streamed is withdrawn
        parts.clear()


def format_events(events: DataFrame, with_text: bool = False) -> DataFrame:
    """Fold every conversation's log into final messages, render them, and read the result back.

    Events are dealt by conversation and sorted by message and sequence; a task streams through them and holds one
    message at a time, so a conversation of any length needs no more memory than its longest message (with
    `with_text` it holds the formatted conversation, which is the output). Unknown event kinds change
    nothing; a null role is an empty role; a null conv_id is a conversation of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[list] = [[] for _ in range(7)]
        state: dict = {}

        def open_conversation(conv) -> None:
            state.update(conv=conv, turns=0, sha=hashlib.sha256(), loss=0, loss_sha=hashlib.sha256(), chars=0, text=[])

        def close_message() -> None:
            rendered, (begin, end) = render_turn(state["role"], "".join(state["parts"]))
            state["chars"] += len(rendered)
            for role, text in read_turns(rendered):
                state["turns"] += 1
                state["sha"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            covered = unescape(rendered[begin:end])
            state["loss"] += len(covered)
            state["loss_sha"].update(covered.encode("utf-8", "surrogatepass"))
            if with_text:
                state["text"].append(rendered)

        def close_conversation() -> None:
            values = (state["conv"], state["turns"], state["sha"].hexdigest(), state["loss"], state["loss_sha"].hexdigest(), state["chars"], "".join(state["text"]) if with_text else None)
            for column, value in zip(done, values):
                column.append(value)

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "formatted"]
            out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(done, kinds)], names)
            for column in done:
                column.clear()
            return out

        current = None
        for batch in batches:
            for conv, message, tie, copy, role, kind, payload in zip(*(batch.column(k).to_pylist() for k in range(7))):
                at = (conv, message, tie, copy)
                if at != current:
                    if current is not None:
                        close_message()
                        if conv != current[0]:
                            close_conversation()
                    if current is None or conv != current[0]:
                        open_conversation(conv)
                    current, state["role"], state["parts"] = at, role or "", []
                fold(kind, payload, state["parts"])
            if len(done[0]) >= 256:
                yield flush()
        if current is not None:
            close_message()
            close_conversation()
        yield flush()

    order = ["conv_id", "message", "tie", "copy"]
    dealt = events.select(F.col("conv_id").cast("long").alias("conv_id"), *order[1:], "role", "kind", "payload", "seq").repartition("conv_id").sortWithinPartitions(*order, "seq")
    out = dealt.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, formatted string")
    return out if with_text else out.drop("formatted")


#: The conversation that the query adds, whose texts are control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.unionByName(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))
