"""Chat formatting from event logs.

A conversation is a log of events. Rows are dealt out by ranges of (conversation, message) and sorted by sequence; a task
folds streamed deltas, edits and regenerations into final messages and renders them at once. A short conversation that
lies in one task is then whole; long ones, and the first and the last of each task, which may go on in another, are left as
ordered parts of whole turns and are read part by part.

Template: ``<|im_start|>role\\n text <|im_end|>\\n`` without the spaces. Control strings inside texts are escaped: ``<``,
any backslashes and ``|`` get one backslash more, so no text ever holds ``<|``, and taking one away restores it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearmask.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

#: kinds of events, in the order that equal sequence numbers take
OPEN, DELTA, EDIT, REGENERATE, DROP = "open", "delta", "edit", "regenerate", "drop"
KINDS = (OPEN, REGENERATE, EDIT, DELTA, DROP)


#: characters after which a part of a conversation ends
PART_CHARS = 1 << 18


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "l": "<"}.get(m[1], m[1]), role)


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    return list(turns_of(formatted))


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    for m in TURN.finditer(formatted):
        yield unescape_role(m[1]), unescape(m[2])


def events_of(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = 256) -> DataFrame:
    """The log that whole turns would have left: each row opens a message of its own; assistants stream, break off,
    start again and stream the text in pieces; others write and then edit. Null roles and texts count as empty. The work is
    in proportion to the length of a text, which has to fit a row.

    Rows of one turn number stay separate turns, ordered by a hash of role and text, then by their place in the input.
    """
    t, r = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    # the place keeps repeated rows apart
    stream = F.concat(F.hex(F.xxhash64(r, t)), F.lit("-"), F.hex(F.monotonically_increasing_id()))

    def event(seq, kind: str, body) -> F.Column:
        return F.struct(F.lit(seq).cast("long").alias("seq") if isinstance(seq, int) else seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), body.alias("body"))

    base = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("message"), stream.alias("stream"), r.alias("role"), t.alias("text"))
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))  # the text is gone through once, however long
    streamed = F.transform(pieces, lambda body, i: event(i + 3, DELTA, body))
    assistant = F.concat(F.array(event(0, OPEN, F.lit("")), event(1, DELTA, F.substring(F.col("text"), F.lit(1), F.lit(16))), event(2, REGENERATE, F.lit(""))), streamed)
    other = F.array(event(0, OPEN, F.lit("")), event(1, DELTA, F.substring(F.col("text"), F.lit(1), F.lit(16))), event(2, EDIT, F.col("text")))
    log = base.select("conv_id", "message", "stream", "role", F.explode(F.when(F.col("role") == "assistant", assistant).otherwise(other)).alias("e"))
    return log.select("conv_id", "message", "stream", "role", "e.*")


def fold(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from sorted events to rendered conversations, or parts of them: (conv_id, task, part, whole, formatted).
    A part ends with the message that makes it ``most`` characters or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        conv = message = None
        role, parts, alive, done, chars, part, first, started = "", [], False, [], 0, 0, True, False

        def close() -> None:
            nonlocal chars
            if alive:
                done.append(render(role, "".join(parts)))
                chars += len(done[-1])

        def out(last: bool) -> pa.RecordBatch:
            row = [pa.array([conv], pa.int64()), pa.array([task], pa.int64()), pa.array([part], pa.int64()), pa.array([part == 0 and not first and not last], pa.bool_()), pa.array(["".join(done)], pa.string())]
            return pa.RecordBatch.from_arrays(row, names=["conv_id", "task", "part", "whole", "formatted"])

        for batch in batches:
            for c, m, stream, r, kind, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not started or c != conv:
                    if started:
                        close()
                        yield out(False)
                        first = False
                    conv, message, done, chars, part, alive, started = c, None, [], 0, 0, False, True
                if message != (m, stream):
                    close()
                    message, role, parts, alive = (m, stream), r, [], True
                    if chars >= most:
                        yield out(True)  # the conversation goes on
                        done, chars, part = [], 0, part + 1
                if kind == DELTA:
                    parts.append(body or "")
                elif kind == EDIT:
                    parts = [body or ""]
                elif kind == REGENERATE:
                    parts = []
                elif kind == DROP:
                    alive = False
        if started:
            close()
            yield out(True)

    return run


def format_parts(events: DataFrame, most: int = PART_CHARS) -> DataFrame:
    """conv_id, task, part, whole and formatted: conversations of a log in order of (task, part), each part some turns of
    about ``most`` characters. The log has rows of conv_id, message (a number, null first), stream (which of several
    writings of that message), role, seq, kind and body.

    Within a message, events take effect by seq, then kind (open, regenerate, edit, delta, drop), then body: ``delta``
    appends, ``edit`` replaces, ``regenerate`` clears, ``drop`` removes the message. Repeated events count again. A null
    conv_id is a conversation of its own; an empty log gives no row. ``whole`` says that a part is all of its
    conversation. A message has to fit a task, a conversation need not.
    """
    order = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    sorted_log = events.withColumn("__kind", order).repartitionByRange("conv_id", "message", "stream").sortWithinPartitions("conv_id", "message", "stream", "seq", "__kind", "body")
    folded = sorted_log.select("conv_id", "message", "stream", "role", "kind", "body").mapInArrow(fold(most), "conv_id long, task long, part long, whole boolean, formatted string")
    return materialize(folded, "conversations")[0]


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id and formatted for each conversation of a log as of ``format_parts``: for conversations that fit one value;
    others have to stay in parts."""
    folded = format_parts(events)
    in_order = F.array_sort(F.collect_list(F.struct("task", "part", "formatted")))
    cut = folded.where("not whole").groupBy("conv_id").agg(F.array_join(F.transform(in_order, lambda x: x.formatted), "").alias("formatted"))
    return folded.where("whole").select("conv_id", "formatted").unionByName(cut)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts (conv_id, formatted), those of a conversation in a row and in order, to a row a conversation. Of a
    conversation only the part at hand and the states of two hashes are held."""
    conv, turns_hash, loss_hash, done = None, None, None, []
    n_turns = loss_chars = formatted_chars = 0
    names = [x.split()[0] for x in DIGESTS.split(", ")]

    def close() -> None:
        if turns_hash is not None:
            done.append((conv, n_turns, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), formatted_chars))

    def out() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * len(names)
        rows = [pa.array(v, pa.string() if k.endswith("256") else pa.int64()) for k, v in zip(names, columns, strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(rows, names=names)

    for batch in batches:
        for c, text in ((x.as_py(), y.as_py()) for x, y in zip(batch.column(0), batch.column(1), strict=True)):
            if turns_hash is None or c != conv:
                close()
                conv, turns_hash, loss_hash = c, hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = formatted_chars = 0
            formatted_chars += len(text)
            for role, said in turns_of(text):
                n_turns += 1
                turns_hash.update(f"{role}\n{said}\n".encode())
                if role == "assistant":
                    loss_chars += len(said)
                    loss_hash.update(said.encode())
        yield out()
    close()
    yield out()


def turn_digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations (a row each): turns, their digest, and the text under the loss
    mask, which is that of assistants."""
    return formatted.select("conv_id", "formatted").mapInArrow(digests, DIGESTS)


def part_digests(parts: DataFrame) -> DataFrame:
    """``turn_digests`` of conversations in parts. Whole ones are read where they lie; the parts of the others are sorted
    and stream through the hashes, as one after the other is the only order that SHA-256 has."""
    cut = parts.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "task", "part")
    return turn_digests(parts.where("whole")).unionByName(turn_digests(cut))
