"""Chat formatting on the level of tokens.

A turn is rendered as ``### role:``, a line feed, the text, ``</turn>`` and a line feed. In ids the
three control strings are reserved ids beyond the tokenizer's, so no text can imitate them: role and
text are encoded separately and spliced between them. Control strings within a text are still
escaped with a backslash (as are the backslash and every ``#``), so that the rendered form can be read back too. The
loss mask is 1 over the ids of the assistant's texts: marks of +1 and -1 at their ends, summed up.

Encoding, the heavy part, runs on single rows wherever they are; only finished turns are put in
order. A conversation is passed through as a stream of turns, never held whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from osm_tables.llm.packing import byte_bpe

OPEN, COLON, CLOSE = "### ", ":\n", "</turn>\n"
_TEXT = re.compile(r"[\\#]|</turn>")
_ROLE = re.compile(r"[\\#:]|</turn>")
_ESCAPED = re.compile(r"(?s)\\(.)")
SPEAKER = "assistant"
_TURNS = "conv_id bigint, place bigint, start bigint, ids array<int>, loss array<boolean>"


def escape(text: str, pattern=_TEXT) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Turns in order: conv_id, place in the conversation, ids before it, its ids and their loss mask.

    ``rows`` has conv_id, turn, role and text; other columns are not read. Null roles and texts are
    empty; a null conv_id is a conversation of its own. Turns with one number are ordered by role,
    then text; repeated rows are turns of their own. Reserved ids follow the tokenizer's last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        open_, colon, close = reserved(bpe)
        for batch in batches:
            for part in (batch.slice(i, 2_000) for i in range(0, batch.num_rows, 2_000)):
                roles, texts = (part.column(c).to_pylist() for c in ("role", "text"))
                heads = [bpe.encode_ordinary(escape(x or "", _ROLE)) for x in roles]
                bodies = [bpe.encode_ordinary(escape(x or "")) for x in texts]
                turns = [np.array([open_, *h, colon, *b, close], np.int32) for h, b in zip(heads, bodies)]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in turns])))
                ids = np.concatenate([np.zeros(0, np.int32), *turns])
                marks = np.zeros(len(ids) + 1, np.int64)
                speaks = np.array([x == SPEAKER for x in roles])
                np.add.at(marks, ends[:-1][speaks] + np.array([len(h) + 2 for h in heads], np.int64)[speaks], 1)
                np.add.at(marks, ends[1:][speaks] - 1, -1)
                loss = np.cumsum(marks[:-1]) > 0
                at = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(name) for name in ("conv_id", "turn", "role", "text_id")],
                        pa.ListArray.from_arrays(at, pa.array(ids)),
                        pa.ListArray.from_arrays(at, pa.array(loss)),
                    ],
                    ["conv_id", "turn", "role", "text_id", "ids", "loss"],
                )

    # Equal numbers and roles are told apart by the text itself, which the ids stand for.
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text_id"), "text")
    turns = rows.mapInArrow(run, "conv_id bigint, turn bigint, role string, text_id string, ids array<int>, loss array<boolean>")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text_id")
    before = F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.repartition("conv_id").withColumns({"place": F.row_number().over(order).cast("bigint") - 1, "start": F.coalesce(before, F.lit(0))})
    return turns.select("conv_id", "place", "start", "ids", "loss")


def reserved(bpe) -> tuple[int, int, int]:
    first = bpe.max_token_value + 2  # one more is the file's own end of text
    return first, first + 1, first + 2


def read_back(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation, from ids and masks alone: its turns and its masked text, as digests.

    ``turns_sha256`` is of role, line feed, text, line feed of each turn; ``loss_sha256`` of all
    text under the mask; ``formatted_chars`` is the length of the rendered form.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        open_, colon, close = reserved(bpe)
        text = lambda ids: bpe.decode_bytes(ids).decode("utf-8")
        state, done = None, []

        def finished():
            conv, n, turns_, chars, loss, formatted = state
            return conv, n, turns_.hexdigest(), chars, loss.hexdigest(), formatted

        for batch in batches:
            for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        done.append(finished())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if ids[0] != open_ or ids[-1] != close:
                    raise ValueError(f"conversation {conv}: a turn lacks its ends")
                middle = ids.index(colon)
                role, body = text(ids[1:middle]), text(ids[middle + 1 : -1])
                learned = unescape(text([i for i, m in zip(ids, mask) if m]))
                state[1] += 1
                state[2].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += len(OPEN) + len(role) + len(COLON) + len(body) + len(CLOSE)
            if done:
                yield _digests(done)
                done = []
        if state is not None:
            yield _digests([finished()])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "ids", "loss")
    return ordered.mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def _digests(rows) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)
