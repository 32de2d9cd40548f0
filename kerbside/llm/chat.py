"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only
that reply is trainable. A turn is written ``### role``, a line end, the text and ``</turn>``.
Inside roles and texts a backslash goes before ``\\`` and ``#``, and into ``</``, so neither mark
can occur there; reading back removes it. Turns after the last reply, or a conversation without
any, make one example without a target, so nothing is lost.

Conversations are dealt out by id, sorted by turn and streamed: a task holds one conversation's
rendering (which is also its last example) and a bounded batch. Examples of a conversation of n
turns hold each prefix whole, which is what the method asks for.

A null text or role counts as empty, a null turn comes first, ties go by role and text; rows
repeated are turns of their own. An empty table gives no examples; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD, LINE, TAIL = "### ", "\n", " </turn>\n"
TARGET = "assistant"
BATCH_CHARS = 8 << 20
_MARKS, _BACK = re.compile(r"[\\#\n]|</"), re.compile(r"\\(.)|<\\/", re.S)


def escape(text: str, line_ends: bool = False) -> str:
    """``line_ends``: line ends are escaped too (in roles)."""
    def one(m):
        if m[0] == "</":
            return "<\\/"
        if m[0] == "\n":
            return "\\n" if line_ends else "\n"
        return "\\" + m[0]
    return _MARKS.sub(one, text)


def unescape(text: str) -> str:
    def one(m):
        return "</" if m[1] is None else "\n" if m[1] == "n" else m[1]
    return _BACK.sub(one, text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of the text in it)."""
    head = HEAD + escape(role, True) + LINE
    body = escape(text)
    return head + body + TAIL, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(HEAD, at):
            raise ValueError(f"no turn at {at}")
        line = formatted.index(LINE, at)            # a role has no bare line end
        end = formatted.index(TAIL, line)           # a text has no bare </
        out.append((unescape(formatted[at + len(HEAD):line]), unescape(formatted[line + 1:end])))
        at = end + len(TAIL)
    return out


EXAMPLES = "conv_id long, example long, target_turn long, text string, loss_start long, loss_end long"


def _ordered(df: DataFrame, *by: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *by)


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, target_turn, text, loss_start, loss_end): one row per assistant turn.

    ``example`` counts from 0. A last row without target (null turn and mask) holds the whole
    conversation if turns follow the last reply. Positions are code points.
    """
    def run(batches):
        rows, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, (
                    pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["conv_id", "example", "target_turn", "text", "loss_start", "loss_end"])

        conv, prefix, number, open_ = object(), [], 0, False
        length = 0
        for part in batches:
            for c, turn, role, text in zip(*(col.to_pylist() for col in part.columns)):
                if c != conv:
                    if open_:
                        rows.append((conv, number, None, "".join(prefix), None, None))
                        held += length
                    conv, prefix, number, length, open_ = c, [], 0, 0, False
                piece, start, end = render(role or "", text or "")
                prefix.append(piece)
                open_ = role != TARGET
                if not open_:
                    prefix = ["".join(prefix)]
                    rows.append((conv, number, turn, prefix[0], length + start, length + end))
                    number += 1
                    held += length
                length += len(piece)
                if held > BATCH_CHARS:
                    yield batch()
                    rows, held = [], 0
        if open_:
            rows.append((conv, number, None, "".join(prefix), None, None))
        yield batch()

    return _ordered(conversations.select("conv_id", "turn", "role", "text"), "turn", "role", "text").mapInArrow(
        run, EXAMPLES)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples say: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``examples`` come as ``expand`` leaves them: a conversation's together and in order. The last
    one has every turn; the masks of all give the trainable text.
    """
    def run(batches):
        conv, last, loss, chars, total, seen = None, "", hashlib.sha256(), 0, 0, False
        rows = []

        def done():
            turns = parse(last)
            whole = hashlib.sha256()
            for role, text in turns:
                whole.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            rows.append((conv, len(turns), whole.hexdigest(), chars, loss.hexdigest(), total))

        for part in batches:
            for c, _, _, text, start, end in zip(*(col.to_pylist() for col in part.columns)):
                if not seen or c != conv:
                    if seen:
                        done()
                    conv, loss, chars, total, seen = c, hashlib.sha256(), 0, 0, True
                last = text
                total += len(text)
                if start is not None:
                    reply = unescape(text[start:end])
                    chars += len(reply)
                    loss.update(reply.encode("utf-8", "surrogatepass"))
            if len(rows) > 5000:
                yield table(rows)
                rows.clear()
        if seen:
            done()
        yield table(rows)

    def table(rows):
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return examples.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")


def with_sample(conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -7, whose two turns say what the template's marks say."""
    hard = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    sample = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(sample)
