"""Chat formatting with a grammar round trip (operator 6).

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. ``parse`` is the deterministic reader of that grammar. A turn is rendered as
it is, parsed again and compared; while what comes back differs, the text's control strings get one more escape. The escape
of ``<``, any backslashes and ``|`` has one backslash more, which the reader takes away, so it is reversible at any depth.

``format_turns`` works turn by turn, so a conversation of any length is spread over tasks. ``read_back`` needs the turns of a
conversation in order; it streams over sorted partitions and holds one turn and two running digests.

Defined results: a null role or text is empty; turns are ordered by turn (null first), then role, then text, and rows
with equal turns, also repeated rows, are turns of their own; a null conv_id is a conversation of its own. An empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.store import column, slices

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose text a model learns from.
LEARNED = ("assistant",)

SEGMENTS = "conv_id long, turn long, role string, text string, segment string, loss_from int, loss_to int"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

_conflict = re.compile(r"<(\\*)\|")
_escaped = re.compile(r"<\\(\\*)\|")


def unescape(text: str) -> str:
    return _escaped.sub(r"<\1|", text)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """(role, text, where the text begins and ends in ``formatted``) of each turn; None if it isn't a run of turns."""
    turns, at = [], 0
    while at < len(formatted):
        head = formatted.find("\n", at)
        stop = formatted.find("<|", head)
        if not formatted.startswith(START, at) or head < 0 or stop < 0 or not formatted.startswith(END + "\n", stop):
            return None
        role = formatted[at + len(START):head]
        if "<|" in role:
            return None
        turns.append((_read_role(role), unescape(formatted[head + 1:stop]), head + 1, stop))
        at = stop + len(END) + 1
    return turns


def _read_role(role: str) -> str:
    return re.sub(r"\\([npl\\])", lambda m: {"n": "\n", "p": "|", "l": "<"}.get(m[1], m[1]), role)


def _write_role(role: str) -> str:
    """A role stays on its line: line ends, ``<|`` and backslashes are written with a backslash."""
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<|", "\\l\\p")


def render(role: str, text: str) -> str:
    """One turn that ``parse`` reads back as it was: first as it is, then escaped once more until the two are identical."""
    own_role, own_text = role, text
    while True:
        segment = f"{START}{own_role}\n{own_text}{END}\n"
        turns = parse(segment)
        if turns is not None and [t[:2] for t in turns] == [(role, text)]:
            return segment
        own_role = _write_role(role)
        if turns is None or len(turns) != 1 or turns[0][1] != text:
            own_text = _conflict.sub(r"<\\\1|", own_text)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        roles = [r or "" for r in column(batch, "role").to_pylist()]
        texts = [t or "" for t in column(batch, "text").to_pylist()]
        segments = [render(r, t) for r, t in zip(roles, texts)]
        spans = [parse(s)[0][2:] if r in LEARNED else (0, 0) for s, r in zip(segments, roles)]
        yield pa.RecordBatch.from_arrays(
            [column(batch, "conv_id"), column(batch, "turn"), pa.array(roles), pa.array(texts), pa.array(segments),
             pa.array([a for a, _ in spans], pa.int32()), pa.array([b for _, b in spans], pa.int32())],
            names=["conv_id", "turn", "role", "text", "segment", "loss_from", "loss_to"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn with its ``segment`` of the formatted conversation and the part of it, in code points, that is learned from.

    A conversation's formatted text is its segments in the order of (turn, role, text).
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return rows.mapInArrow(_segments, SEGMENTS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order to a row for each conversation, from what ``parse`` finds in the segments alone."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    own, n, chars, learned, whole, loss, begun = None, 0, 0, 0, None, None, False

    def done(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in slices(batches, "segment"):
        rows = []
        for conv, segment, start, stop in zip(*(column(batch, c).to_pylist() for c in (
                "conv_id", "segment", "loss_from", "loss_to"))):
            if not begun or conv != own:
                if begun:
                    rows.append((own, n, whole.hexdigest(), learned, loss.hexdigest(), chars))
                own, n, chars, learned, begun = conv, 0, 0, 0, True
                whole, loss = hashlib.sha256(), hashlib.sha256()
            for role, text, _, _ in parse(segment):
                whole.update(f"{role}\n{text}\n".encode())
                n += 1
            part = unescape(segment[start:stop])
            loss.update(part.encode())
            learned, chars = learned + len(part), chars + len(segment)
        if rows:
            yield done(rows)
    if begun:
        yield done([(own, n, whole.hexdigest(), learned, loss.hexdigest(), chars)])


def read_back(segments: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the segments and their loss spans.

    A SHA-256 runs over a conversation in order, so one task streams each conversation; formatting itself doesn't.
    """
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "segment", "loss_from", "loss_to").mapInArrow(_digests, DIGESTS)
