"""Chat formatting with offset-aligned loss masks.

Turns are rendered between control strings; a control string inside a text is escaped reversibly. A
rendered run of turns is encoded once with character offsets; the sorted spans of the assistant texts
are then met with the sorted token spans by binary search, which gives each token its mask.

Conversations are split over tasks by ranges of (conversation, turn), so one of any length is rendered
and encoded by many tasks, in parts of whole turns. A control string always ends a token, so
the parts' tokens are the conversation's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: A part is closed at the first turn end beyond so many characters.
PART_CHARS = 1 << 18
#: Characters of role and text that decide where ranges of turns begin.
_PREFIX = 32

_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MIDDLE) + "(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    """No control string can stand in the result: every ``<|`` gets one backslash more between its signs."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns, and the (begin, end) of each assistant text in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{START}{escape(role)}{MIDDLE}"
        body = escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that ``render`` was given."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def mask_tokens(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (rows of begin, end) lie inside one of the sorted, disjoint spans."""
    if not spans or not len(offsets):
        return np.zeros(len(offsets), bool)
    begin, end = np.array(spans).T
    k = np.searchsorted(begin, offsets[:, 0], "right") - 1
    return (k >= 0) & (offsets[:, 1] <= end[k]) & (offsets[:, 1] > offsets[:, 0])


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text under the mask, one piece for each run of characters; tokens may share a character."""
    if not mask.any():
        return []
    begin, end = offsets[mask].T
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(begin[1:] > reach[:-1]) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(begin)])) - 1
    return [formatted[a:z] for a, z in zip(begin[first], reach[last])]


def encoder(vocabulary: str):
    """The vocabulary's encoder with the control strings as tokens of their own."""
    from tokenizers import AddedToken, Tokenizer

    encode = Tokenizer.from_str(vocabulary)
    encode.add_special_tokens([AddedToken(s, normalized=False) for s in (START, MIDDLE, END)])
    return encode


def _parts(vocabulary: str, kind: pa.DataType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        conv, place, turns, size = None, None, [], 0

        def part() -> pa.RecordBatch:
            text, spans = render(turns)
            made = encode.encode(text, add_special_tokens=False)
            offsets = np.array(made.offsets, np.int64).reshape(-1, 2)
            mask = mask_tokens(offsets, spans)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv], kind),
                    pa.array([place], pa.int64()),
                    pa.array([len(turns)], pa.int64()),
                    pa.array([text]),
                    pa.array([made.ids], pa.list_(pa.int32())),
                    pa.array([mask.tolist()], pa.list_(pa.bool_())),
                    pa.array([masked_text(text, offsets, mask)], pa.list_(pa.string())),
                ],
                names=["conv_id", "place", "n_turns", "formatted", "token_ids", "loss_mask", "loss_texts"],
            )

        for batch in batches:
            for c, at, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "place", "role", "text"))):
                if turns and (c != conv or size >= PART_CHARS):
                    yield part()
                    turns, size = [], 0
                if not turns:
                    conv, place = c, at
                turns.append((role or "", text or ""))
                size += len(text or "")
        if turns:
            yield part()

    return rows


def format_conversations(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """conv_id, place, n_turns, formatted, token_ids, loss_mask, loss_texts: parts of conversations.

    ``place`` orders the parts of a conversation. ``loss_texts`` holds what the masked tokens cover (still
    escaped). Turns are ordered by turn (null first), then role and text. Null roles and texts are
    empty, repeated rows are turns of their own, rows without conv_id are one conversation without id; ids keep their type.
    Other columns are not read. An empty table gives no rows.
    """
    with open(vocabulary, encoding="utf-8") as file:
        text = file.read()
    slim = turns.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    order = ["conv_id", "turn", "role", "text"]
    # What fixes the ranges reaches the driver: prefixes that sort like the whole, never whole texts.
    more = F.char_length("role") > _PREFIX
    prefixes = (F.substring("role", 1, _PREFIX), more, F.when(~more, F.substring("text", 1, _PREFIX)))
    ranged = slim.repartitionByRange("conv_id", "turn", *prefixes).sortWithinPartitions(*order)
    kind = slim.schema["conv_id"].dataType
    return ranged.select("conv_id", "role", "text", F.monotonically_increasing_id().alias("place")).mapInArrow(
        _parts(text, to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, place long, n_turns long, formatted string, token_ids array<int>, loss_mask array<boolean>, loss_texts array<string>",
    )


def _digest(kind: pa.DataType):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def row() -> pa.RecordBatch:
            n, turns, chars, loss, size = state
            values = [[conv], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [size]]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for c, formatted, loss in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_texts"))):
                if state is not None and c != conv:
                    yield row()
                    state = None
                if state is None:
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                for text in map(unescape, loss):
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(formatted)
        if state is not None:
            yield row()

    return run


def digests(parts: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its parts in order.

    The digest of a conversation runs over its parts one after the other (a hash cannot be split); its
    task holds one part at a time."""
    slim = parts.select("conv_id", "place", "formatted", "loss_texts").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    kind = slim.schema["conv_id"].dataType
    return slim.mapInArrow(
        _digest(to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
