"""Chat formatting with a template that is only ever called, never looked into.

A template is a function from turns to text.  Successive prefixes of a
conversation are rendered; if each output continues the one before it (up to a
constant ending), what was added is the new turn's span.  If not, the template
rewrites history and no span is trusted.  Inside its span a turn's text is
found by rendering the last turn with two one-letter texts: the outputs differ
first where the text begins, and what follows that letter is what closes a turn.

All prefixes are rendered from the start, whatever the length; of the outputs only
the last two are held.  A conversation is held as a whole, as its template takes
it, and takes time with the square of its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, runs

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

BLOCK = 16


# --- the template -----------------------------------------------------------

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    """Without control strings: every ``<|`` is broken by a backslash, backslashes are doubled."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def marked_turns(turns: list[Turn]) -> str:
    """The template of the query: marked turns, roles and texts escaped; a role also loses its line ends."""
    return "".join(
        f"{START}{escape(role)}\n{escape(text)}{END}\n".replace("\n", "\\n", role.count("\n")) for role, text in turns
    )


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def read_turns(formatted: str) -> list[Turn]:
    """The turns of whole marked turns."""
    return [
        (re.sub(r"\\(.)", lambda c: "\n" if c[1] == "n" else c[1], m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)
    ]


# --- the black box ----------------------------------------------------------


class Rewrites(Exception):
    """The template changes what it said about earlier turns."""


def _common(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def _common_end(texts: list[str]) -> str:
    end = texts[0][::-1]
    for text in texts[1:]:
        end = end[: _common(end, text[::-1][: len(end)])]
    return end[::-1]


def located(template: Template, turns: list[Turn]):
    """The whole output but its ending, per turn the span of all of it and of its text, and the constant ending."""
    out = template([])
    lengths, cut, ending = [len(out)], 0, out
    for k in range(1, len(turns) + 1):
        last, out = out, template(turns[:k])
        cut = max(cut, len(last) - _common(last, out))
        ending = _common_end([ending, out[max(len(out) - len(ending), 0) :]])
        lengths.append(len(out))
    # What every output ends with, the empty one too; nothing if outputs simply grow.
    if not cut:
        ending = ""
    if len(ending) < cut or any(b < a for a, b in zip(lengths, lengths[1:])):
        raise Rewrites
    bodies = [n - len(ending) for n in lengths]
    spans, texts = [], []
    for k, (role, _) in enumerate(turns):
        one, other = (template([*turns[:k], (role, letter)]) for letter in "AB")
        start = _common(one, other)
        if start < bodies[k] or len(one) != len(other):
            raise Rewrites
        spans.append((bodies[k], bodies[k + 1]))
        texts.append((start, lengths[k + 1] - (len(one) - start - 1)))
    return out[: bodies[-1]], spans, texts, ending


Block = tuple[str, list[tuple[int, int]], int]


def formatted_blocks(template: Template, turns: Iterator[Turn]) -> Iterator[Block]:
    """A conversation's output in blocks, all of it rendered from the start: text, spans of the assistant's texts in it, number of turns."""
    said = list(turns)
    text, spans, texts, ending = located(template, said)
    for lo in range(0, len(said), BLOCK):
        hi = min(lo + BLOCK, len(said))
        begin, end = spans[lo][0] if lo else 0, spans[hi - 1][1]
        loss = [(s - begin, e - begin) for (s, e), (role, _) in zip(texts[lo:hi], said[lo:hi]) if role == "assistant"]
        yield text[begin:end] + (ending if hi == len(said) else ""), loss, hi - lo


_BLOCKS = "conv_id long, block int, n_turns int, formatted string, loss array<struct<start:long,end:long>>, rewrites boolean"
_BLOCKS_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int32()), ("n_turns", pa.int32()), ("formatted", pa.string())]
    + [("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("rewrites", pa.bool_())]
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, most)):
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _formatter(template: Template):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv_id,), turns in runs(batches, ["conv_id"]):
            pairs = ((t["role"], t["text"]) for t in turns)
            block = 0
            try:
                for block, (text, loss, n) in enumerate(formatted_blocks(template, pairs)):
                    yield conv_id, block, n, text, [{"start": s, "end": e} for s, e in loss], False
            except Rewrites:
                yield conv_id, block + 1, 0, None, None, True

    return lambda batches: _batches(rows(batches), _BLOCKS_ARROW)


def formatted(conversations: DataFrame, template: Template = marked_turns) -> DataFrame:
    """Blocks of formatted text per conversation, with the spans of the assistant's texts under the loss.

    Turns are ordered by ``turn``, ties by role and text; repeated rows are
    turns of their own; a null role or text is empty; rows without ``conv_id``
    are one conversation.  The blocks of a conversation, joined in order, are
    the whole output; spans count from the block's start.  Where the template
    rewrites history, a row with ``rewrites`` and no text follows the blocks
    that were certain.  Every prefix is rendered as it is.  Other columns are not read; no rows give no rows.
    """
    empty = F.lit("")
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(ordered, _formatter(template), _BLOCKS)


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"
)
_DIGEST_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
    + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites", pa.bool_())]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for (conv_id,), blocks in runs(batches, ["conv_id"]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            rewrites = False
            for block in blocks:
                if block["rewrites"]:
                    rewrites = True
                    continue
                text = block["formatted"]
                chars += len(text)
                for role, said in read_turns(text):
                    n += 1
                    turns.update(f"{role}\n{said}\n".encode())
                for span in block["loss"]:
                    said = unescape(text[span["start"] : span["end"]])
                    loss_chars += len(said)
                    loss.update(said.encode())
            yield conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, rewrites

    return _batches(rows(), _DIGEST_ARROW)


def digests(blocks: DataFrame) -> DataFrame:
    """What can be read back from the marked turns of ``formatted()``, a row per conversation.

    ``blocks`` is in the order in which ``formatted()`` gives it; read a stored
    copy through ``repartition("conv_id").sortWithinPartitions("conv_id", "block")``.
    A conversation's digest is one pass over its text in order; memory holds a block.
    """
    return map_arrow(blocks, _digests, _DIGEST)
