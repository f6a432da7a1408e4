"""Periodic runs of words in texts, and texts without their repetitions.

A run of period q and at least 4 q words holds three places of any grid of
steps of q, so also one of a grid of steps of 3 q whose word stands q further on
again: all such places of all periods are a harmonic sum, n log n.  Each is
extended to both sides by what is common from both places on, which a grammar
of the words made by recompression answers (``recompression``).  Texts are
handled some at a time, parted by marks that occur once, longest first, so that
each period looks only at texts long enough for it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, slices
from .recompression import Grammar

TIMES, LEAST = 4, 6
#: Candidates that are extended at a time.
AT_ONCE = 1 << 17

Run = tuple[int, int, int]  # start, length, period


def runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per sequence of numbers (0 or more) its runs, rows of start, length and period by start and period.

    A run is a stretch with smallest period q and ``max(LEAST, TIMES * q)`` numbers
    or more that cannot be made longer with that period.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    if not len(order) or lengths[0] < LEAST:
        return [np.zeros((0, 3), np.int64) for _ in texts]
    # Marks are negative and stand before each text and at the end.
    begins = np.cumsum(np.r_[1, lengths[:-1] + 1])
    words = np.empty(int(lengths.sum()) + len(order) + 1, np.int64)
    words[np.r_[begins - 1, len(words) - 1]] = -1 - np.arange(len(order) + 1)
    for begin, i in zip(begins, order):
        words[begin : begin + len(texts[i])] = texts[i]
    found = _all_runs(words, begins + lengths, lengths)
    of = np.searchsorted(begins, found[:, 0], "right") - 1
    found[:, 0] -= begins[of]
    out: list[np.ndarray] = [found[:0]] * len(texts)
    edges = np.searchsorted(of, np.arange(len(order) + 1))
    for k, i in enumerate(order):
        out[i] = found[edges[k] : edges[k + 1]]
    return out


def _all_runs(words: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    forward = Grammar(words)
    backward = forward.mirrored()
    n = len(words)
    # The run that reaches furthest over each place so far: its period, or 0.
    covered = np.zeros(n, np.int64)
    reach = np.zeros(n, np.int64)
    found = [np.zeros((0, 3), np.int64)]
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def extend() -> None:
        nonlocal size
        at, period = (np.concatenate(c) for c in zip(*waiting))
        waiting.clear()
        size = 0
        for lo in range(0, len(at), AT_ONCE):
            i, q = at[lo : lo + AT_ONCE], period[lo : lo + AT_ONCE]
            after = forward.common(i, i + q)
            before = backward.common(n - i, n - i - q)
            rows = np.stack([i - before, before + after + q, q], 1)
            rows = _first_of_stretch(rows[rows[:, 1] >= np.maximum(LEAST, TIMES * q)])
            found.append(rows)
            for start, length, q_ in rows.tolist():
                if length >= 8 * q_:  # only such runs hold places of a multiple of their period
                    inside = slice(start, start + length)
                    longer = reach[inside] < start + length
                    covered[inside][longer] = q_
                    reach[inside][longer] = start + length

    for q in range(1, int(lengths[0]) // TIMES + 1):
        # Texts of at least 4 q words; they stand first.
        end = int(ends[np.searchsorted(-lengths, -max(LEAST, TIMES * q), "right") - 1])
        step = 3 * q
        at = np.arange(0, end - q, step)
        at = at[words[at] == words[at + q]]
        known = covered[at]
        # Inside a known run whose period divides q nothing new can be found.
        at = at[(known == 0) | (q % np.maximum(known, 1) != 0) | (reach[at] <= at + q)]
        if len(at):
            waiting.append((at, np.full(len(at), q)))
            size += len(at)
        if size and (size >= AT_ONCE or q & (q - 1) == 0):
            extend()
    if size:
        extend()
    rows = _first_of_stretch(np.concatenate(found))
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _first_of_stretch(rows: np.ndarray) -> np.ndarray:
    """One row per stretch, that of its smallest period."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    if not len(rows):
        return rows
    return rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]]


def best(found: np.ndarray) -> Run | None:
    """The run of the greatest length / period, ties to the smallest start, then period."""
    top = None
    for start, length, period in found.tolist():
        if top is None or length * top[2] > top[1] * period:
            top = (start, length, period)
    return top


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """The words that no run holds behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


def repeated(n: int, key: int) -> np.ndarray | None:
    """The places of a text of ``n`` words that is made periodic by ``key``; None if it stays as it is."""
    if key % 10 or not n:
        return None
    g = key // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


_COLUMNS = {
    "doc_id": pa.int64(), "n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(),
    "exponent_milli": pa.int64(), "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
}
_SCHEMA = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _COLUMNS.items())


def _read(batch: pa.RecordBatch, planted: bool) -> Iterator[tuple[int | None, list[bytes], np.ndarray]]:
    """Per row its id, its words and their numbers; equal words of a batch have equal numbers."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        places = None
        if planted and doc_id is not None:
            places = repeated(len(words), zlib.crc32(str(doc_id).encode()))
        if places is not None:
            words = [words[i] for i in places.tolist()]
        yield doc_id, words, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def _digested(planted: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = list(_read(part, planted))
                out = []
                for (doc_id, words, _), found in zip(texts, runs([numbers for *_, numbers in texts])):
                    top = best(found)
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
                    left = [words[i] for i in kept_words(len(words), found).tolist()] if len(found) else words
                    digests = [hashlib.sha256(b).hexdigest() for b in (listed.encode(), b" ".join(left))]
                    out.append((doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], *digests))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), _COLUMNS.values())], list(_COLUMNS))

    return rows


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = list(_read(part, False))
            out = []
            for (doc_id, words, _), found, text in zip(texts, runs([t[2] for t in texts]), part.column("text").to_pylist()):
                if len(found):
                    text = b" ".join(words[i] for i in kept_words(len(words), found).tolist()).decode("utf-8", "surrogatepass")
                out.append((doc_id, text, [dict(zip(("start", "length", "period"), r)) for r in found.tolist()]))
            kinds = [pa.int64(), pa.string(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["doc_id", "text", "runs"])


def run_digests(docs: DataFrame, planted: bool = False) -> DataFrame:
    """Per row of ``docs (doc_id, text)``: the number of runs, the most repeated one, and digests of all runs and of the text without them.

    Words are parted by ASCII white space.  A run is at least four periods and
    six words long; of the runs of greatest length / period that of the smallest
    start counts, then of the smallest period.  ``planted`` first makes a tenth of
    the texts periodic, chosen by the checksum of their ``doc_id``; rows without
    one stay as they are.  A null or empty text has no words and no runs: nulls,
    and digests of nothing.  Repeated rows each get a row; no rows give no rows;
    other columns are not read.  Memory holds about 1 MB of texts at a time, or
    one longer text.
    """
    return map_arrow(docs.select("doc_id", "text"), _digested(planted), _SCHEMA)


def collapsed(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text with every run cut to its first period, and the list of runs.

    A text without runs stays as it is, a null one stays null; in others the words
    that are left are joined by single spaces.
    """
    return map_arrow(
        docs.select("doc_id", "text"), _collapsed, "doc_id long, text string, runs array<struct<start:long,length:long,period:long>>"
    )
