"""Packing of token sequences into as few full-length sequences as possible.

Documents are tokenized once; only (document, piece, length) rows go on.  The
histogram of lengths has at most ``capacity`` rows whatever the corpus' size.
On it the configuration linear program (a configuration is a multiset of
lengths that fits one sequence) is solved by multiplicative weights: lengths
far from covered get dear, a dynamic program over the capacity finds the
configurations of the greatest price, and these get a small share of the
lengths they use.  The solution is rounded down, and what that leaves, about
one sequence per configuration, is packed best fit.  The result says for each
length which ranks go to which run of sequences; pieces are ranked within
their length in a distributed way and look their place up.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_arrow, slices, stored
from .tokens import plain_word, tokenizer

CAPACITY = 2048
#: Pricing rounds of the linear program, share of a length covered per round, slack of a column's price.
ROUNDS, STEP, SLACK, STEEP = 150, 0.1, 0.05, 8.0
#: Pieces of one length are ranked in so many parts.
PARTS = 256
#: Texts are tokenized together up to so many bytes; a longer one in parts of so many characters.
TOGETHER = 1 << 22
#: Bytes of remembered words and their ids, of each of two kinds; words whose ids are put together at a time.
KNOWN, STRETCHES = 1 << 23, 1 << 16
#: Letters as in ``tokens.LETTERS``, and marks that are a pre-token of their own behind them.
_LETTERS_AND_MARKS = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,!?;:$%&*#]{0,8})$"


# --- pieces -----------------------------------------------------------------


class _Known:
    """Ids of words, packed into arrays; keeps the last call's words only where all would take more than ``KNOWN`` bytes."""

    def __init__(self, make: Callable[[list[str]], Iterable[list[int]]]):
        self.make, self.words = make, pa.array([], pa.large_string())
        self.ids, self.ends = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``words``, one after the other, and where each begins and ends; ``make`` gets lists of new words."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at)).unique()
        if len(new):
            ids, sizes = [], []
            for start in range(0, len(new), 1000):
                found = self.make(new.slice(start, 1000).to_pylist())
                sizes += map(len, found)
                ids.append(np.fromiter(chain.from_iterable(found), "<u4"))
            if self.words.nbytes + new.nbytes + self.ids.nbytes + self.ends.nbytes > KNOWN:
                used = at.drop_null().unique()
                self.words = self.words.take(used)
                self.ids, self.ends = _gathered(self.ids, self.ends, used.to_numpy())
            self.words = pa.concat_arrays([self.words, new])
            self.ids, self.ends = np.concatenate([self.ids, *ids]), np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
            at = pc.index_in(words, value_set=self.words)
        return _gathered(self.ids, self.ends, at.to_numpy())


@cache
def _known(path: str) -> tuple[_Known, _Known]:
    """Ids of words of letters in lower case, by the library's model alone, and of all other words."""
    encode, plain = tokenizer(path).encode_batch_fast, plain_word(path)
    return _Known(lambda words: list(map(plain, words))), _Known(lambda words: [e.ids for e in encode(words, add_special_tokens=False)])


def _gathered(pool: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``which`` of ``pool`` (k begins and ends at ``ends[k]`` and the next) one after the other, and where each begins and ends.

    Some stretches at a time, as the numbers of their places take more room than the ids.
    """
    sizes, out_ends = np.diff(ends), np.zeros(len(which) + 1, np.int64)
    np.cumsum(sizes[which], out=out_ends[1:])
    out = np.empty(out_ends[-1], pool.dtype)
    for start in range(0, len(which), STRETCHES):
        some, to = which[start : start + STRETCHES], out_ends[start : start + STRETCHES + 1]
        out[to[0] : to[-1]] = pool[np.repeat(ends[some] - to[:-1], sizes[some]) + np.arange(to[0], to[-1])]
    return out, out_ends


def _word_ids(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, one after the other, and where each begins and ends.

    Words that differ by capitals or by the marks behind them share their
    letters' ids; marks never merge with letters.
    """
    cores, others = _known(path)
    parted = pc.extract_regex(words, _LETTERS_AND_MARKS)
    letters = pc.utf8_lower(pc.struct_field(parted, "letters")).dictionary_encode()
    marks = pc.struct_field(parted, "marks").dictionary_encode()
    plain = pc.is_valid(parted)
    rest = words.filter(pc.invert(plain))
    plain = plain.to_numpy(zero_copy_only=False)
    # Each word is two pieces: letters and marks, or itself and nothing.
    n, m = len(letters.dictionary), len(marks.dictionary)
    (core_ids, core_ends), (ids, ends) = cores.of(letters.dictionary), others.of(pa.concat_arrays([marks.dictionary, rest]))
    pool = np.concatenate([core_ids, ids])
    ends = np.concatenate([core_ends, len(core_ids) + ends[1:], [len(pool)]])
    which = np.full((len(words), 2), len(ends) - 2)
    which[plain, 0] = letters.indices.drop_null().to_numpy()
    which[plain, 1] = n + marks.indices.drop_null().to_numpy()
    which[~plain, 0] = n + m + np.arange(len(rest))
    ids, ends = _gathered(pool, ends, which.ravel())
    return ids, ends[::2]


def all_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts under a tokenizer that drops white space, one after the other, and where each text's begin and end.

    Such a tokenizer treats what stands between spaces or line ends on its own:
    normal forms, pre-tokens and special strings never reach across them.  So
    the words of all texts are numbered, each distinct one is looked up once,
    and the ids are put together by number.  A null text is empty.
    """
    spaced = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
    lists = pc.split_pattern(spaced, " ")
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words = lists.flatten().dictionary_encode()
    del spaced, lists  # as large as the texts
    ids, ends = _gathered(*_word_ids(words.dictionary, path), words.indices.to_numpy())
    return ids, ends[offsets]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of one text; a long one is worked on in parts that end between words."""
    parts = [all_ids(pa.array([part]), path)[0] for part in _parts(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _parts(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > TOGETHER:
        found = [i for i in (text.find(c, start + TOGETHER) for c in " \n") if i >= 0]
        if not found:
            break
        yield text[start : min(found)]
        start = min(found)
    yield text[start:]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TOGETHER):
                rows = []
                if part.num_rows == 1:
                    found = token_ids(part.column("text")[0].as_py() or "", path)
                    ends = np.array([0, len(found)])
                else:
                    found, ends = all_ids(part.column("text"), path)
                for doc_id, begin, end in zip(part.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
                    ids = np.append(found[begin:end], np.uint32(0)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        raw = ids[start : start + capacity].tobytes()
                        row = (doc_id, piece, start, len(raw) // 4, zlib.crc32(raw), raw)
                        rows.append(row[: len(names)])
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return cut


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's ids and a closing id 0, in pieces of at most ``capacity``.

    Pieces but a document's last are full.  A null text is empty: one piece of
    one id.  Rows that repeat or lack a ``doc_id`` are documents of their own.
    ``with_ids`` adds the ids as little-endian 32-bit integers.
    """
    schema = _PIECE + (", ids binary" if with_ids else "")
    return map_arrow(docs.select("doc_id", "text"), _cut(path, capacity, with_ids), schema)


# --- the program over the histogram -----------------------------------------

Configuration = tuple[tuple[int, int], ...]  # (length, how many), longest first


def _best_fill(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest price of items within each capacity, and the last item taken (-1: none)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room], last[room] = best[room - 1], -1
        if k := fits[room]:
            values = prices[:k] + best[room - lengths[:k]]
            i = int(values.argmax())
            if values[i] > best[room]:
                best[room], last[room] = values[i], i
    return best, last


def _read_back(room: int, lengths: np.ndarray, last: np.ndarray) -> Counter:
    taken: Counter = Counter()
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            taken[int(last[room])] += 1
            room -= int(lengths[last[room]])
    return taken


def fractional(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> dict[tuple, float]:
    """A near-optimal fractional cover: how often to use each configuration (items by index).

    A price is ``exp(-STEEP * covered share)`` per share of the demand; covered
    lengths are free.  Per round, the best configuration with each length in it
    is used if its price is within ``SLACK`` of the best one's; no length gains
    more than ``STEP`` of its demand in a round.
    """
    covered, use = np.zeros(len(lengths)), defaultdict(float)
    for _ in range(ROUNDS):
        open_ = covered < 1 - 1e-9
        if not open_.any():
            break
        # The small reward for room used keeps configurations full.
        prices = np.where(open_, np.exp(-STEEP * covered) * lengths / capacity, 0.0)
        best, last = _best_fill(lengths, prices, capacity)
        worth = prices + best[capacity - lengths]
        columns = set()
        for i in np.flatnonzero(open_ & (worth >= (1 - SLACK) * best[capacity])):
            taken = _read_back(capacity - int(lengths[i]), lengths, last)
            taken[int(i)] += 1
            columns.add(tuple(sorted(taken.items())))
        shared = Counter(i for c in columns for i, _ in c)
        gained = np.zeros(len(lengths))
        for c in columns:
            times = min(min(STEP, 1 - covered[i]) * demand[i] / (k * shared[i]) for i, k in c if open_[i])
            use[c] += times
            for i, k in c:
                gained[i] += times * k / demand[i]
        covered += gained
    return use


def _best_fit(left: dict[int, int], capacity: int) -> Counter:
    """Best fit, longest first, over equal items and equal sequences at once."""
    open_: dict[int, Counter] = defaultdict(Counter)  # room left: configurations
    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            room = min((r for r, group in open_.items() if r >= length and group), default=capacity)
            each = room // length
            if room == capacity:
                made, config = max(1, todo // each), ()
            else:
                config, there = next(iter(open_[room].items()))
                made = min(there, max(1, todo // each))
                open_[room][config] -= made
                if not open_[room][config]:
                    del open_[room][config]
            k = min(each, todo)
            open_[room - k * length][config + ((length, k),)] += made
            todo -= made * k
    return sum(open_.values(), Counter())


def configurations(histogram: dict[int, int], capacity: int = CAPACITY) -> Counter:
    """How many sequences of each configuration hold exactly the pieces of ``histogram``."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return Counter()
    demand = np.array([histogram[int(n)] for n in lengths], dtype=np.float64)
    left, out = dict(histogram), Counter()
    for column, times in sorted(fractional(lengths, demand, capacity).items(), key=lambda x: (-x[1], x[0])):
        config = tuple((int(lengths[i]), k) for i, k in sorted(column, reverse=True))
        whole = min(int(times + 1e-9), *(left[n] // k for n, k in config))
        if whole:
            out[config] += whole
            for n, k in config:
                left[n] -= whole * k
    return out + _best_fit({n: k for n, k in left.items() if k}, capacity)


# --- places -----------------------------------------------------------------


def _places(chosen: Counter) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces per sequence, first offset) of each run."""
    ranks, sequence, rows = Counter(), 0, []
    for config, times in sorted(chosen.items()):
        offset = 0
        for length, k in config:
            rows.append((length, ranks[length], sequence, k, offset))
            ranks[length] += times * k
            offset += k * length
        sequence += times
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``: whole pieces, gapless from 0 in each sequence.

    ``cut`` must be stored, as it is read more than once; its columns pass
    through, and its own columns of those two names are replaced.  No pieces
    give no rows.
    """
    spark, cut = cut.sparkSession, cut.drop("sequence_id", "offset")
    histogram = {int(r["length"]): r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(configurations(histogram, capacity)) or [(0, 0, 0, 1, 0)]
    # From Arrow: plain rows would go through more Python workers, beside those that made the pieces.
    table = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*places)], ["length", "first", "sequence", "per", "at"]))
    runs = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "per", "at"))).alias("_runs"))

    order = ["doc_id", "piece", "start", "ids_crc32"]
    dealt = cut.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(PARTS)).cast("int"))
    counts = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    ahead = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    place = F.row_number().over(W.partitionBy("length", "_part").orderBy(*order)) - 1
    ranked = dealt.withColumn("_place", place).join(ahead, ["length", "_part"])
    # At most a run per length and configuration: bounded by the capacity, not by the corpus.
    found = ranked.join(F.broadcast(runs), "length").withColumn("_rank", F.col("_ahead") + F.col("_place"))
    found = found.withColumn("_run", F.element_at(F.filter("_runs", lambda r: r["first"] <= F.col("_rank")), -1))
    nth = F.col("_rank") - F.col("_run.first")
    in_sequence = F.pmod(nth, F.col("_run.per"))
    return found.select(
        *cut.columns,
        (F.col("_run.sequence") + ((nth - in_sequence) / F.col("_run.per")).cast("long")).alias("sequence_id"),
        (F.col("_run.at") + in_sequence * F.col("length")).alias("offset"),
    )


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``docs`` with their places."""
    return pack(stored(pieces(docs, path, capacity), "pieces"), capacity)
