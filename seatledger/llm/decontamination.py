"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Documents are read in overlapping passages.  A passage is a TF-IDF vector over
the words of the benchmark: other words can neither match an item nor change
which item is nearest.  Counts behind the weights are taken over all passages.
A randomised singular value decomposition of the matrix of all passages gives a
latent space (over disjoint passages): each task multiplies its passages with one random matrix and back,
the small products are added up, and a Nystroem step on the sums yields the
directions.  Passages and items whose projections have a cosine of ``COSINE`` or
more are candidates.  So is each place where a run of ``RUN`` words of an item
stands, whatever its words weigh: an item that is copied so often that its own
words are frequent is found like any other.  A candidate is checked in the text
itself: the longest common subsequence of words must cover most of the item, and
of its answer, the item's last sentence.

The text is read once: what stays of it are the places of the benchmark's words,
which the three steps (counts, products, search) read from the shared folder.
Words outside the benchmark match nothing, so the common subsequence needs no
more either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, stored
from .words import mix, word_hashes

#: Words of a passage and from one passage to the next.
PASSAGE, STRIDE = 48, 24
RANK = 128
#: A candidate's cosine in latent space, and the share of the item's TF-IDF vector that the passage must hold.
COSINE, PART = 0.25, 0.15
#: Share of an item's words, and of its answer's, that the common subsequence covers.
COVER, ANSWER = 0.6, 0.5
#: Items with fewer words are not looked for: any text may hold them.
MIN_WORDS = 5
#: Equal words in a row that make a candidate; no item is shorter.
RUN = MIN_WORDS
#: Items of one search; a larger benchmark is searched in blocks.
BLOCK = 5000


@dataclass
class Items:
    """A block of the benchmark, with its words as numbers."""

    ids: list[int]
    words: list[np.ndarray]  # hashes
    answers: list[int]  # words from here on are the answer
    terms: np.ndarray  # sorted distinct hashes

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        words = word_hashes([text for _, text in rows])
        heads = word_hashes([_question(text) for _, text in rows])
        kept = [i for i, w in enumerate(words) if len(w) >= MIN_WORDS]
        chosen = [words[i] for i in kept]
        terms = np.unique(np.concatenate(chosen)) if chosen else np.empty(0, np.uint64)
        return cls([rows[i][0] for i in kept], chosen, [len(heads[i]) for i in kept], terms)


def _question(text: str) -> str:
    """The item without its last sentence; all of a one-sentence item is its answer."""
    body = text.rstrip().rstrip(".?!")
    ends = [m.end() for m in re.finditer(r"[.?!\n]", body)]
    return body[: ends[-1]] if ends else ""


def _passages(lengths: np.ndarray, stride: int) -> np.ndarray:
    """The passages of texts of so many words; the last one of each reaches the end."""
    return np.maximum(-(-(lengths - PASSAGE) // stride), 0) + 1


@dataclass
class Hits:
    """The benchmark's words in some texts: words per text; per hit its text, place and term."""

    lengths: np.ndarray
    text: np.ndarray
    place: np.ndarray
    term: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray], terms: np.ndarray) -> Hits:
        lengths = np.array([len(w) for w in texts], np.int64)
        if not len(terms) or not lengths.sum():
            return cls(lengths, *[np.empty(0, np.int64)] * 3)
        words = np.concatenate(texts)
        at = np.searchsorted(terms, words)
        at[at == len(terms)] = 0
        hits = np.flatnonzero(terms[at] == words)
        text = np.repeat(np.arange(len(texts)), lengths)[hits]
        return cls(lengths, text, hits - (np.cumsum(lengths) - lengths)[text], at[hits])

    @classmethod
    def read(cls, batch: pa.RecordBatch) -> Hits:
        place, term = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<i4").astype(np.int64) for c in ("place", "term"))
        sizes = [n // 4 for n in pc.binary_length(batch.column("place")).to_pylist()]
        return cls(np.array(batch.column("words").to_pylist(), np.int64), np.repeat(np.arange(len(sizes)), sizes), place, term)

    def vectors(self, count: int, stride: int):
        """(passage, term, count) sorted, passages numbered through, and each text's first passage; terms are below ``count``."""
        many = _passages(self.lengths, stride)
        offsets = np.concatenate([[0], np.cumsum(many)])
        text, place, term = self.text, self.place, self.term
        # A word lies in the passages that begin up to PASSAGE - 1 words before it.
        first = np.maximum(-(-(place - PASSAGE + 1) // stride), 0)
        reps = np.minimum(place // stride, many[text] - 1) - first + 1
        passage = np.repeat(offsets[text] + first, reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        key, counts = np.unique(passage * count + np.repeat(term, reps), return_counts=True)
        return key // count, key % count, counts, offsets

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs of ``RUN`` words in a row, as hashes, and the hit each begins with."""
        ends = np.arange(RUN - 1, len(self.term))
        first = ends - RUN + 1
        whole = (self.text[ends] == self.text[first]) & (self.place[ends] - self.place[first] == RUN - 1)
        first = first[whole]
        run = np.zeros(len(first), np.uint64)
        for k in range(RUN):
            run = mix(run * np.uint64(3) + self.term[first + k].astype(np.uint64) + np.uint64(1))
        return run, first


_HITS = "doc_id long, text_hash long, words int, place binary, term binary"


def _found(terms: np.ndarray):
    names = ["doc_id", "text_hash", "words", "place", "term"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hits = Hits.of(word_hashes([t or "" for t in part.column("text").to_pylist()]), terms)
                cuts = np.searchsorted(hits.text, np.arange(1, part.num_rows))
                raw = [[x.astype("<i4").tobytes() for x in np.split(y, cuts)] for y in (hits.place, hits.term)]
                columns = [part.column("doc_id"), part.column("text_hash"), pa.array(hits.lengths, pa.int32())]
                yield pa.record_batch([*columns, *[pa.array(r, pa.binary()) for r in raw]], names)

    return find


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Hits]]:
    for batch in batches:
        for part in slices(batch, "place", 1 << 18):
            yield part, Hits.read(part)


def _counted(count: int):
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, passages = np.zeros(count, np.int64), 0
        for _, hits in _read(batches):
            _, term, _, offsets = hits.vectors(count, PASSAGE)
            seen += np.bincount(term, minlength=count)
            passages += int(offsets[-1])
        used = np.flatnonzero(seen)
        rows = [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(seen[used], passages), pa.int64())]
        yield pa.record_batch(rows, ["term", "n"])

    return tally


def term_weights(hits: DataFrame, count: int) -> np.ndarray:
    """Inverse passage frequencies over all passages; at least log 2, so that no word is without weight."""
    sums = map_arrow(hits.select("words", "place", "term"), _counted(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    seen, total = np.zeros(count), 0
    for r in sums.collect():  # a row per benchmark word
        if r["term"] < 0:
            total = r["n"]
        else:
            seen[r["term"]] = r["n"]
    return np.log1p((1 + total) / (1 + seen))


def _rows(passage: np.ndarray, term: np.ndarray, counts: np.ndarray, weights: np.ndarray):
    """TF-IDF rows in compressed form: passages, their first entries, terms, unit values, and norms."""
    values = (1 + np.log(counts)) * weights[term]
    if not len(passage):
        return passage, passage, term, values, values
    begin = np.flatnonzero(np.diff(passage, prepend=-1))
    norms = np.sqrt(np.add.reduceat(values * values, begin))
    return passage[begin], begin, term, values / np.repeat(norms, np.diff(np.append(begin, len(passage)))), norms


def _blocks(begin: np.ndarray, term: np.ndarray, values: np.ndarray, rows: int = 256) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Some rows at a time: the first of them, the terms they have, and their values as a matrix over those terms."""
    ends = np.append(begin, len(term))
    for lo in range(0, len(begin), rows):
        hi = min(lo + rows, len(begin))
        used, column = np.unique(term[ends[lo] : ends[hi]], return_inverse=True)
        dense = np.zeros((hi - lo, len(used)), "f4")
        dense[np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1])), column] = values[ends[lo] : ends[hi]]
        yield lo, used, dense


def _multiplied(weights: np.ndarray, seed: int, rank: int):
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(seed).standard_normal((len(weights), rank)).astype("f4")
        total = np.zeros((len(weights), rank), "f4")
        for _, hits in _read(batches):
            _, begin, term, values, _ = _rows(*hits.vectors(len(weights), PASSAGE)[:3], weights)
            for _, used, dense in _blocks(begin, term, values):
                total[used] += dense.T @ (dense @ random[used])
        used = np.flatnonzero(total.any(1))
        raw = [total[i].tobytes() for i in used.tolist()]
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(raw, pa.binary())], ["term", "row"])

    return multiply


def _added(rank: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, raw in zip(batch.column("term").to_pylist(), batch.column("row").to_pylist()):
                row = np.frombuffer(raw, "<f4")
                if term in sums:
                    sums[term] += row
                else:
                    sums[term] = row.astype("f8")
        yield pa.record_batch(
            [pa.array(list(sums), pa.int64()), pa.array([r.astype("f4").tobytes() for r in sums.values()], pa.binary())], ["term", "row"]
        )

    return add


def _nystroem(product: np.ndarray, random: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors and eigenvalues of a positive matrix M, from M R and R."""
    shift = 1e-6 * max(np.linalg.norm(product), 1e-12)
    shifted = product + shift * random
    inner = random.T @ shifted
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > values.max() * 1e-9
    left, singular, _ = np.linalg.svd(shifted @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left, singular * singular


def latent_directions(hits: DataFrame, items: Items, weights: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """Leading right singular vectors of all passages: terms by at most ``rank``.

    With the passages' matrix A and a random matrix R, one pass sums A'(A R).
    The eigenvectors of A'A then follow from these products and R alone.  The
    benchmark's own passages are rows of A too, each as heavy as the corpus'
    strongest direction, so that the space holds what is searched for.
    """
    rank = min(rank, len(weights))
    partial = map_arrow(hits.select("words", "place", "term"), _multiplied(weights, seed, rank), "term long, row binary")
    sums = map_arrow(partial.repartition(16, "term"), _added(rank), "term long, row binary")
    product = np.zeros((len(weights), rank))
    for r in sums.toLocalIterator():  # a row per benchmark word
        product[r["term"]] = np.frombuffer(bytes(r["row"]), "<f4")
    random = np.random.default_rng(seed).standard_normal((len(weights), rank)).astype("f4").astype("f8")
    heaviest = _nystroem(product, random)[1].max(initial=0.0) or 1.0
    _, begin, term, values, _ = _rows(*Hits.of(items.words, items.terms).vectors(len(weights), STRIDE)[:3], weights)
    if len(begin):
        rows = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(term))))
        inner = np.add.reduceat(random[term] * values[:, None], begin)
        np.add.at(product, term, heaviest * inner[rows] * values[:, None])
    return _nystroem(product, random)[0]


def word_bits(words: np.ndarray) -> dict[int, int]:
    """The places of each word, as bits."""
    where: dict[int, int] = {}
    for i, word in enumerate(words.tolist()):
        where[word] = where.get(word, 0) | 1 << i
    return where


def common_subsequence(where: dict[int, int], size: int, text: list[int]) -> int:
    """Places of a longest common subsequence of ``text`` and the ``size`` words of ``where``, as bits."""
    ones = row = (1 << size) - 1
    for word in text:
        if bits := where.get(word):
            hit = row & bits
            row = ((row + hit) | (row - hit)) & ones
    return ones & ~row


def _searched(items: Items, weights: np.ndarray, directions: np.ndarray, cosine: float, cover: float, answer: float):
    names = ["doc_id", "text_hash", "item_id", "word", "cosine", "covered", "answer_covered"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    directions = directions.astype("f4")
    count = len(weights)

    def project(hits: Hits):
        """Passages with words, their first entries, terms, raw values, unit latent rows; first passages of the texts."""
        passage, term, counts, offsets = hits.vectors(count, STRIDE)
        rows, begin, term, values, norms = _rows(passage, term, counts, weights)
        if not len(begin):
            return rows, begin, term, values, np.empty((0, directions.shape[1]), "f4"), offsets
        latent = np.empty((len(begin), directions.shape[1]), "f4")
        for lo, used, dense in _blocks(begin, term, values):
            latent[lo : lo + len(dense)] = dense @ directions[used]
        latent /= np.maximum(np.sqrt((latent * latent).sum(1, keepdims=True)), 1e-9)
        raw = values * np.repeat(norms, np.diff(np.append(begin, len(term))))
        return rows, begin, term, raw, latent, offsets

    asked = Hits.of(items.words, items.terms)
    query, q_begin, q_term, q_raw, queries, first = project(asked)
    owner = np.searchsorted(first, query, side="right") - 1
    start = (query - first[owner]) * STRIDE
    bits = [word_bits(np.searchsorted(items.terms, w)) for w in items.words]
    # The items' vectors as sorted keys, to look entries up.
    q_key = np.repeat(np.arange(len(query)), np.diff(np.append(q_begin, len(q_term)))) * count + q_term
    q_square = np.add.reduceat(q_raw * q_raw, q_begin) if len(query) else q_raw

    # The items' runs, sorted, with the item of each and its place there.
    runs, first_of_run = asked.runs()
    order = np.argsort(runs, kind="stable")
    runs, run_item, run_place = runs[order], asked.text[first_of_run[order]], asked.place[first_of_run[order]]

    def shared(hits: Hits) -> Iterator[tuple[int, int, int]]:
        """Text, item and start of the stretch to compare, on the grid of the passages, wherever a run of an item stands."""
        found, hit = hits.runs()
        lo, hi = np.searchsorted(runs, found), np.searchsorted(runs, found, side="right")
        sizes = hi - lo
        hit = np.repeat(hit, sizes)
        at = np.repeat(lo - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        begin = np.maximum((hits.place[hit] - run_place[at]) // STRIDE * STRIDE - PASSAGE, 0)
        if len(at):
            yield from map(tuple, np.unique(np.stack([hits.text[hit], run_item[at], begin], 1), axis=0).tolist())

    def held(p: np.ndarray, q: np.ndarray, begin: np.ndarray, term: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """The share of each item passage's vector that is in the document's passage."""
        sizes = np.diff(np.append(begin, len(term)))[p]
        ends = np.cumsum(sizes)
        entry = np.repeat(begin[p] - (ends - sizes), sizes) + np.arange(sizes.sum())
        key = np.repeat(q, sizes) * count + term[entry]
        at = np.minimum(np.searchsorted(q_key, key), len(q_key) - 1)
        product = np.where(q_key[at] == key, q_raw[at] * np.minimum(raw[entry], q_raw[at]), 0.0)
        return np.add.reduceat(product, ends - sizes) / q_square[q]

    def leaks_in(hits: Hits) -> Iterator[tuple]:
        passage, entries, term, raw, latent, offsets = project(hits)
        text = np.searchsorted(offsets, passage, side="right") - 1
        begin = (passage - offsets[text]) * STRIDE
        first_hit = np.searchsorted(hits.text, np.arange(len(hits.lengths) + 1))
        seen, best = set(), {}

        def compare(t: int, k: int, at: int, close: float | None) -> None:
            if (t, k, at) in seen:
                return
            seen.add((t, k, at))
            size, (a, b) = len(items.words[k]), first_hit[t : t + 2]
            a, b = a + np.searchsorted(hits.place[a:b], [at, at + size + 2 * PASSAGE])
            found = common_subsequence(bits[k], size, hits.term[a:b].tolist())
            covered = found.bit_count() / size
            told = (found >> items.answers[k]).bit_count() / max(size - items.answers[k], 1)
            if covered >= cover and told >= answer and covered > best.get((t, k), (0.0,))[0]:
                best[t, k] = (covered, told, at, close)

        for lo in range(0, len(passage), 512):
            near = latent[lo : lo + 512] @ queries.T
            p, q = np.nonzero(near >= cosine)
            if not len(p):
                continue
            close = near[p, q]
            enough = held(p + lo, q, entries, term, raw) >= PART
            for p_, q_, close_ in zip((p[enough] + lo).tolist(), q[enough].tolist(), close[enough].tolist()):
                compare(int(text[p_]), int(owner[q_]), max(int(begin[p_] - start[q_]) - PASSAGE, 0), close_)
        for t, k, at in shared(hits):
            if best.get((t, k), (0.0,))[0] < 1:  # nothing covers more than all of the item
                compare(t, k, at, None)
        for (t, k), (covered, told, at, close) in best.items():
            # Rounded: the last digits depend on which passages are multiplied together.
            yield t, items.ids[k], at, None if close is None else round(float(close), 4), covered, told

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hits in _read(batches):
            ids, hashes = part.column("doc_id").to_pylist(), part.column("text_hash").to_pylist()
            out = [(ids[t], hashes[t], *rest) for t, *rest in leaks_in(hits)] if len(queries) else []
            columns = zip(*out) if out else [[]] * len(types)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    return search


_LEAK = "doc_id long, text_hash long, item_id long, word long, cosine double, covered double, answer_covered double"
_NO_LEAKS = pa.table({name: pa.array([], {"long": pa.int64(), "double": pa.float64()}[kind]) for name, kind in map(str.split, _LEAK.split(", "))})


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, cover: float = COVER, answer: float = ANSWER) -> DataFrame:
    """A row per document and benchmark item found in it.

    ``word`` is where the compared stretch of the document begins, ``cosine``
    that of the passage in latent space (null where a run of equal words led to
    the place), ``covered`` and ``answer_covered`` the
    shares of the item's and its answer's words in the common subsequence.
    Null texts and items hold nothing; items of fewer than ``MIN_WORDS`` words
    are not looked for; rows without ``item_id`` are left out.  Equal items are
    each reported; repeated documents, and those without ``doc_id``, each have
    their rows.  Empty tables give no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    blocks = max(1, -(-items.count() // BLOCK))
    dealt = items.withColumn("b", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # From Arrow: plain rows, none too, would go through more Python workers, beside those that search.
    found = spark.createDataFrame(_NO_LEAKS)
    for b in range(blocks):  # the stated queries against all rows, in blocks
        block = Items.of(sorted((r["item_id"], r["text"]) for r in dealt.filter(F.col("b") == b).collect()))
        if not block.ids:
            continue
        hits = stored(map_arrow(texts, _found(block.terms), _HITS), "benchmark-words")
        weights = term_weights(hits, len(block.terms))
        directions = latent_directions(hits, block, weights)
        found = found.union(map_arrow(hits, _searched(block, weights, directions, cosine, cover, answer), _LEAK))
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all other rows unchanged.

    Rows with null texts stay; of rows that repeat ``doc_id`` and text all go or
    none; empty tables give what is there.  Columns of any name pass through.
    """
    bad = stored(leaks(docs, benchmark).select("doc_id", "text_hash").distinct(), "leaks")
    kept = docs.alias("d").join(
        bad.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64("d.text") == F.col("b.text_hash")), "left_anti"
    )
    return kept.select("d.*")
