"""Toxicity from bags of subwords: averaged embeddings under a linear softmax.

A text is the bag of its words and of the character n-grams of its words, all
hashed to ``BUCKETS`` rows of an embedding.  The rows are averaged over the
bag and a linear softmax tells the two labels apart; embeddings and softmax are
trained jointly, in numpy, on a bounded sample of labelled documents.  A word
never seen shares n-grams with the words it is a misspelling of.

After training the score is linear in the average, so every bucket counts for
one number.  Scoring a text is one sum over its bag: whole texts of any
length, piece by piece, with a table of fixed size as the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices
from .words import mix

BUCKETS, DIMS = 1 << 19, 8
#: Lengths of n-grams, word marks included.
GRAMS = (3, 4, 5)
#: Bound of the training sample; its documents are chosen by a hash of their id.
SAMPLE = 6000
#: Bound of all bags of the sample: 512 MB.  The longest bag has ``BUCKETS`` entries.
ENTRIES = 1 << 26
EPOCHS, BATCH, RATE, INIT = 6, 32, 1.0, 0.02
#: Parts of a training text: a text counts by all of its parts.
RUN = 1 << 18

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(1 << 8, bool)
_SPACE[[ord(c) for c in ' \t\n\r\x0b\x0c.,;:!?"()[]{}|']] = True


def _characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with a 0 before, between and after words; the text each belongs to."""
    codes = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "surrogatepass"), "<u4")
    if len(texts) > 1:
        lengths = [len(t.lower()) + 1 for t in texts]
    else:
        lengths = [len(codes) + 1]
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(codes)]
    gap = _SPACE[np.minimum(codes, 255)] & (codes < 256) | (codes == 0)
    codes = np.where(gap, 0, codes)
    keep = ~gap | np.concatenate([[True], ~gap[:-1]])
    return np.concatenate([[0], codes[keep], [0]]).astype(np.uint64), np.concatenate([[0], owner[keep], [len(texts) - 1]])


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all words and n-grams, with the number of the text each is from."""
    codes, owner = _characters(texts)
    is_gap = codes == 0
    gaps = np.flatnonzero(is_gap)
    # Words: from gap to gap, by a running polynomial of their characters.
    starts, ends = gaps[:-1] + 1, gaps[1:]
    full = ends > starts
    starts, ends = starts[full], ends[full]
    if not len(starts):
        return
    position = np.arange(len(codes)) - np.repeat(gaps, np.diff(np.append(gaps, len(codes))))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes * _MULTIPLY + position.astype(np.uint64)))])
    word = mix(sums[ends] - sums[starts])
    yield (word % np.uint64(BUCKETS)).astype(np.int64), owner[starts]
    inner = np.concatenate([[0], np.cumsum(is_gap)])
    rolled = codes.copy()
    for n in range(2, max(GRAMS) + 1):
        rolled = rolled[:-1] * _MULTIPLY + codes[n - 1 :]
        if n in GRAMS:
            at = np.arange(len(rolled))
            fits = inner[at + n - 1] == inner[at + 1]
            yield (mix(rolled[fits] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64), owner[at[fits] + 1]


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end at a space or line end."""
    start = 0
    while len(text) - start > RUN:
        end = min((i for i in (text.find(c, start + RUN) for c in " \n") if i >= 0), default=len(text))
        yield text[start:end]
        start = end
    yield text[start:]


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a whole text and their counts."""
    counts = np.zeros(BUCKETS, np.int64)
    for part in _parts(text):
        for buckets, _ in features([part]):
            counts += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used, counts[used]


# --- training ---------------------------------------------------------------


@dataclass
class Model:
    """What each bucket adds to the log odds, per feature of the bag, and the odds of an empty bag."""

    weights: np.ndarray
    bias: float
    trained: bool = True

    def scores(self, texts: list[str]) -> np.ndarray:
        total, size = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, owner in features(texts):
            total += np.bincount(owner, self.weights[buckets], len(texts))
            size += np.bincount(owner, minlength=len(texts))
        return _odds(total / np.maximum(size, 1) + self.bias)

    def score_long(self, text: str) -> float:
        total = size = 0.0
        for part in _parts(text):
            for buckets, _ in features([part]):
                total += float(self.weights[buckets].sum())
                size += len(buckets)
        return float(_odds(np.array(total / max(size, 1.0) + self.bias)))


def _odds(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 0) -> Model:
    """Embeddings and softmax by stochastic gradients with per-weight rates."""
    if not len(bags):
        return Model(np.zeros(BUCKETS, np.float32), 0.0, trained=False)
    rng = np.random.default_rng(seed)
    table = rng.uniform(-INIT, INIT, (BUCKETS, DIMS)).astype(np.float32)
    softmax, offset = np.zeros((DIMS, 2), np.float32), np.log(np.bincount(labels, minlength=2) + 1.0).astype(np.float32)
    grown, grown_soft = np.full(BUCKETS, 1e-8, np.float32), np.full((DIMS, 2), 1e-8, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            chosen = [i for i in order[start : start + BATCH] if len(bags[i][0])]
            if not chosen:
                continue
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] / bags[i][1].sum() for i in chosen]).astype(np.float32)
            sizes = [len(bags[i][0]) for i in chosen]
            row_starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(table[ids] * share[:, None], row_starts)
            logits = mean @ softmax + offset
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            odds[np.arange(len(chosen)), labels[chosen]] -= 1  # the gradient of the loss
            soft_step = mean.T @ odds
            grown_soft += soft_step**2
            back = odds @ softmax.T
            used, inverse = np.unique(ids, return_inverse=True)
            step = np.empty((len(used), DIMS), np.float32)
            per_row = np.repeat(back, sizes, 0) * share[:, None]
            for d in range(DIMS):
                step[:, d] = np.bincount(inverse, per_row[:, d], len(used))
            grown[used] += (step**2).mean(1)
            table[used] -= rate * step / np.sqrt(grown[used])[:, None]
            softmax -= rate * soft_step / np.sqrt(grown_soft)
            offset -= rate * odds.mean(0) * 0.1
    table[grown <= 1e-8] = 0  # rows the sample never used say nothing
    way = softmax[:, 1] - softmax[:, 0]
    return Model((table @ way).astype(np.float32), float(offset[1] - offset[0]))


def held_out(doc_id="doc_id"):
    """Rows no label is learned from: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


_BAG = "doc_id long, toxic int, buckets binary, counts binary"


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "toxic", "buckets", "counts"]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    for batch in batches:
        for r in batch.to_pylist():
            used, counts = bag(r["text"] or "")
            row = (r["doc_id"], r["toxic"], used.astype("<i4").tobytes(), counts.astype("<i4").tobytes())
            yield pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, entries: int = ENTRIES) -> Model:
    """A model of ``labels (doc_id, toxic)``, from at most ``sample`` rows that are not held out.

    Their bags may have ``entries`` entries together, 8 bytes each: rows beyond that,
    in the order of the ids' hashes, are left out.  The driver gets the weights only.

    Ids with both labels, null labels and labels but 0 and 1 are not used.  Of
    rows that repeat a ``doc_id`` the one with the smallest text hash is used.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out()).groupBy("doc_id")
    known = known.agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("top")).filter("toxic = top").drop("top")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` ids: bounded by the parameter.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "toxic")
    # Each of the sample's bags is made where its text is; one task learns from them and gives the weights.
    bags = map_arrow(texts, _bags, _BAG).repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    trained = map_arrow(bags, _trained(entries), "weights binary, bias double, trained boolean").first()
    if trained is None:  # no rows, no task
        return train([], np.zeros(0, np.int64))
    return Model(np.frombuffer(bytes(trained["weights"]), "<f4"), trained["bias"], trained["trained"])


def _trained(most: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, entries = [], 0
        for r in (r for batch in batches for r in batch.to_pylist()):
            used = np.frombuffer(r["buckets"], "<i4")
            entries += len(used)
            if entries > most:
                break
            rows.append((r["doc_id"], r["toxic"], used, np.frombuffer(r["counts"], "<i4")))
        rows.sort(key=lambda r: r[0])
        model = train([r[2:] for r in rows], np.array([r[1] for r in rows], np.int64))
        columns = [[model.weights.astype("<f4").tobytes()], [model.bias], [model.trained]]
        yield pa.record_batch([pa.array(c) for c in columns], ["weights", "bias", "trained"])

    return learn


# --- scoring ----------------------------------------------------------------


def _scored(model: Model):
    names, types = ["doc_id", "text_hash", "held_out", "score"], [pa.int64(), pa.int64(), pa.bool_(), pa.float64()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", RUN):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = [model.score_long(texts[0])] if len(texts) == 1 else model.scores(texts).tolist()
                columns = [part.column("doc_id"), part.column("text_hash"), part.column("held_out"), pa.array(found, types[3])]
                yield pa.record_batch(columns, names)

    return score


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, from its text alone.

    The score of a text without words, a null one included, is the model's
    share of label 1.  Repeated rows and rows without ``doc_id`` each get a row
    (the latter are not held out).  Other columns are not read.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), held_out().alias("held_out"))
    found = map_arrow(rows, _scored(model), "doc_id long, text_hash long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _kept(model: Model):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", RUN):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = np.array([model.score_long(texts[0])]) if len(texts) == 1 else model.scores(texts)
                yield part.filter(pa.array(found < 0.5))

    return keep


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, unchanged; all rows if the model had nothing to learn from."""
    if not model.trained:
        return docs
    return map_arrow(docs, _kept(model), docs.schema)
