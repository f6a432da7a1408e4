"""Similarity join of documents on word shingles by chosen paths.

Texts with the same shingles are one class.  Every class is embedded as
``COORDINATES`` minima of random functions over its shingles: two classes share
such a token with a probability equal to their Jaccard similarity.  A run starts
with all classes in one node; a node samples ``CHILDREN`` coordinates and sends
each class to the child named by its token there, so classes split by tokens
they share.  Children of few classes are compared by brute force on all
coordinates; large ones split again.  A node whose classes agree on most
sampled coordinates is all near copies: it is joined as a whole, without pairs.
Runs repeat until a pair at the threshold is found with ``RECALL``.

What comes out are candidate groups, never lists of pairs.  Each group's
shingles are then read once and all pairs of a group compared exactly, block by
block, so that neither a group's size nor a hot shingle makes one task's work.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, runs, slices, stored
from .graph import components
from .words import SHINGLE, mix, shingles, word_hashes

THRESHOLD = 0.8
RECALL = 0.999999
COORDINATES, CHILDREN = 64, 3
#: Nodes of at most so many classes are compared by brute force.
SMALL = 512
#: A node is all near copies when its classes agree on this share of sampled coordinates; for a node
#: of up to ``MEDIUM`` classes, which costs little to compare, half of that is enough.
DENSE, MEDIUM = 0.5, 4096
#: Classes per partition while paths are followed: rows are few bytes.
PART_CLASSES = 10_000
#: Nodes that are large after so many splits are joined as a whole.
DEPTH = 8
#: Coordinates that must agree: five standard errors below the threshold.
AGREE = int(COORDINATES * THRESHOLD - 5.3 * (COORDINATES * THRESHOLD * (1 - THRESHOLD)) ** 0.5)
#: Classes and shingles of one block of a large group.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 18

_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_KEY = "doc_id long, k1 long, k2 long, n int, sketch binary"


def number_of_runs(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met in a leaf with probability ``recall``."""
    met = 1.0
    for _ in range(3):
        met = 1 - (1 - threshold * met) ** CHILDREN
    return max(1, ceil(log(1 - recall) / log(1 - met)))


# --- classes ----------------------------------------------------------------


def _sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Two keys that stand for the whole set, and the minima, of each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    k1 = np.add.reduceat(mix(flat), starts)
    k2 = np.bitwise_xor.reduceat(mix(flat + _FACTORS[0]), starts)
    least = np.empty((len(sets), COORDINATES), "<u4")
    for j, factor in enumerate(_FACTORS):
        least[:, j] = np.minimum.reduceat(((flat * factor) >> np.uint64(32)).astype(np.uint32), starts)
    return k1.view(np.int64), k2.view(np.int64), least


def _signed(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int32()), ("sketch", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                sets = [shingles(w, size) for w in word_hashes([t or "" for t in part.column("text").to_pylist()])]
                full = [i for i, s in enumerate(sets) if len(s)]
                k1, k2, sketch = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64), [None] * len(sets)
                if full:
                    k1[full], k2[full], least = _sketches([sets[i] for i in full])
                    for row, i in enumerate(full):
                        sketch[i] = least[row].tobytes()
                columns = [part.column("doc_id"), pa.array(k1), pa.array(k2), pa.array([len(s) for s in sets], pa.int32())]
                yield pa.record_batch([*columns, pa.array(sketch, pa.binary())], schema=schema)

    return sign


def signed(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row: the keys of its set of shingles, their number, and the sketch (null without words)."""
    return map_arrow(docs.select("doc_id", "text"), _signed(size), _KEY)


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per distinct set of shingles; ``cid`` is fixed by storing."""
    made = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    return stored(made.withColumn("cid", F.monotonically_increasing_id()), "classes")


# --- chosen paths -----------------------------------------------------------


def _token(at: Column | int) -> Column:
    start = (F.lit(at) if isinstance(at, int) else at) * 4 + 1
    return F.substring("sketch", start.cast("int"), F.lit(4))


def _sized(rows: DataFrame, parts: int) -> DataFrame:
    """``rows (node, cid)`` of nodes with company, with the node's size ``m``."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("m")).filter("m > 1").coalesce(parts)
    return stored(rows.join(sizes, "node").coalesce(parts), "nodes")


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect all pairs of a small node whose sketches agree enough."""
    a, b = [], []
    for _, rows in runs(batches, ["node"]):
        rows = list(rows)
        ids = [r["cid"] for r in rows]
        least = np.frombuffer(b"".join(r["sketch"] for r in rows), "<u4").reshape(len(rows), -1)
        root = np.arange(len(rows))
        for i in range(1, len(rows)):
            hits = np.flatnonzero((least[:i] == least[i]).sum(1) >= AGREE)
            for r in np.unique(root[hits]):
                a.append(ids[i])
                b.append(ids[int(hits[root[hits] == r][0])])
            if len(hits):
                root[np.isin(root, root[hits])] = root[hits].min()
                root[i] = root[hits].min()
        if len(a) > 10_000:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a, b = [], []
    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def candidate_edges(classes: DataFrame, times: int) -> DataFrame:
    """Edges ``a``, ``b`` whose components hold every pair found on a shared path."""
    order = np.random.default_rng(7).permutation(COORDINATES)
    roots = [
        F.xxhash64(F.lit(r), F.lit(at), _token(at))
        for r in range(times)
        for at in (int(x) for x in order[np.arange(r * CHILDREN, (r + 1) * CHILDREN) % COORDINATES])
    ]
    level = classes.select("cid", F.explode(F.array(*roots)).alias("node"))
    sketches = classes.select("cid", "sketch")
    parts = max(8, classes.count() // PART_CLASSES)
    found, depth = None, 0
    while True:
        depth += 1
        nodes = _sized(level, parts)
        leaves = nodes.filter(F.col("m") <= SMALL).select("node", "cid").join(sketches, "cid").coalesce(parts)
        leaves = leaves.repartition("node").coalesce(parts).sortWithinPartitions("node")
        edges = stored(map_arrow(leaves, _near, "a long, b long"), "edges")
        large = nodes.filter(F.col("m") > SMALL).select("node", "cid", "m")
        found = edges if found is None else found.union(edges)
        if not large.limit(1).count():
            return found
        # The sketches' agreement on the next coordinates tells near copies from texts that share a passage.
        picks = [F.pmod(F.xxhash64("node", F.lit(depth), F.lit(j)), F.lit(COORDINATES)) for j in range(CHILDREN)]
        children = F.array(*[F.struct(F.lit(j).alias("coordinate"), F.xxhash64("node", F.lit(j), _token(at)).alias("child")) for j, at in enumerate(picks)])
        split = large.join(sketches, "cid").select("node", "cid", "m", F.explode(children).alias("p"))
        split = stored(split.select("node", "cid", "m", "p.coordinate", "p.child").coalesce(parts), "split")
        shares = split.groupBy("node", "m", "coordinate", "child").agg(F.count("*").alias("k"), F.min("cid").alias("least"))
        agreed = F.sum(F.pow(F.col("k") / F.col("m"), F.lit(2))) / CHILDREN
        judged = shares.coalesce(parts).groupBy("node", "m").agg(agreed.alias("agree"), F.min("least").alias("b"))
        enough = F.when(F.col("m") <= MEDIUM, DENSE / 2).otherwise(DENSE)
        judged = judged.select("node", "b", ((F.col("agree") >= enough) | F.lit(depth >= DEPTH)).alias("whole")).coalesce(parts)
        split = stored(split.join(judged, "node").coalesce(parts), "split")
        found = found.union(split.filter("whole AND cid <> b").select(F.col("cid").alias("a"), "b"))
        level = split.filter("NOT whole").select(F.col("child").alias("node"), "cid")


# --- exact comparison -------------------------------------------------------


def _shingled(size: int):
    schema = pa.schema([("gid", pa.int64()), ("cid", pa.int64()), ("copies", pa.int64()), ("n", pa.int32()), ("grams", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                rows = part.to_pylist()
                out = []
                for r, words in zip(rows, word_hashes([r["text"] or "" for r in rows])):
                    grams = shingles(words, size)
                    if len(grams):
                        k1, k2, _ = _sketches([grams])
                        if (k1[0], k2[0]) == (r["k1"], r["k2"]):
                            out.append((r["gid"], r["cid"], r["copies"], len(grams), grams.tobytes()))
                if out:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return cut


def _matches(one: np.ndarray, flat: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """How many of ``one``'s shingles each owner has; ``flat`` is sorted."""
    lo, hi = np.searchsorted(flat, one, "left"), np.searchsorted(flat, one, "right")
    size = hi - lo
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    return np.bincount(owner[at], minlength=count)


def _compared(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, ["gid", "ea", "ia", "eb", "ib"]):
            seen = {}
            for r in rows:
                seen.setdefault(r["cid"], (r["is_a"], r["is_b"], r["copies"], np.frombuffer(r["grams"], np.uint64)))
            ids, sides = list(seen), list(seen.values())
            right = [i for i, s in enumerate(sides) if s[1]]
            sets = [sides[i][3] for i in right]
            if not sets:
                continue
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(right)), [len(s) for s in sets])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            sizes = np.array([len(s) for s in sets])
            links, root, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
            right = np.array(right)
            copies = np.array([s[2] for s in sides])
            for i, (is_a, is_b, _, one) in enumerate(sides):
                if not is_a:
                    continue
                both = _matches(one, flat, owner, len(right))
                near = right[both >= threshold * (len(one) + sizes - both) - 1e-9]
                # Inside a block each pair is met from both ends: count it at the later one.
                near = near[near < i] if is_b else near
                if len(near):
                    links[i] += copies[near].sum()
                    links[near] += copies[i]
                    for r in np.setdiff1d(np.unique(root[near]), root[i]):
                        edges.append((ids[i], ids[int(near[root[near] == r][0])]))
                    merged = np.append(root[near], root[i])
                    root[np.isin(root, merged)] = merged.min()
            linked = np.flatnonzero(links).tolist()
            a = [ids[i] for i in linked] + [e[0] for e in edges]
            b = [None] * len(linked) + [e[1] for e in edges]
            n = [int(links[i]) for i in linked] + [0] * len(edges)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "links"])

    return compare


def _dealt(members: DataFrame) -> DataFrame:
    """Members repeated for the pairs of blocks they are compared in.

    Sets whose sizes differ by more than the threshold cannot be similar: sizes
    fall into steps of 5/4, and blocks meet blocks of their own and the next step.
    """
    step = F.floor(F.log("n") / F.lit(log(1 / THRESHOLD))).cast("int")
    cells = members.select("gid", step.alias("e"), "n").groupBy("gid", "e").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_CLASSES, F.col("s") / BLOCK_SHINGLES)).cast("int")
    total = F.when((F.sum("m") <= BLOCK_CLASSES) & (F.sum("s") <= BLOCK_SHINGLES), F.lit(True)).otherwise(F.lit(False))
    plan = cells.groupBy("gid").agg(total.alias("small"), F.map_from_entries(F.collect_list(F.struct("e", blocks.alias("k")))).alias("k"))
    with_plan = members.withColumn("e", step).join(plan, "gid")

    own = F.col("e")
    i = F.pmod(F.xxhash64("cid"), F.element_at("k", own)).cast("int")

    def task(ea, ia, eb, ib, is_a, is_b):
        return F.struct(
            *[x.cast("int").alias(n) for x, n in ((ea, "ea"), (ia, "ia"), (eb, "eb"), (ib, "ib"))],
            F.lit(is_a).alias("is_a") if isinstance(is_a, bool) else is_a.alias("is_a"),
            F.lit(is_b).alias("is_b") if isinstance(is_b, bool) else is_b.alias("is_b"),
        )

    def blocks_of(e):
        return F.sequence(F.lit(0), F.coalesce(F.try_element_at("k", e), F.lit(0)) - 1)

    def there(e):
        return F.coalesce(F.try_element_at("k", e), F.lit(0)) > 0

    same = F.transform(blocks_of(own), lambda j: task(own, F.least("i", j), own, F.greatest("i", j), F.col("i") <= j, F.col("i") >= j))
    none = F.slice(same, 1, 0)
    up = F.when(there(own + 1), F.transform(blocks_of(own + 1), lambda j: task(own, F.col("i"), own + 1, j, True, False))).otherwise(none)
    down = F.when(there(own - 1), F.transform(blocks_of(own - 1), lambda j: task(own - 1, j, own, F.col("i"), False, True))).otherwise(none)
    zero = F.lit(0)
    tasks = F.when(F.col("small"), F.array(task(zero, zero, zero, zero, True, True))).otherwise(F.concat(same, up, down))
    return with_plan.withColumn("i", i).select("gid", "cid", "copies", "grams", F.explode(tasks).alias("t")).select(
        "gid", "t.*", "cid", "copies", "grams"
    )


def links(docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Stored rows ``a, b, links``: what each class links to (``b`` null), and edges that connect linked classes."""
    groups = components(candidate_edges(classes, number_of_runs(threshold)), "groups")
    members = groups.select(F.col("node").alias("cid"), F.col("root").alias("gid")).join(classes, "cid")
    named = members.select("cid", "gid", "copies", "k1", "k2", F.col("rep").alias("doc_id"))
    texts = docs.select("doc_id", "text").join(named, "doc_id")
    grams = stored(
        map_arrow(texts, _shingled(size), "gid long, cid long, copies long, n int, grams binary"), "grams"
    )
    keys = ["gid", "ea", "ia", "eb", "ib"]
    dealt = _dealt(grams).repartition(*keys).sortWithinPartitions(*keys)
    return stored(map_arrow(dealt, _compared(threshold), "a long, b long, links long"), "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Per row: ``class_id``, ``copy_of``, ``n_links``, ``n_copies`` and ``kept``.

    Words are runs of letters and digits in lower case; a text of fewer than
    ``size`` words is one shingle.  ``copy_of`` is the smallest ``doc_id`` with
    the same shingles, ``n_copies`` the number of rows with them.  Rows whose
    sets have a Jaccard similarity of ``threshold`` or more are linked:
    ``n_links`` counts the linked rows, copies included, and ``class_id`` is
    the smallest ``doc_id`` reachable over links.  ``kept`` marks the row whose
    ``doc_id`` is the ``class_id``.  Texts without words, nulls among them, and
    rows without ``doc_id`` link with nothing and are kept.  Repeated rows are
    copies.  Only ``doc_id`` and ``text`` are read.
    """
    rows = stored(signed(docs, size), "signed")
    classes = classes_of(rows)
    found = links(docs, classes, threshold, size)
    linked = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("linked"))
    joined = components(found.filter("b IS NOT NULL").select("a", "b"), "joined")
    named = joined.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    smallest = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    of_class = joined.join(smallest, "root").select(F.col("node").alias("cid"), "class_id")
    # The counts and classes concern few rows; copies are looked up by the keys of their set.
    told = classes.select("cid", "k1", "k2", "rep", "copies").join(of_class, "cid", "left").join(
        linked.withColumnRenamed("a", "cid"), "cid", "left"
    ).drop("cid")
    mine = rows.select("doc_id", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("k1")).alias("k1"), "k2")
    out = mine.join(told, ["k1", "k2"], "left")
    class_id = F.coalesce("class_id", "rep", "doc_id")
    return out.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce("rep", "doc_id").alias("copy_of"),
        (F.coalesce("linked", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"),
    )
