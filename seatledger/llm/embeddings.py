"""Exact join of vectors within a cosine range, by pivots.

On unit vectors a cosine of at least ``c`` is a distance of at most
``r = sqrt(2 - 2c)``.  Every vector's home is the cell of its nearest pivot.
For a pair ``x``, ``y`` within ``r`` the triangle inequality gives
``d(x, p) <= d(x, home of x) + 2r`` for ``y``'s pivot ``p``; ``x`` is repeated
in every cell that passes this and two sharper consequences: ``x`` lies within
``r`` of the plane halfway between the two pivots, and within ``r`` of the
farthest vector at home in the cell.  So each cell holds all partners of its
home vectors, and cells are joined independently of each other.

Equal vectors are one class.  The home vectors of a large cell are dealt to
blocks; a block is held in memory while the cell's vectors stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .graph import components

COSINE = 0.9
#: Pivots, chosen far apart among a bounded sample of vectors.
PIVOTS, SAMPLE = 16, 4096
#: Home vectors of a cell that one task holds.
BLOCK = 4096
#: Single precision finds candidates this far below the threshold; doubles decide.
SLACK = 1e-4


def _usable(name: str = "embedding"):
    ok = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(name, lambda x: x != 0), F.lit(False))


def _units(raw: list[bytes], dims: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(raw), "<f8").reshape(-1, dims)
    rows = rows / np.abs(rows).max(1, keepdims=True)  # no overflow in the squares
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [np.array(v, "<f8").tobytes() for v in batch.column("embedding").to_pylist()]
        yield pa.record_batch([batch.column("vec_id"), pa.array(raw, pa.binary())], ["vec_id", "v"])


def _pivots(classes: DataFrame, dims: int, count: int) -> np.ndarray:
    """Vectors far apart: each next one is farthest from those chosen, within the sample."""
    sample = classes.filter(F.length("v") == dims * 8).orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()
    units = _units([bytes(r["v"]) for r in sample], dims)
    chosen, near = [0], units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, units @ units[chosen[-1]])
    return units[chosen]


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (units @ pivots.T), 0))


def _homes(pivots: np.ndarray):
    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_units(batch.column("v").to_pylist(), pivots.shape[1]), pivots)
                cell = d.argmin(1)
                columns = [batch.column(c) for c in ("cid", "copies", "v")]
                yield pa.record_batch([*columns, pa.array(cell, pa.int32()), pa.array(d.min(1))], ["cid", "copies", "v", "home", "d"])

    return home


def _repeated(pivots: np.ndarray, radius: float, reach: np.ndarray, blocks: np.ndarray):
    """Rows for each (cell, block) that a vector is compared in."""
    names = ["cell", "block", "side", "cid", "copies", "v"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    apart = _distances(pivots, pivots)
    eps = 1e-9

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                raw = batch.column("v").to_pylist()
                d = _distances(_units(raw, pivots.shape[1]), pivots)
                home = np.array(batch.column("home").to_pylist())
                mine = d[np.arange(len(d)), home][:, None]
                to = apart[home]
                to[to == 0] = 1.0
                near = (d <= mine + 2 * radius + eps) & (d <= reach[None, :] + radius + eps)
                near &= (d * d - mine * mine) / (2 * to) <= radius + eps
                near &= blocks[None, :] > 0
                near[np.arange(len(d)), home] = True
                ids, copies = batch.column("cid").to_pylist(), batch.column("copies").to_pylist()
                rows = []
                for i, cell in zip(*(x.tolist() for x in np.nonzero(near))):
                    own = ids[i] % int(blocks[cell])
                    for block in range(int(blocks[cell])):
                        is_home = cell == home[i] and block == own
                        rows.append((cell, block, 1, ids[i], copies[i], raw[i]))
                        if is_home:
                            rows.append((cell, block, 0, ids[i], copies[i], raw[i]))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return repeat


def _joined(dims: int, cosine: float):
    """Per home vector what it links to; edges that connect linked vectors."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home = None, []
        for batch in batches:
            cells, blocks, sides = (np.array(batch.column(c).to_pylist()) for c in ("cell", "block", "side"))
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(blocks) != 0) | (np.diff(sides) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                part, now = batch.slice(lo, hi - lo), (int(cells[lo]), int(blocks[lo]))
                if now != key:
                    if home:
                        yield from _told(home)
                    key, home = now, []
                ids = np.array(part.column("cid").to_pylist(), np.int64)
                copies = np.array(part.column("copies").to_pylist(), np.int64)
                units = _units(part.column("v").to_pylist(), dims)
                if sides[lo] == 0:
                    home.append([ids, units])
                    continue
                if not home:  # no vector of this block is at home here
                    continue
                if len(home[0]) == 2:
                    all_ids, all_units = np.concatenate([h[0] for h in home]), np.concatenate([h[1] for h in home])
                    n = len(all_ids)
                    home = [[all_ids, all_units, all_units.astype("f4"), np.zeros(n, np.int64), np.arange(n), []]]
                yield from _streamed(home[0], ids, copies, units, cosine)
        if home:
            yield from _told(home)

    return join


def _streamed(home: list, ids: np.ndarray, copies: np.ndarray, units: np.ndarray, cosine: float) -> Iterator[pa.RecordBatch]:
    home_ids, home_units, single, links, root, edges = home
    for start in range(0, len(ids), 512):
        there = units[start : start + 512]
        rows, cols = np.nonzero(there.astype("f4") @ single.T >= cosine - SLACK)
        exact = np.einsum("ij,ij->i", there[rows], home_units[cols]) >= cosine
        rows, cols = rows[exact], cols[exact]
        other = ids[start + rows] != home_ids[cols]
        rows, cols = rows[other], cols[other]
        np.add.at(links, cols, copies[start + rows])
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(rows)]):
            hits = cols[lo:hi]
            edges.append((int(ids[start + rows[lo]]), int(home_ids[hits[0]])))
            merged = np.unique(root[hits])
            if len(merged) > 1:
                root[np.isin(root, merged)] = merged[0]
    if len(edges) > 20_000:
        yield _batch([e[0] for e in edges], [e[1] for e in edges], [0] * len(edges))
        edges.clear()


def _told(home: list) -> Iterator[pa.RecordBatch]:
    if len(home[0]) > 2:
        ids, _, _, links, root, edges = home[0]
        linked = np.flatnonzero(links).tolist()
        moved = np.flatnonzero(root != np.arange(len(root))).tolist()
        a = [int(ids[i]) for i in linked] + [e[0] for e in edges] + [int(ids[i]) for i in moved]
        b = [None] * len(linked) + [e[1] for e in edges] + [int(ids[root[i]]) for i in moved]
        yield _batch(a, b, [int(links[i]) for i in linked] + [0] * (len(edges) + len(moved)))


def _batch(a: list, b: list, n: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "links"])


def _links(classes: DataFrame, dims: int, cosine: float, pivot_count: int) -> DataFrame:
    """Stored ``a, b, links`` of the classes of vectors of ``dims`` numbers."""
    pivots, radius = _pivots(classes, dims, pivot_count), sqrt(2 - 2 * cosine)
    same = classes.filter(F.length("v") == dims * 8).select("cid", "copies", "v")
    homes = stored(map_arrow(same, _homes(pivots), "cid long, copies long, v binary, home int, d double"), "homes")
    reach, blocks = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in homes.groupBy("home").agg(F.max("d").alias("d"), F.count("*").alias("n")).collect():  # a row per pivot
        reach[r["home"]], blocks[r["home"]] = r["d"], -(-r["n"] // BLOCK)
    rows = map_arrow(
        homes, _repeated(pivots, radius, reach, blocks), "cell int, block int, side int, cid long, copies long, v binary"
    )
    parts = max(int(blocks.sum()), 1)
    dealt = rows.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "side")
    return stored(map_arrow(dealt, _joined(dims, cosine), "a long, b long, links long"), "vector-links")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors (vec_id, embedding)``.

    Rows whose cosine, in doubles, is at least ``cosine`` are linked; equal
    vectors are linked with each other.  Vectors that are null or zero, or hold
    null or non-finite numbers, and rows without ``vec_id`` link with nothing.
    Vectors of different lengths do not link.  ``component_id`` is the smallest
    ``vec_id`` reachable.  Repeated rows link like equal vectors.  Other
    columns are not read; an empty table gives no rows.
    """
    usable = F.coalesce(F.col("vec_id").isNotNull() & _usable(), F.lit(False))
    rows = vectors.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding"))
    packed = stored(map_arrow(rows.filter("embedding IS NOT NULL"), _packed, "vec_id long, v binary"), "vectors")
    classes = packed.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")

    found = None
    for r in classes.select((F.length("v") / 8).cast("int").alias("n")).distinct().collect():  # the vector lengths in use
        part = _links(classes, r["n"], cosine, pivots)
        found = part if found is None else found.union(part)
    members = packed.join(classes.select("v", "cid", "rep", "copies"), "v").select("vec_id", "cid", "rep", "copies")
    alone = rows.filter("embedding IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if found is None:
        return alone
    linked = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("linked")).withColumnRenamed("a", "cid")
    joined = components(found.filter("b IS NOT NULL").select("a", "b"), "vector-groups")
    named = joined.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    smallest = named.groupBy("root").agg(F.min("rep").alias("least"))
    least = joined.join(smallest, "root").select(F.col("node").alias("cid"), "least")
    out = members.join(linked, "cid", "left").join(least, "cid", "left")
    component = F.coalesce("least", "rep")
    return out.select(
        "vec_id",
        (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    ).union(alone)
