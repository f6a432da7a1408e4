"""Reproducible shuffle into shards: a keyed Feistel permutation of global row numbers.

Every row gets a number 0..n-1 that depends on the rows alone: rows are dealt
to buckets by a hash, counted per bucket, and numbered inside each bucket by
``doc_id`` and text.  The permutation splits a number into two digits of bases
``a`` and ``b`` with ``a * b >= n``, mixes one digit with a keyed hash of the
other in each round, and walks again while the result is not below ``n``.
Shard and slot are then arithmetic: ``p % shards`` and ``p div shards``.  Anyone
who knows ``n`` and the key can compute where a row number went, without data.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ROUNDS = 6


def _bases(n: int) -> tuple[int, int]:
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _rounds(x: Column, a: int, b: int, key: int) -> Column:
    """One pass of the network over 0..a*b-1: each round adds a keyed hash of one digit to the other."""
    right = x % b
    left = ((x - right) / b).cast("long")
    for r in range(0, ROUNDS, 2):
        left = (left + F.pmod(F.xxhash64(F.lit(key), F.lit(r), right), F.lit(a))) % a
        right = (right + F.pmod(F.xxhash64(F.lit(key), F.lit(r + 1), left), F.lit(b))) % b
    return left * b + right


def _longest_walk(spark, n: int, a: int, b: int, key: int) -> int:
    """The number of passes after which every number below ``n`` has come back below ``n``.

    A walk leaves 0..n-1 only through the a*b-n < a numbers above, so the walks
    of those numbers bound all others: about the square root of ``n`` rows.
    """
    if n == 0:
        return 1
    steps, out = 1, spark.range(n, a * b).select(F.col("id").alias("p"))
    while out.limit(1).count():
        steps += 1
        out = out.select(_rounds(F.col("p"), a, b, key).alias("p")).filter(F.col("p") >= n)
        if steps % 8 == 0:
            out = stored(out, "walks")
    return steps


def permuted(spark, number: Column, n: int, key: int = 0) -> Column:
    """``number`` (0..n-1) after the permutation of 0..n-1 chosen by ``key``."""
    a, b = _bases(n)
    steps = _longest_walk(spark, n, a, b, key)
    first = _rounds(number, a, b, key)
    if steps == 1:
        return first
    return F.aggregate(
        F.sequence(F.lit(2), F.lit(steps)),
        first,
        lambda p, _: F.when(p < n, p).otherwise(_rounds(p, a, b, key)),
    )


def numbered(rows: DataFrame, by: list[str], buckets: int = 1 << 14) -> tuple[DataFrame, int]:
    """``rows`` with ``row_number`` 0..n-1, and n.

    ``by`` must tell unequal rows apart; equal rows are interchangeable.
    Offsets are sums over at most ``buckets`` counts.
    """
    from pyspark.sql import Window as W

    kept = stored(rows.withColumn("bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")), "numbered")
    counts = kept.groupBy("bucket").agg(F.count("*").alias("n"))
    ahead = F.coalesce(F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("bucket", ahead.alias("ahead"))
    place = F.row_number().over(W.partitionBy("bucket").orderBy(*by)) - 1
    n = kept.count()
    with_place = kept.withColumn("place", place).join(F.broadcast(offsets), "bucket")
    return with_place.withColumn("row_number", (F.col("ahead") + F.col("place")).cast("long")).drop("bucket", "place", "ahead"), n


def shards(docs: DataFrame, count: int = 40, key: int = 0) -> DataFrame:
    """Shard and slot of every row of ``docs (doc_id, text)``: law ``rows``.

    Shard sizes differ by one row at most; slots are gapless from 0.  A null
    text has no bytes and the checksum of the empty text; a null ``doc_id`` is
    numbered like any other value.  Rows that repeat each get a place of their
    own.  Other columns are not read.  An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    placed, n = numbered(rows, ["doc_id", "text_hash", "text_crc32", "size"])
    p = placed.select(
        "doc_id", "size", "text_crc32", "row_number", permuted(docs.sparkSession, F.col("row_number"), n, key).alias("p")
    )
    shard = F.col("p") % count
    return p.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        ((F.col("p") - shard) / count).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
