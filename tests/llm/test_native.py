"""Line dedup and sharding against SQL and brute force; no Python in their plans."""

import zlib
from collections import Counter

import compare
from pyspark.sql import functions as F

from seatledger.llm import lines, queries, sharding


def test_line_dedup_equals_sql(spark, sf):
    con = compare.connect(sf)
    for name in ("op3_line_spread", "op4_chosen_path_join", "op5_incremental_chat", "op9_pivot_join"):
        assert compare.difference(queries.queries()[name](spark, sf), con, queries.oracle_sql()[name]) is None, name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_plans(spark, sf):
    for name in ("op3_line_spread", "op8_feistel_shards"):
        text = plan(queries.queries()[name](spark, sf))
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_thresholds_and_first_occurrence(spark):
    line = "one two three four five"
    rows = [(i, f"{line}\nown text number {i} of all", f"s{i}") for i in range(5)]
    rows += [(10 + i, "six seven eight nine ten", f"s{i}") for i in range(4)]
    got = {r.doc_id: r for r in lines.remove_widespread(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [got[i].n_spread for i in range(5)] == [1] * 5 and [got[i].n_removed for i in range(5)] == [0, 1, 1, 1, 1]
    assert got[0].text.startswith(line) and got[3].text == "own text number 3 of all"
    assert all(got[10 + i].n_spread == 0 for i in range(4))


def test_lines_without_spaces_and_short_lines(spark):
    chinese, thai = "版权所有，未经许可不得转载", "สงวนลิขสิทธิ์ตามกฎหมาย"
    spread = {"one\ttwo\tthree\tfour\tfive": 5, "one\u00a0two\u00a0three\u00a0four\u00a0five": 5, chinese: 5, thai: 5}
    spread |= {"All rights reserved.": 9, "Read more": 13, "Menu": 25}
    rare = {"a\tb\tc\td\te": 4, "版权所有": 12, "Some rights reserved.": 8, "Read less": 12, "And.": 24, "-----": 30, "": 30}
    rows = [(i * 100 + k, f"{line}\nown{i}x{k}", f"s{k}") for i, (line, n) in enumerate((spread | rare).items()) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lines.remove_widespread(docs).collect()
    gone = {r.doc_id for r in got if r.n_removed}
    assert gone == {i * 100 + k for i, n in enumerate(spread.values()) for k in range(1, n)}
    assert {r.text for r in got if r.n_removed} == {f"own{d // 100}x{d % 100}" for d in gone}


def test_many_sites_and_a_hot_line(spark):
    """One line in every row on 300 sites: the sketch decides; near the threshold counts are exact."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("a b c d e f\nrow "), F.col("id").cast("string"), F.lit(" has its own words")).alias("text"),
        (F.col("id") % 300).cast("string").alias("source"),
    )
    for sites, removed in ((300, 2999), (301, 0), (100, 2999)):
        assert lines.remove_widespread(docs, sites).agg(F.sum("n_removed")).first()[0] == removed


def test_messy_lines(messy, nothing):
    got = lines.remove_widespread(messy, sites=2).collect()
    assert len(got) == messy.count()
    assert all(r.n_lines == 0 and r.text is None for r in got if r.doc_id == 2)
    assert [r.n_removed for r in got if r.doc_id == 1] == [0, 0]
    assert [r.n_removed for r in got if r.doc_id is None and r.source == "c" and r.n_lines] == [1]
    assert lines.remove_widespread(nothing).count() == 0


def test_shards(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.shards(docs).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw)) and r.law == "rows"
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert {(r.shard, r.slot) for r in rows} == {(s, i) for s, n in sizes.items() for i in range(n)}
    again = sharding.shards(docs.repartition(7)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_permutations_of_every_size(spark):
    for n in (1, 2, 3, 7, 10, 97, 1000, 1023):
        out = [r.p for r in spark.range(n).select(sharding.permuted(spark, F.col("id"), n, key=n).alias("p")).collect()]
        assert sorted(out) == list(range(n))


def test_messy_shards(messy, nothing):
    rows = sharding.shards(messy, 3).collect()
    assert len(rows) == messy.count() == len({(r.shard, r.slot) for r in rows})
    assert sharding.shards(nothing).count() == 0


def test_a_text_with_many_removed_lines(spark):
    body = "\n".join(f"boilerplate line with number {i}" for i in range(30_000))
    rows = [(i, f"first {i}\n{body}\nlast {i}", f"s{i}") for i in range(6)]
    got = lines.remove_widespread(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: r.text for r in got if r.doc_id} == {i: f"first {i}\nlast {i}" for i in range(1, 6)}
    assert {r.n_removed for r in got} == {0, 30_000}
