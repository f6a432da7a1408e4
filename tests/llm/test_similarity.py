"""Similarity joins, decontamination and their graph against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatledger.llm import decontamination, embeddings, graph, jaccard, words


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    pairs += [(5000, 5000 + i) for i in range(200)]
    df = spark.createDataFrame([*pairs, (None, 4), (7, 7)], "a long, b long")
    expected = closure({x for p in pairs for x in p}, pairs)
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert got == {n: expected[n] for n in got} and {a for a, b in pairs if a != b} <= set(got)
    assert graph.components(df.limit(0)).count() == 0


def near_texts(n_groups, group, rng, size=120):
    out = []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(size)]
        for _ in range(group):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(size)] = f"w{rng.randrange(4000)}"
            out.append(" ".join(text))
    return out


def brute(texts):
    sets = [
        {" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if (w := re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())) else set()
        for t in texts
    ]
    return [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9
    ]


def test_join_finds_every_link(spark, monkeypatch):
    """With tiny nodes and blocks every path is walked: splits, whole nodes, several blocks."""
    for name, value in (("SMALL", 4), ("MEDIUM", 8), ("BLOCK_CLASSES", 16)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(8)
    texts = near_texts(3, 40, rng) + near_texts(30, 3, rng) + near_texts(1, 60, rng, 40)
    shared = " ".join(f"common{i}" for i in range(60))
    texts += [f"{shared} " + " ".join(f"x{rng.randrange(9999)}" for _ in range(40)) for _ in range(40)]
    texts += [texts[0]] * 5 + ["", "tiny text", "tiny text", "Tiny, TEXT!"]
    rng.shuffle(texts)
    got = {r.doc_id: r for r in jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    links = brute(texts)
    expected = closure(range(len(texts)), links)
    assert {i: r.class_id for i, r in got.items()} == expected
    counts = np.bincount([x for p in links for x in p], minlength=len(texts))
    assert [got[i].n_links for i in range(len(texts))] == counts.tolist()
    assert all(r.kept == (r.class_id == i) for i, r in got.items())


def test_messy_join(messy, nothing):
    got = jaccard.near_duplicates(messy).collect()
    assert len(got) == messy.count()
    assert sorted((r.class_id, r.n_links) for r in got if r.doc_id == 1) == [(1, 1), (1, 1)]
    assert all(r.kept and r.n_links == 0 for r in got if r.doc_id in (None, 2, 3, 4, 7))
    assert [r.n_links for r in got if r.doc_id == 5] == [1, 1]
    assert jaccard.near_duplicates(nothing).count() == 0


def test_words_are_those_of_the_pattern():
    texts = ["", "A b-c\x00d", "ÉÉ é,日本 x1", "a" * 50, " lead", "trail "] * 3
    seen = {}
    for text, hashes in zip(texts, words.word_hashes(texts)):
        for word, h in zip(re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower()), hashes.tolist(), strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("block", [7, 4096])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    rows = np.concatenate([base, base[:25] + 0.12 * rng.normal(size=(25, 16)), base[:1] + 0.08 * rng.normal(size=(40, 16)), base[:3] * 2])
    rows = rows.astype(np.float32)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    links = [(i, j) for i, j in zip(*np.nonzero(near)) if i > j]
    data = [(i, v.tolist()) for i, v in enumerate(rows)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [1.0] * 15 + [None]), (904, [float("inf")] * 16), (905, [1.0, 2.0])]
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(data + odd, "vec_id long, embedding array<float>")).collect()}
    expected = closure(range(len(rows)), links)
    assert {i: got[i].component_id for i in range(len(rows))} == expected
    assert [got[i].n_links for i in range(len(rows))] == (near.sum(1) - 1).tolist()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(none).count() == 0


def test_leaks(spark, sf):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rng = random.Random(4)
    items = {r.item_id: r.text for r in bench.collect()}
    plain = [r.text.split() for r in docs.filter("lang = 'en'").limit(60).collect()]
    made = []
    for k, text in items.items():
        for share in (0.0, 0.15):
            host = rng.choice(plain)
            at = rng.randint(0, len(host))
            said = [rng.choice(host) if rng.random() < share else w for w in text.split()]
            made.append((10_000 + 10 * k + int(share > 0), " ".join(host[:at] + said + host[at:])))
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(rows, bench).collect()}
    find = re.compile(r"[a-z0-9\x80-\U0010ffff]+").findall
    bodies = {r.doc_id: " ".join(find(r.text.lower())) for r in rows.collect()}
    exact = {(d, i) for i, t in items.items() if len(q := find(t.lower())) >= 5 for d, b in bodies.items() if f" {' '.join(q)} " in f" {b} "}
    assert exact <= got
    assert sum((10_001 + 10 * k, k) in got for k in items) >= 0.9 * len(items)
    # Nothing else: every other finding is a reworded item that was planted, or holds most of its words in order.
    assert all(d >= 10_000 or (d, i) in exact for d, i in got)


def test_common_subsequence_is_longest():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 15))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        bits = decontamination.common_subsequence(decontamination.word_bits(np.array(a)), len(a), b)
        assert bits.bit_count() == table[-1, -1]


def test_items_copied_into_many_documents_are_found(spark):
    """Copies of one item in most documents make all its words frequent; an item of frequent words alone likewise."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    often = " ".join(f"copied{i}" for i in range(30)) + ". its answer is seven."
    plain = "red red green blue red green. blue green red red blue."
    rows = []
    for i in range(300):
        host = [rng.choice(vocabulary) for _ in range(80)] + rng.sample(["red", "green", "blue"], 3)
        at = rng.randrange(80)
        rows.append((i, " ".join([*host[:at], *([often] if i % 3 else []), *([plain] if i % 10 == 0 else []), *host[at:]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, often), (2, plain), (3, " ".join(vocabulary[:40]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    assert {(i, 1) for i in range(300) if i % 3} <= got and {(i, 2) for i in range(0, 300, 10)} <= got
    assert not {(i, 1) for i in range(0, 300, 3)} & got and not any(k == 3 for _, k in got)


def test_messy_leaks(spark, messy, nothing):
    bench = spark.createDataFrame(
        [(1, "one two three four five six seven."), (2, None), (None, "x y z x y z"), (3, ""), (4, "a b")], "item_id long, text string"
    )
    found = decontamination.leaks(messy, bench)
    assert sorted((r.doc_id is None, r.doc_id, r.item_id) for r in found.collect()) == [(False, 1, 1), (False, 1, 1), (True, None, 1)]
    assert decontamination.decontaminated(messy, bench).count() == messy.count() - 3
    assert decontamination.leaks(nothing, bench).count() == 0
    assert decontamination.leaks(messy, bench.limit(0)).count() == 0
