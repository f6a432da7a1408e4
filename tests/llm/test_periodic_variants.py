"""Periodic runs and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from seatledger.llm import periodic, variants
from seatledger.llm.queries import queries
from seatledger.llm.recompression import Grammar


def slow_runs(words):
    """All periods one after the other; a stretch counts with its smallest."""
    found, seen = [], set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q) and (i, length) not in seen:
                seen.add((i, length))
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = [rng.randrange(rng.randint(1, 3)) for _ in range(rng.randint(0, 60))]
    if words and rng.random() < 0.5:
        p, a = rng.randint(1, max(1, len(words) // 4)), rng.randrange(len(words))
        p = min(p, len(words) - a)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    return words * rng.randint(1, 12) if rng.random() < 0.1 else words


def test_common_extensions():
    rng = random.Random(5)
    for _ in range(30):
        words = [rng.randrange(3) for _ in range(rng.randint(2, 400))] * rng.randint(1, 3)
        sequence = np.array([-1, *words, -2])
        grammar = Grammar(sequence)
        a = np.array([rng.randrange(1, len(sequence) - 1) for _ in range(200)])
        b = np.array([rng.randrange(1, len(sequence) - 1) for _ in range(200)])
        a, b = a[a != b], b[a != b]
        for i, j, ahead, back in zip(a, b, grammar.common(a, b), grammar.mirrored().common(len(sequence) - 1 - a, len(sequence) - 1 - b)):
            n = next(k for k in range(len(sequence)) if sequence[i + k] != sequence[j + k])
            m = next(k for k in range(len(sequence)) if sequence[i - k] != sequence[j - k])
            assert (ahead, back) == (n, m)


def test_runs_equal_all_periods():
    rng = random.Random(1)
    for _ in range(150):
        texts = [random_words(rng) for _ in range(rng.randint(1, 30))]
        for words, found in zip(texts, periodic.runs([np.array(t, np.int64) for t in texts])):
            assert [tuple(r) for r in found.tolist()] == slow_runs(words)


def test_long_texts_take_little_more_than_their_length():
    rng = random.Random(2)
    same = np.zeros(300_000, np.int64)
    mixed = np.array([i % 7 for i in range(100_000)] + [rng.randrange(50) for _ in range(200_000)])
    assert periodic.runs([same])[0].tolist() == [[0, 300_000, 1]]
    assert periodic.runs([mixed])[0].tolist()[0][::2] == [0, 7]


def expected_digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, left)]
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, *digests)


def sortable(rows):
    return sorted(map(tuple, rows), key=repr)


def test_query_on_the_given_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text or "") < 6000]
    found = {r.doc_id: tuple(r) for r in queries()["op12_recompression_runs"](spark, sf).collect()}
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert sum(r[1] > 0 for r in found.values()) > 10
    for doc_id, text in docs:
        assert found[doc_id] == expected_digest(doc_id, text)


def test_messy_runs(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    expected = [expected_digest(*r) for r in rows if len(r[1] or "") < 6000]
    found = periodic.run_digests(messy, planted=True)
    assert found.count() == len(rows)
    assert set(expected) <= {tuple(r) for r in found.collect()}
    assert periodic.run_digests(nothing, planted=True).count() == 0
    assert periodic.collapsed(nothing).count() == 0


def test_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "x " + "a b " * 5 + "y"), (2, "as  it is"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in periodic.collapsed(docs).collect()}
    assert found[1].text == "x a b y" and [tuple(r) for r in found[1].runs] == [(1, 10, 2)]
    assert found[2].text == "as  it is" and found[3].text is None


# --- spelling variants ------------------------------------------------------


def slow_words(rows, planted=True):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def slow_variants(words):
    """By what is left without each character: words one edit apart meet there."""
    left = {}
    for w in words:
        for i in range(len(w)):
            left.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for (_, rest), group in left.items():
        group = group | ({rest} & words.keys())
        for a in group:
            near[a] |= {b for b in group if b != a and (len(a) == len(b) or rest in (a, b))}
    out = {}
    for w, n in words.items():
        form = min(near[w], key=lambda x: (-words[x], x), default=None)
        if form is not None and words[form] < 10 * n:
            form = None
        out[w] = [w, form, None, n, len(near[w]), words[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][1]:
            root = out[root][1]
        row[2] = root
    return sortable(out.values())


def test_query_on_the_given_words(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = slow_variants(slow_words(rows))
    assert sum(r[1] is not None for r in expected) >= 10
    assert sortable(queries()["op13_trie_variants"](spark, sf).collect()) == expected


@pytest.mark.parametrize("letters", ["ab", "abcdefghé"])
def test_dense_words(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 9))): rng.choice([2, 3, 30, 400]) for _ in range(600)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sortable(variants.variants(table).collect()) == slow_variants(words)


def test_words_of_any_length(spark):
    rng = random.Random(3)
    words = {}
    for size in (31, 32, 33, 60, 700):
        word = "".join(rng.choice("abcdefÿ") for _ in range(size))
        words[word] = 500
        for i in (0, size // 2, size - 1):
            words[word[:i] + word[i + 1 :]] = 20
            words[word[:i] + "z" + word[i + 1 :]] = 2
            words[word[:i] + "q" + word[i:]] = 3
    words |= {"a" * n: n for n in range(28, 40)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sortable(variants.variants(table).collect()) == slow_variants(words)


def test_messy_variants(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    assert sortable(variants.spelling_variants(messy).collect()) == slow_variants(slow_words(rows, planted=False))
    assert variants.spelling_variants(nothing).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("Réference reference referenc").alias("text"))
    found = {r.word: r for r in variants.spelling_variants(hot).collect()}
    assert found["reference"].n == 3000 and found["referenc"].n_near == 1 and found["réference"].n_near == 1
