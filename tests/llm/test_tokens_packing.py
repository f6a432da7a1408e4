"""Token counts and packing against the library and against bounds."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
import public_tokenizers

from seatledger.llm import packing, tokens
from seatledger.llm.common import stored

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["the ", "a", "  ", "\n\n", "'re", "'", "s<|endoftext|>", "<|startoftext|>X", "É", "é", " ́", "　", "\x1c"]
PARTS += ["\x85", "İ", "ΑΣ ", "日本", "🙂", " 12", "...", "\t", "Word, ", "word."]


def texts(n, most):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("overlap", [32, 512])
def test_counts_equal_the_library(spark, overlap):
    rows = list(enumerate(texts(60, 700))) + [(60, "a" * 9000), (61, " " * 5000), (62, "ab " * 3000 + "x" * 3000 + " cd" * 2000)]
    encode = tokens.tokenizer(BYTES).encode
    expected = {i: len(encode(t, add_special_tokens=False).ids) for i, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = tokens.token_counts(df, BYTES, overlap=overlap).collect()
    assert {r.doc_id: r.n_tokens for r in got} == expected
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_counts_of_messy_rows(messy, nothing):
    got = tokens.token_counts(messy, BYTES).collect()
    assert len(got) == messy.count()
    assert [(r.n_bytes, r.n_tokens) for r in got if r.doc_id in (2, 3)] == [(0, 0), (0, 0)]
    assert tokens.token_counts(nothing, BYTES).count() == 0


def test_ids_equal_the_library():
    encode = tokens.tokenizer(WORDS).encode
    for t in texts(800, 40):
        assert packing.token_ids(t, WORDS).tolist() == encode(t, add_special_tokens=False).ids, t


def test_memory_forgets_and_gives_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    memory = tokens.Memory(lambda words: [w.upper() for w in words])
    for words in (["a", "b", "c", "d"], ["e", "a"], ["x" * 200, "b"], ["f", "a", "f"]):
        assert memory.of(words) == [w.upper() for w in words]
    assert "x" * 200 not in memory


def check_places(rows, capacity):
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans)


def test_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cut = stored(packing.pieces(docs, WORDS), "pieces")
    rows = packing.pack(cut).collect()
    assert len(rows) == cut.count()
    assert check_places(rows, 2048) <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_packing_of_messy_rows(messy, nothing):
    rows = packing.packed(messy, WORDS, 64).collect()
    assert check_places(rows, 64)
    assert sum(r.length == 1 and r.doc_id == 2 for r in rows) == 1
    assert packing.packed(nothing, WORDS).count() == 0


def test_configurations_hold_exactly_the_pieces():
    rng = random.Random(1)
    for scale in (1, 50):
        need = Counter({n: rng.randint(1, 9) * scale for n in rng.sample(range(1, 201), 60)})
        found = packing.configurations(dict(need), 200)
        held = Counter()
        for config, times in found.items():
            assert sum(n * k for n, k in config) <= 200
            held.update({n: k * times for n, k in config})
        assert held == need
        least = -(-sum(n * k for n, k in need.items()) // 200)
        assert sum(found.values()) <= 1.06 * least + 2


def test_awkward_lengths_beat_first_fit():
    """Three kinds that fill a sequence only together: the program finds the mixture."""
    assert sum(packing.configurations({51: 1000, 27: 1000, 22: 1000}, 100).values()) <= 1010


def test_words_forgotten_give_the_same_ids(monkeypatch):
    encode = tokens.tokenizer(WORDS).encode
    for known in (0, 200):
        monkeypatch.setattr(packing, "KNOWN", known)
        monkeypatch.setattr(packing, "STRETCHES", 3)
        packing._known.cache_clear()
        for t in texts(200, 40) + ["", "a " * 50, "x" * 5000]:
            assert packing.token_ids(t, WORDS).tolist() == encode(t, add_special_tokens=False).ids, t
    packing._known.cache_clear()


def test_workers_hold_little_beside_the_ids():
    """What stays of 200,000 words, and what a text of few words takes for a moment."""
    rng = random.Random(2)
    words = list({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(200_000)})
    packing.token_ids("warm up", WORDS)
    packing._known.cache_clear()
    few = pa.array([" ".join(words[:1000] * 500)])
    held = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for start in range(0, len(words), 50_000):
            packing.all_ids(pa.array([" ".join(words[start : start + 50_000])]), WORDS)
        kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - held
        tracemalloc.reset_peak()
        ids, _ = packing.all_ids(few, WORDS)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        packing._known.cache_clear()
    assert kept < 20e6
    assert peak - kept < ids.nbytes + 30e6


def test_places_need_no_python_rows(spark, monkeypatch):
    """Plain rows would go through workers of another kind, beside those that made the pieces."""
    cut = spark.range(9).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "id % 3 + 1 AS length", "id AS ids_crc32")
    made, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: made.append(type(data)) or create(self, data, *a, **k))
    assert packing.pack(cut, 4).count() == 9
    assert made == [pa.Table]
