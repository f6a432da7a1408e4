"""Spelling variants: words one edit apart, found on a distributed trie.

The trie is a table of edges (node, char), a node being the prefix it stands
for.  A state (word, position, node, edits) says that the word's first
``position`` characters lead to ``node`` with so many edits.  All states of one
position are joined with the edges of their nodes at once: a state without an
edit takes the edges that differ from its next character (replaced) or stays
where it is (deleted), one with an edit takes the edge of its next character
only.  States that reach the word's end with one edit at a node that is a word
are neighbours.  Each edge also carries a mask of what can follow it, so that a
state that has no way on is not written at all.

Near the root a trie is so dense that every word would pass through every node.
So edits start in the second half of a word only, and a second trie of the
reversed words finds those in the first half.  Longer words find shorter ones,
and of two words of one length the one with the smaller character finds the
other; each pair comes up once.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, stored

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word's form occurs at least so many times as often.
RATIO = 10
#: Longer words are compared by checksums of what is left without one character instead of level by level.
LONG = 32
#: One in so many runs loses a character in the query.
PLANT = 31


def occurrences(docs: DataFrame, planted: bool = False, least: int = LEAST_LENGTH) -> DataFrame:
    """A row ``word`` per run of letters of at least ``least`` code points; only A to Z become lower case."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(found).alias("word"))
    if planted:
        key = F.crc32(F.concat("doc", F.lit(":"), "word").cast("binary"))
        at = (key % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.select(F.when(key % PLANT == 0, cut).otherwise(F.col("word")).alias("word"))
    return words.select("word").filter(F.length("word") >= least)


def counted(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _char(text: str, at: Column | int) -> Column:
    return F.substring(text, at + 1, F.lit(1)) if isinstance(at, Column) else F.substring(text, at + 1, 1)


def _prefix(text: str, n: Column | int) -> Column:
    return F.substring(text, F.lit(1), n) if isinstance(n, Column) else F.substring(text, 1, n)


def _both_ways(words: DataFrame) -> DataFrame:
    """Each word forwards and backwards, with the first position at which it may be edited."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    ahead = words.select(F.lit(False).alias("back"), "word", "n", half.alias("start"))
    back = words.select(F.lit(True).alias("back"), F.reverse("word").alias("word"), "n", (size - half).alias("start"))
    return ahead.union(back)


def _bit(char: Column) -> Column:
    """A character's place in a mask of 64; others may share it.  Nothing, where a word ends, has one too."""
    place = F.when(char == "", 62).otherwise(F.ascii(char) % 64).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _edges(ways: DataFrame) -> DataFrame:
    """The trie's edges below the nodes any state can reach, by depth, with the mask of what follows."""
    depths = F.sequence(F.floor(F.length("word") / 2).cast("int"), F.length("word") - 1)
    steps = ways.select("back", "word", F.explode(depths).alias("depth"))
    at = F.col("depth")
    rows = steps.select("back", _prefix("word", at).alias("node"), _char("word", at).alias("char"), _bit(_char("word", at + 1)).alias("next"))
    edges = rows.groupBy("back", "node", "char").agg(F.bit_or("next").alias("next"))
    return edges.select("*", F.ascii("char").alias("code"), F.length("node").alias("depth")).sortWithinPartitions("depth")


def _step(ways: DataFrame, edges: DataFrame, states: DataFrame | None, k: int) -> DataFrame:
    """The states with one edit at position ``k + 1``, from those at ``k``."""
    here = ways.filter((F.col("start") <= k) & (F.length("word") > k))
    # A word's own path is in the trie: its state without edits needs no join.
    exact = here.select("back", "word", "n", _prefix("word", k).alias("node"), F.lit(0).alias("edits"))
    # Equal characters in a row give the same word whichever is deleted: the last of them forwards, the first backwards.
    beside = F.when(F.col("back"), _char("word", k - 1)).otherwise(_char("word", k + 1))
    deleted = exact.filter(_char("word", k) != beside).withColumn("edits", F.lit(1))
    if states is not None:
        exact = exact.union(states.filter(F.length("word") > k).select(*exact.columns))
    # What a state needs is worked out once, not for every edge it meets.
    code = F.ascii(_char("word", k))
    exact = exact.select("*", code.alias("at"), _bit(_char("word", k + 1)).alias("then"))
    near = edges.filter(F.col("depth").between(k - 1, k)).select("back", "node", "char", "code", "next")
    goes = F.when(F.col("edits") == 0, F.col("code") > F.col("at")).otherwise(F.col("code") == F.col("at"))
    moved = exact.join(near, ["back", "node"]).filter(goes & (F.col("next").bitwiseAND(F.col("then")) != 0))
    moved = moved.select("back", "word", "n", F.concat("node", "char").alias("node"), F.lit(1).alias("edits"))
    return moved.union(deleted)


def _trie_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``word, n, near`` of words of at most LONG code points and what may be a word."""
    ways = stored(_both_ways(words), "words")
    longest = ways.agg(F.max(F.length("word"))).first()[0] or 0
    edges = stored(_edges(ways), "edges")
    states, ends = None, []
    for k in range(LEAST_LENGTH // 2, longest):
        states = stored(_step(ways, edges, states, k), "frontier")
        ends.append(states.filter(F.length("word") == k + 1).select("back", "word", "n", "node"))
    if not ends:
        return words.select("word", "n", F.col("word").alias("near")).limit(0)
    found = ends[0]
    for more in ends[1:]:
        found = found.union(more)
    turned = [F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c)).alias(name) for c, name in (("word", "word"), ("node", "near"))]
    return found.select(turned[0], "n", turned[1])


_PRIMES, _BASES = (2147483647, 2147483629), (911382323, 972663749)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.int64)
    size = 1
    while size < n:
        step = pow(base, size, prime)
        more = out[: min(size, n - size)] * step % prime
        out[size : size + len(more)] = more
        size *= 2
    return out


def _checksums(word: str) -> tuple[int, np.ndarray]:
    """A checksum of the word and one of what is left without each of its characters."""
    chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    whole, without = 0, np.zeros(len(chars), np.int64)
    for prime, base in zip(_PRIMES, _BASES):
        sums = np.r_[0, np.cumsum(chars * _powers(base, prime, len(chars)) % prime)]
        after = (sums[-1] - sums[1:]) % prime * pow(base, -1, prime) % prime
        whole = whole << 31 | int(sums[-1] % prime)
        without = without << 31 | (sums[:-1] + after) % prime
    return whole, without


def _long_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["word", "at", "key"]
    for batch in batches:
        for part in slices(batch, "word", 1 << 14):
            for word in part.column("word").to_pylist():
                whole, without = _checksums(word)
                columns = [pa.array([word] * (len(word) + 1)), pa.array(range(-1, len(word)), pa.int32()), pa.array([whole, *without.tolist()])]
                yield pa.record_batch(columns, names)


def _long_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``word, n, near`` for words of more than LONG code points, not yet compared exactly.

    A word is one edit from a longer one if it is what is left of it without a
    character, and from one of its length if both leave the same without the
    same place.  Of the latter no group has more than the alphabet's size.
    """
    ids = words.filter(F.length("word") >= LONG).select("word", "n", F.xxhash64("word").alias("id"))
    ids = stored(ids, "long-words")
    keys = map_arrow(ids.select("word"), _long_keys, "word string, at int, key long")
    keys = stored(keys.select(F.xxhash64("word").alias("id"), F.length("word").alias("size"), "at", "key").distinct(), "long-keys")
    left = keys.filter("at >= 0").select(F.col("id").alias("a"), (F.col("size") - 1).alias("size"), "at", "key")
    whole = keys.filter("at < 0").select(F.col("id").alias("b"), "size", "key")
    shorter = left.select("a", "size", "key").distinct().join(whole, ["size", "key"]).select("a", "b")
    other = left.select(F.col("a").alias("b"), "size", "at", "key")
    same = left.join(other, ["size", "at", "key"]).filter("a < b").select("a", "b")
    pairs = shorter.union(same).distinct()
    one = ids.select(F.col("id").alias("a"), "word", "n")
    two = ids.select(F.col("id").alias("b"), F.col("word").alias("near"))
    found = pairs.join(one, "a").join(two, "b").select("word", "n", "near")
    # Words of exactly LONG code points are compared with each other on the trie.
    return found.filter((F.length("word") > LONG) | (F.length("near") > LONG))


def neighbours(words: DataFrame) -> DataFrame:
    """All pairs ``word, n, near, n_near`` of ``words (word, n)`` that are one edit apart, each both ways.

    An edit inserts, deletes or replaces one code point.  Words occur once in
    the table.
    """
    candidates = _trie_pairs(words.filter(F.length("word") <= LONG)).union(_long_pairs(words))
    candidates = candidates.filter(F.levenshtein("word", "near", 1) == 1)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = stored(candidates.join(known, "near").select("word", "n", "near", "near_n"), "neighbours")
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms end.  Each form is RATIO times as frequent, so chains are short."""
    most = forms.agg(F.max("form_n")).first()[0] or 1
    steps = 0
    while RATIO**steps <= most:
        steps += 1
    roots, reach = forms.select("word", F.col("form").alias("root")), 1
    while reach < steps:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        reach *= 2
    return roots


def variants(words: DataFrame) -> DataFrame:
    """Per row of ``words (word, n)``: ``word, form, root, n, n_near, form_n``.

    ``n_near`` words are one edit apart; ``form`` is the most frequent of them
    (ties: the smallest) if it occurs ``RATIO`` times as often, else null; ``root``
    is where following the forms ends, the word itself if it has none.  No words
    give no rows.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    enough = -F.col("best.minus") >= RATIO * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    found = stored(found, "forms")
    roots = _roots(found.filter("form IS NOT NULL").select("word", "form", "form_n"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The variants among the words of ``docs (doc_id, text)`` that occur twice or more.

    Words are runs of letters (A to Z and U+00C0 to U+00FF) of at least
    ``LEAST_LENGTH`` code points; only A to Z are lower-cased.  ``planted`` deletes a
    character of one run in ``PLANT``, chosen by the checksum of ``doc_id`` and run.
    A null ``doc_id`` counts as empty there; null and empty texts have no words;
    repeated rows count again; other columns are not read.
    """
    return variants(counted(occurrences(docs, planted)))
