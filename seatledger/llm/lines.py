"""Removal of boilerplate lines: lines that stand on many sites.

The number of distinct sites of each line comes from HyperLogLog sketches, one
per line hash, which partial aggregation merges before and after the shuffle;
no list of a line's sites is ever held.  Only lines whose estimate is near the
threshold have their sites counted exactly.  A line of few words must stand on
more sites than a longer one.  The first occurrence of a boilerplate line stays,
so that no sentence disappears from the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SITES = 5
MIN_WORDS = 5
#: log2 of the sketch's registers: a standard error of 1.6 %.
SKETCH_BITS = 12
#: Estimates within this share of the threshold (6 standard errors) are counted exactly.
NEAR = 0.1

KEYS = ["h1", "h2"]

_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
#: A word: two characters of a script without spaces, or a letter or digit and what follows it up to white space of any kind.
WORD = rf"(?U)[{_UNSPACED}]{{1,2}}|[\p{{L}}\p{{N}}&&[^{_UNSPACED}]][^\s{_UNSPACED}]*+"


def _opens_with(words: int) -> str:
    """A line that opens with so many words parted by white space; it has at least as many by ``WORD``, which parts more."""
    return rf"(?U)^(?:[^\p{{L}}\p{{N}}]*+[\p{{L}}\p{{N}}]\S*+){{{words}}}"


def occurrences(docs: DataFrame, sites: int = SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """A row per line, with the sites it takes (``need``); ``text_hash`` tells rows of one ``doc_id`` apart."""
    lines = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")))
    line = F.trim("col")
    words = F.regexp_count(line, F.lit(WORD))
    # Most lines are told by their first words; only the others are read whole.
    need = F.when(line.rlike(_opens_with(min_words)), sites).when(words >= min_words, sites).when(words > 0, F.ceil(F.lit(sites * min_words) / words).cast("int"))
    return lines.select(
        "doc_id", "text_hash", F.col("pos").alias("line_no"), "source", F.xxhash64(line).alias("h1"), F.hash(line).alias("h2"),
        need.alias("need"),
    ).filter("need IS NOT NULL")


def widespread(occ: DataFrame) -> DataFrame:
    """The lines on at least ``need`` distinct sites, with their first occurrence."""
    need, band = F.col("need"), F.greatest(F.lit(1), F.ceil(NEAR * F.col("need")))
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("source", SKETCH_BITS))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "line_no"))
    lines = occ.groupBy(*KEYS).agg(estimate.alias("estimate"), first.alias("first"), F.min("need").alias("need"))
    lines = stored(lines.filter(F.col("estimate") >= need - band), "spread")
    near = lines.filter(F.col("estimate") <= need + band).select(*KEYS)
    pairs = occ.filter("source IS NOT NULL").join(near, KEYS, "left_semi").select(*KEYS, "need", "source").distinct()
    exact = pairs.groupBy(*KEYS, "need").agg(F.count("*").alias("n")).filter(F.col("n") >= need).select(*KEYS)
    return lines.filter(F.col("estimate") > need + band).select(*KEYS, "first").union(
        lines.join(exact, KEYS).select(*KEYS, "first")
    )


def remove_widespread(docs: DataFrame, sites: int = SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` freed of boilerplate lines, plus ``n_lines``, ``n_spread`` and ``n_removed``.

    A line (without spaces at its ends) of at least ``min_words`` words is
    boilerplate when it stands on ``sites`` distinct values of ``source`` or
    more; a null source is no site.  A line of fewer words must stand on
    ``sites * min_words / words`` sites: with 5 and 5, one of 3 words on 9 and
    one of a single word on 25.  Words are parted by any white space; in scripts
    without spaces two characters count as a word; signs alone are none.  The first occurrence of a line, by ``doc_id`` and line, stays;
    ``n_spread`` counts it, ``n_removed`` does not.  All rows stay, also those
    left without text; a null text stays null and has no lines.  Rows that repeat
    lose the same lines.  Other columns pass through; columns named like the
    three counts are replaced.  No rows give no rows.  A text's lines are held as
    one array, whatever its length; its removed lines as another.
    """
    occ = stored(occurrences(docs, sites, min_words), "lines")
    hits = occ.join(widespread(occ), KEYS)
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))
    per_doc = hits.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.when(~is_first, F.col("line_no")))).alias("gone"),
        F.count_distinct("line_no").alias("spread"),
    )
    # Whether each line is removed, up to the last that is: found by its number, so that time is in proportion to the lines.
    gap = lambda g, j: F.array_repeat(F.lit(False), g - F.coalesce(F.get("gone", j - 1), F.lit(-1)) - 1)
    mask = F.flatten(F.transform("gone", lambda g, j: F.concat(gap(g, j), F.array(F.lit(True)))))
    per_doc = per_doc.select(
        F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), F.size("gone").alias("n_gone"), mask.alias("mask"), "spread"
    )

    kept = docs.drop("n_lines", "n_spread", "n_removed").alias("d")
    found = kept.join(
        per_doc.alias("p"),
        F.col("d.doc_id").eqNullSafe(F.col("p.of")) & (F.xxhash64("d.text") == F.col("p.hash")),
        "left",
    )
    lines = F.split("d.text", "\n")
    removed = F.coalesce("p.n_gone", F.lit(0))
    rest = F.array_join(F.filter(lines, lambda _, i: ~F.coalesce(F.get("p.mask", i), F.lit(False))), "\n")
    text = F.when(removed > 0, rest).otherwise(F.col("d.text"))
    return found.select(
        *[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in kept.columns],
        F.when(F.col("d.text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce("p.spread", F.lit(0)).cast("int").alias("n_spread"),
        removed.alias("n_removed"),
    )
