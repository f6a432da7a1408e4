"""Token counts of whole texts, and token ids of words, as the tokenizer library gives them.

Short texts are counted pre-token by pre-token: the library encodes each new
pre-token once and a bounded memory keeps its length.  Huge texts are cut into
blocks that overlap; every block is encoded on its own, so one text is many
tasks' work, and neighbours are spliced where both agree.

Why a splice is exact.  The byte-level tokenizer splits a text from left to
right into pre-tokens and merges inside them only; where the next pre-token
starts, nothing before it matters any more.  Let ``p`` be the start of a
pre-token in both encodings of an overlap, at least ``MARGIN`` characters before
the end of the left block.  The left block is right up to ``p``, as no rule
looks further ahead than ``MARGIN`` (a special string, a contraction, the
character after white space), and from ``p`` on the right block reads the same
text from the same state.  So the count is the left block's tokens before ``p``
plus the right block's from ``p``.  Where an overlap has no such ``p`` (say, in
one endless word) the document is cut again with overlaps four times as wide,
until one block holds it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, stored

#: More than the longest look-ahead: the special string's 13 characters.
MARGIN = 16
OVERLAP = 512
#: A block is this many overlaps long.
BLOCK = 32
#: Remembered words of each of two generations.
REMEMBERED = 250_000
#: Longer words are encoded each time.
LONGEST = 100

_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin text: here the classes of all regular-expression libraries agree.
_OTHER = re.compile("[^\t\n\r -~¡-ɏ]")


class Memory(dict):
    """Values of words, made by ``make`` for lists of new words; forgets words not met for long."""

    def __init__(self, make: Callable[[list[str]], Iterable]):
        super().__init__()
        self.make, self.old = make, {}

    def of(self, words: list[str]) -> list:
        """The values of ``words``, in order."""
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()
        new = []
        for word in {w for w in set(words) if w not in self}:
            if (value := self.old.get(word)) is None:
                new.append(word)
            else:
                self[word] = value
        for start in range(0, len(new), 1000):
            part = new[start : start + 1000]
            self.update(zip(part, self.make(part)))
        values = list(map(self.__getitem__, words))
        for word in new:
            if len(word) > LONGEST:
                del self[word]
        return values


@cache
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Letters in composed form with one-letter lower forms: one pre-token, the same before and after normalizing.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


@cache
def plain_word(path: str) -> Callable[[str], list[int]]:
    """Ids of a word of such letters, with or without a space before it, from the library's model alone.

    The model works on bytes written as characters; the library's own
    pre-tokenizer gives the writing.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    write = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    table = {ord(c): write(c)[0][0] for c in map(chr, range(32, 256)) if c == " " or LETTERS.fullmatch(c)}
    model = tokenizer(path).model.tokenize
    return lambda word: [t.id for t in model(word.translate(table))]


def _lengths(path: str) -> Callable[[list[str]], list[int]]:
    encode, plain, is_plain = tokenizer(path).encode_batch_fast, plain_word(path), LETTERS.fullmatch

    def lengths(words: list[str]) -> list[int]:
        out = [len(plain(w)) if is_plain(w, w.startswith(" ")) else 0 for w in words]
        rest = [i for i, n in enumerate(out) if not n]
        for i, e in zip(rest, encode([words[i] for i in rest], add_special_tokens=False)):
            out[i] = len(e.ids)
        return out

    return lengths


@cache
def _known_lengths(path: str) -> Memory:
    return Memory(_lengths(path))


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Tokens of each text.  Texts outside Latin, or with special strings, go to the library whole."""
    import regex

    words_of, known = regex.compile(_SPLIT).findall, _known_lengths(path)
    special = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    out = []
    for text in texts:
        if _OTHER.search(text) or any(s in text for s in special):
            out.append(len(tokenizer(path).encode_batch_fast([text], add_special_tokens=False)[0].ids))
        else:
            out.append(sum(known.of(words_of(text))))
    return out


def _seams(text: str, block: int, is_first: bool, is_last: bool, overlap: int, path: str):
    """Tokens of a block, and for both overlaps the starts of pre-tokens with what a splice there takes away.

    A position counts from the start of its overlap.  A splice takes from the
    left block the tokens from there on, from the right block those before.
    """
    code = tokenizer(path).encode(text, add_special_tokens=False)
    n, last_word, left, right = len(code.ids), object(), ([], []), ([], [])
    for i, ((at, _), word) in enumerate(zip(code.offsets, code.word_ids)):
        if word != last_word or word is None:
            if not is_first and at < overlap:
                right[0].append(at)
                right[1].append(-i)
            if not is_last and block <= at <= len(text) - MARGIN:
                left[0].append(at - block)
                left[1].append(i - n)
        last_word = word
    return n, left, right


_SEAMS = pa.schema(
    [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("seam", pa.int32()), ("side", pa.string()), ("n", pa.int64())]
    + [("starts", pa.list_(pa.int32())), ("less", pa.list_(pa.int32()))]
)
_SEAM_TYPES = "doc_id long, text_hash long, seam int, side string, n long, starts array<int>, less array<int>"


def _encode_blocks(overlap: int, path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", overlap * BLOCK):
                rows = []
                for r in part.to_pylist():
                    k, is_last = r["block"], r["block"] == r["blocks"] - 1
                    n, left, right = _seams(r["text"], overlap * BLOCK, k == 0, is_last, overlap, path)
                    key = (r["doc_id"], r["text_hash"])
                    rows.append((*key, k, "right", n, *(right if k else (None, None))))
                    if not is_last:
                        rows.append((*key, k + 1, "left", 0, *left))
                columns = zip(*rows)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _SEAMS)], _SEAMS)

    return encode


def _blocks(texts: DataFrame, overlap: int) -> DataFrame:
    """``texts`` cut into blocks, each with the first ``overlap`` characters of the next.

    A last block that its neighbour holds already is left out.
    """
    cut = texts.select("doc_id", "text_hash", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{overlap * BLOCK}}}"), 0).alias("b"))
    many = F.size("b")
    spare = (many > 1) & (F.length(F.element_at("b", -1)) <= overlap)
    count = many - spare.cast("int")
    each = cut.select("doc_id", "text_hash", "b", count.alias("blocks"), F.explode(F.sequence(F.lit(0), count - 1)).alias("block"))
    after = F.coalesce(F.substring(F.get("b", F.col("block") + 1), 1, overlap), F.lit(""))
    text = F.concat(F.get("b", F.col("block")), after)
    return each.select("doc_id", "text_hash", "blocks", "block", text.alias("text"))


def _spliced(seams: DataFrame) -> DataFrame:
    """Per document: its tokens, or null where an overlap has no common start."""

    def side(column: str, name: str):
        return F.first(F.when(F.col("side") == name, F.col(column)), ignorenulls=True).alias(f"{name}_{column}")

    per_seam = seams.groupBy("doc_id", "text_hash", "seam").agg(
        F.sum("n").alias("n"), *[side(c, s) for c in ("starts", "less") for s in ("left", "right")]
    )
    at = F.get(F.array_intersect("left_starts", "right_starts"), F.lit(0))

    def less(name: str):
        return F.get(f"{name}_less", (F.array_position(f"{name}_starts", at) - 1).cast("int"))

    settled = F.when(F.col("seam") == 0, F.col("n")).otherwise(F.col("n") + less("left") + less("right"))
    per_doc = per_seam.select("doc_id", "text_hash", settled.alias("n")).groupBy("doc_id", "text_hash")
    return per_doc.agg(F.when(F.count("n") == F.count("*"), F.sum("n")).alias("n_tokens"))


def count_huge(texts: DataFrame, path: str, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, text_hash, n_tokens`` of distinct ``texts (doc_id, text_hash, text)``, block by block."""
    done, todo = None, texts
    while True:
        blocks = _blocks(todo, overlap).repartition("doc_id", "text_hash", "block")
        found = stored(_spliced(map_arrow(blocks, _encode_blocks(overlap, path), _SEAM_TYPES)), "token-seams")
        right = found.filter("n_tokens IS NOT NULL")
        done = right if done is None else done.union(right)
        failed = found.filter("n_tokens IS NULL").select("doc_id", "text_hash")
        if not failed.limit(1).count():
            return done
        overlap *= 4
        names = failed.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"))
        todo = texts.join(names, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash")), "left_semi")


def _count_short(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                n = pa.array(count_tokens(texts, path), pa.int64())
                yield pa.record_batch([part.column("doc_id"), part.column("n_bytes"), n], ["doc_id", "n_bytes", "n_tokens"])

    return count


def token_counts(docs: DataFrame, path: str, limit: int = 512, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    A null text counts as empty: no bytes, no tokens.  Rows that repeat, and
    rows with a null ``doc_id``, each get a row.  Only ``doc_id`` and ``text``
    are read.  Texts longer than a block and an overlap are encoded in blocks.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    is_huge = F.coalesce(F.length("text") > overlap * (BLOCK + 1), F.lit(False))
    short = map_arrow(rows.filter(~is_huge), _count_short(path), "doc_id long, n_bytes long, n_tokens long")

    huge = rows.filter(is_huge).withColumn("text_hash", F.xxhash64("text"))
    counts = count_huge(huge.select("doc_id", "text_hash", "text").dropDuplicates(["doc_id", "text_hash"]), path, overlap)
    counts = counts.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), "n_tokens")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash"))
    long = huge.select("doc_id", "n_bytes", "text_hash").join(counts, same).select("doc_id", "n_bytes", "n_tokens")
    return short.union(long).withColumn("over_limit", F.col("n_tokens") > limit)
