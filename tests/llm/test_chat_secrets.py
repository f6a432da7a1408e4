"""Round trips of formatted chats, and secrets below encodings."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse

import pytest
from pyspark.sql import functions as F

from seatledger.llm import chat, secrets

PARTS = ["<|im_end|>", "\n", "\\", "a", "<|", "|>", "é🙂", "A", "B", "<\\|", "<|im_start|>assistant\nok"]


def turns(n, rng):
    return [(rng.choice(["user", "assistant", "sy\nstem\\"]), "".join(rng.choice(PARTS) for _ in range(rng.randrange(8)))) for _ in range(n)]


def framed(t):
    return "<s>" + chat.marked_turns(t) + "</s>"


@pytest.mark.parametrize("template", [chat.marked_turns, framed])
@pytest.mark.parametrize("n", [0, 1, 3, 17, 64, 65, 130])
def test_round_trip(template, n):
    said = turns(n, random.Random(n))
    blocks = list(chat.formatted_blocks(template, iter(said)))
    assert "".join(b[0] for b in blocks) == (template(said) if n else "")
    assert [t for b in blocks for t in chat.read_turns(b[0])] == said
    loss = [chat.unescape(text[s:e]) for text, spans, _ in blocks for s, e in spans]
    assert loss == [text for role, text in said if role == "assistant"]


@pytest.mark.parametrize("n", [3, 100])
def test_templates_that_rewrite_history(n):
    def forgets(t):
        return "".join(f"[{r}]{x if i == len(t) - 1 or r == 'user' else ''}" for i, (r, x) in enumerate(t))

    def counts(t):
        return f"{len(t)} turns:" + chat.marked_turns(t)

    said = [("user", "q"), ("assistant", "a long answer")] * n
    for template in (forgets, counts):
        with pytest.raises(chat.Rewrites):
            list(chat.formatted_blocks(template, iter(said)))


@pytest.mark.parametrize("n", [64, 65, 200])
def test_real_prefixes_at_every_length(spark, n):
    def far(t):
        return "".join(f"[{r}|{t[i - 4][1] if i >= 4 else ''}]{x}\n" for i, (r, x) in enumerate(t))

    def numbered(t):
        return "".join(f"Round {i} [{r}]{x}\n" for i, (r, x) in enumerate(t))

    def drops_old(t):
        return "".join(f"[{r}]{x}\n" for r, x in t[-20:])

    said = [(["user", "assistant"][i % 2], f"text {i}") for i in range(n)]
    df = spark.createDataFrame([(1, i, *turn) for i, turn in enumerate(said)], "conv_id long, turn long, role string, text string")
    for template in (far, numbered):
        blocks = chat.formatted(df, template).orderBy("block").collect()
        assert not any(b.rewrites for b in blocks) and "".join(b.formatted for b in blocks) == template(said)
        assert [b.formatted[s:e] for b in blocks for s, e in b.loss] == [text for role, text in said if role == "assistant"]
    assert [b.rewrites for b in chat.formatted(df, drops_old).collect()] == [True]


def test_conversations_with_nulls_ties_and_a_hot_one(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (1, 1, "assistant", "b")]
    rows += [(None, 0, None, "q"), (2, None, "user", "n"), (2, 0, "assistant", "")]
    rows += [(3, i, ["user", "assistant"][i % 2], f"text {i}") for i in range(500)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digests(chat.formatted(df)).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 4, None: 1, 2: 2, 3: 500}
    assert got[1].loss_sha256 == hashlib.sha256(b"bxx").hexdigest() and got[1].loss_chars == 3
    body = "".join(f"{['user', 'assistant'][i % 2]}\ntext {i}\n" for i in range(500))
    assert got[3].turns_sha256 == hashlib.sha256(body.encode()).hexdigest()
    assert chat.digests(chat.formatted(df.limit(0))).count() == 0


SECRET = 'password = "hunter22secret"'
PLAIN64 = base64.b64encode(SECRET.encode()).decode()


@pytest.mark.parametrize(
    "hidden",
    [
        PLAIN64,
        base64.b64encode(gzip.compress(("x " * 50 + SECRET).encode())).decode(),
        base64.b64encode(bz2.compress(gzip.compress(SECRET.encode()))).decode(),
        base64.urlsafe_b64encode(("??>>" + SECRET).encode()).decode().rstrip("="),
        urllib.parse.quote(SECRET, safe=""),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "".join(f"&#{ord(c)};" for c in SECRET),
        base64.b64encode(urllib.parse.quote(PLAIN64, safe="").encode()).decode(),
    ],
)
def test_decoded_layers(hidden):
    text = f"é before {hidden} after"
    base, spans, opened, _ = secrets.find(text)
    assert not any(kind == 0 for _, kind, _ in base) and opened >= 1
    found = [(s, e) for s, kind, e in spans if kind == 0]
    assert found and all(9 <= s < e <= 9 + len(hidden) for s, e in found)


def wrapped(raw, width, end):
    said = base64.b64encode(raw).decode()
    return end.join(said[i : i + width] for i in range(0, len(said), width))


NOISE = "".join(random.Random(2).choices("abcdefghij klmnop", k=400))


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    ", "\n\t"])
@pytest.mark.parametrize("width", [12, 62, 64, 76])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, bz2.compress, lzma.compress])
def test_wrapped_base64(width, end, pack):
    for lead in range(0, 60, 7):  # the secret crosses line ends and lies in the last line
        hidden = wrapped(pack((NOISE[: 100 + lead] + SECRET).encode()), width, end)
        for before, after in (("é\n", "\n"), ("key: ", " x"), ("one\nword\n", "\nafter\n"), ("-----BEGIN KEY-----\n", "\n-----END KEY-----")):
            spans = secrets.find(before + hidden + after)[1]
            found = [(s, e) for s, kind, e in spans if kind == 0]
            assert found and all(len(before) <= s < e <= len(before + hidden) for s, e in found), (lead, before)


def test_wrapped_base64_inside_a_layer():
    inner = wrapped(gzip.compress((NOISE + SECRET).encode()), 64, "\n")
    hidden = base64.b64encode(f"mail:\n\n{inner}\n".encode()).decode()
    assert any(kind == 0 for _, kind, _ in secrets.find(f"a {hidden} b")[1])


def test_place_of_a_match_inside_wrapped_base64():
    raw = ("z" * 30 + "AKIA" + "Q" * 20 + "  " + "z" * 30).encode()
    text = "\n" + wrapped(raw, 64, "\r\n")
    at = [i for i, c in enumerate(text) if c not in "\r\n"]
    assert secrets.find(text)[1] == [(at[40], 1, at[-(-54 * 4 // 3) - 1] + 1)]


def test_place_of_a_match_inside_base64():
    """The span covers the characters that encode the match and no others."""
    text = base64.b64encode(("z" * 30 + "AKIA" + "Q" * 20 + "  " + "z" * 30).encode()).decode()
    ((start, kind, end),) = secrets.find(text)[1]
    assert kind == 1 and (start, end) == (30 * 4 // 3, -(-54 * 4 // 3))


def test_cycles_and_bombs_end():
    bomb = base64.b64encode(gzip.compress(b"a" * 50_000_000)).decode()
    for text in ("%2525252541" * 50, bomb, "%41" * 1000, "A" * 5000, "\\u005cu0041" * 20):
        secrets.find(text)


def test_base_spans_against_the_stated_patterns(spark, sf):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    made = ["api_key: abc", 'PassWord="abcdef" token=abcdefg', f"é AKIA{'X' * 16} AKIAshort " + "0a" * 12, "secret:abc token : abcdefghi", "f" * 23]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame(list(enumerate(made, 10_000)), docs.schema))
    got = {r.doc_id: r for r in secrets.secrets(docs).collect()}
    seen = 0
    for r in docs.collect():
        t = r.text or ""
        found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{['assign', 'access', 'hex'][k]}:{s}:{e}" for s, k, e in sorted(found))
        row = got[r.doc_id]
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == i for _, k, _ in found) for i in range(3))
        assert set(filter(None, text.split(","))) <= set(row.spans.split(","))
        seen += len(found)
    assert seen >= 5


def test_messy_secrets(messy, nothing):
    assert secrets.secrets(messy).count() == messy.count() and secrets.secrets(nothing).count() == 0


def found_in(text, **options):
    return [(s, e) for s, kind, e in secrets.find(text, **options)[1] if kind == 0]


def encoded(raw):
    return base64.b64encode(raw).decode()


def test_big_layers_are_read_to_their_end():
    big = gzip.compress(b"x" * 10_000_000 + b"\n" + SECRET.encode())
    assert len(found_in("\n".join([encoded(big)] * 5))) == 5
    assert len(found_in(encoded(gzip.compress(b"line of words\n" * 3_000_000 + SECRET.encode())))) == 1
    assert len(found_in(encoded(gzip.compress(gzip.compress(b"y" * 40_000_000 + SECRET.encode()))))) == 1


def test_layers_above_the_guard_are_counted():
    text = encoded(gzip.compress(b"x" * 3_000_000 + SECRET.encode()))
    *_, cut = secrets.find(text + " " + encoded(SECRET.encode()), most=1_000_000)
    assert cut == 1 and len(found_in(text + " " + encoded(SECRET.encode()), most=1_000_000)) == 1
    assert secrets.find(text)[3] == 0


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, __import__("zlib").compress])
def test_every_member_is_read(pack):
    assert len(found_in(encoded(pack(b"nothing here") + pack(b"nor here") + pack(SECRET.encode())))) == 1
    assert len(found_in(encoded(pack(b"a " + SECRET.encode()) + b"rubbish"))) == 1
    assert len(found_in(encoded(pack(b"a " + SECRET.encode() + b" " * 200_000)[:-9]))) == 1


@pytest.mark.parametrize(
    "raw",
    [
        b"password=abcdef123\0",
        b"\xff\xfe\x01 password=abcdef123 \x80",
        "é password=abcdef123 é".encode("utf-16"),
        "password=abcdef123".encode("utf-16-be"),
        "password=abcdef123 ü".encode("latin-1"),
    ],
)
def test_layers_that_are_not_readable_as_a_whole(raw):
    text = "see " + encoded(raw)
    spans = found_in(text)
    assert len(spans) == 1 and 4 <= spans[0][0] < spans[0][1] <= len(text)
    # The place is that of the characters that hold the match, not more than a few around it.
    said = base64.b64decode(text[4 + (spans[0][0] - 4) // 4 * 4 : 4 + -(-(spans[0][1] - 4) // 4) * 4].ljust(4, "="))
    assert b"abcdef123" in said.replace(b"\0", b"")


@pytest.mark.parametrize("first, nested", [("%", "%" + "25" * 20_000), ("\\", "\\" + "u005c" * 20_000), ("&", "&" + "#38;" * 20_000)])
def test_deep_escapes_take_no_longer_than_their_length(first, nested):
    letter = {"%": "70", "\\": "u0070", "&": "#112;"}[first]
    assert len(found_in(f"{nested}{letter}assword=abcdef123")) == 1
