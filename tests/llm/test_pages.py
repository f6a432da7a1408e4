"""Main text of pages: the tree, the messages against all states, held-out pages, the given pages against SQL."""

import itertools

import compare
import numpy as np
import pytest

from seatledger.llm import pages
from seatledger.llm.dom import parse
from seatledger.llm.labelled_pages import labelled_pages
from seatledger.llm.queries import oracle_sql, queries


def tree(html):
    """Elements as nested text."""
    page = parse(html)
    below = {i: [] for i in range(len(page.tag))}
    for i, up in enumerate(page.parent[1:], 1):
        below[up].append(i)

    def shown(i):
        return page.tag[i] + (f"({' '.join(map(shown, below[i]))})" if below[i] else "")

    return shown(0)


def blocks(html):
    out, last = [], None
    for _, block, text, _ in parse(html).pieces:
        out = [*out[:-1], out[-1] + text] if block == last else [*out, text]
        last = block
    return [t for t in out if t.strip()]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<div><p>a<p>b<div>c</div></div>", "html(body(div(p p div)))"),
        ("<p><b>a<br><p>b", "html(body(p p))"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "html(body(ul(li li(ul(li)) li)))"),
        ("<table><tr><td>a<td>b<tr><td><table><tr><td>c</table></table>", "html(body(table(tr(td td) tr(td(table(tr(td)))))))"),
        ("<head><title>t</title><p>x", "html(head body(p))"),
        ("<div></p></section>a</div></div></div><p>b", "html(body(div p))"),
        ("<html><body><body><p>a</body></html><p>b", "html(body(p p))"),
        ("<article><b><p>a</b>c</p></article><p>d", "html(body(article(p) p))"),
    ],
)
def test_tree(html, expected):
    assert tree(html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>a<b>b</b>c</p>d<p>e", ["abc", "d", "e"]),
        ("a<!-- <p>no</p> -->b<!-->c<!x>d<?y>e</ >f", ["abcdef"]),
        ("<p title='a > b' x=\"</p>\">t", ["t"]),
        ("<script>if (a < b) '</p>'</script><style>p{}</style>x<textarea><p>y</textarea>", ["x"]),
        ("1 < 2 &amp; 3 &lt; 4 &#8364;&eacute;&notit;<", ["1 < 2 & 3 < 4 €é¬it;<"]),
        ("<p>kept</p><!-- open", ["kept"]),
        ("<p>kept</p><a href='open", ["kept"]),
        ("<p>kept</p><script>open", ["kept"]),
        ("", []),
    ],
)
def test_blocks(html, expected):
    assert blocks(html) == expected


@pytest.mark.parametrize("html", ["<" * 300_000, "<a " * 100_000, "<div>" * 100_000 + "x", "<b>" * 100_000 + "</i>" * 100_000, "<!--" * 100_000, "&" * 300_000, "<p>" * 50_000])
def test_broken_pages_take_no_longer_than_their_length(html):
    parse(html)


def test_messages_equal_the_sum_over_all_states():
    rng = np.random.default_rng(4)
    parent = np.array([-1, 0, 0, 1, 1, 2, -1, 6])
    depth = np.array([0, 1, 1, 2, 2, 2, 0, 1])
    forest = pages.Forest(parent, rng.integers(0, 3, 8), [np.flatnonzero(depth == d) for d in range(3)], np.zeros(0, int), np.zeros(0, int))
    unary, edges = rng.normal(size=(8, 3)), rng.normal(size=(3, 3, 3))
    alone, joint, total = np.zeros((8, 3)), np.zeros((8, 3, 3)), 0
    for states in itertools.product(range(3), repeat=8):
        weight = sum(unary[i, s] for i, s in enumerate(states))
        weight = np.exp(weight + sum(edges[forest.kind[i], states[parent[i]], states[i]] for i in range(8) if parent[i] >= 0))
        total += weight
        for i, s in enumerate(states):
            alone[i, s] += weight
            if parent[i] >= 0:
                joint[i, states[parent[i]], s] += weight
    found, pairs = pages.marginals(forest, unary, edges)
    assert np.allclose(found, alone / total) and np.allclose(pairs, joint / total)


def marked_text(html):
    page, out, last = parse(html), [], None
    for node, block, text, _ in page.pieces:
        if page.marked[node]:
            out.append(text if block == last else " " + text)
            last = block
    return " ".join("".join(out).split())


def test_held_out_pages():
    html = labelled_pages(200, seed=99)
    found = pages.main_texts(html, pages.default_model())
    true = [marked_text(h) for h in html]
    assert sum(a == b for a, b in zip(found, true)) >= 0.92 * len(html)
    words = [(set(a.split()), set(b.split())) for a, b in zip(found, true)]
    both = sum(len(a & b) for a, b in words)
    assert both >= 0.98 * sum(len(a) for a, _ in words) and both >= 0.97 * sum(len(b) for _, b in words)


@pytest.mark.parametrize(
    "html, expected",
    [
        (
            "<div class='topnav'>Home | About</div><div class='article-body'><h1>Title</h1><p>First part, with words.</p>"
            "<div class='ad'>Buy this now.</div><p>Second.</p><section id='comments'><h2>Comments</h2><p>What a great article. Thanks!</p>"
            "</section></div><div class='sidebar'><p>Long text in a sidebar, that goes on.</p></div><div id='footer'>Copyright</div>",
            "Title First part, with words. Second.",
        ),
        (
            "<header><h1>Site</h1><nav><a href=a>A</a></nav></header><main><h1>T</h1><p>One.</p><aside>Related</aside><form><p>Sign up now.</p>"
            "</form><p>Two &amp; three&nbsp;four.</p></main><div class='cookie-notice'>We use cookies.</div><footer>x</footer>",
            "T One. Two & three four.",
        ),
        ("<p>Just one paragraph here.</p>", "Just one paragraph here."),
        ("no tags at all, only a few words", "no tags at all, only a few words"),
        ("<nav><a href=x>A</a><a href=y>B</a></nav><footer>only these</footer>", ""),
    ],
)
def test_pages_of_other_kinds(html, expected):
    assert pages.main_texts([html], pages.default_model()) == [expected]


def test_query_equals_sql_on_the_given_pages(spark, sf):
    name = "op11_tree_marginals"
    assert compare.difference(queries()[name](spark, sf), compare.connect(sf), oracle_sql()[name]) is None


def test_messy_pages(spark):
    deep = "<article>" + "<div>" * 3000 + "<p>deep words here</p>"
    long = "<article><p>" + "many words. " * 200_000 + "</p></article>"
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (None, "u", "<article><p>a b</p></article>"), (3, "v", deep), (4, "v", long)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = [tuple(r) for r in pages.main_text(table).collect()]
    assert len(found) == 6 and found.count((1, None, "", 0)) == 2 and (2, "u", "", 0) in found and (None, "u", "a b", 3) in found
    assert [len(t) for i, _, t, _ in found if i == 4] == [len("many words. " * 200_000) - 1]
    assert pages.main_text(table.limit(0)).count() == 0
