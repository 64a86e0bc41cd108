import html
import itertools
import random
import re

import numpy as np
import pytest

from ticketloom.llm import main_text as M
from ticketloom.llm.dom_blocks import SLOTS, blocks_of
from ticketloom.llm.labelled_pages import MARK, labelled_page

SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def weights(spark, sf):
    return M.train(M.training_sequences(spark.read.parquet(f"{sf}/pages.parquet")))


def plain_article(page):
    """The text of the only article element, for pages whose markup is known."""
    found = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1|article)>", found.group(1) if found else "")
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def _texts(page, marked=None):
    return [b.text for b in blocks_of(page, marked)]


def test_pages_of_the_table(spark, sf, weights):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = {r.page_id: r for r in M.main_text(pages, weights).collect()}
    assert len(rows) == pages.count()
    for page in pages.collect():
        found = rows[page.page_id]
        assert (found.url, found.text, found.n_chars) == (page.url, plain_article(page.html), len(found.text))


def test_unseen_templates(spark, sf, weights):
    """Held-out accuracy: pages laid out by other draws than the training pages."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").limit(30).collect()
    texts = [t for p in pages for t in _texts(p.html)]
    first, moves = (x.tolist() for x in M._moves(weights))
    right = total = 0
    for number in range(300):
        blocks = blocks_of(labelled_page(f"unseen {number}", random.Random(number).sample(texts, 20)), MARK)
        score = [float(weights[list(b.features)].sum()) for b in blocks]
        states = M.viterbi(score, M.kinds_of(blocks), first, moves)
        right += sum(s == b.label for s, b in zip(states, blocks))
        total += len(blocks)
    assert right > 0.98 * total


def _sequence(seed, n):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(1, 4, n)
    return (draw.integers(0, 20, sizes.sum()).astype(np.int32), np.cumsum([0, *sizes]).astype(np.int32),
            np.r_[0, draw.integers(0, 2, n - 1)].astype(np.int32), draw.integers(0, 2, n).astype(np.int32))


def _all_scores(weights, slots, cuts, kinds):
    first, moves = M._moves(weights)
    own = [weights[slots[a:b]].sum() for a, b in zip(cuts, cuts[1:])]
    for states in itertools.product((0, 1), repeat=len(own)):
        score = first[states[0]] + sum(o for o, s in zip(own, states) if s)
        yield states, score + sum(moves[k][a][b] for k, a, b in zip(kinds[1:], states, states[1:]))


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 2), (3, 7)])
def test_likelihood_and_viterbi_by_enumeration(seed, n):
    weights = np.random.default_rng(seed + 9).normal(size=M._SIZE)
    slots, cuts, kinds, truth = _sequence(seed, n)
    scores = dict(_all_scores(weights, slots, cuts, kinds))
    total = np.log(sum(np.exp(s) for s in scores.values()))
    page = slots, cuts, kinds, truth
    sizes = np.array([n])
    loss, gradient = M.likelihood(weights, *page, sizes)
    assert loss == pytest.approx(total - scores[tuple(truth)])
    for place in [*set(slots.tolist()), *range(SLOTS, M._SIZE)]:
        near = weights.copy()
        near[place] += 1e-6
        assert (M.likelihood(near, *page, sizes)[0] - loss) / 1e-6 == pytest.approx(gradient[place], abs=1e-4)
    own = [float(weights[slots[a:b]].sum()) for a, b in zip(cuts, cuts[1:])]
    first, moves = (x.tolist() for x in M._moves(weights))
    assert tuple(M.viterbi(own, kinds.tolist(), first, moves)) == max(scores, key=scores.get)


def test_gradient_is_summed_over_parts(spark):
    rows = [tuple(x.tobytes() for x in _sequence(seed, 1 + seed)) for seed in range(6)]
    weights = M.train(spark.createDataFrame(rows, M._SEQUENCE).repartition(3), iterations=30)
    alone = [M.likelihood(weights, *M.joined([r])) for r in rows]
    assert M.likelihood(weights, *M.joined(rows))[0] == pytest.approx(sum(loss for loss, _ in alone))
    gradient = sum(g for _, g in alone) / 6
    assert np.abs(gradient + 2 * M.RIDGE / 6 * weights).max() < 1e-3
    assert not M.train(spark.createDataFrame([], M._SEQUENCE)).any()


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain", ["plain"]), ("a < b & c &lt; d", ["a < b & c < d"]), ("<p>a<p>b", ["a", "b"]),
    ("<p>x <b>y</b>z<br>w&nbsp;&#233;", ["x yz w é"]), ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
    ("<script>var a='</p><p>no</p>';</script><p>yes", ["yes"]), ("<style>p{}</style><!-- <p>no</p> --><p>yes</p>", ["yes"]),
    ("<!-- never closed <p>no", []), ("<p title='a > b'>yes</p>", ["yes"]), ("<p title=it's>yes</p>", ["yes"]),
    ("<a href=\"x>text</a>", ["text"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("</div></p>a</b>", ["a"]), ("<div>a<div>b</div>c</div>", ["a", "b", "c"]), ("<P>A</P><DIV>B</DIV>", ["A", "B"]),
    ("<p>\n\t  </p><p> a\n\n b </p>", ["a b"]), ("&amp;lt;", ["&lt;"]), ("<textarea><p>t</textarea><p>u", ["<p>t", "u"]),
    ("<div" * 3 + ">x", ["x"]), ("<p>a<", ["a<"]), ("<p>a<b", ["a"]),
])
def test_blocks(page, want):
    assert _texts(page) == want


def test_time_grows_with_the_page_only():
    for page in ("<div>" * 50_000 + "x", "<p a=\"" * 50_000, "<b>" * 20_000 + "<p>" * 2000, "<!--" * 50_000, "&" * 100_000):
        blocks_of(page)


def test_odd_pages(spark, weights):
    article = "<html><body><nav><ul><li><a href=1>Menu</a></ul></nav><article><h1>Title</h1><p>" + "Some words here. " * 20 + \
        "</p></article><div class=comments><p>I like it.</p></div><footer>&copy; all</footer>"
    rows = [(1, "u", None), (2, None, ""), (None, "v", article), (3, "w", article), (3, "w", article),
            (4, "x", "<p>" + "word " * 200_000), (5, "y", " \n"), (6, "z", "<script>only</script>")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("text", "n_chars", "slots", "number"):
        df = df.withColumn(name, df.url)
    found = {(r.page_id, r.url): r for r in M.main_text(df.repartition(3), weights).collect()}
    want = "Title\n" + ("Some words here. " * 20).strip()
    assert found[None, "v"].text == found[3, "w"].text == want
    assert all(found[k].text == "" and found[k].n_chars == 0 for k in ((1, "u"), (2, None), (5, "y"), (6, "z")))
    assert M.main_text(df).count() == len(rows)


def test_no_pages(spark):
    assert M.main_text(spark.createDataFrame([], SCHEMA)).collect() == []
