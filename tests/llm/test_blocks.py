import random

import numpy as np
import pytest

from sluicebox.llm import blocks as B
from sluicebox.llm.blocks import Labeller, blocks_of, compose, main_text, page_of


def texts_of(page):
    return [b.text for b in blocks_of(page)]


def test_blocks():
    assert texts_of("<p>a <b>b</b>\n c&amp;d<br>e<p>f&nbsp;g</p>tail") == ["a b c&d e", "f g", "tail"]
    assert texts_of('<script>var t="</p>";x(1<2)</script><style>p{}</style><!-- <p>no</p> -->yes') == ["yes"]
    assert texts_of('<div title="a > b">x</div><img alt=">">1 < 2') == ["x", "1 < 2"]
    assert texts_of(None) == texts_of("") == texts_of("<p></p> \n") == []
    assert texts_of("plain") == ["plain"]
    assert texts_of("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]


def test_paths_follow_closing_tags():
    page = blocks_of('<nav class="menu"><a>x</a></nav><article><p>y<div class="ad">z</div>w</article>v')
    marks = [set(b.path) for b in page]
    nav, article, ad = (B._bucket(n, B.PATH_BUCKETS) for n in ("<nav", "<article", ".ad"))
    assert [nav in m for m in marks] == [True, False, False, False, False]
    assert [article in m for m in marks] == [False, True, True, True, False]
    assert [ad in m for m in marks] == [False, False, True, False, False]


def test_gradients():
    rng = random.Random(1)
    pages, labels = [], []
    for _ in range(3):
        page, wanted = compose(["some words here.", "other text of a page", "x"], rng)
        pages.append(page_of(blocks_of(page)))
        labels.append(np.array(wanted, np.float32))
    model = Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    _, grads = model.gradients(pages, labels)
    for name, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-3
        up, _ = model.gradients(pages, labels)
        model.p[name][at] = kept - 1e-3
        down, _ = model.gradients(pages, labels)
        model.p[name][at] = kept
        assert abs((up - down) / 2e-3 - g[at]) < 2e-3 + 0.03 * abs(g[at]), name


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    vocabulary = ["lorem", "ipsum", "dolor", "sit", "amet", "größe", "niño"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 40))).capitalize() + "." for _ in range(60)]
    pages = [compose(texts, rng)[0] for _ in range(30)]
    return B.train(pages), texts


def test_held_out_accuracy(model):
    labeller, texts = model
    rng, right, total = random.Random(77), 0, 0
    for _ in range(150):
        page, wanted = compose(texts, rng)
        got = labeller.label([page_of(blocks_of(page))])[0]
        right += int((got == np.array(wanted)).sum())
        total += len(wanted)
    assert right / total > 0.98


def test_batches_do_not_matter(model):
    labeller, texts = model
    pages = [page_of(blocks_of(compose(texts, random.Random(k))[0])) for k in range(40)]
    together = labeller.label(pages)
    for k in (0, 7, 39):
        assert (labeller.label([pages[k]])[0] == together[k]).all()


def test_query_edges(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars int"
    article = "<html><nav><a>Menu</a></nav><article><h1>Head</h1>" + "<p>Some words of the text.</p>" * 40 + "</article><footer>end</footer></html>"
    rows = [(k, "u", article, "clash", 1) for k in range(30)] + [(50, None, None, "x", 1), (51, "u", "", "x", 1), (52, "u", article, "x", None),
                                                                 (52, "u", article, "x", None), (None, "u", "<p>a</p>", "x", 1)]
    got = main_text(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[50]["text"] == by[51]["text"] == "" and by[50]["n_chars"] == 0
    assert by[3]["text"] == "\n\n".join(["Head"] + ["Some words of the text."] * 40) == by[52]["text"]
    assert main_text(spark.createDataFrame([], schema)).count() == 0
