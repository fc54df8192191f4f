"""Pages and texts with very many open elements or spans take time in proportion; marginals equal those of enumeration."""

import itertools
import math
import time

import pytest

from clientele.llm import html_text, pii

MEGABYTE = 1_000_000


@pytest.mark.parametrize("unit", ["<b>", "<p><b>", "<span hidden>", "<b hidden><i></b>", "<textarea>", "<li hidden>", "<script/>", "<a>x<div>"])
def test_pages_of_unclosed_elements(unit):
    model = html_text.train()
    page = unit * (MEGABYTE // len(unit))
    begin = time.perf_counter()
    html_text.main_text(page + "</div></script></iframe></i>end", model)
    assert time.perf_counter() - begin < 30  # a scan of the open elements per tag takes many minutes


def test_end_tags_of_elements_that_are_not_open():
    assert html_text.parse("<p>a</root></p></root></b>b")[1] == [(1, "a"), (0, "b")]
    page = "<div>" * 50_000 + "</b>" * 50_000 + "x"
    assert html_text.parse(page)[1] == [(50_000, "x")]


def test_text_with_very_many_spans():
    unit = "a.b@c.de call 030 1234 5678 "
    n = MEGABYTE // len(unit)
    begin = time.perf_counter()
    base, every = pii.train().spans(unit * n)
    assert time.perf_counter() - begin < 30 and len(base) == n
    one = pii.train().spans(unit * 3)
    assert len(every) == len(one[1]) // 3 * n


@pytest.mark.parametrize("page", [
    "<article><p>one</p><div class=ad>two</div></article>", "<nav><a href=x>m</a></nav><main><h1>t</h1><p>b</p></main>", "<div><div><div>x</div></div></div>"])
def test_marginals_equal_enumeration(page):
    model, nodes = html_text.train(), html_text.parse(page)[0]
    weight = {}
    for states in itertools.product((0, 1), repeat=len(nodes)):
        total = sum(model.unary[f] for s, node in zip(states, nodes) if s for f in html_text._unary(node))
        total += sum(model.pair[html_text._child_kind(node)][states[node.parent]][states[i]] for i, node in enumerate(nodes) if i)
        weight[states] = math.exp(total)
    z = sum(weight.values())
    belief, _, log_z = model.infer(nodes)
    assert log_z == pytest.approx(math.log(z))
    for i in range(len(nodes)):
        assert belief[i] == pytest.approx(sum(w for s, w in weight.items() if s[i]) / z, abs=1e-9)
