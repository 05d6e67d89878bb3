import re
import time
from collections import Counter

import numpy as np
import pytest

from spendlever.llm import html_text


def pages(spark, sf_dir):
    return [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]


def without_telling_tags(html):
    html = re.sub(r"<(/?)(nav|article|main|header|footer|aside)\b", r"<\1div", html)
    return re.sub(r' (class|id|role)="[^"]*"', "", html)


def overlap(got, want):
    a, b = got.split("\n"), want.split("\n")
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def test_pages_that_do_not_say_what_their_parts_are(spark, sf_dir):
    found = pages(spark, sf_dir)
    want = [html_text.main_text(h) for h in found]
    got = [html_text.main_text(without_telling_tags(h)) for h in found]
    assert np.mean([overlap(a, b) for a, b in zip(got, want)]) > 0.95


MENU = "".join(f"<p>Section {i}</p>" for i in range(12))
TEXT = "".join(f"<p>Paragraph {i} of the story, which goes on for a good while and says a lot about its matter in plain words.</p>" for i in range(6))


def test_the_ratio_chooses_the_lines(monkeypatch):
    html = f"<html><body>{MENU}<h1>Headline</h1>{TEXT}<p>The end.</p>{MENU}</body></html>"
    got = html_text.main_text(html).split("\n")
    assert "Headline" in got and "The end." in got and sum(x.startswith("Paragraph") for x in got) == 6
    assert sum(x.startswith("Section") for x in got) <= 2 * html_text.GAP
    monkeypatch.setattr(html_text, "_smoothed", lambda ratio: np.ones(len(ratio)))
    assert sum(x.startswith("Section") for x in html_text.main_text(html).split("\n")) == 24


def test_a_second_region_needs_a_fair_share():
    aside = "<div><p>Two lines of something else, long enough to be text by its ratio alone.</p></div>"
    got = html_text.main_text(f"<body><div>{TEXT}</div>{MENU}{aside}</body>")
    assert "something else" not in got and got.count("Paragraph") == 6
    assert html_text.main_text(f"<body><div>{TEXT}</div>{MENU}<div>{TEXT}</div></body>").count("Paragraph") == 12


@pytest.mark.parametrize("part, kept", [
    ("<section id='related-work'><p>Inner part</p></section>", True), ("<h2 class='search-methods'>Inner part</h2>", True),
    ("<p class='alert'>Inner part</p>", True), ("<p>see <math><mi>Inner part</mi></math></p>", True), ("<span class='ad'>Inner part</span>", True),
    ("<div class='comment-list'><p>Inner part</p></div>", False), ("<div class='box ad-slot'>Inner part</div>", False),
    ("<div id='cookie_banner'>Inner part</div>", False), ("<aside>Inner part</aside>", False), ("<form><p>Inner part</p></form>", False),
    ("<div hidden>Inner part</div>", False), ("<section class='comments'>Inner part</section>", False), ("<footer>Inner part</footer>", False),
])
def test_parts_inside_the_article(part, kept):
    got = html_text.main_text(f"<body><nav>Menu</nav><article><h1>Title</h1>{TEXT}{part}<p>Last</p></article><p>{'outside ' * 40}</p></body>")
    assert ("Inner part" in got) == kept and "Title" in got and "Last" in got and "outside" not in got and "Menu" not in got


@pytest.mark.parametrize("html", [
    "<b>" * 30_000 + "</i>" * 30_000, "<div><i>" + "<b>" * 20_000 + "</i>" * 20_000 + "</div>" * 20_000, "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000,
    "<div>" * 15_000 + "<article>" * 15_000, "<p>" * 60_000, "<div><p>x" * 20_000, "</div>" * 40_000, "<a><div>" * 20_000 + "</a>" * 20_000,
    "<div><b>" * 15_000 + "</b></p>" * 15_000])
def test_hostile_pages_take_time_in_proportion(html):
    started = time.perf_counter()
    html_text.main_text(html + "text")
    assert time.perf_counter() - started < 5  # quadratic work takes minutes


def plain_clusters(content, container, plain):
    """Line by line, container by container."""
    out = [-1] * len(content)
    made = 0
    for c in sorted(set(container)):
        own, clusters = [i for i in range(len(content)) if container[i] == c], []
        for place, i in enumerate(own):
            if content[i]:
                if clusters and place - clusters[-1][-1] <= html_text.GAP + 1 and all(plain[own[j]] for j in range(clusters[-1][-1], place)):
                    clusters[-1].append(place)
                else:
                    clusters.append([place])
        for members in clusters:
            for place, i in enumerate(own):
                near = [m for m in members if abs(m - place) <= html_text.GAP and all(plain[own[j]] for j in range(min(m, place), max(m, place) + 1))]
                if near:
                    out[i] = made
            made += 1
    return out


def test_clusters_against_a_plain_version():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 30))
        plain = rng.random(n) < 0.85
        content, container = (rng.random(n) < 0.35) & plain, rng.integers(0, 3, n)
        got = html_text._clusters(content, container, plain)
        want = plain_clusters(content.tolist(), container.tolist(), plain.tolist())
        assert [x >= 0 for x in got] == [x >= 0 for x in want]
        assert [got[i] for i in np.flatnonzero(content)] == [want[i] for i in np.flatnonzero(content)]
