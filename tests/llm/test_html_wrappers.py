import random
import time

import pytest

from alluvia.llm.html_wrappers import align, main_texts, matches

WORDS = "stone river light garden winter letter market engine forest window silver bridge paper summer harbour".split()


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(4, 25))) + f" {rng.randrange(10**6)}."


def page(rng, kind, i):
    """A page of one of three templates and its main text."""
    title, parts = f"Title {i} {sentence(rng)}", [sentence(rng) for _ in range(rng.randint(1, 8))]
    menu = "".join(f"<li><a href='/{k}'>Section {k}</a></li>" for k in range(rng.randint(3, 7)))
    if kind == 0:
        side = f"<aside><p>Related: {sentence(rng)}</p></aside>" if rng.random() < 0.5 else ""
        body = f"<header><h1>{title}</h1></header>" + "".join(f"<p>{p}</p>" for p in parts)
        return f"<html><head><title>x</title></head><body><nav><ul>{menu}</ul></nav>{side}<article>{body}<footer>Filed under {i}</footer></article><footer>All rights reserved</footer></body></html>", [title, *parts]
    if kind == 1:
        body = f"<h2>{title}</h2>" + "".join(f"<div class='para'>{p}</div>" for p in parts)
        talk = "".join(f"<li>{sentence(rng)}</li>" for _ in range(rng.randint(0, 3)))
        return f"<body><div class='top'><div class='brand'>The Daily Example</div><ul class='menu'>{menu}</ul></div><div class='wrap'><div class='story'>{body}<div class='tagline'>Follow us for more stories</div></div></div><ul class='comments'>{talk}</ul></body>", [title, *parts]
    rows = "".join(f"<tr><td>{p}</td></tr>" for p in parts)
    return f"<body><table><tr><td class='nav'>Home | News | Contact</td><td class='main'><h3>{title}</h3><table>{rows}</table><p>Printed from example.net</p></td></tr></table><script>var x = '<p>no</p>';</script></body>", [title, *parts]


def test_generated_pages_of_three_templates(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for i in range(240):
        kind = i % 3
        html, blocks = page(rng, kind, i)
        rows.append((i, f"https://host{kind}.example/{i}", html))
        expected[i] = blocks
    got = {r["page_id"]: r["text"].split("\n") for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    hits = sum(len(set(got[i]) & set(expected[i])) for i in got)
    assert hits / sum(len(x) for x in expected.values()) >= 0.99  # recall of blocks
    assert hits / sum(len(x) for x in got.values()) >= 0.99  # precision of blocks


def test_matches_are_common_and_in_order():
    rng = random.Random(2)
    for _ in range(50):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))]
        i = j = 0
        for x, y, n in matches(a, b):
            assert x >= i and y >= j and a[x : x + n] == b[y : y + n]
            i, j = x + n, y + n


@pytest.mark.parametrize("n", [20, 900, 1100, 2500])
def test_alignment_does_not_depend_on_length(n):
    rng = random.Random(5)
    core = [rng.choice(["p", "/p", "b"]) for _ in range(n)]
    assert sum(m[2] for m in matches(["u", *core, "v"], ["w", *core, "x"])) == n
    assert sum(m[2] for m in matches(["u", *["p", "/p"] * n, "v"], ["w", *["p", "/p"] * n, "x"])) == 2 * n


def test_long_streams_align_in_bounded_time():
    rng = random.Random(3)
    one, other = ([rng.choice(["p", "/p", "#text", "b", "/b", f"div.{k}"]) for k in range(20_000)] for _ in range(2))
    began = time.time()
    out = align(one, other)
    assert time.time() - began < 20
    assert len(out) >= 20_000


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>&am<b>p;</b> &amp;lt; &#65;&nbsp;&nbsp;x</p>", "&amp; &lt; A x"),
        ("<article><header><h1>Title</h1></header><p class='ad-hoc'>one</p><div class='share-price'>two</div></article>", "Title\none\ntwo"),
        ("<p>" + "long " * 100_000 + "</p>", ("long " * 100_000).strip()),
        (None, ""),
    ],
)
def test_edges(spark, html, text):
    df = spark.createDataFrame([(1, "http://h/1", html, "x", 3)], "page_id long, url string, html string, root string, host int")
    [row] = main_texts(df).collect()
    assert row["text"] == text and row["n_chars"] == len(text)


def test_empty_table(spark):
    assert main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
