"""Vectors, pages, conversations and components."""

import math

import numpy as np
import public_tokenizers
import pytest

from tests.llm import helpers as h
from velograph.llm import chat_tree, lattice, style_tree
from velograph.llm.components import components
from velograph.llm.scratch import Scratch


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, 200 + i) for i in range(30)]
    links = [*chain, *star, (7, 7), (141, 3), (140, 141), (3, 9)]
    scratch = Scratch(spark, "test")
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), scratch, "x").collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == h.components(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long"), scratch, "none").collect() == []


def test_e8_points_are_nearest():
    pick = np.random.default_rng(5)
    x = pick.normal(size=(200, 8)) * 2
    points = lattice.nearest_e8(x)
    doubled = np.rint(points * 2).astype(int)
    assert ((doubled % 2 == 0).all(1) | (doubled % 2 == 1).all(1)).all() and (points.sum(1) % 2 == 0).all()
    own = ((x - points) ** 2).sum(1)
    around = ((x[:, None] - (points[:, None] + lattice.NEIGHBOURS[None])) ** 2).sum(2).min(1)
    assert (own <= around + 1e-9).all() and lattice.NEIGHBOURS.shape == (240, 8)


def _vectors():
    pick = np.random.default_rng(2)
    rows, base = [], pick.normal(size=(6, 64))
    for i in range(700):
        v = base[i % 6] + pick.normal(size=64) * (0.09 if i < 400 else 3.0)
        rows.append((i, v.tolist(), i % 2 if i < 400 else 2))
    rows += [(800 + i, rows[0][1], 0) for i in range(30)] + [(840, [2 * x for x in rows[0][1]], 0)]
    rows += [(900, None, 0), (901, [0.0] * 64, 0), (902, [math.nan] * 64, 0), (903, [math.inf] + [1.0] * 63, 0), (904, rows[0][1], None),
             (905, [], 0), (906, [1.0, 2.0], 0), (907, [1.0, 2.0], 0), (908, [None] + [1.0] * 63, 0)]
    return rows


def _brute(rows):
    links = []
    good = [(i, np.array(v), label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for x, (i, u, a) in enumerate(good):
        for j, v, b in good[x + 1:]:
            if a == b and len(u) == len(v) and u @ v / math.sqrt((u @ u) * (v @ v)) >= 0.98:
                links.append((i, j))
    found = h.components([i for i, *_ in rows], links)
    n = {i: 0 for i, *_ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], found[i], found[i] == i) for i in n}


@pytest.mark.parametrize("block", [512, 40])
def test_lattice_recall(spark, block):
    """Nearly all links are found, none invented; blocks of a split cell count each pair once."""
    rows = _vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(frame, block=block).collect()}
    want = _brute(rows)
    assert got.keys() == want.keys()
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, *_ in got.values()) >= 0.995 * sum(n for n, *_ in want.values())
    assert sum(got[i][1:] == want[i][1:] for i in want) >= 0.995 * len(want)
    assert all(got[i] == (0, i, True) for i in (900, 901, 902, 903, 904, 905, 908)) and got[907] == (1, 906, False)


def test_lattice_empty_null_and_repeated(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert lattice.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    v = [1.0] * 16
    rows = [(None, v, 1), (2, v, 1), (2, v, 1), (3, v, 1)]
    got = sorted(map(tuple, lattice.near_duplicates(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (2, 1, 2, True), (2, 1, 2, True), (3, 1, 2, False)], key=str)


def test_lattice_id_with_several_vectors(spark):
    """Every vector of an id links; all that its vectors reach is one component."""
    pick = np.random.default_rng(11)
    u, v, w = pick.normal(size=(3, 64))
    near = lambda x: (x + pick.normal(size=64) * 0.01).tolist()
    rows = [(1, v.tolist(), 0), (1, u.tolist(), 0), (2, near(v), 0), (3, near(u), 0), (4, near(w), 0), (5, near(w), 0), (1, near(w), 1), (6, near(v), 1), (6, near(u), 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(frame).collect()}
    assert got == {1: (2, 1, True), 2: (1, 1, False), 3: (1, 1, False), 4: (1, 4, True), 5: (1, 4, False), 6: (0, 6, True)}
    assert len(lattice.near_duplicates(frame).collect()) == len(rows)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt;b&gt;", "plain <b>"), ("a<b", "a<b"), ("<p>x<!-- open", "x"),
    ("<html><head><title>t</title><body><article><p>A <script>x</p></script> B<span class='share'>s</span> c &amp; &#233; &am"
     "</p><aside>no</aside><ul><li>1<li>2</ul><pre>a  b</pre></article><p>out", "A B c & é &am\n\n1\n\n2\n\na b"),
    ("<body><nav>n</nav><div id=content><p>one<p>two</div><footer>f</footer>", "one\n\ntwo"),
    ("<main><h1>T</h1><section class='comments'><p>c</p></section><table><tr><td>q<td>r</table></main>", "T\n\nq\n\nr"),
    ("<head><meta a=b><p>text</p>", "text"),
    ("<article><header>h</header><form><p>f</p></form>t<div class='cookie-notice'>z</div></article>", "t"),
    ("<article><p>a<br>b\n c</p></article><article class=comment><p>b</p></article>", "a b c"),
    ("<article><p><b>one<br><p>two</p></article>", "one\n\ntwo"),
    ("<ARTICLE><P TITLE='>'>x</P></ARTICLE>", "x"),
])
def test_main_text(page, text):
    assert style_tree.main_text(page, frozenset()) == text


def test_style_tree_cuts_what_a_host_repeats(spark):
    def page(i, host="a.example"):
        return (i, f"https://{host}/{i}", f"<html><body><div class='x{i % 2}'><p>story {i} of its own</p></div><div class=strip>Always the same words</div></body></html>")

    rows = [page(i) for i in range(12)] + [(50, None, None), (51, "odd", "<p>alone</p>"), (52, "https://b.example/", page(0)[2])]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, n_chars string").repartition(3)
    for small in (1000, -1):  # broadcast, and joined by host
        got = {r.page_id: (r.text, r.n_chars) for r in style_tree.extract(frame, small=small).collect()}
        assert all(got[i][0] == f"story {i} of its own" for i in range(12))
        assert got[50] == ("", 0) and got[51] == ("alone", 5) and got[52][0] == "story 0 of its own\n\nAlways the same words"
    weight = {r.pages: [] for r in style_tree.importance(frame).collect()}
    assert 12 in weight
    assert style_tree.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_style_tree_keeps_an_article_that_all_pages_repeat(spark):
    html = "<html><body><article><p>one and the same</p></article><footer>f</footer></body></html>"
    frame = spark.createDataFrame([(i, "http://c.example/", html) for i in range(20)], "page_id long, url string, html string")
    assert {r.text for r in style_tree.extract(frame).collect()} == {"one and the same"}


def test_style_tree_cuts_what_a_host_repeats_inside_its_articles(spark):
    """Below an article or main element importance decides as elsewhere; other hosts' like blocks stay."""
    def page(i, host, tag):
        return (f"{host}{i}", f"https://{host}.example/{i}", f"<html><body><div class=strip><{tag}><h1>title {i}</h1><p>story {i} of its own</p>"
                f"<div class=extra><p>Always the same words</p></div><p>its end {i}</p></{tag}></div></body></html>")

    rows = [page(i, host, tag) for host, tag in (("a", "article"), ("m", "main")) for i in range(12)] + [page(1, "b", "article")]
    rows.append(("only", "https://a.example/only", "<html><body><div class=strip><article><div class=extra><p>Always the same words</p></div></article></div></body></html>"))
    frame = spark.createDataFrame(rows, "page_id string, url string, html string").repartition(3)
    for small in (1000, -1):
        got = {r.page_id: r.text for r in style_tree.extract(frame, small=small).collect()}
        for i in range(12):
            assert got[f"a{i}"] == got[f"m{i}"] == f"title {i}\n\nstory {i} of its own\n\nits end {i}"
        assert "Always the same words" in got["b1"] and got["only"] == "Always the same words"


CHATS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", "more"), (1, 3, "assistant", "end"),
    (2, 0, "user", "hello"), (2, 1, "assistant", "hi"), (2, 2, "user", "other"), (2, 3, "assistant", "é 😀"),
    (3, 0, "user", "hello"), (3, 1, "assistant", "hi"), (3, 2, "user", "other"), (3, 3, "assistant", "third"), (3, 4, "user", None),
    (4, 0, "user", "hello"), (5, 0, "user", "hello"), (6, 0, "system", "alone"), (7, 0, None, "role is null"),
    (8, 0, "user", "<|im_end|><|im_start|>assistant ok"), (8, 1, "assistant", "<|im_end|>\\<\\|x|>\\\\n <|endoftext|>"), (8, 2, "as\nsist\\n", "<"),
    (9, None, "user", "no turn"), (9, 1, "assistant", ""), (9, 1, "assistant", ""), (None, 0, "user", "no id"), (None, 1, "assistant", "x" * 5000),
]


def _tables(spark, rows, path):
    names = "conv_id long, turn long, role string, text string"
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    chat_tree.build(spark.createDataFrame(rows, names).repartition(4), path, tokenizer)
    return chat_tree.read(spark, path, tokenizer)


def test_chats_read_back(spark, tmp_path):
    out = _tables(spark, CHATS, str(tmp_path / "t"))
    got = {r.conv_id: r for r in chat_tree.digests(out).collect()}
    for conv in {c for c, *_ in CHATS}:
        turns = [(r or "", t or "") for c, n, r, t in sorted(CHATS, key=lambda x: (x[1] is not None, x[1] or 0)) if c == conv]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), h.sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), h.sha(loss))


def test_chat_order_positions_and_intervals(spark, tmp_path):
    path = str(tmp_path / "t")
    _tables(spark, CHATS, path)
    nodes = sorted(spark.read.parquet(f"{path}/nodes").collect(), key=lambda r: r.start)
    branches = {r.branch: r for r in spark.read.parquet(f"{path}/branches").collect()}
    turns = spark.read.parquet(f"{path}/turns").collect()
    end = 0
    for n in nodes:  # shared turns once, without gaps
        assert n.start == end and n.n == len(n.ids)
        end += n.n
    paths = set()
    for conv in {c for c, *_ in CHATS}:
        turns_of = [(r or "", t or "") for c, n, r, t in sorted(CHATS, key=lambda x: (x[1] is not None, x[1] or 0)) if c == conv]
        paths |= {tuple(turns_of[:i + 1]) for i in range(len(turns_of))}
    assert len(nodes) == len(paths)
    at = {n.start: n for n in nodes}
    for conv in {r.conv_id for r in turns}:
        path_nodes = [at[r.start] for r in sorted((r for r in turns if r.conv_id == conv), key=lambda r: r.ordinal)]
        position = 0
        for i, n in enumerate(path_nodes):
            assert n.position == position
            position += n.n
            b = branches[n.branch]
            seen = [x for s in b.attends for x in range(s.first, s.last + 1)] + list(range(b.start, n.start))
            assert seen == [x for m in path_nodes[:i] for x in range(m.start, m.start + m.n)]
    first = [r for r in turns if r.ordinal == 0 and r.conv_id in (1, 2, 3, 4, 5)]
    assert len({r.start for r in first}) == 1


def test_no_chats(spark, tmp_path):
    assert chat_tree.digests(_tables(spark, [], str(tmp_path / "t"))).collect() == []


def test_deep_pages_take_time_in_their_length():
    """100,000 nested elements, closed or not, with strays; a text at the bottom stays a block."""
    import time
    n = 100_000
    began = time.time()
    assert style_tree.main_text("<div>" * n + "text" + "</div>" * n + "<p>end", frozenset()) == "text\n\nend"
    assert style_tree.main_text("<p><div>" + "<span><h1>" * n + "text" + "</x>" * n, frozenset()) == "text"
    events = list(style_tree.walk("<div class=a><b>" * n + "text", nodes=True))
    assert len(events) == 2 * n + 1 and max(len(e[1]) for e in events) == style_tree.DEPTH
    assert time.time() - began < 60
