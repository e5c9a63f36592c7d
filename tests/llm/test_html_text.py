import numpy as np
import pytest

from tidegate.llm import html_text as h


def texts(page):
    return [b.text for b in h.blocks(page)]


def test_blocks_of_broken_and_odd_markup():
    assert texts("a<b>b</b>c<p>d &amp;amp; e&nbsp;&#233;\n f<p>g<br>h") == ["abc", "d &amp; e é f", "g h"]
    assert texts("<script>if (a<b) '</p>'</script>x<style>y</style><!-- z --><textarea>t</textarea>") == ["x"]
    assert texts("<!-- open") == [] and texts("") == [] and texts("<p") == ["<p"] and texts("1 < 2 <p>3") == ["1 < 2", "3"]
    assert texts("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == ["a", "b", "c", "d", "e"]
    assert texts('<p title="a>b">x</p><script>never closed') == ["x"]


def test_paths_and_links():
    found = h.blocks('<div id="siteMain" class="post-body"><p><b>one<p>two <a href="#">link</a></div><p>three')
    assert [b.path[0] for b in found] == ["div", "div", "p"] and found[1].path.count("p") == 1
    assert {"name:site", "name:main", "name:post", "name:body"} <= set(found[0].path)
    assert [b.linked for b in found] == [0, 4, 0]


def test_gradients_equal_differences():
    draw = np.random.default_rng(0)
    model = h.Labeller(1)
    x = draw.normal(size=(3, 4, h.INPUT)).astype(np.float32)
    alive = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 1, 1, 0]], bool)
    y = (draw.random((3, 4)) > 0.5).astype(np.float32)

    def loss():
        s = model.scores(x, alive).astype(np.float64)
        return ((np.logaddexp(0, s) - y * s) * alive).sum() / alive.sum()

    grad = model._gradients(x, alive, y)
    for name, weight in model.weights.items():
        at = np.unravel_index(np.argmax(np.abs(grad[name])), weight.shape)
        keep = weight[at]
        weight[at] = keep + 1e-2
        up = loss()
        weight[at] = keep - 1e-2
        down = loss()
        weight[at] = keep
        assert (up - down) / 2e-2 == pytest.approx(grad[name][at], rel=0.05), name


def test_held_out_layouts():
    """Layouts of another seed than those trained on: share of blocks with the right label."""
    model, layouts, right, total = h.trained(), h.Layouts(4242), 0, 0
    for _ in range(60):
        marked = [b for b in h.blocks(layouts.page()) if any(c in b.text for c in h._YES + h._NO)]
        truth = [next(c for c in b.text if c in h._YES + h._NO) == h._YES for b in marked]
        plain = [h.Block(b.path, b.text.replace(h._YES, "").replace(h._NO, "").strip() or "x", b.linked) for b in marked]
        x, alive = h.padded([h.vectors(plain)])
        right += int(((model.scores(x, alive)[0] > 0) == truth).sum())
        total += len(truth)
    assert right / total > 0.98


def test_extracts_whole_articles_from_rows(frame):
    article = "".join(f"<p>Sentence number {i} of the story, which goes on &amp; on.</p>" for i in range(400))
    page = f"<html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article>{article}</article><footer>&copy; all rights</footer></body></html>"
    rows = h.extract(frame([(1, page), (2, None), (3, ""), (4, page), (5, "<p")], "page_id long, html string"), "html").collect()
    got = {r["page_id"]: r["text"] for r in rows}
    assert got[1] == got[4] == " ".join(f"Sentence number {i} of the story, which goes on & on." for i in range(400))
    assert got[2] == got[3] == "" and all(r["row"] == "x" for r in rows)
    assert h.extract(frame([], "page_id long, html string"), "html").count() == 0


def test_padding_does_not_change_a_page():
    pages = ["<article><p>Some words of a text, here.</p></article>", "<nav>" + "<a>x</a><p>y</p>" * 50 + "</nav><article><p>More words, there.</p></article>"]
    model = h.trained()
    assert model.extract(pages) == [model.extract([p])[0] for p in pages]


def test_only_raw_text_without_an_end_tag_hides_the_rest():
    for name in ("svg", "math", "object", "template"):
        assert texts(f"<p>a</p><{name} class='x'><p>b</p><p>c</p>") == ["a", "b", "c"], name
    for name in ("script", "style", "textarea", "iframe", "noscript"):
        assert texts(f"<p>a</p><{name}><p>b</p><p>c</p>") == ["a"], name
    assert texts("<p>a <math><mi>x</mi><mspace/><mn>2</mn></math> b</p>") == ["a", "x", "2", "b"]
    assert texts("<p>a <object data='y'>b</object> c</p><svg/><p>d</p>") == ["a", "b", "c", "d"]
    assert h.blocks("<div><svg><g><p>b</p></div>")[0].path == ("div", "p")


def test_articles_keep_formulas_and_what_follows_open_elements():
    sentences = [f"Sentence number {i} of the story, which goes on and on." for i in range(24)]
    body = [f"<p>{s}</p>" for s in sentences]
    for middle, extra in (("<svg><path d='x'>", []), ("<object data='a'>", []), ("<p>The law says <math><mi>E</mi><mo>=</mo><mi>m</mi></math> for bodies.</p>", ["The law says E = m for bodies."])):
        page = f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article>{''.join(body[:12])}{middle}{''.join(body[12:])}</article><footer>&copy; all rights</footer></body></html>"
        assert h.trained().extract([page]) == [" ".join([*sentences[:12], *extra, *sentences[12:]])]


def test_pieces_and_groups_do_not_change_scores(monkeypatch):
    model, layouts = h.trained(), h.Layouts(7)
    pages = [layouts.page() for _ in range(12)]
    whole = model.extract(pages)
    for page in pages:
        sequence = h.blocks(page)
        expected = model.scores(*h.padded([h.vectors(sequence)]))[0]
        monkeypatch.setattr(h, "CELLS", 5)
        assert model.page_scores(sequence) == pytest.approx(expected, abs=1e-4)
        monkeypatch.undo()
    monkeypatch.setattr(h, "CELLS", 40)
    assert model.extract(pages) == whole
    lengths = [3, 0, 41, 20, 20, 20, 1]
    groups = h.grouped(lengths)
    assert sorted(i for g in groups for i in g) == [0, 2, 3, 4, 5, 6]
    assert all(len(g) == 1 or len(g) * max(lengths[i] for i in g) <= 40 for g in groups)


def test_a_page_of_very_many_blocks_runs_in_little_memory(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(h, "CELLS", 2000)
    sequence = h.blocks("<nav><a>x</a></nav><article>" + "<p>Some words of a text, here.</p>" * 20_000 + "</article><footer>y</footer>")
    model = h.Labeller()
    assert len(sequence) == 20_002
    tracemalloc.start()
    scores = model.page_scores(sequence)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All vectors at once would take 25 MB.
    assert len(scores) == len(sequence) and peak < 10 << 20


def test_open_tags_without_an_end_do_not_take_the_square_of_the_page():
    import time

    started = time.perf_counter()
    assert len(texts("<p>a</p>" + "<a href=x " * 200_000)) == 2
    assert texts("<p>a</p>" + "<a href=x " * 3 + "<!-- b <p ")[1].endswith("<a href=x")
    assert time.perf_counter() - started < 20


def test_a_column_called_text_is_replaced(frame):
    page = "<article><p>Some words of a text, which are here to stay.</p></article>"
    rows = h.extract(frame([(1, page, "old")], "page_id long, html string, text string"), "html").collect()
    assert rows[0]["text"] != "old" and sorted(rows[0].asDict()) == ["html", "page_id", "row", "text"]
