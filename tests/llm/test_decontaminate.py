import hashlib
import random
import re

import pytest

from tidegate.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    words, hit, found = plain_words(text), set(), set()
    for name, body in items:
        item = plain_words(body)
        size = min(window, len(item))
        for i in range(len(item) - size + 1) if item else ():
            for at in range(len(words) - size + 1):
                if words[at : at + size] == item[i : i + size]:
                    hit |= set(range(at, at + size))
                    found.add(str(name) if name is not None else "")
    return len(words), sorted(hit), sorted(found)


@pytest.fixture(scope="module")
def case():
    draw = random.Random(5)
    vocabulary = ["a", "b", "Ab", "é", "x1", "c,d", "Z"]
    text = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(i, text(draw.choice([1, 2, 3, 4, 8, 12, 20]) + 2)) for i in range(12)] + [(50, ""), (51, None), (None, text(9)), (3, text(7))]
    bodies = [text(draw.randint(0, 60)) for _ in range(60)] + [None, "", "...", text(4000)]
    bodies += [f"{text(5)} {items[k][1]} {text(5)}" for k in range(12)]
    return items, bodies


@pytest.mark.parametrize(("window", "block_words"), [(4, 10_000), (7, 10_000), (4, 25)])
def test_spans_and_items_equal_brute_force(frame, case, window, block_words):
    items, bodies = case
    documents = frame([(i, t) for i, t in enumerate(bodies)] + [(None, bodies[0])], "doc_id long, text string")
    benchmark = frame(items, "item_id long, text string")
    rows = d.contaminated_spans(documents, "text", benchmark, window=window, block_words=block_words).collect()
    assert len(rows) == len(bodies) + 1
    for r in rows:
        n, hit, found = brute(r["text"], items, window)
        got = [w for s, e in r["hit_spans"] for w in range(s, e)]
        assert (r["n_words"], got, r["hit_items"]) == (n, hit, found), r["text"]
        assert r["row"] == "x"


def test_an_empty_benchmark_hits_nothing_and_empty_documents_give_nothing(frame):
    none = frame([], "item_id long, text string")
    rows = d.contaminated_spans(frame([(1, "a b")], "doc_id long, text string"), "text", none).collect()
    assert [(r["n_words"], r["hit_spans"]) for r in rows] == [(2, [])]
    assert d.contaminated_spans(none.withColumnRenamed("item_id", "doc_id"), "text", none).count() == 0


def test_spans_are_cut_out_and_mostly_hit_documents_dropped(frame):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Kept before, (One two three four five six seven eight nine ten eleven) and {'kept ' * 20}after."), (2, item), (3, "clean"), (4, None)]
    matched = d.contaminated_spans(frame(rows, "doc_id long, text string"), "text", frame([(9, item)], "item_id long, text string"))
    out = {r["doc_id"]: r["text"] for r in d.removed_spans(matched, "text").collect()}
    assert out == {1: f"Kept before, () and {'kept ' * 20}after.", 3: "clean", 4: None}


def test_ten_blocks_equal_one_and_the_driver_holds_one_at_a_time(frame, monkeypatch):
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=40))) for i in range(120)]
    items += items[:3] * 40
    bodies = [" ".join(draw.choices(vocabulary, k=30)) + " " + " ".join(items[i][1].split()[5:30]) for i in range(0, 120, 2)] + [" ".join(draw.choices(vocabulary, k=60)) for _ in range(40)]
    documents = frame([(i, t) for i, t in enumerate(bodies * 2)] + [(None, None), (None, "")], "doc_id long, text string")
    benchmark = frame(items, "item_id long, text string")
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")
    one = sorted(d.contaminated_spans(documents, "text", benchmark).collect(), key=key)
    held = []
    inner = d._machine
    monkeypatch.setattr(d, "_machine", lambda automata, block: held.append(automata.filter(d.F.col("block") == block).first()["machine"]) or inner(automata, block))
    ten = sorted(d.contaminated_spans(documents, "text", benchmark, block_words=960).collect(), key=key)
    assert ten == one and sum(bool(r["hit_spans"]) for r in ten) >= 120
    assert len(held) >= 8 and max(map(len, held)) < sum(map(len, held)) / 3


@pytest.mark.parametrize("block_words", [1000, 12])
def test_columns_with_the_names_of_added_ones_are_replaced(frame, block_words):
    rows = [(1, "one two three four", 7, "x", "y"), (2, None, 7, None, "z")]
    documents = frame(rows, "document long, text string, n_words int, HIT_SPANS string, digest string")
    items = [(i, f"{w} two three four five six seven eight nine ten eleven") for i, w in enumerate(["zero", "one", "uno"])] + [(9, "two three")]
    out = d.contaminated_spans(documents, "text", frame(items, "item_id long, text string"), block_words=block_words)
    assert out.columns == ["document", "text", "digest", "row", "n_words", "hit_spans", "hit_items"]
    got = {r["document"]: (r["digest"], r["n_words"], r["hit_spans"], r["hit_items"]) for r in out.collect()}
    assert got == {1: ("y", 4, [[1, 3]], ["9"]), 2: ("z", 0, [], [])}


def test_digest_of_items():
    assert d.item_digest(["10", "9"]) == hashlib.sha256(b"10,9").hexdigest()
