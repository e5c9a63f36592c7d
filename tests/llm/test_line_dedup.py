import random
from functools import lru_cache

import pytest

from tidegate.llm import line_dedup as ld

SCHEMA = "doc_id long, text string"


@lru_cache(None)
def near(a, b):
    """At most one character changed, added or left out."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i:] or a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def brute(rows):
    places = [((d is not None, d or 0, n), line) for d, t in rows if t is not None for n, line in enumerate(t.split("\n")) if len(line) >= ld.LEAST_CHARS]
    return {(p, line) for p, line in places if any(q < p and near(line, other) for q, other in places)}


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    base = ["".join(draw.choices("abcdéü 𝄞", k=k)) for k in (16, 16, 17, 18, 31, 40, 41, 90)] + ["a" * 16, "a" * 17, "a" * 30]

    def edited(line):
        for _ in range(draw.choice([0, 0, 1, 1, 2])):
            i = draw.randrange(len(line))
            line = draw.choice([line[:i] + line[i + 1 :], line[:i] + draw.choice("abé𝄞") + line[i:], line[:i] + draw.choice("abcü") + line[i + 1 :]])
        return line

    out = [(i, "\n".join(edited(draw.choice(base)) for _ in range(draw.randint(0, 6)))) for i in range(80)]
    return [*out, (200, None), (201, ""), (202, "short\nshort"), (None, out[3][1]), (None, "x" * 20 + "\n" + "x" * 21), (300, "y" * 3000 + "z"), (301, "y" * 3001)]


def test_removed_lines_equal_brute_force(frame, rows):
    found = ld.near_lines(frame(rows, SCHEMA)).collect()
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t)
    got = set()
    for r in found:
        for t in texts[r["doc_id"]]:
            lines = (t or "").split("\n")
            if r["no"] < len(lines):
                place = ((r["doc_id"] is not None, r["doc_id"] or 0, r["no"]), lines[r["no"]])
                got.add(place)
    expected = brute(rows)
    assert expected and {e for e in expected if e[0][0]} == {g for g in got if g[0][0]}
    assert expected - got == set()


def test_repeated_rows_are_one_place_and_very_common_lines_keep_one(frame):
    line = "a line that everyone has"
    rows = [(i, line) for i in range(1, 400)] + [(1, line)] + [(1000 + i, f"a line that number {i % 10} has") for i in range(40)]
    removed = ld.near_lines(frame(rows, SCHEMA))
    counts = {(r["doc_id"], r["n_removed"]) for r in ld.line_counts(frame(rows, SCHEMA), removed).collect()}
    assert {d for d, n in counts if n == 0} == {1, 1000}


def test_texts_without_the_lines(frame, rows):
    documents = frame([(1, "a first line of text\nkept short\nanother long line here"), (2, "kept\na first line of texts\nmore of the kept lines"), (3, None)], SCHEMA)
    out = {r["doc_id"]: (r["text"], r["row"]) for r in ld.without_lines(documents, ld.near_lines(documents)).collect()}
    assert out[2] == ("kept\nmore of the kept lines", "x") and out[3] == (None, "x") and out[1][0].count("\n") == 2


def test_empty_table(frame):
    none = frame([], SCHEMA)
    assert ld.line_counts(none, ld.near_lines(none)).count() == 0


def test_short_lines_go_if_equal_and_only_then(frame, rows):
    found = ld.near_lines(frame(rows, SCHEMA), equal_chars=1).filter("doc_id is not null").collect()
    places = [((d is not None, d or 0, n), line) for d, t in rows if t is not None for n, line in enumerate(t.split("\n")) if line]
    alike = lambda a, b: a == b or (min(len(a), len(b)) >= ld.LEAST_CHARS and near(a, b))
    expected = {p[1:] for p, line in places if p[0] and any(q < p and alike(line, other) for q, other in places)}
    assert (202, 1) in expected and {(r["doc_id"], r["no"]) for r in found} == expected


def test_the_query_removes_copies_of_short_lines(spark, tmp_path):
    from __spark_entry__ import queries

    texts = [(1, "Home\n\nan article of some length\nShare"), (2, "Home\n\nShare\nShore"), (3, "Share\n}\n}")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed_lines"]) for r in queries()["op2_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (4, 0, ""), 2: (4, 2, "0,2"), 3: (3, 2, "0,2")}
