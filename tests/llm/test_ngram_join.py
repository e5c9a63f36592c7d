import pickle
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import components as components_module
from tidegate.llm import ngram_join as nj
from tidegate.llm.common import written
from tidegate.llm.components import components

SCHEMA = "doc_id long, text string"


def shingles(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", folded) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(id, set size, component) of each row; rows that share an id are one node."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = set()
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
                if a != b and x != y:
                    links.add((max(a, b), min(a, b)))
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=repr), links


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    words = [f"w{i}" for i in range(300)] + ["Ab", "é"]
    text = lambda n: draw.choices(words, k=n)
    passage = text(50)
    out = []
    for base in [text(n) for n in (3, 8, 30, 60, 120, 200)]:
        for _ in range(22):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 5, 9])):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            out.append(copy[: len(copy) - draw.choice([0, 0, 1, 4])])
    out += [text(20) + passage + text(draw.randint(1, 60)) for _ in range(60)]
    rows = [(i * 3, " ".join(t)) for i, t in enumerate(out)]
    return rows + [(1, None), (2, ""), (4, " \n"), (5, " ".join(text(4000))), (None, rows[0][1]), (None, None), rows[9], (rows[30][0], rows[90][1]), (7, rows[50][1].upper())]


@pytest.mark.parametrize("agree", [9, 2])
def test_components_equal_brute_force(frame, rows, agree, monkeypatch):
    monkeypatch.setattr(nj, "HUB_AGREE", agree)  # with 9 there are no hubs, and every link is found by the prefix filters
    found, links = nj.near_duplicates(frame(rows, SCHEMA))
    expected, all_links = brute(rows)
    assert sorted(map(tuple, found.collect()), key=repr) == expected
    assert {(r["a"], r["b"]) for r in links.collect()} <= all_links


def test_a_large_group_of_copies_costs_a_pair_for_each(frame):
    draw = random.Random(1)
    base = [f"w{i}" for i in range(150)]

    def copy():
        out = list(base)
        out[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        return " ".join(out)

    found, links = nj.near_duplicates(frame([(i, copy()) for i in range(600)], SCHEMA))
    assert {r["component_id"] for r in found.collect()} == {0}
    assert links.count() < 6000


def test_copies_that_only_the_original_links_do_not_become_all_pairs(frame, monkeypatch):
    draw, n = random.Random(4), 2000
    base = [f"w{i}" for i in range(300)]

    def copy():
        out = list(base)
        for at in draw.sample(range(300), 6):  # two copies are about 0.66 alike
            out[at] = f"x{draw.randrange(10**9)}"
        return " ".join(out)

    ids = draw.sample(range(10**9), n + 1)  # the original is anywhere among them
    met, cross = [], nj.cross_pairs

    def counted(rows):
        met.append(cross(rows))
        return met[-1]

    monkeypatch.setattr(nj, "cross_pairs", counted)
    unlike = [(10**9 + i, " ".join(f"u{i}_{j}" for j in range(60))) for i in range(200)]
    found, links = nj.near_duplicates(frame([(ids[0], " ".join(base)), *((i, copy()) for i in ids[1:]), *unlike], SCHEMA))
    components = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert {components[i] for i in ids} == {min(ids)}
    assert all(components[i] == i for i, _ in unlike)
    assert links.count() < 5 * n and met[0].count() < n


def test_empty_table(frame):
    found, links = nj.near_duplicates(frame([], SCHEMA))
    assert found.count() == 0 and links.count() == 0


def test_word_hashes_tell_words_apart_wherever_they_stand():
    draw = random.Random(2)
    words = [bytes(draw.choices(b"abcXYZ\xc3\xa9\x00\xff-", k=draw.choice([1, 2, 3, 8, 64, 65, 300]))) for _ in range(3000)] + [b"ab", b"ba", b"a" * 3_000_000]
    text = b"".join(w + draw.choice([b" ", b"\t\n", b"\r\x0b\x0c "]) for w in words)
    ids = nj.Shingler().word_ids(text)
    assert len(ids) == len(words) and len(set(words)) == len(set(ids.tolist())) == len(set(zip(words, ids.tolist())))
    assert nj.Shingler().word_ids(b" \n").tolist() == []


def test_a_prefix_is_the_start_of_the_whole_order():
    counts = np.random.default_rng(1).integers(0, 3, (nj.ORDERS, nj.BUCKETS))
    for n in (1, 2, 5, 100, 1000):
        tokens = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64))
        for order in range(nj.ORDERS):
            keys = [(int(counts[order][nj.buckets_of(tokens[i : i + 1], order)[0]]), int(nj.mixed(tokens[i : i + 1], order + nj.ORDERS)[0] >> np.uint64(30)), int(t)) for i, t in enumerate(tokens)]
            assert nj.first_in_order(tokens, counts, order).tolist() == [k[2] for k in sorted(keys)][: nj.prefix_size(len(tokens))]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(900, i) for i in range(901, 930)] + [(5, 5), (7, 6), (6, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 900 for i in range(900, 930)} | {6: 6, 7: 6}


def test_rounds_of_components_send_nothing_through_the_driver(spark, monkeypatch):
    plans = []

    def noted(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(components_module, "written", noted)
    chain = spark.range(1, 9).selectExpr("id AS a", "id - 1 AS b").unionByName(spark.range(21, 30).selectExpr("id AS a", "20L AS b"))
    got = components_module.components(chain)
    assert {(r.node, r.component) for r in got.collect()} == {(n, 0) for n in range(9)} | {(n, 20) for n in range(20, 30)}
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 3 and not any("Broadcast" in p for p in plans)
    plans.clear()
    components_module.components(spark.range(1, 9).selectExpr("id AS a", "0L AS b"))
    assert len(plans) == 1, "stars need no round"


def test_a_round_of_components_shuffles_seven_times(spark, monkeypatch):
    plans = []

    def noted(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n"))
        return written(df, name)

    monkeypatch.setattr(components_module, "written", noted)
    components_module.components(spark.range(1, 9).selectExpr("id AS a", "id - 1 AS b"))
    shuffles = [sum("Exchange hashpartitioning" in line and "Reused" not in line for line in plan) for plan in plans[1:]]
    assert shuffles and max(shuffles) <= 7


def test_later_components_start_from_the_stars_of_earlier_ones(frame, monkeypatch):
    draw, n = random.Random(4), 80
    base = [f"w{i}" for i in range(300)]
    given = []

    def noted(links, name):
        given.append(links.distinct().collect())
        return components(links, name)

    def copy():
        out = list(base)
        for at in draw.sample(range(300), 6):  # two copies are about 0.66 alike
            out[at] = f"x{draw.randrange(10**9)}"
        return " ".join(out)

    monkeypatch.setattr(nj, "components", noted)
    found, _ = nj.near_duplicates(frame([(n // 2, " ".join(base)), *((i, copy()) for i in range(n) if i != n // 2)], SCHEMA))
    assert {r["component_id"] for r in found.collect()} == {0}
    hangs = [r["a"] for r in given[-1] if r["a"] != r["b"]]
    assert len(hangs) == len(set(hangs)) == n - 1


def test_the_driver_holds_the_token_counts_packed(frame):
    profiles = frame([(b"", None)], "x binary, y long").select("x").mapInArrow(lambda batches: nj._profile(pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": pa.array([b"a b c d e f"])}) for _ in batches), "doc_id long, n long, d1 long, d2 long, least array<long>, counts binary")
    counts = nj.token_counts(profiles)
    assert len(pickle.dumps(counts)) < 1 << 20
    assert counts.tables.shape == (nj.ORDERS, nj.BUCKETS) and counts.tables.sum() == 2 * nj.ORDERS


def test_full_buckets_count_no_higher():
    full = np.full((nj.ORDERS, nj.BUCKETS), nj.FULL + 5)
    added = next(nj._added(iter([pa.RecordBatch.from_pydict({"counts": [nj._packed_counts(full)] * 3})])))
    assert (nj.TokenCounts(added.column(0)[0].as_py()).tables == nj.FULL).all()


def test_the_nodes_of_stars_are_found_without_a_join(spark):
    got = components(spark.range(1, 50).selectExpr("id AS a", "0L AS b"))
    assert sorted(map(tuple, got.collect())) == [(i, 0) for i in range(50)]
    # An anti join is pushed below the distinct and then sends all links of a hub to one task.
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
