import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from tidegate.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string"


def brute(rows):
    words = [(t or "").encode().split() for _, t in rows]
    windows = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        hit = {j for i in range(len(w) - 34) if windows[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in hit)
        out.append((d, len(w), len(hit), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    text = lambda n: " ".join(draw.choices(["a", "b\t", "c\n", "dé", "e f"] + [f"w{i}" for i in range(40)], k=n))
    passages = [text(n) for n in (20, 34, 35, 36, 60, 200)]
    out = [(i, f"{text(draw.randint(0, 50))} {draw.choice(passages)} {text(draw.randint(0, 50))}") for i in range(120)]
    out += [(200, None), (201, ""), (202, text(34)), (203, " ".join(["x"] * 300)), (204, text(3000)), (205, text(35)), (None, out[0][1]), (None, None)]
    copied = text(50)
    return out + [(300 + i, copied) for i in range(40)] + [out[5], (6, text(80))]


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_equals_brute_force_whatever_the_cuts(spark, frame, rows, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = sd.removed_repeats(frame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter(map(tuple, got)) == Counter(brute(rows))


def test_kept_text_and_empty_table(frame, rows):
    kept = sd.removed_repeats(frame(rows, SCHEMA), with_text=True).collect()
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in kept)
    assert sd.removed_repeats(frame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sizes", [[1, 1, 1, 1, 1, 1, 1], [7], [2, 5], [1, 6], [3, 1, 3]])
def test_nodes_do_not_depend_on_batches(sizes):
    keys = [1, 2, 2, 3, 4, 4, 4]
    names = ["s01", "s23", "s4", "doc_id", "version", "start"]
    table = pa.table([keys, keys, keys, list(range(7)), [0] * 7, [0] * 7], names=names)
    batches, at = [], 0
    for n in sizes:
        batches.append(table.slice(at, n).combine_chunks().to_batches()[0])
        at += n
    out = pa.Table.from_batches(sd._deep_nodes(iter(batches))).to_pylist()
    assert sorted(r["doc_id"] for r in out if not r["edge"]) == [1, 2, 4, 5, 6]
    assert sorted((r["doc_id"], r["placed"]) for r in out if r["edge"]) == [(0, True), (6, False)]
