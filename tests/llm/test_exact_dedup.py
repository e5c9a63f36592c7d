import hashlib

import pytest
from pyspark.sql import functions as F

from tidegate.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def brute(rows, largest):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        some = [i for i in ids if i is not None]
        keep = (max if largest else min)(some) if some else None
        stays = ids.index(keep)
        out += [(i, keep, len(ids), n == stays, hashlib.sha256(text.encode()).hexdigest()) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


ROWS = [(i, f"t{i % 37}") for i in range(400)] + [(1000 + i, "hot é") for i in range(300)] + [(None, "t1"), (None, "alone"), (None, "alone"), (5, None), (6, ""), (7, "a" * 300_000), (8, "a" * 300_000)] + [(9, "tie")] * 3


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("fan_rounds", [1, 3])
def test_equals_brute_force(frame, monkeypatch, largest, fan_rounds):
    monkeypatch.setattr(exact_dedup, "rounds_for", lambda partitions: fan_rounds)
    got = exact_dedup.exact_duplicates(frame(ROWS, SCHEMA, 7), largest=largest).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(ROWS, largest)


def test_rounds_cover_all_partitions():
    assert [exact_dedup.rounds_for(n) for n in (1, 16, 17, 256, 257, 4097)] == [1, 1, 2, 2, 3, 4]


def test_a_normaliser_decides_what_is_equal(frame):
    rows = [(1, " A b"), (2, "a b "), (3, "ab")]
    got = exact_dedup.exact_duplicates(frame(rows, SCHEMA), normalise=lambda t: F.lower(F.trim(t)))
    assert sorted((r.doc_id, r.keep_id) for r in got.collect()) == [(1, 1), (2, 1), (3, 3)]


def test_the_kept_documents_keep_all_their_columns(frame):
    df = frame(ROWS[:400], SCHEMA).withColumn("kept", F.lit("k"))
    got = exact_dedup.without_copies(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == list(range(37))


def test_empty_table(frame):
    assert exact_dedup.exact_duplicates(frame([], SCHEMA)).count() == 0


def test_nothing_runs_in_python(frame):
    plan = exact_dedup.exact_duplicates(frame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
