import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidegate.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(tree, index):
    """Siblings of a leaf, level by level."""
    out = []
    for nodes in tree[:-1]:
        first = index - index % 8
        out += [nodes[i] for i in range(first, min(first + 8, len(nodes))) if i != index]
        index //= 8
    return out


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof hash)."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), leaf(row), row[0]))
    names = sorted(by_lang, key=lambda n: (n is not None, (n or "").encode()))
    trees = {n: levels([d for _, d, _ in sorted(by_lang[n])]) for n in names}
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for t, n in enumerate(names):
        for i, (_, d, doc_id) in enumerate(sorted(by_lang[n])):
            out.append((doc_id, d, trees[n][-1][0], top[-1][0], h(*path(trees[n], i), *path(top, t))))
    return sorted(out, key=repr)


def proven(df):
    rows = df.select("doc_id", "lang", "text", merkle.leaf_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))).alias("leaf"))
    found, root = merkle.manifest(rows, "lang", ["doc_id"], "leaf")
    return found.withColumn("root", F.lit(root))


def test_every_node_stands_where_its_position_says():
    for leaves in (1, 2, 8, 9, 63, 64, 65, 70, 600):
        for height in (merkle.levels_above(leaves), merkle.levels_above(leaves) + 1):
            builder, counts, order = merkle.Builder(height), [0] * (height + 1), []
            append = builder.append

            def noted(digest, level=0, append=append, counts=counts, order=order):
                order.append((level, counts[level]))
                counts[level] += 1
                append(digest, level)

            builder.append = noted
            for i in range(leaves):
                builder.append(i.to_bytes(32, "big"))
            log = builder.close()
            assert len(log) == 32 * len(order)
            assert [merkle.position(level, index, leaves, height) for level, index in order] == list(range(len(order)))


@pytest.mark.parametrize("tier", [1, 2, 4])
def test_digests_and_proofs_equal_brute_force(frame, tier, monkeypatch, by_value):
    monkeypatch.setattr(merkle, "TIER", tier)  # with small blocks there are several tiers
    by_value(merkle)
    rows = [(i * 7 % 301, "web", "en" if i % 3 else ("de" if i % 2 else None), i, f"Text {i} é") for i in range(301)]
    rows += [(None, None, "fr", None, None), (5000, "", "it", 0, ""), (5001, "s", "", 3, "a" * 50_000), (5002, "s", "pt", 1, "x"), (5003, "s", "ru", 1, "x"), (5004, "s", "zh", 1, "x"), (5005, "s", "日", 1, "x"), (5006, "s", "𝄞", 1, "x"), (5007, "s", "sv", 1, "x")]
    rows += [rows[4]] * 20 + [(12, "other", "en", 1, "same id")]
    got = proven(frame(rows, SCHEMA)).withColumn("proof", F.sha2(F.array_join("siblings", ""), 256))
    assert sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof").collect()), key=repr) == brute(rows)


def test_a_changed_leaf_leads_to_another_root(frame):
    rows = [(i, "s", "en" if i % 2 else "de", i, f"t{i}") for i in range(100)]
    got = proven(frame(rows, SCHEMA))
    fold = lambda digest: merkle.folded(digest, F.col("places"), F.col("siblings"))
    right, wrong = got.select((fold(F.col("leaf")) == F.col("root")).alias("v")), got.select((fold(F.sha2("text", 256)) == F.col("root")).alias("v"))
    assert {r.v for r in right.collect()} == {True} and {r.v for r in wrong.collect()} == {False}


def test_one_leaf_is_its_root_and_no_leaf_has_none(frame):
    one = proven(frame([(1, "s", "en", 1, "t")], SCHEMA)).first()
    assert one.leaf == one.subroot == one.root and one.siblings == []
    assert proven(frame([], SCHEMA)).count() == 0


def test_reserved_columns_are_refused(frame):
    df = frame([(1, "s", "en", 1, "t")], SCHEMA).withColumn("index", F.lit(1)).withColumn("leaf", F.lit("00"))
    with pytest.raises(ValueError, match="index"):
        merkle.manifest(df, "lang", ["doc_id"], "leaf")


def test_tampering_is_found_in_the_query(spark, tmp_path):
    from tidegate.llm.queries import QUERIES

    rows = [(i, "s", "en", 1, "ABC" if i % 2 else "abc") for i in range(60)] + [(None, None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.verified for r in QUERIES["op11_merkle"](spark, str(tmp_path)).collect()}
    assert got == {i: not (i % 2 and zlib.crc32(str(i).encode()) % 3 == 0) for i in range(60)} | {None: True}
