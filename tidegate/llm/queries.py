"""Registered queries of the subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import decontaminate, exact_dedup, html_text, language, line_dedup, merkle, mixing, ngram_join, prefix_trie, quality_lines, sharding, substring_dedup, warc
from tidegate.llm.common import n_words, table
from tidegate.llm.sql import CRC_TABLE, crc32, merkle_sql
from tidegate.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


@query(
    "op1_warc",
    """
WITH sized AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM sized LEFT JOIN firsts USING (payload_digest)
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path, payloads=False))


@query(
    "op2_line_dedup",
    """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM documents WHERE text IS NOT NULL
), firsts AS (
    SELECT line, min((doc_id, no)) AS first FROM lines WHERE line <> '' GROUP BY line
), shorter AS (
    SELECT line, first, p, md5(left(line, p - 1) || substr(line, p + 1)) AS rest FROM (SELECT *, unnest(range(1, length(line) + 1)) AS p FROM firsts WHERE length(line) >= 16)
), met AS (
    SELECT s.line FROM shorter s JOIN (SELECT rest, p, min(first) AS first FROM shorter GROUP BY ALL) m USING (rest, p) WHERE m.first < s.first
    UNION
    SELECT s.line FROM shorter s JOIN firsts f ON s.rest = md5(f.line) WHERE length(f.line) >= 16 AND f.first < s.first
    UNION
    SELECT f.line FROM shorter s JOIN firsts f ON s.rest = md5(f.line) WHERE length(f.line) >= 16 AND s.first < f.first
), gone AS (
    SELECT DISTINCT l.doc_id, l.no FROM lines l JOIN firsts f USING (line) WHERE (l.doc_id, l.no) > f.first OR l.line IN (SELECT line FROM met)
), numbers AS (
    SELECT doc_id, count(*) AS n_removed, string_agg(no::VARCHAR, ',' ORDER BY no) AS removed_lines FROM gone GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed_lines, '') AS removed_lines
FROM documents d LEFT JOIN numbers USING (doc_id)
""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that equal or nearly equal an earlier line of any document; short ones only if equal."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_counts(documents, line_dedup.near_lines(documents, equal_chars=1))


@query(
    "op3_decontaminate",
    """
WITH folded AS (
    SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words FROM documents
), items AS (
    SELECT item_id, words, least(10, len(words)) AS size
    FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark)
    WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[start:start + size - 1], ' ') AS sequence
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS start FROM items)
), starts AS (
    SELECT row, start, size, array_to_string(words[start:start + size - 1], ' ') AS sequence
    FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS start FROM folded, (SELECT DISTINCT size FROM windows))
), found AS (
    SELECT row, start, size, item_id FROM starts JOIN windows USING (size, sequence)
), hit AS (
    SELECT row, count(DISTINCT position) AS n_hit FROM (SELECT row, start + unnest(range(0, size)) AS position FROM found) GROUP BY row
), named AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM found) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM folded LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in windows of benchmark items."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = decontaminate.contaminated_spans(documents, "text", table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    return matched.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


@query(
    "op4_substring_dedup",
    """
WITH worded AS (
    SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents
), windows AS (
    SELECT row, start, md5(array_to_string(words[start:start + 34], ' ')) AS sequence
    FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS start FROM worded)
), starts AS (
    SELECT row, start FROM windows JOIN (SELECT sequence FROM windows GROUP BY sequence HAVING count(*) > 1) USING (sequence)
), hit AS (
    SELECT DISTINCT row, start + unnest(range(0, 35)) AS position FROM starts
), removed AS (
    SELECT row, list(position) AS positions FROM hit GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(positions), 0)::BIGINT AS n_removed,
    sha256(CASE WHEN positions IS NULL THEN array_to_string(words, ' ')
        ELSE array_to_string(list_transform(list_sort(list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(positions, p))), lambda p: words[p]), ' ') END) AS kept_sha256
FROM worded LEFT JOIN removed USING (row)
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that occur twice or more."""
    return substring_dedup.removed_repeats(table(spark, sf_dir, "documents"))


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages, "html").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(
    "op6_ngram_join",
    """
WITH RECURSIVE worded AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, md5(array_to_string(words[start:start + 4], ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS start FROM worded WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * common >= 75 * (p.n + q.n - common)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id FROM reached r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of each document under Jaccard links of word 5-grams."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))[0]


@query("op7_quality_lines")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document and whether enough of its words lie in content lines."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    field = quality_lines.train(documents, "doc_id", "text", table(spark, sf_dir, "labels"), "quality")
    return quality_lines.judge(documents, "text", field).drop("text")


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document; a fifth of the documents, by crc32 of the id, is not learned from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    samples = language.language_samples(documents.filter(~held_out), "text", "lang")
    return language.identify(documents.select("doc_id", "text", held_out.alias("held_out")), "text", samples).drop("text")


@query(
    "op9_mix",
    """
WITH RECURSIVE sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sources AS (
    SELECT source, sum(size) AS source_size, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
    FROM sized GROUP BY source
), shares AS (
    SELECT source, source_size::DOUBLE AS source_size, weight, FALSE AS capped, 0.0::DOUBLE AS target, 0 AS round FROM sources
    UNION ALL
    SELECT source, source_size, weight,
        capped OR share >= 2 * source_size,
        CASE WHEN capped OR share >= 2 * source_size THEN 2 * source_size ELSE share END, round + 1
    FROM (
        SELECT *, weight / greatest(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 1e-300)
            * (1.5 * sum(source_size) OVER () - sum(CASE WHEN capped THEN 2 * source_size ELSE 0 END) OVER ()) AS share
        FROM shares WHERE round < 64
    )
), targets AS (
    SELECT source, source_size::BIGINT AS source_size, target FROM shares WHERE round = 64
), keyed AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 1e-6)::BIGINT AS budget,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix' || chr(31) || coalesce(d.doc_id::VARCHAR, chr(0))), d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, floor(target * 1000 + 0.5) / 1000 AS target,
    (CASE WHEN source_size > 0 THEN (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM keyed
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", n_words(F.col("text")).alias("size"), "source")
    mixed = mixing.mix(documents, "size", "source", ["doc_id"])
    taken = F.col("epochs") * F.col("size") + F.col("part")
    target = (F.floor(F.col("target") * 1000 + 0.5) / 1000).alias("target")
    return mixed.select("doc_id", "size", "source_size", target, taken.alias("taken"))


@query("op10_shard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    documents = table(spark, sf_dir, "documents").withColumn("size", (F.octet_length(body) + 16).cast("long"))
    sharded = sharding.shuffle_into_shards(documents, "size", 40)
    return sharded.select(
        "doc_id", "size", F.crc32(body).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op11_merkle", merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proof of every document, folded from a leaf that is tampered with in a third of the cases."""
    body = F.col("text")
    lowered = F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, lowered).otherwise(body)
    leaf = lambda text: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", leaf(body).alias("leaf"), leaf(tampered).alias("claimed"))
    proven, root = merkle.manifest(rows, "lang", ["doc_id"], "leaf")
    folded = merkle.folded(F.col("claimed"), F.col("places"), F.col("siblings"))
    digests = proven.select(
        "doc_id", "leaf", "subroot", F.lit(root).alias("root"), F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), folded.alias("folded_root")
    )
    return digests.withColumn("verified", F.col("folded_root") == F.col("root"))


@query(
    "op12_exact_dedup",
    """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each text, of which the one with the largest id stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), largest=True)


@query(
    "op13_prefix_trie",
    f"""
WITH {CRC_TABLE}, turns AS (
    SELECT conv_id, turn, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(bytes ORDER BY turn NULLS FIRST, id) AS sizes FROM turns GROUP BY conv_id
), headed AS (
    SELECT own.*, {crc32("conv_id::VARCHAR")} % 9 AS h FROM own, crc_table
), rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.ids[1:o.h], []), o.ids[o.h + 1:]) AS ids, list_concat(coalesce(b.sizes[1:o.h], []), o.sizes[o.h + 1:]) AS sizes
    FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5
), prefixes AS (
    SELECT conv_id, d AS depth, array_to_string(ids[1:d], '') AS key, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes, len(ids) = d AS ends
    FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(bytes) AS saved, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
    FROM prefixes GROUP BY key, depth
), grown AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN (SELECT left(key, len(key) - 32) AS above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above) c ON c.above = n.key
), sums AS (
    SELECT key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT left(key, 32 * unnest(range(0, depth + 1))) AS key, n_children, saved FROM grown) GROUP BY key
)
SELECT g.conv_id, g.depth, p.conv_id AS parent_conv_id, g.n_convs, g.n_children, n_leaves, saved_tokens, sha256(g.ends) AS ends_sha256
FROM grown g JOIN sums USING (key) LEFT JOIN nodes p ON g.depth > 0 AND p.key = left(g.key, len(g.key) - 32)
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the conversations, each rebuilt on the head of another."""
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.conversations(table(spark, sf_dir, "conversations"))))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline applied to the documents."""
    return corpus_pipeline.run(spark, sf_dir)
