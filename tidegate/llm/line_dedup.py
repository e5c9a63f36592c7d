"""Line dedup by a deletion-neighbourhood join, with DataFrame operations only.

Two lines are near if one edit of a character (a change, an insertion or a
removal) at most lies between them. Each candidate line emits the hash of every
variant with one character left out, and its own; equal variants meet, the edit
distance is verified, and the earliest line stays. Lines that no other line
shares a half with cannot have a neighbour and emit nothing: one edit leaves
the half before it or the half behind it as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import dealt_anew, written

#: Shorter lines are near to no other, as one edit means too much there; equal ones can still go.
LEAST_CHARS = 16
#: Copies of a line meet their first one in so many separate groups.
SALTS = 32


def lines_of(documents: DataFrame, doc_id: str, text: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row for each line of ``least_chars`` or more: document, row (hash of id and text), number from 0, text."""
    some = documents.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), F.col(text).alias("text"))
    each = some.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return each.filter(F.length("line") >= least_chars)


def _halves(line: Column) -> list[Column]:
    """Hashes of the halves, for the line as the longer and as the shorter one of a pair; null if both are the same or the line is under ``LEAST_CHARS``."""
    n = F.length(line)
    front, front_short = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    back, back_short = F.ceil(n / 2).cast("int"), F.ceil((n - 1) / 2).cast("int")
    head = lambda size: F.xxhash64(F.lit("front"), size, F.substring(line, F.lit(1), size))
    tail = lambda size: F.xxhash64(F.lit("back"), size, F.substring(line, n - size + 1, size))
    halves = [head(front), F.when(front_short != front, head(front_short)), tail(back), F.when(back_short != back, tail(back_short))]
    return [F.when(n >= LEAST_CHARS, half) for half in halves]


def near_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", equal_chars: int = LEAST_CHARS) -> DataFrame:
    """Lines to remove: ``doc_id``, ``row``, ``no`` of each line with an equal or near one at an earlier place.

    Places are ordered by document id (null first) and line number. A line goes if any earlier line is equal or
    one edit away, whether or not that one stays. Lines of ``LEAST_CHARS`` or more can be near, those of
    ``equal_chars`` or more equal: with 1 all but empty ones are compared. Rows with the same id and text are one place and keep the same
    lines. Null texts have no lines; an empty table has none. Other columns play no part.
    """
    lines = lines_of(documents, doc_id, text, min(equal_chars, LEAST_CHARS))
    named = lines.select("doc_id", "row", "no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), *(k.alias(f"half{i}") for i, k in enumerate(_halves(F.col("line")))))
    firsts = named.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "no")).alias("first"), F.max(F.struct("doc_id", "no")).alias("last"), *(F.max(f"half{i}").alias(f"half{i}") for i in range(4))
    )
    emitting = written(_candidates(firsts, documents, doc_id, text), "line-candidates")
    near = _later_of_pairs(emitting)
    # Of equal lines all but the first go, of lines near to an earlier one all.
    gone = firsts.join(near, ["h1", "h2"], "left").filter(F.col("is_near").isNotNull() | (F.col("first") < F.col("last")))
    spread = gone.select("h1", "h2", "first", "is_near", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = named.select("doc_id", "row", "no", "h1", "h2", F.pmod(F.xxhash64("doc_id", "no"), F.lit(SALTS)).cast("int").alias("salt"))
    later = F.col("is_near").isNotNull() | (F.struct("doc_id", "no") > F.col("first"))
    return salted.join(spread, ["h1", "h2", "salt"]).filter(later).select("doc_id", "row", "no").distinct()


def _candidates(firsts: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Distinct lines that share a half with another one, with their text and which half it is."""
    halves = firsts.select(
        F.explode(F.array_compact(F.array(*(F.when(F.col(f"half{i}").isNotNull(), F.struct(F.col(f"half{i}").alias("half"), F.lit(i < 2).alias("front"))) for i in range(4))))).alias("key"), "h1", "h2", "first"
    ).select("key.half", "key.front", "h1", "h2", "first")
    shared = halves.groupBy("half").agg(F.min("first").alias("one"), F.max("first").alias("other")).filter("one < other").select(dealt_anew(F.col("half")).alias("half"))
    found = halves.withColumn("half", dealt_anew(F.col("half"))).join(shared, "half").groupBy("h1", "h2", "first").agg(F.max("front").alias("front"), F.max(~F.col("front")).alias("back"))
    at = found.select("h1", "h2", "first", "front", "back", F.col("first.doc_id").alias("at_doc"), F.col("first.no").alias("at_no"))
    bodies = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    line = F.element_at(F.split("text", "\n"), F.col("at_no") + 1)
    fetched = at.join(bodies, F.col("at_doc").eqNullSafe(F.col("doc_id"))).filter(F.size(F.split("text", "\n")) > F.col("at_no")).withColumn("line", line)
    right = fetched.filter((F.xxhash64("line") == F.col("h1")) & (F.xxhash64(F.lit(1), "line") == F.col("h2")))
    return right.select("h1", "h2", "first", "front", "back", "line").dropDuplicates(["h1", "h2"])


def _later_of_pairs(lines: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``is_near`` of the lines that have a verified neighbour at an earlier place."""
    n = F.length("line")
    # A shared front half leaves the places behind it, a shared back half those before it.
    start = F.when(F.col("back"), 1).otherwise(F.floor((n - 1) / 2) + 1).cast("int")
    end = F.when(F.col("front"), n).otherwise(n - F.ceil((n - 1) / 2)).cast("int")
    # Characters of four bytes each, so that a place in the text is a place in the bytes.
    wide = lines.withColumn("wide", F.encode("line", "UTF-32"))
    ids = ["h1", "h2", "first"]
    left = F.substring(F.col("wide"), F.lit(1), (F.col("p") - 1) * 4)
    right = F.substring(F.col("wide"), F.col("p") * 4 + 1, F.octet_length("wide"))
    # The places are rows before anything is cut, which lets the cutting be compiled; a function over an array is not.
    places = wide.select(*ids, "wide", F.explode(F.sequence(start, end)).alias("p"))
    cut = places.select(*ids, "p", F.xxhash64(F.concat(left, right)).alias("rest"))
    # Side 1: changed at the same place. Side 2: with a gap, to meet a whole line (side 3).
    change = F.struct(F.xxhash64(F.lit("change"), "rest", "p").alias("key"), F.lit(1).alias("side"))
    gap = F.struct(F.xxhash64(F.lit("gap"), "rest").alias("key"), F.lit(2).alias("side"))
    left_out = cut.select(*ids, F.explode(F.array(change, gap)).alias("k")).select(*ids, "k.key", "k.side")
    own = wide.select(*ids, F.xxhash64(F.lit("gap"), F.xxhash64("wide")).alias("key"), F.lit(3).alias("side"))
    everything = left_out.unionByName(own)
    # Few variants meet another line's; a small aggregate finds them, and only they go on.
    shared = everything.groupBy("key").agg(F.min("h1").alias("one"), F.max("h1").alias("other")).filter("one < other").select(dealt_anew(F.col("key")).alias("key"))
    everything = written(everything.withColumn("key", dealt_anew(F.col("key"))).join(shared, "key"), "line-variants")
    # Changed lines look for any other, shortened ones for a whole line, whole lines for a shortened one.
    first_of = lambda *sides: F.min(F.when(F.col("side").isin(*sides), F.struct("first", "h1", "h2")))
    met = everything.groupBy("key").agg(first_of(1).alias("m1"), first_of(2).alias("m2"), first_of(3).alias("m3"))
    mate = F.when(F.col("side") == 1, F.col("m1")).when(F.col("side") == 2, F.col("m3")).otherwise(F.col("m2"))
    pairs = everything.join(met, "key").withColumn("mate", mate).filter(F.col("mate.first") < F.col("first"))
    pairs = pairs.select("h1", "h2", F.col("mate.h1").alias("m_h1"), F.col("mate.h2").alias("m_h2")).distinct()
    body = lines.select("h1", "h2", "line")
    mates = lines.select(F.col("h1").alias("m_h1"), F.col("h2").alias("m_h2"), F.col("line").alias("m_line"))
    verified = pairs.join(body, ["h1", "h2"]).join(mates, ["m_h1", "m_h2"]).filter(F.levenshtein("line", "m_line", 1) >= 0)
    return verified.select("h1", "h2", F.lit(True).alias("is_near")).distinct()


def line_counts(documents: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds to each document's id its number of lines, how many go and which (numbers from 0, in order)."""
    lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n")))
    narrow = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), lines.cast("long").alias("n_lines"))
    return _with_removed(narrow, removed).select(
        "doc_id", "n_lines", F.coalesce(F.size("numbers"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("numbers", ","), F.lit("")).alias("removed_lines")
    )


def without_lines(documents: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the removed lines taken out of their text; null texts stay null."""
    names = documents.columns
    packed = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), F.struct(*names).alias("document"))
    kept = F.array_join(F.filter(F.split(F.col("document")[text], "\n"), lambda _, i: ~F.array_contains("numbers", i)), "\n")
    body = F.when(F.col("numbers").isNull(), F.col("document")[text]).otherwise(kept)
    return _with_removed(packed, removed).select(*(body.alias(n) if n == text else F.col("document")[n].alias(n) for n in names))


def _with_removed(rows: DataFrame, removed: DataFrame) -> DataFrame:
    # A document's lines are its own size, not a group that grows with the table.
    numbers = removed.groupBy(F.col("doc_id").alias("of_doc"), F.col("row").alias("of_row")).agg(F.array_sort(F.collect_list("no")).alias("numbers"))
    return rows.join(numbers, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("row") == F.col("of_row")), "left")
