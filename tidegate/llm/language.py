"""Language identification by compression.

Each language has a raw-content Zstandard dictionary cut from a bounded sample
of labelled texts. A text is encoded piece by piece with every dictionary; the
language whose dictionary leaves the fewest bytes wins (of either, only letters count, in lower case), and a narrow margin to
the second rejects the verdict.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import add_columns

#: Sample of a language: at most so many texts, chosen by hash, and so many characters of each, from anywhere in it.
SAMPLE_TEXTS, SAMPLE_CHARS = 256, 1500
#: Bytes of a text that are encoded at once; every piece of the text is.
PIECE = 2000
LEVEL = 5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """What tells languages apart: letters in lower case, everything between them as one space."""
    return _OTHER.sub(" ", text.lower()).encode()


def language_samples(labelled: DataFrame, text: str, lang: str) -> dict[str, bytes]:
    """The raw content of each language's dictionary, from a bounded sample of its texts.

    Texts fall into ``SAMPLE_TEXTS`` classes by hash, and the smallest hash of a class
    stands for it, so that the driver gets at most that many excerpts of a language
    and the same ones in every run. The languages come in the order of how many texts
    they have, most first.
    """
    known = labelled.filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    hashed = known.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("hash"), _excerpt(F.col(text)).alias("piece"))
    picked = hashed.groupBy("lang", F.pmod("hash", F.lit(SAMPLE_TEXTS)).alias("class")).agg(F.min(F.struct("hash", "piece")).alias("least"), F.count("*").alias("texts"))
    pieces: dict[str, list[tuple[int, str]]] = {}
    texts: dict[str, int] = {}
    for row in picked.collect():
        pieces.setdefault(row["lang"], []).append((row["least"]["hash"], row["least"]["piece"]))
        texts[row["lang"]] = texts.get(row["lang"], 0) + row["texts"]
    order = sorted(pieces, key=lambda lang: (-texts[lang], lang))
    return {lang: letters("\n".join(p for _, p in sorted(pieces[lang])))for lang in order}


def _excerpt(text: Column) -> Column:
    """``SAMPLE_CHARS`` characters from a place that a hash of the text names, or the whole of a shorter text."""
    places = F.greatest(F.length(text) - SAMPLE_CHARS + 1, F.lit(1))
    return F.substring(text, (F.pmod(F.xxhash64(F.lit("excerpt"), text), places) + 1).cast("int"), F.lit(SAMPLE_CHARS))


class Compressors:
    """One compressor per language; built once in each worker."""

    def __init__(self, samples: dict[str, bytes], level: int = LEVEL):
        self.names = list(samples)
        self.each = []
        for content in samples.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            self.each.append(zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[int]:
        pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.each]

    def verdict(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        """Language, score and whether the margin is too narrow to trust.

        The score is the share by which the best encoding is smaller than the second best, as a part of a fifth.
        """
        if text is None or not self.names or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        # Of equal sizes the more frequent language comes first.
        sizes = sorted(zip(self.sizes(letters(text)), self.names, strict=True), key=lambda s: s[0])
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        gap = 1 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], min(1.0, gap * 5), gap < margin


def identify(documents: DataFrame, text: str, samples: dict[str, bytes], margin: float = 0.02) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``rejected`` (the margin is narrow, or there was nothing to tell by).

    A null text, one without a letter, and every text if nothing was learned, are ``und`` with score 0.
    Ties go to the language with more texts. Whole texts are read. Other columns stay; the added names must be free.
    """
    spark: SparkSession = documents.sparkSession
    shared = spark.sparkContext.broadcast(samples)
    built: list[Compressors] = []

    def scan(bodies: list) -> dict[str, list]:
        if not built:
            built.append(Compressors(shared.value))
        verdicts = [built[0].verdict(t, margin) for t in bodies]
        return {n: [v[k] for v in verdicts] for k, n in enumerate(("lang_pred", "score", "rejected"))}

    return add_columns(documents, [text], scan, "lang_pred string, score double, rejected boolean")
