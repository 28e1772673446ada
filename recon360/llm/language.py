"""Language identification by compression.

Each language has a raw-content dictionary of its own text. A text is compressed with every dictionary
and gets the language whose dictionary makes it smallest.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator, Mapping

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recon360.llm.common import pick, text_slices

UNKNOWN = "und"
# All dictionaries together, and the largest of one language. They are sent to every executor.
MOST_BYTES = 32 << 20
DICTIONARY_BYTES = 96 << 10
# Labelled texts per language that a dictionary is made of, and the characters read of each.
SAMPLE_TEXTS = 600
SAMPLE_CHARACTERS = 4096
LEVEL = 6
# Every part of a text is compressed by itself: the dictionary then matters more than what the text has
# said before, and a text of any length is read whole in bounded memory.
PART_BYTES = 1000
# The runner-up must be larger by this share, or the verdict counts as narrow.
MARGIN = 0.01

_NO_LETTER = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    """Lower case, every run of other characters than letters as one space."""
    return _NO_LETTER.sub(" ", text.lower()).strip()


# --- dictionaries


_TOLD = "lang is not null and text is not null and length(text) > 0"
_LETTER = r"\p{L}"


def language_sizes(labelled: DataFrame) -> dict[str, int]:
    """Different texts with a letter per language, the language with most rows first.

    A language none of whose texts has a letter cannot be learned; that is reported as a warning.
    """
    texts = labelled.where(_TOLD).groupBy("lang", F.xxhash64("text").alias("h"))
    each = texts.agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("text").rlike(_LETTER)).alias("letter"))
    rows = each.groupBy("lang").agg(F.sum("n").alias("n"), F.count_if("letter").alias("texts")).collect()
    silent = sorted(r["lang"] for r in rows if not r["texts"])
    if silent:
        warnings.warn(f"languages without a letter in their texts are not learned: {', '.join(silent)}", stacklevel=2)
    return {r["lang"]: r["texts"] for r in sorted(rows, key=lambda r: (-r["n"], r["lang"])) if r["texts"]}


def sample(labelled: DataFrame, sizes: Mapping[str, int], per_language: int = SAMPLE_TEXTS) -> DataFrame:
    """(lang, h, text): some ``per_language`` to twice as many different texts of each language, or all.

    They are chosen by a hash of the text at a rate that follows from the number of the language's
    different texts, so copies change nothing and no task meets all texts of a frequent language; equal
    texts come once. Of a longer text ``SAMPLE_CHARACTERS`` are taken, from a place that its hash tells.
    """
    rows = labelled.where(_TOLD).where(F.col("text").rlike(_LETTER))
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, 2.0 * per_language / n))).otherwise(rate)
    spare = F.greatest(F.length("text") - SAMPLE_CHARACTERS, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("text", F.lit("place")), spare) + 1).cast("int")
    clipped = rows.where(spread < rate).select(
        "lang", F.xxhash64("text").alias("h"), F.substring("text", start, F.lit(SAMPLE_CHARACTERS)).alias("text")
    )
    return clipped.groupBy("lang", "h").agg(F.max("text").alias("text"))


def build_dictionaries(labelled: DataFrame, per_language: int = SAMPLE_TEXTS) -> dict[str, bytes]:
    """Raw content per language from (lang, text), the most frequent language first.

    The same for the same rows. The texts have equal shares, so a few long ones do not fill a dictionary.
    """
    sizes = language_sizes(labelled)
    if not sizes:
        return {}
    texts: dict[str, list[tuple[int, str]]] = {lang: [] for lang in sizes}
    for row in sorted(sample(labelled, sizes, per_language).collect(), key=lambda r: (r["lang"], r["h"])):
        text = normalise(row["text"])
        if text:  # the piece taken of a text may have no letter
            texts[row["lang"]].append((row["h"], text))
    most = min(DICTIONARY_BYTES, MOST_BYTES // len(texts))
    found = {lang: _content(parts[:per_language], most) for lang, parts in texts.items()}
    empty = [lang for lang, content in found.items() if not content]
    if empty:
        warnings.warn(f"no letter in the pieces taken of these languages, which are not learned: {', '.join(empty)}", stacklevel=2)
    return {lang: content for lang, content in found.items() if content}


def _content(parts: list[tuple[int, str]], most: int) -> bytes:
    """A piece of every (hash, text), all of one length but for shorter texts, from a place that the hash tells."""
    data = [(h, p.encode() + b" ") for h, p in parts]
    low, high = 0, most  # the longest pieces that fit
    while low < high:
        share = (low + high + 1) // 2
        if sum(min(len(d), share) for _, d in data) <= most:
            low = share
        else:
            high = share - 1
    return b"".join(_piece(d, h, low) for h, d in data)


def _piece(data: bytes, place: int, most: int) -> bytes:
    start = place % (len(data) - most + 1) if len(data) > most else 0
    return data[start : start + most]


# --- classification


class Classifier:
    """Sizes of a text under each dictionary. Of languages that tie the first in the mapping wins."""

    def __init__(self, dictionaries: Mapping[str, bytes]):
        self.langs = list(dictionaries)
        self.compressors = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    dict_data=content, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes per language, summed over the parts of the text."""
        data = f" {normalise(text)} ".encode()
        totals = [0] * len(self.langs)
        for start in range(0, len(data), PART_BYTES):
            part = data[start : start + PART_BYTES]
            for i, compressor in enumerate(self.compressors):
                totals[i] += len(compressor.compress(part))
        return totals

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, narrow). The score is 0.5 for a tie and nears 1 as the runner-up grows."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        second = sizes[order[1]] if len(order) > 1 else 2 * best
        gap = (second - best) / second
        return self.langs[order[0]], 0.5 + 0.5 * gap, gap < MARGIN


def _predict(batches: Iterator[pa.RecordBatch], dictionaries: Mapping[str, bytes]) -> Iterator[pa.RecordBatch]:
    classifier = Classifier(dictionaries)
    for batch in text_slices(batches):
        found = [classifier.classify(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ],
            ["doc_id", "lang_pred", "score", "narrow"],
        )


def predict(docs: DataFrame, dictionaries: Mapping[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score and narrow of every whole text.

    ``narrow`` rejects a verdict: the runner-up is within the margin. A null text, a text without a
    letter, or one met without dictionaries is ``und`` with score 0 and narrow. Ties go to the first
    language by name. Only doc_id and text are read; repeated rows give a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dict(dictionaries))
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(
        lambda batches: _predict(batches, shared.value), "doc_id long, lang_pred string, score double, narrow boolean"
    )
