"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of short slices of labelled texts.  A text
is lower-cased, reduced to its letters and compressed block by block with every dictionary; the
dictionary that gives the fewest bytes names the language.  A block counts at most ``CLIP`` times the
bytes of its best dictionary, so that a passage which happens to stand in one dictionary word for word
cannot outweigh the rest of the text.  The margin is the share of bytes by which the best dictionary
beats the next.

A text is rejected if it has no letters, if too few of its four-byte grams stand in its dictionary
(junk, or a language that was not learned), or if the margin is narrow.  As bytes are coarse, most of all on
short texts, sizes of the text written twice over, without blocks, choose where the margin is narrow, and it
passes where the grams name the same language with a clear lead over the next; grams never change the answer.  The three limits are shares of what a hundredth of the labelled slices falls
below, each half of these tried on the other half; with too few slices there is ``MIN_MARGIN`` alone.

The dictionaries come from a bounded sample: of every language ``SLICES`` texts, those with the
smallest hash in each of as many hash buckets, and ``SLICE_CHARS`` characters of each, from a place that
the hash picks.  Everything else covers whole texts of all rows.

Edge cases: null text or one without a letter is ``und`` with score 0; with no labelled row all is
``und``; with one language alone its score is 1; equal texts get equal answers; ties go to the label
that sorts first; a null ``doc_id`` is neither learned from nor held out;
numerals, marks and symbols are not letters; a very long text is compressed block by block to its end;
repeated rows are judged each and learned from once; ``identify`` reads ``doc_id, text, lang`` alone and
``accepted`` carries the other columns in a struct, so their names may be any.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.llm.common import at_work, documents

SLICES, SLICE_CHARS, MAX_LANGUAGES = 128, 512, 512
BLOCK, LEVEL, CLIP = 256, 6, 1.1
MIN_MARGIN = 0.001
# Limits as shares of the 1st percentile of labelled slices; slices tried at most and at least.
NARROW, KNOWN, TRIED, LEAST = 0.5, 0.3, 1024, 16
UNKNOWN = "und"
_LETTER, _NO_LETTERS = regex.compile(r"\p{L}"), regex.compile(r"[^\p{L}\p{M}]+")
#: The same below U+0250, where there are no marks, for the faster engine.
_LATIN, _BEYOND = re.compile("[^A-Za-zªµºÀ-ÖØ-öø-ɏ]+"), re.compile("[\u0250-\U0010ffff]")


def letters(text: str) -> bytes:
    """Lower-cased words of letters and their marks with single spaces between them; empty without a letter."""
    low = text.lower()
    if not _BEYOND.search(low):
        return _LATIN.sub(" ", low).strip().encode()
    return _NO_LETTERS.sub(" ", low).strip().encode() if _LETTER.search(low) else b""


class Limits(NamedTuple):
    """Below which margin bytes are not clear, below which lead grams are not, and the least share of known grams."""

    margin: float = MIN_MARGIN
    lead: float | None = None
    known: float = 0.0


def samples(labelled: DataFrame) -> dict[str, list[bytes]]:
    """The slices of each language from rows ``text, lang``; at most ``MAX_LANGUAGES * SLICES`` reach the driver."""
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text", F.xxhash64("text").alias("h"))
    start = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - SLICE_CHARS + 1, F.lit(1))) + 1
    rows = rows.select("lang", "h", F.substr("text", start.cast("int"), F.lit(SLICE_CHARS)).alias("slice"))
    chosen = rows.groupBy("lang", F.pmod("h", F.lit(SLICES)).alias("bucket")).agg(F.min("h").alias("h"))
    picks = [tuple(r) for r in chosen.select("lang", "h").limit(MAX_LANGUAGES * SLICES + 1).collect()]
    if len(picks) > MAX_LANGUAGES * SLICES:
        raise ValueError(f"over {MAX_LANGUAGES} values of lang")
    if not picks:
        return {}
    wanted = F.broadcast(labelled.sparkSession.createDataFrame(picks, "lang string, h long"))
    found = rows.join(wanted, ["lang", "h"]).groupBy("lang", "h").agg(F.min("slice").alias("slice"))
    slices: dict[str, list[tuple[int, bytes]]] = {}
    for r in found.collect():
        slices.setdefault(r["lang"], []).append((r["h"], letters(r["slice"])))
    return {lang: [s for _, s in sorted(parts)] for lang, parts in sorted(slices.items())}


def fit(slices: dict[str, list[bytes]]) -> dict[str, bytes]:
    """One dictionary per language."""
    return {lang: b" ".join(parts) for lang, parts in slices.items()}


def limits(slices: dict[str, list[bytes]]) -> Limits:
    """What a hundredth of the slices falls below, each half of them tried on the other half."""
    found = []
    each = max(1, TRIED // max(1, 2 * len(slices)))
    for half in (0, 1):
        other = Classifier({lang: b" ".join(parts[1 - half :: 2]) for lang, parts in slices.items()})
        for lang, parts in slices.items():
            for body in parts[half::2][:each]:
                if len(body) >= BLOCK and other.by_bytes(body)[0] == lang:
                    (best, known), lead = other.by_grams(body)
                    found.append((other.by_bytes(body)[1], lead if best == lang else 0.0, known))
    if len(found) < LEAST:
        return Limits()
    margin, lead, known = (sorted(column)[len(found) // 100] for column in zip(*found, strict=True))
    return Limits(max(MIN_MARGIN, NARROW * margin), NARROW * lead, KNOWN * known)


def _grams(body: bytes) -> np.ndarray:
    a = np.frombuffer(b" " + body.ljust(2) + b" ", np.uint8).astype(np.uint32)
    return a[:-3] | a[1:-2] << 8 | a[2:-1] << 16 | a[3:] << 24


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.compressors, self.grams = {}, {}
        for lang, content in sorted(dictionaries.items()):
            data = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False)
            self.grams[lang] = np.unique(_grams(content))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language and the margin."""
        return self.by_bytes(letters(text or ""))

    def by_bytes(self, body: bytes) -> tuple[str, float]:
        if not body or not self.compressors:
            return UNKNOWN, 0.0
        totals = [0.0] * len(self.compressors)
        for i in range(0, len(body), BLOCK):
            sizes = [len(c.compress(body[i : i + BLOCK])) for c in self.compressors.values()]
            most = CLIP * min(sizes)
            totals = [t + min(s, most) for t, s in zip(totals, sizes, strict=True)]
        (best, lang), *others = sorted(zip(totals, self.compressors, strict=True))
        return lang, 1.0 - best / others[0][0] if others else 1.0

    def by_bytes_twice(self, body: bytes) -> str:
        """The smallest size of the whole text twice over: each byte of difference counts, as no block rounds it off."""
        return min(self.compressors, key=lambda lang: (len(self.compressors[lang].compress(body + b" " + body)), lang))

    def known(self, grams: np.ndarray, lang: str) -> float:
        """The share of ``grams`` that stand in the dictionary."""
        own = self.grams[lang]
        return float((own[np.minimum(np.searchsorted(own, grams), len(own) - 1)] == grams).mean())

    def by_grams(self, body: bytes) -> tuple[tuple[str, float], float]:
        """The language with most grams and their share, and its lead over the next."""
        grams = _grams(body)
        (most, lang), *others = sorted(((self.known(grams, x), x) for x in self.compressors), key=lambda x: (-x[0], x[1]))
        return (lang, most), (1.0 - others[0][0] / most if others else 1.0) if most else 0.0

    def judged(self, text: str | None, limits: Limits) -> tuple[str, float, bool]:
        """The language, the margin and whether to reject."""
        body = letters(text or "")
        lang, margin = self.by_bytes(body)
        if lang == UNKNOWN or limits.lead is None:
            return lang, margin, lang == UNKNOWN or margin < limits.margin
        if margin >= limits.margin:
            return lang, margin, self.known(_grams(body), lang) < limits.known
        lang = self.by_bytes_twice(body)
        (other, known), lead = self.by_grams(body)
        return lang, margin, other != lang or lead < limits.lead or known < limits.known


def predicted(text: Column, spark: SparkSession, dictionaries: dict[str, bytes], least: Limits = Limits()) -> Column:
    """``struct<lang_pred, score, rejected>`` for a column of texts."""
    shared = spark.sparkContext.broadcast(dictionaries)
    held: list[Classifier] = []

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def classify(column: pa.Array) -> pa.Array:
        if not held:
            at_work("language")
            held.append(Classifier(shared.value))
        found = [held[0].judged(x.as_py(), least) for x in column]
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _, _ in found], pa.string()), pa.array([s for _, s, _ in found], pa.float64()), pa.array([r for _, _, r in found], pa.bool_())],
            ["lang_pred", "score", "rejected"],
        )

    return classify(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _answer(docs: DataFrame, text: Column) -> Column:
    slices = samples(docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return predicted(text, docs.sparkSession, fit(slices), limits(slices))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row, learned from the rows that are not held out."""
    answer = _answer(docs, F.col("text"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), answer.alias("answer")).select("doc_id", "held_out", "answer.*")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is clear, with all their columns."""
    answer = _answer(docs, F.col("doc.text"))
    return docs.select(F.struct("*").alias("doc")).withColumn("answer", answer).filter(~F.col("answer.rejected")).select("doc.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
