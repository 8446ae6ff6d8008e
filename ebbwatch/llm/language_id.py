"""Language identification by language-bitmask n-gram filters.

A Bloom filter per language, bit-sliced: slot i of one array has a bit for every language, so that one
lookup answers for all of them. An n-gram's languages are the bits that its slots have in common.
A text's language is the one whose share of n-grams, less what its filter's false positives would
give, is the largest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, excerpt, fold, map_batches, named, read_table, text_blocks, texts_of
from ebbwatch.session import write_table

UNKNOWN = "und"
GRAMS = (2, 3, 4)  # bytes of lower-cased UTF-8
SLOTS_LOG2 = 20
SAMPLE_DOCS = 3_000  # bound of the labelled documents that the filters are filled from, all languages together
SHARE_OF_MOST = 0.3  # an n-gram belongs to languages in which it is at least this frequent, against the most
LEAST_COUNT = 3
SAMPLE_BYTES = 16 << 20  # bound of their text, the same for each language
LONG = 16  # a text over this part of a language's bytes is learnt from by pieces
LANGUAGES = 64  # bits of a word; more languages take more words
FILTER_BYTES = 64 << 20  # bound of all words; more than eight have fewer slots each, as each language has fewer rows

# Everything of ASCII but letters separates words.
_SPACED = bytes(b if chr(b).isalpha() or b >= 0x80 else 0x20 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 0x20


def _letters(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(_SPACED) + b" "


def _grams(data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams as numbers, by start, and which of them have no two blanks in a row."""
    size = max(0, len(data) - n + 1)
    codes, valid = np.zeros(size, np.uint32), np.ones(size, bool)
    blank = data == _SPACE
    pairs = blank[1:] & blank[:-1]
    for i in range(n):
        codes <<= np.uint32(8)
        codes |= data[i : i + size]
        if i + 1 < n:
            valid &= ~pairs[i : i + size]
    return codes, valid


class LanguageFilters:
    """Bit-sliced Bloom filters with two hash functions: an array of slots, 8 MB at most, for every 64 languages."""

    def __init__(self, languages: list[str], slots_log2: int = SLOTS_LOG2):
        words = max(1, -(-len(languages) // LANGUAGES))
        while words << slots_log2 + 3 > FILTER_BYTES:
            slots_log2 -= 1
        self.languages, self.bits = languages, slots_log2
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(k).itemsize * 8 >= min(len(languages), LANGUAGES))
        self.slots = np.zeros((words, 1 << slots_log2), kind)

    def _places(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        mixed = (codes.astype(np.uint64) + np.uint64(n << 40)) * _MIX
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        low = np.uint64((1 << self.bits) - 1)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64), ((mixed >> np.uint64(16)) & low).astype(np.int64)

    def bits_of(self, word: int) -> list[tuple[int, np.generic]]:
        """The languages of a word, by number, and their bits."""
        kind = self.slots.dtype.type
        return [(i, kind(i % LANGUAGES)) for i in range(len(self.languages)) if i // LANGUAGES == word]

    def put(self, codes: np.ndarray, n: int, masks: np.ndarray, word: int = 0) -> None:
        for places in self._places(codes, n):
            np.bitwise_or.at(self.slots[word], places, masks.astype(self.slots.dtype))

    def masks(self, codes: np.ndarray, n: int, word: int = 0) -> np.ndarray:
        """For each n-gram, the bits of all languages of a word whose filter holds it."""
        first, second = self._places(codes, n)
        return self.slots[word][first] & self.slots[word][second]

    def false_positives(self) -> np.ndarray:
        """Chance that a language's filter holds an n-gram that was not put in."""
        one = self.slots.dtype.type(1)
        fill = [np.count_nonzero(slots & (one << bit)) for w, slots in enumerate(self.slots) for _, bit in self.bits_of(w)]
        return (np.array(fill, float) / self.slots.shape[1]) ** 2


def fit_filters(rows: list[tuple[str, str]]) -> LanguageFilters:
    """Filters from (text, language) rows; the first language has the most rows."""
    by: dict[str, list[str]] = {}
    for text, language in rows:
        by.setdefault(language, []).append(text or "")
    filters = LanguageFilters(sorted(by, key=lambda k: (-len(by[k]), k)))
    for n in GRAMS:
        found = []
        for language in filters.languages:
            codes, valid = _grams(np.frombuffer(b"".join(map(_letters, by[language])), np.uint8), n)
            found.append(np.unique(codes[valid], return_counts=True))
        every = np.unique(np.concatenate([c for c, _ in found])) if found else np.zeros(0, np.uint32)
        most, spots = np.zeros(len(every)), [np.searchsorted(every, codes) for codes, _ in found]
        for at, (_, counts) in zip(spots, found):
            most[at] = np.maximum(most[at], counts / max(1, counts.sum()))
        for word in range(len(filters.slots)):
            masks = np.zeros(len(every), np.uint64)
            for i, bit in filters.bits_of(word):
                at, counts = spots[i], found[i][1]
                own = (counts / max(1, counts.sum()) >= SHARE_OF_MOST * most[at]) & (counts >= LEAST_COUNT)
                masks[at[own]] |= np.uint64(1) << np.uint64(bit)
            filters.put(every, n, masks, word)
    return filters


def identify(texts: list[str], filters: LanguageFilters) -> tuple[list[str], list[float]]:
    """Language and score of whole texts."""
    has_letter = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    if not filters.languages or not texts:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    parts = [_letters(t) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    data = np.frombuffer(b"".join(parts), np.uint8)
    hits, total = np.zeros((len(filters.languages), len(texts))), np.zeros(len(texts))
    one = filters.slots.dtype.type(1)
    for n in GRAMS:
        codes, valid = _grams(data, n)  # an n-gram across two texts has two blanks in a row
        at = np.minimum(starts[:-1], max(0, len(codes) - 1))
        total += np.add.reduceat(valid, at, dtype=np.int64) if len(codes) else 0
        for word in range(len(filters.slots)):
            masks = filters.masks(codes, n, word)
            masks[~valid] = 0
            for i, shift in filters.bits_of(word):
                bit = (masks >> shift) & one
                hits[i] += np.add.reduceat(bit, at, dtype=np.int64) if len(codes) else 0
    wrong = filters.false_positives()[:, None]
    shares = np.maximum((hits / np.maximum(total, 1) - wrong) / np.maximum(1 - wrong, 1e-9), 0)
    best = shares.argmax(axis=0)
    sums = shares.sum(axis=0)
    scores = np.divide(shares.max(axis=0), sums, out=np.zeros(len(texts)), where=sums > 0) * has_letter
    return [filters.languages[b] if x else UNKNOWN for b, x in zip(best, has_letter)], scores.tolist()


def learning_rows(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int, most_bytes: int = SAMPLE_BYTES,
) -> list[tuple[str, str]]:
    """At most about ``most`` documents, an equal number for each language, chosen by a hash of the id.

    Each language has an equal part of ``most_bytes``. A text that does not fit is passed over, and one over a small part
    of these bytes is represented by pieces of it. With more languages than ``most``, only some have a learning row.
    """
    rows = named(docs, id_col, text_col, lang_col).toDF("id", "text", "lang").where("id is not null and lang is not null")
    # Written, so that the planner knows its size and sends it only if it is small: labels may be noisy.
    sizes = write_table(rows.groupBy("lang").agg(F.count("*").alias("size")), "languages")
    languages = max(1, sizes.count())
    chance = F.pmod(F.xxhash64(F.col("id"), F.lit("language sample")), F.lit(1 << 40)) / float(1 << 40)
    chosen = rows.join(sizes, "lang").withColumn("chance", chance).where(F.col("chance") < most / languages / F.col("size"))
    bytes_each = most_bytes // min(languages, most)
    chosen = chosen.withColumn("text", excerpt("text", max(1, bytes_each // LONG)))
    found, used = [], {}
    for text, lang in chosen.orderBy("chance", "id").select("text", "lang").toLocalIterator():
        size = len((text or "").encode())
        if used.get(lang, 0) + size <= bytes_each:
            used[lang] = used.get(lang, 0) + size
            found.append((text, lang))
    return found


def language_id(
    docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (id, lang_pred, score) and the columns of ``keep``, one per document of ``docs``.

    The filters are filled from at most about ``sample_docs`` documents of ``learn`` (see ``learning_rows``); rows without
    a language teach nothing. Null texts and texts without a letter are ``und`` with score 0. A
    text that shares no n-gram with any language gets the language with most learning rows and
    score 0; ties go to the language with more rows, then the smaller name. Without learning rows
    all is ``und``.
    """
    spark = docs.sparkSession
    filters = spark.sparkContext.broadcast(fit_filters(learning_rows(learn, id_col, text_col, lang_col, sample_docs)))
    columns = list(dict.fromkeys([id_col, text_col, *keep]))
    rows = named(docs, *columns)
    held = [c for c in columns if c in keep or c == id_col]

    def work(batches: Batches) -> Batches:
        for b in (part for whole in batches for part in text_blocks(whole, text_col)):
            langs, scores = identify(texts_of(b.column(text_col)), filters.value)
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in held), *new], [*held, "lang_pred", "score"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in held)
    return map_batches(rows, work, f"{schema}, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language_id(docs, docs.where(fold("doc_id", 3) != 1))
    return found.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
