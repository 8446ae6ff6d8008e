"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ebbwatch.llm.common import Batches, excerpt, map_batches, named, read_table, text_blocks, texts_of
from ebbwatch.llm.pretokens import VOCABULARY, encode_apart, pretokens, tokenizer

TABLE_SLOTS = 1 << 17  # of 9 bytes each: the broadcast has 1.2 MB at any input size
SAMPLE_DOCS = 2_000  # texts that say which pre-tokens are frequent; they do not affect any count
SAMPLE_BYTES = 16 << 10  # of one of these texts: with the above, 32 MB reach the driver at most
CACHE_ENTRIES = 400_000  # of a worker, about 50 MB; a full cache starts anew
CACHED_CHARS = 64  # longer pre-tokens are forgotten after their block of texts

_CACHES: dict[str, dict[str, int]] = {}  # of this worker process, by vocabulary


class LengthTable:
    """Open-addressed table from the 64-bit hash of a pre-token to its number of tokens."""

    def __init__(self, slots: int = TABLE_SLOTS):
        self.keys = np.zeros(slots, np.uint64)
        self.lengths = np.zeros(slots, np.uint8)

    def _slot(self, key: int) -> int:
        keys, mask = self.keys, len(self.keys) - 1
        i = key & mask
        while keys[i] and keys[i] != key:
            i = (i + 1) & mask
        return i

    def put(self, pretoken: str, length: int) -> None:
        if length < 256:
            key = xxhash.xxh3_64_intdigest(pretoken) or 1
            i = self._slot(key)
            self.keys[i], self.lengths[i] = key, length

    def get(self, pretoken: str) -> int:
        """0 if unknown."""
        return int(self.lengths[self._slot(xxhash.xxh3_64_intdigest(pretoken) or 1)])


def frequent_lengths(texts: list[str], vocabulary: str = VOCABULARY, slots: int = TABLE_SLOTS) -> LengthTable:
    seen = Counter(p for t in texts for p in pretokens(t) or ())
    best = [p for p, _ in seen.most_common(slots // 2)]
    table = LengthTable(slots)
    if best:
        for p, n in zip(best, np.diff(encode_apart(best, vocabulary)[1], prepend=0).tolist()):
            table.put(p, n)
    return table


def _lookup(vocabulary: str, table: LengthTable, most: int):
    """Counts for lists of texts, through the cache of the worker process."""
    known = _CACHES.setdefault(vocabulary, {})

    def learn(new: set[str]) -> None:
        missing = []
        for p in new:
            if n := table.get(p):
                known[p] = n
            else:
                missing.append(p)
        if missing:
            known.update(zip(missing, np.diff(encode_apart(missing, vocabulary)[1], prepend=0).tolist()))

    def counts(texts: list[str]) -> list[int]:
        splits = [pretokens(t) for t in texts]
        here = set().union(*(s for s in splits if s))
        if new := here.difference(known):
            if len(known) + len(new) > most:
                known.clear()
                new = here
            learn(new)
        get, library = known.__getitem__, tokenizer(vocabulary)
        found = [
            len(library.encode(t, add_special_tokens=False).ids) if s is None else sum(map(get, s))
            for t, s in zip(texts, splits)
        ]
        for p in new:
            if len(p) > CACHED_CHARS:
                del known[p]
        return found

    return counts


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, limit: int = 2048,
    sample_docs: int = SAMPLE_DOCS, cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit), one per input row, repeated rows included.

    Null and empty texts have no tokens. The counts are those of the library for whole texts of any
    length. A sample of at most ``sample_docs`` texts, of long ones pieces of ``SAMPLE_BYTES`` in all, fills the
    broadcast table; it decides the speed only. An empty input gives no rows.
    """
    rows = named(docs, id_col, text_col)
    share = min(1.0, 2 * sample_docs / max(1, rows.count()))
    sample = rows.sample(share, seed=7).select(excerpt(text_col, SAMPLE_BYTES).alias("text")).limit(sample_docs).toArrow().column(0)
    sent = rows.sparkSession.sparkContext.broadcast(frequent_lengths(texts_of(sample), vocabulary))

    def work(batches: Batches) -> Batches:
        counts = _lookup(vocabulary, sent.value, cache_entries)
        for b in (part for whole in batches for part in text_blocks(whole, text_col)):
            n = pa.array(counts(texts_of(b.column(1))), pa.int64())
            size = pc.fill_null(pc.cast(pc.binary_length(b.column(1)), pa.int64()), 0)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), size, n, pc.greater(n, limit)], ["id", "n_bytes", "n_tokens", "over_limit"]
            )

    kind = rows.schema[0].dataType.simpleString()
    return map_batches(rows, work, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed(
        "id", id_col
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
