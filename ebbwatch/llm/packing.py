"""Best-fit decreasing packing of documents into windows of a fixed length.

Whether a piece fits a window depends on lengths alone, and there are at most ``window`` lengths. The
plan is therefore made from the histogram of lengths, at most ``window`` numbers, and says for runs
of pieces of one length which run of windows takes them. It is the packing that best-fit decreasing
gives when it takes the pieces one by one, and its size does not grow with the corpus.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, map_batches, named, read_table, text_blocks, texts_of
from ebbwatch.llm.pretokens import VOCABULARY, encode_apart, joined_split, latin_bytes, latin_split, pretokens, tokenizer
from ebbwatch.session import write_table

WINDOW = 2048
SEPARATOR = 1
CACHE_ENTRIES = 400_000
BUCKET_ROWS = 2_000  # pieces that one window task numbers, about
BLOCK_BYTES = 4 << 20  # of texts that are split together
_CACHES: dict[tuple[str, int | None], KnownIds] = {}  # of this worker process, by vocabulary and separator

Encoder = Callable[[list[str]], list[bytes]]


class OpenWindows:
    """Runs of open windows by remaining capacity, and a segment tree over the capacities in use."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.used = bytearray(2 * self.size)
        self.runs: list[deque[tuple[int, int]]] = [deque() for _ in range(window + 1)]

    def _mark(self, capacity: int) -> None:
        i = self.size + capacity
        self.used[i] = bool(self.runs[capacity])
        while i > 1:
            i //= 2
            self.used[i] = self.used[2 * i] | self.used[2 * i + 1]

    def add(self, capacity: int, first: int, n: int) -> None:
        if capacity and n:
            self.runs[capacity].append((first, n))
            self._mark(capacity)

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """The first run of this capacity, or the part of it that is wanted."""
        first, n = self.runs[capacity].popleft()
        if n > most:
            self.runs[capacity].appendleft((first + most, n - most))
            n = most
        self._mark(capacity)
        return first, n

    def tightest(self, length: int) -> int:
        """Smallest capacity in use of at least ``length``; 0 if there is none."""
        i = self.size + length
        if self.used[i]:
            return length
        while i > 1:
            if i % 2 == 0 and self.used[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.used[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return 0


def best_fit_plan(counts: dict[int, int], window: int) -> np.ndarray:
    """Rows (length, first rank, first window, pieces per window, offset), ordered by length and rank.

    ``counts`` has the number of pieces by length. Pieces of a length are numbered from 0; piece
    ``first rank + j`` lies in window ``first window + j // per``, at ``offset + j % per * length``.
    """
    spaces, opened, rows = OpenWindows(window), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = spaces.tightest(length)
            per = (capacity or window) // length
            if capacity:
                first, n = spaces.take(capacity, -(-left // per))
            else:
                capacity, first, n = window, opened, -(-left // per)
                opened += n
            placed = min(left, n * per)
            rows.append((length, rank, first, per, window - capacity))
            full, over = divmod(placed, per)
            spaces.add(capacity - per * length, first, full)
            if over:  # the last window takes fewer
                spaces.add(capacity - over * length, first + full, 1)
            rank, left = rank + placed, left - placed
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


class KnownIds:
    """Ids of pre-tokens behind each other, and where those of each one begin and how many they are.

    Place 0 is the separator's. With more than ``most`` pre-tokens, or eight times as many ids, it starts anew.
    """

    def __init__(self, vocabulary: str, separator: int | None):
        self.vocabulary, self.separator = vocabulary, [] if separator is None else [separator]
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.array(self.separator, "<u4")
        self.firsts, self.sizes = np.zeros(1, np.int64), np.array([len(self.ids)], np.int64)

    def find(self, words: list[str], most: int) -> np.ndarray:
        """The places of distinct pre-tokens; new ones are encoded together."""
        if len(self.ids) > 8 * most:
            self.clear()
        new = [w for w in words if w not in self.places]
        if new and len(self.places) + len(new) > most:
            self.clear()
            new = words
        if new:
            ids, ends = encode_apart(new, self.vocabulary)
            firsts = np.concatenate([[0], ends[:-1]])
            self.places.update(zip(new, range(len(self.firsts), len(self.firsts) + len(new))))
            self.firsts = np.concatenate([self.firsts, len(self.ids) + firsts])
            self.sizes = np.concatenate([self.sizes, ends - firsts])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def encode(self, words: list[str], positions: np.ndarray, ends: np.ndarray, most: int) -> list[bytes]:
        """Ids of texts that are split as ``latin_split`` does, each with the separator behind it."""
        places = np.insert(self.find(words, most)[positions], ends, 0)
        sizes = self.sizes[places]
        after = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.firsts[places] - after + sizes, sizes) + np.arange(after[-1])]
        data, cuts = ids.tobytes(), [0, *(4 * after[ends + np.arange(len(ends))]).tolist()]
        return [data[i:j] for i, j in zip(cuts, cuts[1:])]


def bpe_encoder(vocabulary: str, separator: int | None, most: int = CACHE_ENTRIES) -> Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, each text followed by the separator.

    Texts are encoded together, from the distinct pre-tokens they have; those that cannot be split, one by one.
    """
    known = _CACHES.setdefault((vocabulary, separator), KnownIds(vocabulary, separator))
    end = b"" if separator is None else separator.to_bytes(4, "little")

    def encode(texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        latin, wide = {}, {}
        for i, t in enumerate(texts):
            if "<|" not in t and (b := latin_bytes(t)) is not None:
                latin[i] = b
            elif (split := pretokens(t)) is not None:
                wide[i] = split
            else:
                ids = tokenizer(vocabulary).encode(t, add_special_tokens=False).ids
                out[i] = np.array(ids, "<u4").tobytes() + end
        for some, split in ((latin, latin_split), (wide, joined_split)):
            if some:
                for i, ids in zip(some, known.encode(*split(list(some.values())), most)):
                    out[i] = ids
        return out

    return encode


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    vocabulary: str = VOCABULARY, separator: int | None = SEPARATOR, keep_ids: bool = False,
) -> DataFrame:
    """Each document's ids cut into full windows and a rest: (id, start, length, ids_crc32, doc_tokens).

    ``copy`` tells rows with the same id apart. With ``keep_ids`` the ids themselves are a column too.
    A null text reads as empty; without a separator, it has no piece.
    """
    rows = named(docs, id_col, text_col)

    def work(batches: Batches) -> Batches:
        encode = bpe_encoder(vocabulary, separator)
        for b in (part for whole in batches for part in text_blocks(whole, text_col, BLOCK_BYTES)):
            out: list[list] = [[] for _ in range(6)]
            for doc, ids in zip(b.column(0).to_pylist(), encode(texts_of(b.column(1)))):
                view, total = memoryview(ids), len(ids) // 4
                for start in range(0, total, window):
                    piece = view[4 * start : 4 * (start + window)]
                    values = (doc, start, len(piece) // 4, zlib.crc32(piece), total, bytes(piece) if keep_ids else None)
                    for column, value in zip(out, values):
                        column.append(value)
            kinds = [b.schema.field(0).type, *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    kind = rows.schema[0].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    pieces = map_batches(rows, work, schema).withColumnRenamed("id", id_col)
    return pieces if keep_ids else pieces.drop("ids")


def ranked(pieces: DataFrame, id_col: str, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """Adds ``rank``, gapless from 0 within each length, and gives the number of pieces by length.

    A length that a third of all pieces have is numbered in buckets of bounded size: a bucket's first
    number comes from the counts of the buckets before it.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    buckets = max(1, -(-max(counts.values(), default=0) // bucket_rows))
    order = F.xxhash64(F.col(id_col), "start", "ids_crc32")
    placed = pieces.withColumn("order", order).withColumn("bucket", F.pmod("order", F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    firsts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "bucket").orderBy("order", id_col, "start")
    numbered = placed.withColumn("number", F.row_number().over(inside) - 1).join(firsts, ["length", "bucket"])
    return numbered.withColumn("rank", F.col("first") + F.col("number")), counts


def pack(pieces: DataFrame, id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``window``.

    Pieces of equal length are taken in the order of a hash, so the result does not depend on the
    partitioning. Equal rows get places of their own. An empty input gives no rows.
    """
    kept = write_table(pieces, "pieces")
    numbered, counts = ranked(kept, id_col)
    plan = pieces.sparkSession.sparkContext.broadcast(best_fit_plan(counts, window))
    columns = kept.columns

    def work(batches: Batches) -> Batches:
        rows = plan.value
        keys = rows[:, 0] << 44 | rows[:, 1]
        for b in batches:
            length, rank = (np.asarray(b.column(c)).astype(np.int64) for c in ("length", "rank"))
            at = rows[np.searchsorted(keys, length << 44 | rank, "right") - 1] if len(length) else rows[:0]
            j = rank - at[:, 1]
            sequence = at[:, 2] + j // np.maximum(at[:, 3], 1)
            offset = at[:, 4] + j % np.maximum(at[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                [*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return map_batches(
        numbered.select(*columns, F.col("rank").cast("long")), work, f"{schema}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Pieces of all documents with their places; see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, id_col, text_col, **options), id_col, options.get("window", WINDOW))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
