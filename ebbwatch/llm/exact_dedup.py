"""Exact substring de-duplication by suffix sorting.

A byte goes if a string of ``span`` bytes that covers it also starts earlier: in a document with a smaller id, or
earlier in the same one. The corpus is too large for one suffix array, so strings are first brought together
that can be equal:

* A string's anchor is its 32-byte part with the least hash. Equal strings have equal anchors at equal
  offsets, and neighbouring strings mostly share theirs, so a document has one row per run of strings with one anchor.
* Anchors that occur once are dropped. Runs with equal bytes are equal string by string.
* The other runs are cut at fixed offsets from the anchor into pieces of 16 strings, which have 85 bytes in common.
  Pieces that share these bytes but differ further out form a bucket: with one symbol in place of the shared bytes, its
  strings are ordered by suffix sorting, which shows the equal ones.
* A bucket over ``BUCKET`` pieces, at the edge of a very common passage, is split by further bytes: its pieces are cut into shorter ones, which have
  more bytes in common, and these form buckets in the same way, down to pieces of one string.

Whole copies are left out before the search, as all their strings start in the document with the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.bloom import bloom_filter, may_hold
from ebbwatch.llm.common import Batches, map_batches, named, read_table, text_blocks
from ebbwatch.llm.shingles import mixed
from ebbwatch.llm.suffix_groups import suffix_order
from ebbwatch.session import write_table

SPAN = 100
ANCHOR = 32
PIECE = 16  # strings
SHORTER = 4  # times shorter are the pieces of a bucket that is split
BUCKET = 1024  # pieces that one task sorts at once, 33 KB without what they have in common
STRETCH = 1 << 20
COPIES = 1_000_000  # ids of whole copies that are sent to every task, 8 MB; more of them are joined
APART, SHARED = 0xFF, b"\xfe"  # bytes that UTF-8 never has

_HIGH = np.uint64(0xFFFFFFFF00000000)
_BYTE = np.random.default_rng(77).integers(1, 1 << 63, 256, np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all 32-byte parts, by start."""
    hashes, size, base = _BYTE[data], 1, 0x9E3779B97F4A7C15
    while size < ANCHOR:
        hashes = hashes[:-size] * np.uint64(base) + hashes[size:]
        size, base = 2 * size, base * base & (1 << 64) - 1
    return mixed(hashes)


def runs(text: bytes, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, anchor's place, first string, past the last string) of the runs of strings with one anchor.

    Grams compare by the high half of their hash, and the leftmost of equal ones is the anchor.
    """
    if len(text) < span:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    grams = gram_hashes(np.frombuffer(text, np.uint8))
    least, size, width = grams & _HIGH | np.arange(len(grams), dtype=np.uint64), 1, span - ANCHOR + 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if rest := width - size:
        least = np.minimum(least[:-rest], least[rest:])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    place = (least[first] & ~_HIGH).astype(np.int64)
    return grams[place], place, first, np.concatenate([first[1:], [len(least)]])


def _hash(part: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(part, seed) - (1 << 63)


def _signed(value: np.ndarray) -> np.ndarray:
    return value.view(np.int64)


def _texts(batches: Batches) -> Iterator[tuple[int, bytes]]:
    """(id, bytes) of the texts."""
    for b in (part for whole in batches for part in text_blocks(whole, "text")):
        for doc, text in zip(b.column("id").to_pylist(), b.column("text").cast(pa.large_binary()).to_pylist()):
            if doc is not None and text:
                yield doc, text


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 50_000) -> Batches:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


# The steps over the texts


def _anchors(docs: DataFrame, span: int) -> DataFrame:
    """The hash of every run's anchor."""

    def work(batches: Batches) -> Batches:
        held: list[np.ndarray] = []
        for _, text in _texts(batches):
            held.append(runs(text, span)[0])
            if sum(map(len, held[-64:])) + len(held) > STRETCH // 16:
                yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(held)))], ["anchor"])
                held = []
        yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(held or [np.zeros(0, np.uint64)])))], ["anchor"])

    return map_batches(docs, work, "anchor long")


def _runs(docs: DataFrame, anchors: Broadcast, span: int) -> DataFrame:
    """The runs whose anchor may occur more than once: (anchor, run, doc, first, n)."""
    schema = pa.schema([("anchor", pa.int64()), ("run", pa.int64()), ("doc", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])

    def rows(batches: Batches) -> Iterator[tuple]:
        for doc, text in _texts(batches):
            anchor, _, first, last = runs(text, span)
            keep = may_hold(anchors.value, _signed(anchor))
            for a, i, j in zip(_signed(anchor[keep]).tolist(), first[keep].tolist(), last[keep].tolist()):
                yield a, _hash(text[i : j + span - 1], j - i), doc, i, j - i

    return map_batches(docs, lambda b: _batches(rows(b), schema), "anchor long, run long, doc long, first int, n int")


def _run_bytes(docs: DataFrame, anchors: Broadcast, wanted: Broadcast, span: int) -> DataFrame:
    """The bytes of the wanted runs, and the place of the anchor in them: (run, place, bytes). ``anchors`` has theirs."""
    schema = pa.schema([("run", pa.int64()), ("place", pa.int32()), ("bytes", pa.binary())])

    def rows(batches: Batches) -> Iterator[tuple]:
        seen: set[int] = set()
        for _, text in _texts(batches):
            anchor, place, first, last = runs(text, span)
            near = may_hold(anchors.value, _signed(anchor))
            place, first, last = place[near], first[near], last[near]
            parts = [text[i : j + span - 1] for i, j in zip(first.tolist(), last.tolist())]
            hashes = [_hash(p, j - i) for p, i, j in zip(parts, first.tolist(), last.tolist())]
            for k in np.flatnonzero(may_hold(wanted.value, np.array(hashes, np.int64))).tolist():
                if hashes[k] not in seen:
                    seen.add(hashes[k])
                    yield hashes[k], int(place[k] - first[k]), parts[k]

    return map_batches(docs, lambda b: _batches(rows(b), schema, 5_000), "run long, place int, bytes binary")


# Pieces and buckets


def _pieces(rows: DataFrame, span: int, most: int) -> DataFrame:
    """Pieces of ``most`` strings: (core, piece, doc, first, n, at, bytes); the core's bytes begin ``at`` bytes into those of the piece.

    ``rows`` has runs or longer pieces: (doc, first, n, place, bytes), with what their strings have in common from ``place`` on.
    """
    kinds = [("core", pa.int64()), ("piece", pa.int64()), ("doc", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("at", pa.int32()), ("bytes", pa.binary())]
    schema = pa.schema(kinds)

    def cut(batches: Batches) -> Iterator[tuple]:
        for b in batches:
            for doc, first, n, place, text in zip(*(b.column(c).to_pylist() for c in ("doc", "first", "n", "place", "bytes"))):
                # A string at s holds the place place - s bytes from its start; pieces are ranges of that.
                for number in range((place - n + 1) // most, place // most + 1):
                    core = place - most * number
                    lo, hi = max(0, core - most + 1), min(n - 1, core)
                    whole = text[lo : hi + span]
                    yield (_hash(text[core : core + span - most + 1], number), _hash(whole, 1024 * number + hi - core + most),
                           doc, first + lo, hi - lo + 1, core - lo, whole)

    return map_batches(
        rows.select("doc", "first", "n", "place", "bytes"), lambda b: _batches(cut(b), schema, 5_000),
        "core long, piece long, doc long, first int, n int, at int, bytes binary",
    )


def _having(rows: DataFrame, column: str, wanted: Broadcast) -> DataFrame:
    """The rows whose value may be wanted, before a join that decides."""

    def work(batches: Batches) -> Batches:
        for b in batches:
            yield b.filter(pa.array(may_hold(wanted.value, b.column(column).to_numpy())))

    return map_batches(rows, work, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))


def repeated_strings(pieces: list[tuple[int, int, int, bytes]], span: int = SPAN) -> list[tuple[int, int]]:
    """(doc, start) of the strings of a bucket that occur at an earlier (doc, start) of it; pieces are (doc, first, n, bytes)."""
    text, owner = bytes([APART]).join(p[3] for p in pieces), []
    for k, (_, _, n, part) in enumerate(pieces):
        owner += [(k, i) if i < n else None for i in range(len(part) + 1)]
    out, same, before = [], [], None

    def settle() -> None:
        if len(same) > 1:
            least = min(same)
            out.extend(s for s in same if s != least)

    for at in suffix_order(text):
        if owner[at] is None:
            continue
        k, i = owner[at]
        string = text[at : at + span]
        if string != before:
            settle()
            same, before = [], string
        same.append((pieces[k][0], pieces[k][1] + i))
    settle()
    return out


def _intervals(starts: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(doc, first, past the last) for starts that follow each other."""
    first = last = None
    for s in sorted(set(starts)):
        if last is not None and s == (last[0], last[1] + 1):
            last = s
            continue
        if last is not None:
            yield first[0], first[1], last[1] + 1
        first = last = s
    if last is not None:
        yield first[0], first[1], last[1] + 1


def _sorted_buckets(pieces: DataFrame, span: int, most: int) -> DataFrame:
    """The strings of the buckets that occur earlier in theirs; a bucket is sorted in one task, and has a bounded number of pieces."""
    schema = pa.schema([("doc", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
    shared = span - most + 1  # bytes that all strings of a bucket hold, as one symbol here

    def rows(batches: Batches) -> Iterator[tuple]:
        core, held = None, []
        for b in batches:
            for c, doc, first, n, at, part in zip(*(b.column(x).to_pylist() for x in ("core", "doc", "first", "n", "at", "bytes"))):
                if c != core:
                    yield from _intervals(repeated_strings(held, span - shared + 1))
                    core, held = c, []
                held.append((doc, first, n, part[:at] + SHARED + part[at + shared :]))
        yield from _intervals(repeated_strings(held, span - shared + 1))

    sorted_ = pieces.repartition("core").sortWithinPartitions("core").select("core", "doc", "first", "n", "at", "bytes")
    return map_batches(sorted_, lambda b: _batches(rows(b), schema), "doc long, first int, last int")


# A document and a start in it as one number in the same order; its fixed width lets Spark aggregate by hashing.


def _place() -> Column:
    return (F.col("doc").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")) * F.lit(1 << 32).cast("decimal(11,0)") + F.col("first")


def _placed(place: str) -> list[Column]:
    size = F.lit(1 << 32).cast("decimal(11,0)")
    first = F.col(place) % size
    doc = ((F.col(place) - first) / size).cast("decimal(21,0)") - F.lit(str(1 << 63)).cast("decimal(20,0)")
    return [doc.cast("long").alias("doc"), first.cast("int").alias("first")]


def _split(rows: DataFrame, bucket: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose bytes occur earlier, and of the others those that share a bucket with other bytes, with ``parts``.

    Rows of one kind have the same bytes, and so the same number of strings.
    """
    kinds = rows.groupBy(bucket, kind).agg(F.min(_place()).alias("least"), F.max("n").alias("n"), F.count("*").alias("copies"))
    kinds = write_table(kinds, "kinds")
    later = rows.join(kinds.where("copies > 1").select(bucket, kind, "least"), [bucket, kind]).where(_place() != F.col("least"))
    parts = kinds.groupBy(bucket).agg(F.count("*").alias("parts")).where("parts > 1")
    others = kinds.join(parts, bucket).select(bucket, kind, *_placed("least"), "n", "parts")
    return later.select("doc", "first", (F.col("first") + F.col("n")).cast("int").alias("last")), others


def _apart(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces whose bytes occur earlier, and of the others, written, those that share a core with other bytes."""
    later, kinds = _split(pieces.drop("bytes", "at"), "core", "piece")
    kinds = write_table(kinds, "apart-kinds")
    cores = pieces.sparkSession.sparkContext.broadcast(bloom_filter(kinds.select("core").distinct(), kinds.count()))
    content = _having(pieces.select("core", "piece", "doc", "first", "at", "bytes"), "core", cores)
    apart = kinds.join(content, ["core", "piece", "doc", "first"]).dropDuplicates(["core", "piece"])
    return later, write_table(apart, "apart")


def _without(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """The rows but for whole copies, whose ids are sent if few; if not, the texts are shuffled and written once."""
    if copies.count() <= COPIES:
        return rows.join(F.broadcast(copies), F.col("id") == F.col("doc"), "left_anti")
    return write_table(rows.join(copies, F.col("id") == F.col("doc"), "left_anti"), "texts")


def repeated_starts(rows: DataFrame, copies: DataFrame, span: int = SPAN, bucket: int = BUCKET) -> DataFrame:
    """(doc, first, last): ranges of the starts of strings that also start earlier; ``rows`` has id and text.

    ``copies`` has the ids of texts that go as a whole; they are not searched.
    """
    spark = rows.sparkSession
    rows = _without(rows, copies)
    often = write_table(_anchors(rows, span).groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    anchors = spark.sparkContext.broadcast(bloom_filter(often, often.count()))
    found = write_table(_runs(rows, anchors, span), "runs")
    starts, others = _split(found, "anchor", "run")
    others = write_table(others, "other-runs")
    wanted = spark.sparkContext.broadcast(bloom_filter(others.select("run"), others.count()))
    near = others.select("anchor").distinct()
    near = spark.sparkContext.broadcast(bloom_filter(near, others.count()))
    longer = others.join(_run_bytes(rows, near, wanted, span).dropDuplicates(["run"]), "run")
    most = PIECE
    while True:  # shorter pieces for the buckets that are too large; those of one string have all bytes in common
        later, apart = _apart(write_table(_pieces(longer, span, most), "pieces"))
        starts = starts.union(later).union(_sorted_buckets(apart.where(F.col("parts") <= bucket), span, most))
        longer = apart.where(F.col("parts") > bucket).withColumnRenamed("at", "place")
        if most == 1 or longer.isEmpty():
            return starts
        most = max(1, most // SHORTER)


def _copies(rows: DataFrame) -> DataFrame:
    """Ids of texts that a smaller id has as well."""
    texts = rows.where("id is not null").select("id", F.sha2("text", 256).alias("content"))
    least = texts.groupBy("content").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    return texts.join(least, "content").where("id > least").select(F.col("id").alias("doc")).distinct()


def removed_spans(size: int, ranges: list[dict], span: int) -> list[tuple[int, int]]:
    """Maximal removed runs of bytes; a range of starts covers the bytes of all its strings."""
    out: list[tuple[int, int]] = []
    for first, last in sorted((r["first"], min(r["last"] - 1 + span, size)) for r in ranges):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, bucket: int = BUCKET,
) -> DataFrame:
    """Rows (id, n_bytes, kept, spans): the bytes that stay, and the maximal removed runs of bytes.

    Null texts count as empty; texts under ``span`` bytes lose nothing. Rows that repeat an id and its text are one document
    and lose the same; rows without an id are not compared and lose nothing. Of rows with one id and different
    texts, which ids should not allow, each loses what is found for any.
    """
    rows = named(docs, id_col, text_col).toDF("id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    keyed = rows.withColumn("id", F.col("id").cast("long"))
    copies = write_table(_copies(keyed.where(F.octet_length("text") >= span)), "copies")
    whole = copies.select("doc", F.lit(0).alias("first"), F.lit(np.iinfo(np.int32).max // 2).alias("last"))
    starts = repeated_starts(keyed, copies, span, bucket).union(whole)
    ranges = starts.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))  # bounded by the text
    joined = rows.join(ranges, rows["id"].cast("long") == F.col("doc"), "left").select("id", "text", "ranges")
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Batches) -> Batches:
        span_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for b in (part for whole in batches for part in text_blocks(whole, "text")):
            kept, spans, sizes = [], [], []
            for text, ranges in zip(b.column("text").cast(pa.large_binary()).to_pylist(), b.column("ranges").to_pylist()):
                gone, at, parts = removed_spans(len(text), ranges or [], span) if len(text) >= span else [], 0, []
                for first, last in gone:
                    parts.append(text[at:first])
                    at = last
                kept.append(b"".join(parts) + text[at:])
                spans.append([{"first": x, "last": y} for x, y in gone])
                sizes.append(len(text))
            columns = [b.column("id"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, span_type)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "kept", "spans"])

    schema = f"id {kind}, n_bytes long, kept binary, spans array<struct<first: int, last: int>>"
    return map_batches(joined, work, schema).withColumnRenamed("id", id_col)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
