"""Benchmark decontamination with one Aho-Corasick automaton over normalised test questions and answers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, map_batches, named, read_table, text_blocks, texts_of

WINDOW_WORDS = 10
BLOCK_BYTES = 8 << 20  # of benchmark text in one automaton, which takes some 200 MB of a worker

# The words of the contract, after lower-casing A-Z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(range(256)).lower()  # of bytes: A-Z only
_AUTOMATA: dict[str, Matcher] = {}  # of this worker process: the latest one


def lowered(text: str) -> str:
    """A-Z in lower case; nothing else moves, so offsets stay those of the text."""
    return text.lower() if text.isascii() else text.encode().translate(_LOWER).decode()


class Matcher:
    """Finds the windows of a block of items in the words of a text.

    The automaton reads words as numbers. Its patterns are the items' words in consecutive pieces of half a window: each window
    holds a whole piece, and every word is in one piece only, so the automaton has a node per word at most. From a piece that occurs,
    the match is followed to both sides; as many equal words as a window has, or as a shorter item has, make it an occurrence.
    """

    def __init__(self, items: list[tuple], window: int = WINDOW_WORDS) -> None:
        self.numbers: dict[str, int] = {}  # 0 is a word of no item
        owners: dict[tuple[int, ...], set] = {}  # equal items are one text
        for item, text in items:
            words = WORD.findall(lowered(text or ""))
            if words:
                owners.setdefault(tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words), set()).add(item)
        self.texts, self.owners = list(owners), list(owners.values())
        self.needed = [min(window, len(t)) for t in self.texts]
        step = (window + 1) // 2
        places: dict[tuple[int, ...], dict[int, list[int]]] = {}
        for number, text in enumerate(self.texts):
            size = step if len(text) >= window else len(text)
            for at in range(0, len(text) - size + 1, size):
                places.setdefault(text[at : at + size], {}).setdefault(number, []).append(at)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for piece, having in places.items():
            self.machine.add_word(piece, (len(piece), having))
        if places:
            self.machine.make_automaton()

    def word_hits(self, words: list[str]) -> tuple[list[tuple[int, int]], set]:
        """Runs [first, last) of words inside occurrences, and the items that occur."""
        if not self.texts:
            return [], set()
        get = self.numbers.get
        line = tuple([get(w, 0) for w in words])
        runs, items = [], set()
        covered: dict[int, tuple[int, int]] = {}  # the latest run of each text
        for end, (size, having) in self.machine.iter(line):
            first, last = end - size + 1, end + 1
            for number, places in having.items():
                needed = self.needed[number]
                # All windows that hold this piece; nothing is new if they are in a run of this text.
                low, high = max(0, last - needed), min(len(line), first + needed)
                for at in places:
                    x, y = covered.get(number, (0, 0))
                    if x <= low and high <= y:
                        break
                    run = self._followed(line, first, last, self.texts[number], at)
                    if run[1] - run[0] >= needed:
                        runs.append(run)
                        items |= self.owners[number]
                        covered[number] = (min(x, run[0]), max(y, run[1])) if y and run[0] <= y else run
        return merged(runs), items

    @staticmethod
    def _followed(line: tuple[int, ...], first: int, last: int, text: tuple[int, ...], at: int) -> tuple[int, int]:
        """The longest run around [first, last) that equals the text around ``at``."""
        i, j = at - 1, at + last - first
        while first and i >= 0 and line[first - 1] == text[i]:
            first, i = first - 1, i - 1
        while last < len(line) and j < len(text) and line[last] == text[j]:
            last, j = last + 1, j + 1
        return first, last


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same positions in runs that are in order and do not touch."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``most`` bytes, or one longer item; all blocks of a scan are in the driver until it has run."""
    block, size = [], 0
    for item, text in named(benchmark.where(F.col(text_col).isNotNull()), item_col, text_col).toLocalIterator():
        block.append((item, text))
        size += len(text.encode())
        if size >= most:
            yield block
            block, size = [], 0
    yield block


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (id, n_words, n_items, items, word_runs, spans), and the columns of ``keep``; one per document.

    ``word_runs`` has the runs of hit words, ``spans`` the same as offsets of characters in the original
    text, both as arrays of (first, last) with the last left out. A benchmark is taken in blocks with an
    automaton each, which bounds what is broadcast; each block is a step of the same scan, without a shuffle.
    Null and empty texts have no words. An item without words occurs nowhere; equal items all
    count, one without an id under the name None. A benchmark without rows leaves every document clean. Repeated documents are rows
    of their own. A text is read whole, in time that grows with its words.
    """
    columns = list(dict.fromkeys([id_col, text_col, *keep]))
    runs = "cast(array() as array<struct<first: int, last: int>>)"
    rows = named(docs, *columns).withColumns(
        {"n_words": F.lit(0).cast("long"), "word_runs": F.expr(runs), "spans": F.expr(runs), "items": F.expr("cast(array() as array<string>)")}
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        rows = map_batches(rows, _marker(block, text_col, window), schema)
    return rows.withColumn("n_items", F.size("items").cast("long"))


def _marker(block: list[tuple], text_col: str, window: int):
    """A step of the scan: adds the occurrences of one block of items."""
    key = hashlib.sha256(repr((window, block)).encode()).hexdigest()

    def work(batches: Batches) -> Batches:
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = Matcher(block, window)
        machine = _AUTOMATA[key]
        for b in (part for whole in batches for part in text_blocks(whole, text_col)):
            new = {n: b.column(n).to_pylist() for n in ("n_words", "word_runs", "spans", "items")}
            for i, text in enumerate(texts_of(b.column(text_col))):
                text = lowered(text)
                words = WORD.findall(text)
                new["n_words"][i] = len(words)
                hits, having = machine.word_hits(words)
                if hits:
                    hits = merged(hits + [(r["first"], r["last"]) for r in new["word_runs"][i]])
                    at = [m.span() for m in WORD.finditer(text)]
                    new["word_runs"][i] = [{"first": x, "last": y} for x, y in hits]
                    new["spans"][i] = [{"first": at[x][0], "last": at[y - 1][1]} for x, y in hits]
                    new["items"][i] = sorted({*new["items"][i], *map(str, having)})
            names = b.schema.names
            columns = [pa.array(new[n], b.schema.field(n).type) if n in new else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return work


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("word_runs", F.lit(0).cast("long"), lambda n, r: n + (r["last"] - r["first"]))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), "n_items",
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
