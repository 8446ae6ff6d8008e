"""License notices found by an exact set-similarity join of text blocks with templates, by containment.

A template is a set of words. A block is a stretch of a text: with ``s``, the least power of two that
is not below the template's number of words, blocks have ``2 * s`` words and begin at every multiple
of ``s``, so whatever is no longer than the template lies whole in some block. A pair of block and template is
found if the block has at least the threshold's share of the template's words. Words are ordered by how
often they occur in all texts, rarest first; words of no template cannot count and are left out of the blocks.

* length filter: a block needs as many words as must be shared;
* prefix filter: if ``o`` of ``n`` words must be shared, one of the rarest ``n - o + 1`` is, on either side;
* positional filter: behind the place of a shared word, both sides must have enough words left;
* what is left is verified once per pair.

A phrase is a template with threshold 1, whose words must also stand consecutively: that is checked in the
blocks that the join finds.

Two scans of the texts, one to count words and one to join; only counts of template words are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, joined_bytes, map_batches, named, read_table, text_blocks
from ebbwatch.llm.license_templates import NOTICES, PHRASES

THRESHOLD = 0.9  # share of a notice's words that a block must have

# The words of the contract, after lower-casing A-Z.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_INSIDE = np.array([bool(WORD.match(bytes([b]))) for b in bytes(range(256)).lower()])


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    needed: int  # distinct words that a block must have
    consecutive: bool

    @property
    def step(self) -> int:
        """Words between the beginnings of blocks."""
        return 1 << max(2, (len(self.words) - 1).bit_length())


def template(text: str, label: str, threshold: float = 1.0, consecutive: bool = False) -> Template:
    words = tuple(WORD.findall(text.encode().lower()))
    if not words:
        raise ValueError(f"a template without words: {text!r}")
    # The small number keeps 0.9 * 10 from becoming 10.
    return Template(label, words, max(1, ceil(threshold * len(set(words)) - 1e-9)), consecutive)


def license_templates(threshold: float = THRESHOLD) -> list[Template]:
    phrases = [template(text, label, consecutive=True) for text, label in PHRASES.items()]
    return phrases + [template(text, label, threshold) for text, label in NOTICES.items()]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in the bytes of all texts, and the number of words of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = _INSIDE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[edges], last[edges - 1] = inside[edges], inside[edges - 1]  # words do not go on into the next text
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


class Vocabulary:
    """Finds the template words among the words of a batch, without a loop over words."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = words
        self.lengths = np.array([len(w) for w in words])
        data, offsets = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum(self.lengths)])
        self.head, self.tail = self._ends(data, offsets[:-1], offsets[1:])
        for factor in range(0x9E3779B97F4A7C15, 1 << 64, 2):
            self.factor = np.uint64(factor)
            keys = self._key(self.head, self.tail, self.lengths)
            if len(set(keys.tolist())) == len(words):
                break
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.starts_with = np.zeros(256, bool)
        self.starts_with[[w[0] for w in words]] = True

    @staticmethod
    def _ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last eight bytes of words as numbers."""
        head, tail = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for k in range(8):
            there = starts + k < ends
            head[there] |= data[starts[there] + k].astype(np.uint64) << np.uint64(8 * k)
            tail[there] |= data[ends[there] - 1 - k].astype(np.uint64) << np.uint64(8 * k)
        return head, tail

    def _key(self, head: np.ndarray, tail: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return (head * self.factor ^ tail) * self.factor + lengths.astype(np.uint64)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word, -1 of others; ``data`` is in lower case."""
        found = np.full(len(starts), -1, np.int64)
        maybe = np.flatnonzero(self.starts_with[data[starts]] & np.isin(ends - starts, self.lengths)) if len(starts) else starts
        starts, ends = starts[maybe], ends[maybe]
        head, tail = self._ends(data, starts, ends)
        at = np.searchsorted(self.keys, self._key(head, tail, ends - starts))
        word = self.order[np.minimum(at, len(self.order) - 1)]
        same = (self.head[word] == head) & (self.tail[word] == tail) & (self.lengths[word] == ends - starts)
        for i in np.flatnonzero(same & (ends - starts > 16)):  # up to 16 bytes, head and tail are the word
            same[i] = data[starts[i] : ends[i]].tobytes() == self.words[word[i]]
        found[maybe[same]] = word[same]
        return found


class BlockJoin:
    """The join of blocks of one size with the templates of that size."""

    def __init__(self, templates: list[Template], members: list[int], rank: dict[bytes, int]) -> None:
        self.step = templates[members[0]].step
        self.members = members
        self.has = np.zeros((len(members), len(rank)), bool)
        prefixes: list[tuple[int, int, int]] = []  # (rank of the word, template, place of the word)
        for t, member in enumerate(members):
            sorted_words = sorted({rank[w] for w in templates[member].words})
            self.has[t, sorted_words] = True
            needed = templates[member].needed
            prefixes += [(r, t, i) for i, r in enumerate(sorted_words[: len(sorted_words) - needed + 1])]
        prefixes.sort()
        self.prefix = np.array(prefixes, np.int64).reshape(-1, 3)
        self.first = np.searchsorted(self.prefix[:, 0], np.arange(len(rank) + 1))
        self.size = self.has.sum(1)
        self.needed = np.array([templates[m].needed for m in members])
        self.used = self.has.any(0)

    def pairs(self, owner: np.ndarray, position: np.ndarray, rank: np.ndarray, n_words: np.ndarray):
        """Pairs (text, block, template, shared words) that meet the threshold; each pair once."""
        mine = self.used[rank]
        owner, position, rank = owner[mine], position[mine], rank[mine]
        base = np.concatenate([[0], np.cumsum(n_words // self.step + 1)])
        block = position // self.step
        again = block > 0  # every word is in two blocks, but for the first ones
        keys = np.concatenate([base[owner] + block, base[owner[again]] + block[again] - 1])
        keys = np.unique(keys * len(self.used) + np.concatenate([rank, rank[again]]))  # blocks as sets, rarest word first
        block, rank = keys // len(self.used), keys % len(self.used)
        begins = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else block
        sizes = np.diff(np.append(begins, len(block)))
        of = np.repeat(np.arange(len(begins)), sizes)
        place = np.arange(len(block)) - begins[of]
        meets = self.first[rank + 1] - self.first[rank]
        word = np.repeat(np.arange(len(block)), meets)
        entry = self.first[rank[word]] + np.arange(len(word)) - np.repeat(np.cumsum(meets) - meets, meets)
        t, i = self.prefix[entry, 1], self.prefix[entry, 2]
        size, j, needed = sizes[of[word]], place[word], self.needed[t]
        kept = (size >= needed) & (j <= size - needed)  # length; prefix of the block
        kept &= 1 + np.minimum(self.size[t] - 1 - i, size - 1 - j) >= needed  # position
        pair = np.unique(of[word[kept]] * len(self.members) + t[kept])
        of, t = pair // len(self.members), pair % len(self.members)
        if not len(pair):
            return pair, pair, pair, pair
        n = sizes[of]
        begin = np.cumsum(n) - n
        words = rank[np.repeat(begins[of] - begin, n) + np.arange(n.sum())]
        shared = np.add.reduceat(self.has[np.repeat(t, n), words].astype(np.int64), begin)
        enough = shared >= self.needed[t]
        unit = block[begins[of[enough]]]
        text = np.searchsorted(base, unit, "right") - 1
        return text, unit - base[text], np.array(self.members)[t[enough]], shared[enough]


def _batches(batches: Batches, column: str) -> Iterator[tuple]:
    """Parts of batches with their bytes in lower case and the words in them."""
    for part in (part for whole in batches for part in text_blocks(whole, column)):
        data, offsets = joined_bytes(part.column(column))
        yield part, _LOWER[data], offsets, *word_spans(data, offsets)


def word_counts(docs: DataFrame, text_col: str, words: list[bytes]) -> dict[bytes, int]:
    """How often each of the words occurs in all texts; one row per word reaches the driver."""

    def work(batches: Batches) -> Batches:
        vocabulary, total = Vocabulary(words), np.zeros(len(words), np.int64)
        for _, data, _, starts, ends, _ in _batches(batches, text_col):
            found = vocabulary.find(data, starts, ends)
            total += np.bincount(found[found >= 0], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["word", "n"])

    counts = map_batches(named(docs, text_col), work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return dict.fromkeys(words, 0) | {words[r.word]: r.n for r in counts.collect()}


_SPAN = "array<struct<label: string, first_word: long, last_word: long, first_byte: long, last_byte: long, containment: double>>"


def license_blocks(
    docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (id, n_words, places, blocks) and the columns of ``keep``; one per document.

    ``places`` are the places of the phrases, ``blocks`` the text blocks that meet a notice's threshold; both have
    the label, the words and bytes they reach over (the last one left out), and the containment, in the order of the text.
    Null and empty texts have no words and no places. Repeated rows are rows of their own. A text is read whole, however
    long; a task holds about 1 MB of texts or one longer text. The templates are a parameter of the code, not a table.
    An empty input gives no rows.
    """
    templates = license_templates() if templates is None else templates
    columns = list(dict.fromkeys([id_col, text_col, *keep]))
    rows = named(docs, *columns)
    counts = word_counts(rows, text_col, sorted({w for t in templates for w in t.words}))
    words = sorted(counts, key=lambda w: (counts[w], w))  # rarest first

    def work(batches: Batches) -> Batches:
        vocabulary, rank = Vocabulary(words), {w: i for i, w in enumerate(words)}
        steps = sorted({t.step for t in templates})
        joins = [BlockJoin(templates, [i for i, t in enumerate(templates) if t.step == s], rank) for s in steps]
        for part, data, offsets, starts, ends, n_words in _batches(batches, text_col):
            found = vocabulary.find(data, starts, ends)
            at = np.flatnonzero(found >= 0)
            before = np.cumsum(n_words) - n_words
            owner = np.searchsorted(before, at, "right") - 1
            spans: list[list] = [[[], []] for _ in range(part.num_rows)]
            for join in joins:
                for text, block, t, shared in zip(*(x.tolist() for x in join.pairs(owner, at - before[owner], found[at], n_words))):
                    first, total, of = block * join.step, int(n_words[text]), templates[t]
                    last = min(total, first + 2 * join.step)
                    reach = [(first, last)]
                    if of.consecutive:
                        line = found[before[text] + first : before[text] + last]
                        goal, m = [rank[w] for w in of.words], len(of.words)
                        # A place belongs to the block in whose first half it begins; the others have it again.
                        heads = np.flatnonzero(line[: join.step] == goal[0]).tolist()
                        reach = [(first + h, first + h + m) for h in heads if line[h : h + m].tolist() == goal]
                    for x, y in reach:
                        span = (x, y, int(starts[before[text] + x] - offsets[text]), int(ends[before[text] + y - 1] - offsets[text]))
                        spans[text][not of.consecutive].append((of.label, *span, shared / len(set(of.words))))
            names = ("label", "first_word", "last_word", "first_byte", "last_byte", "containment")
            lists = [[[dict(zip(names, s)) for s in sorted(x[k], key=lambda s: (s[1:3], s[0], -s[5]))] for x in spans] for k in (0, 1)]
            kind = pa.list_(pa.struct([*zip(names, [pa.string(), *[pa.int64()] * 4, pa.float64()])]))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(n_words, pa.int64()), *(pa.array(x, kind) for x in lists)],
                [*part.schema.names, "n_words", "places", "blocks"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    found = map_batches(rows, work, f"{schema}, n_words long, places {_SPAN}, blocks {_SPAN}")
    return found.select(*dict.fromkeys([id_col, *keep]), "n_words", "places", "blocks")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_blocks(read_table(spark, sf_dir, "documents"))
    labels = lambda of: F.concat_ws(",", F.array_sort(F.array_distinct(of)))
    starts = F.col("places.first_word")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.col("places.label")).alias("base_labels"),
        labels(F.concat("places.label", "blocks.label")).alias("labels"),
        F.coalesce(F.array_max(F.concat("places.containment", "blocks.containment")), F.lit(0.0)).alias("score"),
    )
