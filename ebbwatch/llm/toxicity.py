"""Toxicity by a bidirectional gated recurrent network with attention pooling over characters and words.

A word is read twice: as an entry of a small vocabulary, and character by character by the first layer. The second layer
reads windows of words. Windows overlap by half and cover the whole text; the most toxic one decides.
Whatever depends on a word alone is computed once per distinct word of a block of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.attentive_gru import Adam, Layer, Params, going, new_layer, pooled, scan, sigmoid
from ebbwatch.llm.common import Batches, excerpt, fold, joined_bytes, map_batches, named, read_table, text_blocks
from ebbwatch.llm.shingles import mixed

WINDOW, STRIDE = 16, 8
PIECE = 24  # bytes of a word that the character layer reads at once; longer words are several
HIDDEN, CHARS, EMBEDDED = 8, 8, 8
VOCABULARY = 4_096  # most frequent words of the sample that have a vector of their own
LEAST_COUNT = 5
SAMPLE_DOCS = 3_000  # bound of the labelled documents learnt from, up to half of them toxic
SAMPLE_BYTES = 8 << 20  # bound of their text, up to half of it toxic
LONG = 32  # a text over this part of a half is learnt from by pieces
ROUNDS = 14  # at least; small samples are gone through more often
STEPS = 400  # batches of 256 windows, at least
BLOCK = 4 << 20

_BASE = 0x5851F42D4C957F2D
_WORD = np.zeros(256, bool)
_WORD[[b for b in range(256) if b >= 0x80 or chr(b).isalnum()]] = True
_CODE = np.random.default_rng(5).integers(1, 1 << 63, 256, np.uint64)


class Words:
    """The words of a column of texts: lower-cased pieces of bytes, and which text each is in."""

    def __init__(self, column: pa.Array):
        data, offsets = joined_bytes(pc.utf8_lower(column.cast(pa.large_string())))
        self.texts = len(column)
        if not len(data):
            self.starts = self.ends = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, np.uint64)
        else:
            inside = _WORD[data]
            breaks = np.zeros(len(data) + 1, bool)
            breaks[offsets] = True
            first = inside & (breaks[:-1] | np.concatenate([[True], ~inside[:-1]]))
            last = inside & (breaks[1:] | np.concatenate([~inside[1:], [True]]))
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            parts = -(-(ends - starts) // PIECE)
            number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            self.starts = np.repeat(starts, parts) + PIECE * number
            self.ends = np.minimum(self.starts + PIECE, np.repeat(ends, parts))
            self.hashes = self._hashes(data)
        self.data = data
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i] .. bounds[i + 1]

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Byte by byte for all words at once, the longest first, so that a step works on those that go on."""
        lengths = self.ends - self.starts
        order = np.argsort(-lengths, kind="stable")
        starts, hashes = self.starts[order], lengths[order].astype(np.uint64)
        for k, n in enumerate(going(lengths[order], PIECE)):
            hashes[:n] = hashes[:n] * np.uint64(_BASE) + _CODE[data[starts[:n] + k]]
        out = np.empty_like(hashes)
        out[order] = mixed(hashes)
        return out

    def characters(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes (steps, size) and lengths of the words at these places."""
        lengths = self.ends[at] - self.starts[at]
        steps = np.arange(int(lengths.max(initial=1)))[:, None]
        places = np.minimum(self.starts[at] + steps, max(0, len(self.data) - 1))
        return self.data[places] if len(self.data) else np.zeros(places.shape, np.uint8), lengths

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and text of all windows; a text without words has one of length 0."""
        n = np.diff(self.bounds)
        many = np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1
        text = np.repeat(np.arange(self.texts), many)
        number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = self.bounds[text] + np.minimum(number * STRIDE, np.maximum(0, n[text] - WINDOW))
        return start, np.minimum(n[text], WINDOW), text


class ToxicityModel:
    def __init__(self, vocabulary: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.vocabulary = np.sort(vocabulary)
        self.params: Params = new_layer(rng, CHARS, HIDDEN, "chars") | new_layer(rng, 2 * HIDDEN + EMBEDDED, HIDDEN, "words")
        self.params["bytes"] = rng.standard_normal((256, CHARS)).astype(np.float32) * 0.5
        self.params["vectors"] = np.zeros((len(vocabulary) + 1, EMBEDDED), np.float32)  # the last one: any other word
        self.params["vectors"][:-1] = rng.standard_normal((len(vocabulary), EMBEDDED)) * 0.3
        self.params["out"] = (rng.standard_normal(2 * HIDDEN) * 0.3).astype(np.float32)
        self.params["bias"] = np.zeros(1, np.float32)
        self.shift = 0.0

    def entries(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == hashes if len(self.vocabulary) else hashes != hashes
        return np.where(known, at, len(self.vocabulary))

    def logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Logit and text of every window."""
        start, length, text = words.windows()
        p = self.params
        _, first, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        gates = {s: np.zeros((len(first) + 1, 3 * HIDDEN), np.float32) for s in "fb"}
        order = np.argsort(words.starts[first] - words.ends[first], kind="stable")  # longest first
        for at in range(0, len(order), 8192):
            mine = order[at : at + 8192]
            chars, sizes = words.characters(first[mine])
            inputs = np.concatenate([self._read(chars, sizes), p["vectors"][self.entries(words.hashes[first[mine]])]], axis=1)
            for s in "fb":
                gates[s][mine] = inputs @ p[f"words.W{s}"] + p[f"words.b{s}"]
        out = np.empty(len(start), np.float32)
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), 8192):
            mine = order[at : at + 8192]
            spots = np.minimum(start[mine] + np.arange(WINDOW)[:, None], max(0, len(place) - 1))
            spots = place[spots] if len(place) else np.zeros(spots.shape, np.int64)
            counts = going(length[mine], WINDOW)
            states = [scan(lambda t, n, s=s: gates[s][spots[t, :n]], p[f"words.U{s}"], counts, s == "b", len(mine)) for s in "fb"]
            out[mine] = pooled(np.concatenate(states, axis=2), p["words.v"], counts)[0] @ p["out"] + p["bias"][0]
        return out, text

    def _read(self, chars: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        p, counts, sides = self.params, going(sizes, len(chars)), []
        for s in "fb":
            gates = p["bytes"] @ p[f"chars.W{s}"] + p[f"chars.b{s}"]
            sides.append(scan(lambda t, n, g=gates: g[chars[t, :n]], p[f"chars.U{s}"], counts, s == "b", chars.shape[1]))
        return pooled(np.concatenate(sides, axis=2), p["chars.v"], counts)[0]

    def gradient(self, words: Words, start: np.ndarray, length: np.ndarray, target: np.ndarray, hide: np.ndarray) -> Params:
        """Of the logistic loss over some windows, the longest first; ``hide`` leaves words to their characters."""
        p, grads = self.params, {k: np.zeros_like(v) for k, v in self.params.items()}
        spots = np.minimum(start + np.arange(WINDOW)[:, None], len(words.hashes) - 1)
        _, first, place = np.unique(words.hashes[spots], return_index=True, return_inverse=True)
        which = spots.ravel()[first]
        order = np.argsort(words.starts[which] - words.ends[which], kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        place, which = rank[place.reshape(spots.shape)], which[order]
        chars, sizes = words.characters(which)
        read = Layer(p, "chars", p["bytes"][chars], sizes)
        entry = np.where(hide, len(self.vocabulary), self.entries(words.hashes[spots]))
        seen = Layer(p, "words", np.concatenate([read.out[place], p["vectors"][entry]], axis=2), length)
        off = ((sigmoid(seen.out @ p["out"] + p["bias"][0]) - target) / len(target)).astype(np.float32)
        grads["out"] += off @ seen.out
        grads["bias"] += off.sum()
        d = seen.backward(off[:, None] * p["out"], grads)
        np.add.at(grads["vectors"], entry, d[:, :, 2 * HIDDEN :])
        grads["vectors"][-1] = 0
        d_read = np.zeros_like(read.out)
        np.add.at(d_read, place, d[:, :, : 2 * HIDDEN])
        np.add.at(grads["bytes"], chars, read.backward(d_read, grads))
        return grads

    def scores(self, column: pa.Array) -> np.ndarray:
        words = Words(column)
        logits, text = self.logits(words)
        best = np.full(words.texts, -np.inf)
        np.maximum.at(best, text, logits.astype(np.float64))
        return np.round(sigmoid(best - self.shift), 6)  # sums depend on the block in their last bits


def train(texts: list[str], toxic: list[int], rounds: int = ROUNDS, seed: int = 3) -> ToxicityModel:
    """Learns from labels of whole texts: a toxic text's windows count as toxic only as far as the model singles them out."""
    rng, labels = np.random.default_rng(seed), np.array(toxic, bool)
    words = Words(pa.array(texts, pa.string()))
    values, counts = np.unique(words.hashes, return_counts=True)
    often = np.argsort(-counts, kind="stable")[:VOCABULARY]
    model = ToxicityModel(values[often[counts[often] >= LEAST_COUNT]], seed)
    start, length, text = words.windows()
    adam, able = Adam(model.params), length > 0
    if not able.any() or labels.all() or not labels.any():
        model.params["bias"][0] = 4.0 * (2 * labels.mean() - 1) if len(labels) else -4.0
        model.params["out"][:] = 0
        return model
    clean = np.flatnonzero(able & ~labels[text])
    rounds = max(rounds, min(3 * rounds, STEPS * 256 // (4 * words.texts)))
    for i in range(rounds):
        rank = rng.random(len(start))
        if i >= 2:  # from now on, each text is represented by the windows that look worst
            if i % 2 == 0:
                worst = model.logits(words)[0]
            rank = rank * 0.01 - worst
        order = np.lexsort((rank, text))
        number = np.arange(len(order)) - np.searchsorted(text[order], text[order])
        most = np.where(labels[text[order]], 3 if i < 2 else 1 + (i < 6), 2)
        mine = order[able[order] & (number < most)]
        mine = np.concatenate([mine, rng.choice(clean, min(len(mine), 4000))])
        rng.shuffle(mine)
        adam.rate = 0.012 if i < rounds - 4 else 0.004
        for at in range(0, len(mine), 256):
            part = mine[at : at + 256]
            part = part[np.argsort(-length[part], kind="stable")]
            hide = rng.random((WINDOW, len(part))) < 0.5
            adam.step(model.gradient(words, start[part], length[part], labels[text[part]].astype(np.float32), hide))
    model.shift = _threshold(words.texts, *model.logits(words), labels)
    return model


def _threshold(texts: int, logits: np.ndarray, text: np.ndarray, labels: np.ndarray) -> float:
    """The logit that parts the texts learnt from with the best F1, halfway between its neighbours."""
    best = np.full(texts, -np.inf)
    np.maximum.at(best, text, logits.astype(np.float64))
    order = np.argsort(-best)
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(texts) + 1 + labels.sum())
    at = int(f1.argmax())
    above, below = best[order[at]], best[order[min(at + 1, texts - 1)]]
    return float(above + below) / 2 if at + 1 < texts else float(above) - 1.0


def learning_rows(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
    most: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES,
) -> tuple[list[str], list[int]]:
    """About ``most`` labelled documents, chosen by a hash of the id, toxic and others in equal number if there are.

    Each kind is taken in the order of the hash as far as its bytes go: half of ``most_bytes`` for toxic ones, all that these leave
    for the others. A text that does not fit is passed over, and one over a small part of the half is represented by pieces of it.
    """
    label = named(labels, id_col, label_col).toDF("id", "label").where("id is not null and label in (0, 1)")
    label = label.groupBy("id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in label.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic = min(sizes.get(1, 0), most // 2)
    wanted = {1: toxic, 0: min(sizes.get(0, 0), most - toxic)}
    chance = F.pmod(F.xxhash64("id", F.lit("toxicity sample")), F.lit(1 << 40)) / float(1 << 40)
    share = F.when(F.col("label") == 1, F.lit(wanted[1] / max(1, sizes.get(1, 0)))).otherwise(F.lit(wanted[0] / max(1, sizes.get(0, 0))))
    chosen = label.withColumn("chance", chance).where(F.col("chance") < share)
    rows = named(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(chosen), "id")  # about ``most`` rows
    rows = rows.withColumn("text", excerpt("text", max(1, most_bytes // 2 // LONG)))
    texts, toxic_of, room = [], [], {1: most_bytes // 2, 0: most_bytes}
    for text, value in rows.orderBy(F.desc("label"), "chance", "id").select("text", "label").toLocalIterator():
        size = len((text or "").encode())
        if size > room[value]:
            continue
        for kind in {value, 0}:  # what toxic texts take is not left for the others
            room[kind] -= size
        texts.append(text or "")
        toxic_of.append(value)
    return texts, toxic_of


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """Rows (id, score), one per document; ``labels`` says which documents to learn from.

    Learns from at most about ``sample_docs`` documents with ``sample_bytes`` of text (see ``learning_rows``), and scores every window of every text. Null
    and empty texts, and those without a word, score as a window without words. Without labels of both kinds, all scores are equal.
    A document with several labels counts as the highest.
    """
    texts, toxic = learning_rows(docs, labels, id_col, text_col, label_col, sample_docs, sample_bytes)
    model = docs.sparkSession.sparkContext.broadcast(train(texts, toxic))
    rows = named(docs, id_col, text_col).toDF("id", "text")

    def work(batches: Batches) -> Batches:
        for b in (part for whole in batches for part in text_blocks(whole, "text", BLOCK)):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.scores(b.column(1)))], ["id", "score"])

    kind = rows.schema[0].dataType.simpleString()
    return map_batches(rows, work, f"id {kind}, score double").withColumnRenamed("id", id_col)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    found = toxicity(read_table(spark, sf_dir, "documents"), labels)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
