"""The registered queries over whole tables, against plain readings of their contracts."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbwatch.llm import sharding
from ebbwatch.llm.common import read_table
from ebbwatch.llm.exact_dedup import op1_exact_dedup
from ebbwatch.llm.language_id import op5_language_id
from ebbwatch.llm.nearest import op2_nearest
from ebbwatch.llm.packing import op8_packing
from ebbwatch.llm.token_counts import op6_token_counts
from ebbwatch.llm.toxicity import op3_toxicity

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").orderBy("doc_id").toPandas().set_index("doc_id")


def crc(value) -> int:
    return zlib.crc32(str(value).encode())


def test_op1_against_all_strings(spark, sf_dir, docs):
    seen, want = set(), {}
    for i, text in docs.text.items():
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            piece = data[k : k + 100]
            if piece in seen:
                gone[k : k + 100] = True
            seen.add(piece)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        want[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op1_exact_dedup(spark, sf_dir).collect()}
    assert got == want


def test_op2_against_all_products(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings").orderBy("vec_id").toPandas()
    ids, vectors = rows.vec_id.to_numpy(), np.array(rows.embedding.tolist(), np.float64)
    got = op2_nearest(spark, sf_dir).toPandas().sort_values(["query_id", "rank"])
    assert sorted(set(got.query_id)) == [i for i in ids if i % 20 == 0]
    at, found, total = {v: k for k, v in enumerate(ids)}, 0, 0
    for query, part in got.groupby("query_id"):
        score = vectors @ vectors[at[query]]
        assert list(part["rank"]) == list(range(1, 21)) and query not in set(part.vec_id)
        assert np.allclose(part.score, [score[at[v]] for v in part.vec_id], rtol=0, atol=1e-12)
        best = [v for v in ids[np.lexsort((ids, -score))] if v != query][:20]
        found, total = found + len(set(best) & set(part.vec_id)), total + 20
    assert found >= 0.9 * total


def test_op3_folds_and_scores(spark, sf_dir, docs):
    got = op3_toxicity(spark, sf_dir).toPandas()
    assert sorted(got.doc_id) == list(docs.index)
    assert list(got.held_out) == [crc(i) % 5 == 0 for i in got.doc_id]
    assert got.score.between(0, 1).all() and list(got.predicted) == [int(s >= 0.5) for s in got.score]


def test_op5_folds_and_accuracy(spark, sf_dir, docs):
    got = op5_language_id(spark, sf_dir).toPandas()
    assert sorted(got.doc_id) == list(docs.index)
    assert list(got.held_out) == [crc(i) % 3 == 1 for i in got.doc_id]
    learnt = {lang for i, lang in docs.lang.items() if lang and crc(i) % 3 != 1}
    right = []
    for r in got.itertuples():
        text, lang = docs.text[r.doc_id], docs.lang[r.doc_id]
        lettered = any(c.isalpha() for c in text or "")
        assert 0 <= r.score <= 1 and (r.lang_pred in learnt if lettered else r.lang_pred == "und")
        if r.held_out and lettered and lang:
            right.append(r.lang_pred == lang)
    assert np.mean(right) >= 0.9


def test_op6_and_op8_against_the_library(spark, sf_dir, docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in docs.text.items()}
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op6_token_counts(spark, sf_dir).collect()}
    assert counts == {i: (len((docs.text[i] or "").encode()), len(x), len(x) > 2048) for i, x in ids.items()}

    pieces = op8_packing(spark, sf_dir).toPandas()
    for i, part in pieces.sort_values("start").groupby("doc_id"):
        whole, at = [*ids[i], 1], 0
        for r in part.itertuples():
            assert r.start == at and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(whole)
    assert set(pieces.doc_id) == set(ids)
    for _, part in pieces.sort_values("offset").groupby("sequence_id"):
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 2048


def naive_tree(points: np.ndarray, weight: np.ndarray, rows: np.ndarray, first: int, shards: int, ranges: list, extent: list, out: np.ndarray) -> None:
    """Sorted weighted medians, a cell at a time."""
    if shards == 1:
        out[rows] = first
        return
    d = max(range(len(ranges)), key=lambda k: (ranges[k][1] - ranges[k][0]) / extent[k])
    order = rows[np.argsort(points[rows, d], kind="stable")]
    ends, goal = np.cumsum(weight[order]), weight[rows].sum() * (shards // 2) / shards
    k = int(np.argmax(ends >= goal))
    before = ends[k] - weight[order[k]]
    cut = int(points[order[k], d]) + (1 if ends[k] - goal < goal - before else 0)
    left = points[rows, d] < cut
    for mine, start, n, side in ((left, first, shards // 2, (ranges[d][0], cut - 1)), (~left, first + shards // 2, shards - shards // 2, (cut, ranges[d][1]))):
        naive_tree(points, weight, rows[mine], start, n, [side if i == d else r for i, r in enumerate(ranges)], extent, out)


def test_op4_against_sorted_medians(spark, sf_dir, docs):
    got = sharding.op4_sharding(spark, sf_dir).toPandas().sort_values("doc_id")
    data = [(t or "").encode() for t in docs.text]
    assert list(got.doc_id) == list(docs.index) and list(got["size"]) == [len(d) + 16 for d in data]
    assert list(got.text_crc32) == [zlib.crc32(d) for d in data] and set(got.law) == {"bytes"}
    for number, part in got.groupby("shard"):
        assert 0 <= number < 40 and sorted(part.slot) == list(range(len(part)))
    spread = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    frame = spark.createDataFrame(got[["doc_id", "size", "text_crc32"]])
    keys = sharding.sharding_keys(F.col("size"), F.col("text_crc32"), spread)
    points = frame.select("doc_id", *[c.alias(k) for k, c in keys.items()]).orderBy("doc_id").toPandas()[list(keys)].to_numpy(np.int64)
    ranges = [(int(points[:, d].min()), int(points[:, d].max())) for d in range(2)]
    want = np.zeros(len(points), np.int64)
    naive_tree(points, got["size"].to_numpy(), np.arange(len(points)), 0, 8, ranges, [max(1, b - a) for a, b in ranges], want)
    eight = sharding.shard(read_table(spark, sf_dir, "documents"), shards=8).toPandas().sort_values("doc_id")
    assert list(eight.shard) == list(want)
