import random

import corpus_pipeline
import pyarrow as pa
from ebbwatch.llm.decontamination import contamination
from ebbwatch.llm.pseudonyms import found_values
from tests.llm.test_similarity_join import brute
from tests.llm.texts import documents, frame, prose

COLUMNS = list(corpus_pipeline.COLUMNS)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    groups = brute([texts[i] for i in sorted(texts)])
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == COLUMNS, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    ids = {r.doc_id for r in kept.collect()}
    leaks = {r.doc_id for r in contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_items > 0").collect()}
    assert ids == {i for i, (_, least) in groups.items() if i == least and i not in leaks}
    for r in kept.collect():
        assert r.n_chars == len(r.text) and bool(found_values(r.text, b"k")) == bool(found_values(texts[r.doc_id], b"k"))
    pieces = corpus_pipeline.STAGES[4][1](spark, kept, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids


def test_edges(spark, sf_dir):
    odd = frame(spark, [(1, None, None, None, None), (2, "12", "en", "s", 2), (3, "a b", None, None, 3), (3, "a b", None, None, 3), (None, "c", "en", "s", 1)])
    for docs, ids in ((documents(spark, []), []), (odd, [3, None])):
        for _, stage in corpus_pipeline.STAGES[:4]:
            docs = stage(spark, docs, sf_dir)
        assert sorted([r.doc_id for r in docs.collect()], key=str) == ids


def test_no_labels_to_learn_from(spark):
    docs = documents(spark, ["some text", "日本", "12 3", None], [None] * 4)
    assert sorted(r.doc_id for r in corpus_pipeline.languages(spark, docs, "").collect()) == [0, 1]


def test_texts_that_share_an_id(spark):
    rng = random.Random(4)
    a, b, c, d = (prose(rng, 60, 5000) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, c), (3, d), (3, f"{d} more"), (4, d), (5, None), (5, ""), (5, "")]
    docs = frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in rows])
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    got = sorted([(r.doc_id, "d" if r.text and r.text.startswith(d) else r.text) for r in got.collect()], key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (3, "d"), (5, None), (5, "")], key=str)


def test_batches_are_bounded_by_bytes(spark):
    """Eighty texts of half a million bytes, which would otherwise reach a worker at once."""
    docs = spark.range(0, 80, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 50000) as text", "'en' as lang", "'s' as source", "550000L as n_chars")
    corpus_pipeline.STAGES[0][1](spark, docs, "")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 40e6 and max(found) < 6e6
