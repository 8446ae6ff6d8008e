import zlib

from ebbwatch.llm.sharding import shard
from tests.llm.texts import documents, frame, mixed_texts, prose
import random


def checked(rows, shards):
    for number, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part))) and 0 <= number < shards
    return rows.groupby("shard")["size"].sum()


def test_even_bytes(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(3000)]
    texts += ["copy of a text"] * 1500  # a third
    got = shard(documents(spark, texts), shards=7, bucket_rows=100).toPandas()
    sizes = checked(got, 7)
    assert len(got) == 4500 and len(sizes) == 7 and sizes.max() - sizes.min() < 0.02 * sizes.mean()
    for r in got.itertuples():
        assert r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    parted = got[got.doc_id < 3000].groupby("text_crc32").shard.nunique()
    assert (parted > 1).sum() <= 6  # equal texts stay together but for the cuts


def test_edges(spark):
    texts = mixed_texts()
    got = shard(documents(spark, texts), shards=5).toPandas()
    checked(got, 5)
    assert sorted(got.doc_id) == list(range(len(texts))) and got.set_index("doc_id")["size"][0] == 16
    assert shard(documents(spark, [])).count() == 0
    twice = shard(frame(spark, [(1, "a", None, None, 1)] * 2 + [(None, None, None, None, 0)]), shards=3).toPandas()
    assert len(twice) == 3
    checked(twice, 3)
