import hashlib
import random
import zlib

import pytest

from ebbwatch.llm import prefix_trie as module
from ebbwatch.llm.prefix_trie import op13_prefix_trie, prefix_trie, rebuilt, turn_rows

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """The turns of each conversation in order."""
    out = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def nodes_of(whole):
    """The rows of the trie by walking every prefix of every conversation."""
    members, ends = {}, {}
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(conv)
        ends.setdefault(tuple(turns), set()).add(conv)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    sums = {}
    for prefix in sorted(members, key=len, reverse=True):
        below = [sums[c] for c in children.get(prefix, [])]
        own = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        sums[prefix] = (sum(b[0] for b in below) or (0 if below else 1), own + sum(b[1] for b in below))
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), *sums[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, ())))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def rows_of(found):
    return sorted(tuple(-1 if v is None and i == 2 else v for i, v in enumerate(r)) for r in found.collect())


def conversations(rng, longest=12, convs=120):
    said = [(r, t) for r in ("user", "assistant", None) for t in ("hello", "Ünï ☃ 𝄞", "", None, "x" * 50)]
    rows = []
    for c in range(convs):
        shared = rng.randrange(4)  # groups that begin alike
        script = random.Random(shared)
        length = rng.randrange(1, longest)
        turns = [script.choice(said) for _ in range(length - length // 4)] + [rng.choice(said) for _ in range(length // 4)]
        rows += [(c * 7, t, *turn) for t, turn in enumerate(turns)]
    rows += [(10_000 + c, t, "user", f"the same {t}") for c in range(60) for t in range(5)]  # equal conversations
    rows += [(20_000, t, "user", "long") for t in range(90)] + [(20_100, t, "user", "long") for t in range(70)]
    rows += [(20_201, t, "user", "long" if t < 33 else "other") for t in range(64)]
    return rows


@pytest.mark.parametrize("block,rows_a_shard", [(16, 50_000), (16, 7), (4, 10), (1, 25)])
def test_against_walk(spark, monkeypatch, block, rows_a_shard):
    monkeypatch.setattr(module, "BLOCK", block)
    rows = conversations(random.Random(block))
    if block == 1:
        rows = [r for r in rows if r[0] < 20_000]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "'clash' AS conv", "1 AS pos", "2 AS k", "3 AS ids")
    convs = frame.select("conv_id").distinct().toDF("conv")
    assert rows_of(prefix_trie(turn_rows(frame), convs, rows_a_shard)) == nodes_of(sequences(rows))


def test_segments_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 2)
    monkeypatch.setattr(module, "SEGMENT", 3)
    rows = [(c, t, "user", f"{t}" if t < 20 else f"{t} {c % 3}") for c in range(9) for t in range(20 + c)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = prefix_trie(turn_rows(frame), frame.select("conv_id").distinct().toDF("conv"), 4)
    assert rows_of(found) == nodes_of(sequences(rows))


def test_query_against_walk(spark, tmp_path):
    rng = random.Random(4)
    rows = [(c, t, "user" if t % 2 else None, f"{t} {rng.randrange(2)}") for c in range(90, 330) if c != 200 for t in range(rng.randrange(1, 9))]
    rows += [(c, None, "system", "first") for c in range(100, 130)] + [(None, 0, "user", "no id"), (-250, 0, "user", "below"), (-200, 0, "user", "base")]
    rows += [(400, 0, "user", "copied")] * 3 + [(401, 0, "user", "copied")] * 3
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    whole, made = sequences(rows), {}
    for c in whole:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100 if c >= 0 else c + -c % 100
        made[c] = whole.get(base, [])[:h] + whole[c][h:]
    assert any(not turns for turns in made.values())  # some are left without turns
    assert rows_of(op13_prefix_trie(spark, str(tmp_path))) == nodes_of(made)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(turn_rows(none), none.select("conv_id").toDF("conv")).count() == 0
    convs = spark.createDataFrame([(5,), (3,)], "conv long")
    assert rebuilt(turn_rows(none), convs).count() == 0
    only_root = prefix_trie(turn_rows(none), convs).collect()
    assert [tuple(r) for r in only_root] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())]
