import hashlib
import random

import pytest

from ebbwatch.llm import exact_dedup
from ebbwatch.llm.exact_dedup import removed_spans, without_repeats
from ebbwatch.llm.suffix_groups import lyndon_groups, suffix_order
from tests.llm.texts import documents, frame, mixed_texts


def brute(texts: dict, span: int = 100) -> dict:
    seen, out = set(), {}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - span + 1):
            part = data[at : at + span]
            if part in seen:
                gone[at : at + span] = b"\1" * span
            seen.add(part)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc] = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(docs, **options) -> dict:
    rows = without_repeats(docs, **options).collect()
    return {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in rows}


def passages(seed: int) -> list:
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcd é") for _ in range(rng.randint(90, 300))) for _ in range(5)]
    part = lambda: rng.choice([
        "x" * rng.randint(0, 250), rng.choice(shared)[rng.randint(0, 60) :], "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
    ])
    return ["".join(part() for _ in range(rng.randint(0, 5))) for _ in range(120)]


@pytest.mark.parametrize("bucket, copies", [(256, 10**6), (2, 0), (1, 10**6)])
def test_against_brute_force(spark, monkeypatch, bucket, copies):
    monkeypatch.setattr(exact_dedup, "COPIES", copies)  # 0: the ids of whole copies are joined, not sent
    texts = passages(3) + mixed_texts()
    assert found(documents(spark, texts), bucket=bucket) == brute(dict(enumerate(texts)))


def test_edges_of_a_common_passage_are_split_by_further_bytes(spark):
    rng, passage = random.Random(8), "".join(f"{i:x}" for i in range(1000, 1060))  # 180 bytes
    side = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
    texts = [f"{i} {side()}{passage[: 90 + rng.randint(0, 9)]}{side()} {i}" for i in range(400)]
    assert found(documents(spark, texts), bucket=20) == brute(dict(enumerate(texts)))


def test_edges(spark):
    assert without_repeats(documents(spark, [])).count() == 0
    text = "".join(f"{i} " for i in range(60))
    rows = [(1, text, None, None, 0), (1, text, None, None, 0), (None, text, None, None, 0), (2, text, None, None, 0)]
    got = sorted((r.doc_id or 0, len(r.kept)) for r in without_repeats(frame(spark, rows)).collect())
    assert got == [(0, len(text)), (1, len(text)), (1, len(text)), (2, 0)]


def test_suffix_order():
    rng = random.Random(4)
    for _ in range(2000):
        text = bytes(rng.choice(b"ab\x00c"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 40)))
        assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])
        group, length, _ = lyndon_groups(text)
        for i, g in enumerate(group):  # the longest prefix that is smaller than its proper suffixes
            word = text[i : i + length[g]]
            assert all(word < word[k:] for k in range(1, len(word)))


def test_spans():
    ranges = [{"first": 0, "last": 1}, {"first": 50, "last": 52}, {"first": 300, "last": 10**9}]
    assert removed_spans(400, ranges, 100) == [(0, 151), (300, 400)]
