import os
import subprocess
import sys
import zlib
from bisect import bisect_left, insort

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbwatch.llm import packing
from ebbwatch.llm.packing import best_fit_plan, bpe_encoder, pack_documents
from ebbwatch.llm.pretokens import VOCABULARY, pretokens, tokenizer
from ebbwatch.llm.token_counts import LengthTable, _lookup, token_counts
from tests.conftest import ROOT
from tests.llm.texts import documents, mixed_texts

SIGNS = st.text(st.one_of(st.sampled_from("abZ's'tREve09½²ßİſ \u0085\x1c\x00\n!.́é<|endoftext|>Ǆⱥ日本😀"), st.characters(exclude_categories=["Cs"])), max_size=40)


def library(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(SIGNS)
def test_counts_are_the_library_s(text):
    assert _lookup(VOCABULARY, LengthTable(64), 50)([text]) == [len(library(text))]


def test_every_character_below_the_limit():
    texts = [t for c in map(chr, range(0x300)) for t in (c, f"a{c}b", f"1{c}'s", f"!{c}!")]
    assert all(pretokens(t) is not None for t in texts if not set(t) & set("İȺȾ"))
    assert _lookup(VOCABULARY, LengthTable(64), 10**6)(texts) == [len(library(t)) for t in texts]


LATIN = st.text(st.one_of(st.sampled_from("abZ'strevmld09½²ß \u0085\x1c\xa0\x00\n!.é<|"), st.characters(max_codepoint=0xFF)), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(LATIN, SIGNS), min_size=1, max_size=12), st.sampled_from([None, 1]), st.sampled_from([5, 10**6]))
def test_ids_of_texts_together_are_the_library_s(texts, separator, most):
    end = [] if separator is None else [separator]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in bpe_encoder(VOCABULARY, separator, most)(texts)]
    assert got == [library(t) + end for t in texts]


def test_latin_texts_are_not_split_one_by_one(monkeypatch):
    def refuse(text):
        raise AssertionError("split by itself")

    texts = [f"{a}{c}{b}" for c in map(chr, range(0x100)) for a in ("x", "'", " ") for b in ("'s", "'rex", "9")] + ["", "it's l'été, he'll"]
    monkeypatch.setattr(packing, "pretokens", refuse)
    got = [np.frombuffer(ids, "<u4").tolist() for ids in bpe_encoder(VOCABULARY, 1)(texts)]
    assert got == [library(t) + [1] for t in texts]


def test_table_counts(spark):
    texts = mixed_texts()
    got = token_counts(documents(spark, texts), cache_entries=100).toPandas().set_index("doc_id")
    for i, t in enumerate(texts):
        n = len(library(t))
        assert (got.n_tokens[i], got.n_bytes[i], got.over_limit[i]) == (n, len((t or "").encode()), n > 2048)
    assert token_counts(documents(spark, [])).count() == 0


def brute_best_fit(lengths, window):
    spaces, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(spaces, length)
        space = spaces.pop(at) if at < len(spaces) else window
        opened += space == window
        if space > length:
            insort(spaces, space - length)
    return opened, spaces


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    values, counts = np.unique(np.array(lengths, int), return_counts=True)
    plan = best_fit_plan(dict(zip(values.tolist(), counts.tolist())), 16)
    used: dict[int, set[int]] = {}
    for k, n in zip(values.tolist(), counts.tolist()):
        rows = plan[plan[:, 0] == k]
        for rank in range(n):
            _, first, window, per, offset = rows[np.searchsorted(rows[:, 1], rank, "right") - 1]
            place = range(offset + (rank - first) % per * k, offset + (rank - first) % per * k + k)
            mine = used.setdefault(window + (rank - first) // per, set())
            assert not mine & set(place)
            mine |= set(place)
    opened, spaces = brute_best_fit(lengths, 16)
    assert sorted(16 - len(u) for u in used.values() if len(u) < 16) == spaces and len(used) == opened
    assert all(u == set(range(len(u))) for u in used.values())


def test_packed_documents(spark):
    texts = mixed_texts()
    got = pack_documents(documents(spark, texts), window=256, keep_ids=True).toPandas()
    for doc, part in got.groupby("doc_id"):
        part = part.sort_values("start")
        ids = np.frombuffer(b"".join(part.ids), "<u4").tolist()
        assert ids == [*library(texts[doc]), 1] and (part.doc_tokens == len(ids)).all()
        assert (part.start == part.length.cumsum() - part.length).all()
        assert all(zlib.crc32(x) == c for x, c in zip(part.ids, part.ids_crc32))
    assert set(got.doc_id) == set(range(len(texts)))
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert (part.offset == part.length.cumsum() - part.length).all() and part.length.sum() <= 256
    assert got.sequence_id.nunique() == brute_best_fit(got.length.tolist(), 256)[0]
    assert pack_documents(documents(spark, [])).count() == 0
    assert pack_documents(documents(spark, ["same"] * 50)).select("sequence_id", "offset").distinct().count() == 50


MEMORY = """
import random, re
import pyarrow as pa
from ebbwatch.llm.common import map_batches
from ebbwatch.llm.packing import VOCABULARY, bpe_encoder

class Frame:
    def mapInArrow(self, work, schema):
        return work

def work(batches):
    encode = bpe_encoder(VOCABULARY, 1)
    for b in batches:
        encode(b.column(0).to_pylist())
        yield b

def held():
    with open("/proc/self/status") as f:
        return int(re.search(r"VmRSS:\\s+(\\d+)", f.read())[1]) >> 10

rng = random.Random(1)
words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 9))) for _ in range(60_000)]
batches = lambda n: (pa.record_batch([[" ".join(rng.choices(words, k=300)) for _ in range(2_000)]], ["text"]) for _ in range(n))
task = map_batches(Frame(), work, "text string")
encode = bpe_encoder(VOCABULARY, 1)(["word"])
before = held()
assert sum(b.num_rows for b in task(batches(5))) == 10_000
print("MB", held() - before)
"""


def test_a_task_gives_back_what_packing_took():
    """20 MB of text in a task, in a process of its own as a worker is."""
    out = subprocess.run([sys.executable, "-c", MEMORY], capture_output=True, text=True, check=True, cwd=ROOT, timeout=300, env=os.environ | {"PYTHONPATH": ROOT})
    assert int(out.stdout.rpartition("MB ")[2]) < 16
