import os
import random
import re
import subprocess
import sys
import time

from ebbwatch.llm.decontamination import Matcher, contamination
from tests.llm.texts import documents, mixed_texts, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    mine, hit, found = words(text), set(), set()
    for item, its in items:
        its = words(its)
        n = min(10, len(its))
        windows = {tuple(its[i : i + n]) for i in range(len(its) - n + 1)} if its else set()
        for i in range(len(mine) - n + 1):
            if n and tuple(mine[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(mine), len(hit), sorted(found)


def test_against_brute_force(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(1, 30), 10**6)) for i in range(20)] + [(20, None), (21, "..."), (22, "w1 w2"), (23, "W1, w2")]
    texts = mixed_texts()
    for i, (_, t) in enumerate(items[:20]):
        texts.append(f"{prose(rng, 20)} {t.upper().replace(' ', ', ')}! {prose(rng, 5)} {t}")
        texts.append(" ".join(t.split()[: 3 * i]))
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS spans")
    docs = documents(spark, texts)
    for block in (1 << 20, 200):  # one automaton, and several
        got = {r.doc_id: r for r in contamination(docs, benchmark, block_bytes=block).collect()}
        for i, t in enumerate(texts):
            n_words, n_hit, found = brute(t, items)
            runs = [range(r["first"], r["last"]) for r in got[i].word_runs]
            assert (got[i].n_words, sum(map(len, runs)), sorted(got[i]["items"])) == (n_words, n_hit, found)
            parts = [w for s in got[i].spans for w in words(t[s["first"] : s["last"]])]
            assert parts == [words(t)[k] for r in runs for k in r]  # offsets are those of the original


def test_edges(spark):
    docs = documents(spark, mixed_texts())
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, nothing).where("n_items > 0").count() == 0
    assert contamination(docs.limit(0), nothing).count() == 0


def test_matcher_against_windows():
    """Periodic and overlapping texts, items in several places, and windows of all sizes."""
    rng = random.Random(11)
    for window in (1, 2, 3, 4, 5, 10):
        for letters in ("ab", "abc", "abcdefgh"):
            items = [(i, " ".join(rng.choices(letters, k=rng.randrange(1, 25)))) for i in range(5)]
            items += [(5, items[0][1]), (6, None), (7, "?"), (None, "a b")]
            machine = Matcher(items, window)
            for _ in range(30):
                mine = rng.choices([*letters, "z"], k=rng.randrange(40))
                if rng.random() < 0.6:
                    mine[5:5] = items[rng.randrange(5)][1].split()
                hit, found = set(), set()
                for item, its in items:
                    its = words(its)
                    n = min(window, len(its))
                    windows = {tuple(its[i : i + n]) for i in range(len(its) - n + 1)} if its else set()
                    for i in range(len(mine) - n + 1):
                        if n and tuple(mine[i : i + n]) in windows:
                            hit.update(range(i, i + n))
                            found.add(item)
                runs, having = machine.word_hits(mine)
                assert ({i for x, y in runs for i in range(x, y)}, having) == (hit, found)


def test_repetitive_texts_take_linear_time():
    machine = Matcher([(0, "a " * 2_000), (1, "a b " * 1_000), (2, "b " * 9)])
    began = time.perf_counter()
    runs, items = machine.word_hits(["a"] * 40_000 + ["b"] * 10)
    assert runs == [(0, 40_010)] and items == {0, 2}
    assert machine.word_hits(["a", "b"] * 20_000)[0] == [(0, 40_000)]
    assert time.perf_counter() - began < 20


def test_large_block_fits_a_worker():
    """A full block of the registered size, in a process of its own."""
    code = (
        "import random, resource\n"
        "from ebbwatch.llm.decontamination import BLOCK_BYTES, Matcher\n"
        "rng = random.Random(1)\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "items = [(i, ' '.join(f'word{rng.randrange(300_000)}' for _ in range(100))) for i in range(BLOCK_BYTES // 1_060)]\n"
        "assert sum(len(t) for _, t in items) > 0.95 * BLOCK_BYTES\n"
        "machine = Matcher(items)\n"
        "assert machine.word_hits(items[7][1].split()) == ([(0, 100)], {7})\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=ROOT, timeout=300)
    assert int(out.stdout) < 500
