import random
from collections import Counter

import numpy as np

from ebbwatch.llm.language_id import GRAMS, LEAST_COUNT, SHARE_OF_MOST, LanguageFilters, fit_filters, identify, language_id, learning_rows
from tests.llm.texts import documents, mixed_texts

PARTS = {"aa": ["ting", "the", "ou", "er"], "bb": ["schä", "lich", "ung", "ein"], "cc": ["ción", "mente", "que", "ado"]}


def text(rng, lang, words):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


def test_held_out():
    rng = random.Random(3)
    rows = [(text(rng, k, rng.randint(1, 40)), k) for _ in range(200) for k in PARTS]
    filters = fit_filters(rows[:300])
    predicted, scores = identify([t for t, _ in rows[300:]], filters)
    assert sum(p == k for p, (_, k) in zip(predicted, rows[300:])) > 0.98 * 300
    assert all(0 <= s <= 1 for s in scores) and (filters.false_positives() < 0.01).all()


def grams(texts):
    """All n-grams of the texts without two blanks in a row, read plainly."""
    for t in texts:
        letters = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in t.lower().encode())
        data = b" " + letters + b" "
        for n in GRAMS:
            yield from (data[i : i + n] for i in range(len(data) - n + 1) if b"  " not in data[i : i + n])


def test_against_exact_sets():
    rng = random.Random(4)
    rows = [(text(rng, k, rng.randint(1, 40)), k) for _ in range(60) for k in PARTS]
    counts = {k: Counter(grams(t for t, lang in rows if lang == k)) for k in PARTS}
    totals = {k: {n: sum(c for g, c in counts[k].items() if len(g) == n) for n in GRAMS} for k in PARTS}
    share = lambda k, g: counts[k][g] / totals[k][len(g)]
    own = {k: {g for g, c in counts[k].items() if c >= LEAST_COUNT and share(k, g) >= SHARE_OF_MOST * max(share(j, g) for j in PARTS)} for k in PARTS}
    texts = [text(rng, k, rng.randint(1, 30)) for _ in range(40) for k in PARTS] + ["Q9 xyz!", "the schä que"]
    predicted, scores = identify(texts, fit_filters(rows))
    for t, lang, score in zip(texts, predicted, scores):
        found = list(grams([t]))
        want = {k: sum(g in own[k] for g in found) / len(found) for k in PARTS}
        best = max(want.values())
        assert want[lang] > best - 0.02  # false positives of the filters, corrected on average
        assert abs(score - (want[lang] / sum(want.values()) if best else 0)) < 0.05


def test_many_languages_in_one_lookup():
    filters = LanguageFilters([f"l{i}" for i in range(40)])
    codes = np.arange(1000, dtype=np.uint32)
    masks = np.uint64(1) << (codes % 40).astype(np.uint64)
    filters.put(codes, 3, masks)
    assert ((filters.masks(codes, 3) & masks) == masks).all()


def test_edges(spark):
    rng = random.Random(5)
    texts = mixed_texts() + ["123 456", "日本"] + [text(rng, k, 30) for k in PARTS for _ in range(20)]
    langs = [None] * (len(texts) - 60) + [k for k in PARTS for _ in range(20)]
    docs = documents(spark, texts, langs)
    got = language_id(docs, docs).toPandas().set_index("doc_id").sort_index()
    for i, t in enumerate(texts):
        known = any(map(str.isalpha, t or ""))
        assert (got.lang_pred[i] == "und") == (not known) and 0 <= got.score[i] <= 1
    assert (got.lang_pred[-60:] == langs[-60:]).all()
    assert set(language_id(docs, docs.limit(0)).toPandas().lang_pred) == {"und"}
    assert language_id(docs.limit(0), docs).count() == 0


def test_more_languages_than_bits(spark):
    rng = random.Random(9)
    words = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(4)] for i in range(130)}
    langs = [k for k in words for _ in range(6)]
    texts = [" ".join(rng.choice(words[k]) for _ in range(30)) for k in langs]
    docs = documents(spark, texts, langs)
    got = language_id(docs, docs).toPandas().set_index("doc_id").sort_index()
    assert (got.lang_pred == langs).mean() > 0.98


def test_bytes_learnt_from_are_bounded(spark):
    rng = random.Random(2)
    texts = [text(rng, k, 20) for _ in range(30) for k in PARTS]
    for i in range(3):
        texts[i] = text(rng, list(PARTS)[i], 50_000)
    docs = documents(spark, texts, list(PARTS) * 30)
    found = learning_rows(docs, "doc_id", "text", "lang", 3000, 30_000)
    for k in PARTS:
        mine = [t for t, lang in found if lang == k]
        assert len(mine) == 30 and sum(len(t.encode()) for t in mine) <= 10_000
        assert sum(t not in texts for t in mine) == 1
