import random
import re

from ebbwatch.llm.license_scan import license_blocks, license_templates, op11_license_scan, template
from ebbwatch.llm.license_templates import NOTICES, PHRASES
from tests.llm.texts import documents, mixed_texts, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates):
    """All places of phrases, and all blocks by counting the shared words of each."""
    mine, places, blocks = words(text), [], []
    for t in templates:
        its = [w.decode() for w in t.words]
        if t.consecutive:
            places += [(t.label, i, i + len(its), 1.0) for i in range(len(mine)) if mine[i : i + len(its)] == its]
            continue
        for first in range(0, len(mine), t.step):
            part = mine[first : first + 2 * t.step]
            shared = len(set(part) & set(its))
            if shared >= t.needed:
                blocks.append((t.label, first, first + len(part), shared / len(set(its))))
    return len(mine), sorted(places), sorted(blocks)


def license_texts():
    rng = random.Random(3)
    texts = mixed_texts()
    for notice in [*NOTICES, *PHRASES]:
        its = notice.split()
        for lost in range(3):  # whole, and without some words
            some = [w for i, w in enumerate(its) if i not in rng.sample(range(len(its)), min(lost, len(its) - 1))]
            texts.append(f"{prose(rng, rng.randrange(40))}\n{' '.join(some).upper()}. {prose(rng, rng.randrange(40))}")
        rng.shuffle(its)
        texts.append(" ".join(its))
    texts += [
        "Under the MIT license, under the mit\nlicense under the MIT-License", "under themit license", "é cc by nc é", "cc by-ncé",
        "the mit license under " * 300, "cc by nc " * 4_000, f"{prose(rng, 20_000)} released under the MIT license.",
        "permission hereby " * 50, "under the license mit",
    ]
    return texts


def test_against_brute_force(spark):
    texts, templates = license_texts(), [*license_templates(), template("longerthansixteenbytes twelve", "long", 0.5)]
    texts += ["longerthansixteenbytes", "longerthansixteenbytez", "longerXhansixteenbytes", "twelve"]
    got = {r.doc_id: r for r in license_blocks(documents(spark, texts), templates).collect()}
    assert len(got) == len(texts)
    found = 0
    for i, text in enumerate(texts):
        r, raw = got[i], (text or "").encode()
        row = [sorted((s["label"], s["first_word"], s["last_word"], s["containment"]) for s in x) for x in (r.places, r.blocks)]
        assert (r.n_words, *row) == brute(text, templates)
        for s in [*r.places, *r.blocks]:  # bytes are those of the original
            assert words(raw[s["first_byte"] : s["last_byte"]].decode()) == words(text)[s["first_word"] : s["last_word"]]
        found += len(r.blocks)
    assert found > 50


def test_query(spark, tmp_path):
    texts = ["Released under the MIT license. Again: under the MIT license", None, "nothing here", next(iter(NOTICES))]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op11_license_scan(spark, str(tmp_path)).collect()}
    assert rows[0][1:] == (10, 2, 1, 6, "mit", "mit", 1.0)
    assert rows[1][1:] == (0, 0, None, None, "", "", 0.0)
    assert rows[2][1:] == (2, 0, None, None, "", "", 0.0)
    assert rows[3][1:] == (20, 0, None, None, "", "mit", 1.0)


def test_edges(spark):
    docs = documents(spark, ["under the mit license", None])
    assert license_blocks(docs.limit(0)).count() == 0
    twice = license_blocks(docs.union(docs), keep=("lang",)).collect()
    assert sorted((r.doc_id, len(r.places), r.lang) for r in twice) == [(0, 1, "en"), (0, 1, "en"), (1, 0, "en"), (1, 0, "en")]
