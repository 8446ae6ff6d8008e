import random

import numpy as np
import pyarrow as pa

from ebbwatch.llm.toxicity import STRIDE, WINDOW, ToxicityModel, Words, learning_rows, toxicity, train
from tests.llm.texts import documents, mixed_texts, prose


def corpus(n: int, seed: int) -> tuple[list[str], list[int]]:
    """Every fourth text has a bad word, of a few, or one that only begins like them."""
    rng, texts, labels = random.Random(seed), [], []
    for i in range(n):
        words, bad = prose(rng, rng.randrange(5, 120)).split(), i % 4 == 0
        if bad:
            word = rng.choice(["moron", "scum", "trash", f"zork{rng.choice('abcdefgh')}{rng.randrange(1000)}"])
            words.insert(rng.randrange(len(words) + 1), word)
        texts.append(" ".join(words))
        labels.append(int(bad))
    return texts, labels


def test_gradient():
    model = ToxicityModel(np.unique(Words(pa.array(["bad word here"])).hashes))
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    words = Words(pa.array(["bad word here is another one " * 4, "short text"]))
    start, length, _ = words.windows()
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    target = (np.arange(len(start)) % 2).astype(float)
    grads = model.gradient(words, start, length, target, np.zeros((WINDOW, len(start)), bool))

    def loss():
        logits = model.logits(words)[0][order].astype(np.float64)
        return np.mean(np.log1p(np.exp(logits)) - target * logits)

    for name, grad in grads.items():
        flat, at = model.params[name].ravel(), int(np.abs(grad).argmax())
        kept = flat[at]
        flat[at] = kept + 0.01
        up = loss()
        flat[at] = kept - 0.01
        down = loss()
        flat[at] = kept
        assert abs((up - down) / 0.02 - grad.ravel()[at]) < 1e-3, name


def test_windows_cover_every_word():
    words = Words(pa.array([None, "", "a", prose(random.Random(1), 100), "y" * 1000]))
    start, length, text = words.windows()
    seen = {i for s, n in zip(start, length) for i in range(s, s + n)}
    assert seen == set(range(len(words.hashes))) and set(text) == set(range(5))
    assert max(np.diff(start[text == 3])) <= STRIDE and (length[text == 0] == 0).all()
    assert len(words.hashes) == 1 + 100 + 42  # a very long word is several


def test_held_out():
    model = train(*corpus(1200, 1))
    texts, labels = corpus(400, 2)
    predicted = model.scores(pa.array(texts)) >= 0.5
    labels = np.array(labels, bool)
    assert (predicted & labels).sum() / labels.sum() > 0.8 and (predicted & ~labels).sum() < 0.05 * (~labels).sum()


def test_edges(spark):
    texts = mixed_texts()
    docs = documents(spark, texts + texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity(docs, labels).toPandas()
    assert len(got) == 2 * len(texts) and got.score.between(0, 1).all()
    by_id = got.set_index("doc_id").score
    assert all(abs(by_id[i] - by_id[i + len(texts)]) < 1e-5 for i in range(len(texts)))
    assert toxicity(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert toxicity(docs.limit(0), labels).count() == 0


def learnt(spark, texts, labels, most, most_bytes):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "doc_id long, toxic int")
    return learning_rows(documents(spark, texts), rows, "doc_id", "text", "toxic", most, most_bytes)


def test_rare_toxic_rows_are_learnt_from(spark):
    texts = [f"{'ä' * 100} {i}" for i in range(4000)]
    found, toxic = learnt(spark, texts, [int(i % 100 == 0) for i in range(4000)], 400, 40_000)
    assert sum(toxic) == 40 and toxic.count(0) > 100 and sum(len(t.encode()) for t in found) <= 40_000
    found, toxic = learnt(spark, texts, [int(i % 20 == 0) for i in range(4000)], 400, 40_000)  # 200 toxic ones, 40 kB
    assert 90 < sum(toxic) < 100 and 90 < toxic.count(0) < 100


def test_one_huge_text_does_not_end_the_sample(spark):
    rng = random.Random(7)
    texts, labels = [f"{i} {prose(rng, 10)}" for i in range(40)], [i % 2 for i in range(40)]
    found, _ = learnt(spark, texts, labels, 40, 64_000)
    for label in (1, 0):  # the first of its kind is huge
        first = int(next(t for t in found if int(t.split()[0]) % 2 == label).split()[0])
        huge = [prose(rng, 100_000) if i == first else t for i, t in enumerate(texts)]
        some, toxic = learnt(spark, huge, labels, 40, 64_000)
        pieces = [t for t in some if t not in texts]
        assert sum(toxic) == 20 and len(some) == 40 and len(pieces) == 1
        assert 500 < len(pieces[0]) <= 1000 and set(pieces[0].split()) <= set(huge[first].split())
