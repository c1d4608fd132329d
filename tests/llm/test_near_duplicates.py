"""Operator 10 against brute force over all pairs."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import prob_minhash as M


def bag(text, k=5):
    w = (text or "").split()
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def slow(a, b):
    return sum(1 / sum(max(a.get(x, 0) / a[d], b.get(x, 0) / b[d]) for x in set(a) | set(b)) for d in set(a) & set(b))


def classes(rows, least=0.8):
    """Least id by id, linking equal texts and pairs of at least the given probability Jaccard."""
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [(i, t or "", bag(t)) for i, t in rows]
    for x, (i, t, a) in enumerate(bags):
        for j, u, b in bags[x + 1:]:
            if t == u or (a.keys() & b.keys() and slow(a, b) >= least):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: root(i) for i in parent}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, i = [], 0
    for _ in range(6):  # families: near copies of near copies, at many distances
        base = text(rng.randint(30, 200))
        for _ in range(rng.randint(2, 14)):
            body = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                body[rng.randrange(len(body))] = rng.choice(vocabulary)
            rows.append((i := i + 1, " ".join(body)))
            base = body if rng.random() < .3 else base
    rows += [((i := i + 1), " ".join(text(rng.randint(1, 90)))) for _ in range(40)]
    rows += [((i := i + 1), t) for t in ("", None, "", "a b", "a b", "a  b", "x " * 200, "x " * 230, "x " * 90 + "y " * 90)]
    rng.shuffle(rows)
    return rows


def test_exact_probability_jaccard():
    rng = random.Random(0)
    for _ in range(200):
        a, b = (Counter(rng.choices(range(12), k=rng.randint(1, 30))) for _ in "ab")
        arrays = lambda c: (np.array(sorted(c), np.uint64), np.array([c[x] for x in sorted(c)], float))
        assert M.probability_jaccard(*arrays(a), *arrays(b)) == pytest.approx(slow(a, b))


def test_registers_estimate_it():
    rng = random.Random(1)
    gaps = []
    for n in (4, 30, 300, 2000):
        for _ in range(12):
            a = [str(rng.randrange(n)) for _ in range(n)]
            b = a[:int(n * .8)] + [str(rng.randrange(n)) for _ in range(n - int(n * .8))]
            t, e, w = M.elements(pa.array([" ".join(a), " ".join(b)]), 1)
            kept = M.signatures(t, e, w, 2)
            gaps.append((kept[0] == kept[1]).mean() - M.probability_jaccard(e[t == 0], w[t == 0], e[t == 1], w[t == 1]))
    assert abs(np.mean(gaps)) < .02 and np.std(gaps) < .06


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, class_id string, n int").repartition(4)
    want = classes(rows)
    found = M.near_duplicates(df).collect()
    assert {r.doc_id: r.class_id for r in found} == want and len(found) == len(rows)
    assert all((r.n_links > 0) <= (list(want.values()).count(r.class_id) > 1) for r in found)
    kept = M.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_nulls_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (1, None), (2, "")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.class_id, r.n_links) for r in M.near_duplicates(df).collect()), key=str)
    assert got == [(0, None, 0), (1, 1, 0), (2, 1, 0), (3, 3, 0), (3, 3, 0)]
    assert M.keep_one(df).count() == 4
    assert M.near_duplicates(df.limit(0)).count() == 0 == M.keep_one(df.limit(0)).count()


def bands_of(texts):
    return np.array(M._sign(pa.record_batch({"id": range(len(texts)), "text": texts}), 5).column("bands").to_pylist())


def crowded_pair(seed=0):
    """Two texts of similarity 0.8 that share one band only, and over 100 texts of less that share it too."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    while True:
        base = fresh(67)

        def changed(n, times):  # ``n`` new words at the ends
            heads = [rng.randint(0, n) for _ in range(times)]
            return [" ".join(fresh(k) + base[k:k + 67 - n] + fresh(n - k)) for k in heads]

        near = changed(7, 2000)
        own, *bands = bands_of([" ".join(base), *near])
        shared = np.array(bands) == own
        for i in np.flatnonzero(shared.sum(axis=1) == 1):
            texts = changed(11, 2500)
            crowd = [t for t, b in zip(texts, bands_of(texts)) if (b == own)[shared[i]][0]]
            if len(crowd) > 100:
                return " ".join(base), near[i], crowd[:150]


def test_links_of_one_crowded_band_are_found(spark):
    a, b, crowd = crowded_pair()
    rows = list(enumerate([*crowd, a, b]))
    bags = [set(bag(t)) for _, t in rows]  # no text repeats a shingle
    links = [(i, j) for j in range(len(rows)) for i in range(j) if len(bags[i] & bags[j]) / len(bags[i] | bags[j]) >= .8]
    n = len(crowd)
    assert n > 100 and links == [(n, n + 1)]
    random.Random(1).shuffle(rows)
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in found} == {i: min(i, n) for i, _ in rows}


def test_alike_texts_share_a_rare_shingle():
    rng = random.Random(3)
    texts = [t or "" for _, t in corpus(4)]
    frequency = np.full(M.SLOTS, 2, np.uint16)
    frequency[rng.sample(range(M.SLOTS), M.SLOTS // 2)] = 9
    who, name, before, rest = M.rare_shingles(pa.array(texts), 5, .8, frequency)
    rare = [set(name[who == i].tolist()) for i in range(len(texts))]
    room = {(w, n): (b, r) for w, n, b, r in zip(who.tolist(), name.tolist(), before.tolist(), rest.tolist())}

    def possible(i, j, shingle):  # as the operator's condition on a bucket's rows
        (bi, ri), (bj, rj) = room[i, shingle], room[j, shingle]
        if ri > 0 and rj > 0:
            return min(ri, rj) >= .8 * (1 - 1e-9) * (bi + bj + max(ri, rj))
        return 1 + bi / abs(ri) + bj / abs(rj) <= 1.25 + 1e-9

    met = 0
    assert sum(map(len, rare)) < .4 * sum(len(bag(t)) for t in texts)
    for i, t in enumerate(texts):
        for j in range(i):
            a, b = bag(t), bag(texts[j])
            if a.keys() & b.keys() and slow(a, b) >= .8:
                met += 1
                assert any(possible(i, j, x) for x in rare[i] & rare[j])
    assert met > 10
