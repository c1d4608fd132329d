"""Operators 7 and 8: held-out accuracy, planted texts, folds and odd inputs."""
import itertools
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import kernel_toxicity as K
from ledgerline.llm import pu_quality as Q
from ledgerline.llm import queries

SF = "/root/testdata/sf0.01"


def held_out(spark, query, label, folds, rest):
    rows = {r.doc_id: r for r in query(spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == rest) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    test = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    return Counter(test)


def test_quality_query_finds_held_out_labels(spark):
    c = held_out(spark, queries.op7_pu_quality, "quality", 4, 2)
    assert (c[1, 1] + c[0, 0]) / sum(c.values()) > 0.95


def test_toxicity_query_finds_held_out_labels(spark):
    c = held_out(spark, queries.op8_kernel_toxicity, "toxic", 3, 1)
    assert (c[1, 1] + c[0, 0]) / sum(c.values()) > 0.93 and c[1, 0] <= 0.02 * (c[1, 0] + c[0, 0])


def test_prior_and_risk_on_planted_mixture():
    rng = np.random.default_rng(0)
    good = lambda n: [" ".join("abcdefghij"[k] * 3 for k in rng.integers(0, 10, 40)) for _ in range(n)]
    bad = lambda n: [" ".join(["SPAM!!"] * 40) for _ in range(n)]
    scorer = Q.fit(pa.array(good(400)), pa.array(good(300) + bad(300)))
    assert 0.4 < scorer.prior < 0.7
    assert (scorer.score(pa.array(good(50))) > 0.7).all() and (scorer.score(pa.array(bad(5))) < 0.3).all()


def slow_kernel(s, t):
    def weights(word):
        word, out = [K.BEGIN, *word, K.END], Counter()
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if j - i <= K.GAP and k - j <= K.GAP:
                out[word[i], word[j], word[k]] += K.DECAY ** (k - i + 1)
        return out
    a, b = weights(s), weights(t)
    dot = lambda x, y: sum(v * y[u] for u, v in x.items())
    return (dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))) ** K.POWER


def test_kernel_equals_the_sum_over_subsequences():
    s = K.split(pa.array(["banana ananas", "x ab idiot idxiot éàé", None, ""]))
    mine = K.Landmarks.of(s.letters, s.start, s.length).kernel(s.letters, s.start, s.length)
    words = [s.letters[a:a + n].tolist() for a, n in zip(s.start, s.length)]
    assert mine == pytest.approx(np.array([[slow_kernel(a, b) for b in words] for a in words]), abs=1e-5)


def test_words_join_single_letters_and_skip_signs():
    s = K.split(pa.array(["an i d i o t. a b", "i-d.i o t", "i d", "q"]))
    words = [(int(t), "".join(chr(c + 96) for c in s.letters[a:a + n])) for t, a, n in zip(s.text, s.start, s.length)]
    assert words == [(0, "an"), (0, "idiotab"), (1, "idi"), (1, "o"), (1, "t"), (2, "i"), (2, "d"), (3, "q")]


def test_gapped_and_inserted_characters_are_caught():
    toxic = [f"the {a} man is {b} here" for a in ("idiot", "moron") for b in "trees green open calm".split()]
    clean = [f"the {a} man is {b} here" for a in ("good", "tall", "iron") for b in "trees green open calm".split()]
    machine = K.fit(pa.array(toxic), pa.array(clean))
    scores = machine.score(pa.array(["such an idiot", "i.d.i.o.t", "an i d i o t here", "a tall man", "", None]))
    assert (scores[:3] > 0.5).all() and (scores[3:] < 0.5).all()
    value = machine.decide(pa.array(["idxiot!", "mor-xon", "good", "tall", "iron"]))
    assert value[:2].min() > value[2:].max()


def test_scores_mean_the_same_below_and_above_the_caps(spark):
    rng = np.random.default_rng(5)
    word = lambda: rng.choice("green open calm trees river stone table light".split())
    texts = [f"{word()} {'zyxwvut' if i % 4 == 0 else 'klmnopq'} {word()}" for i in range(4800)]
    toxic = [int(i % 4 == 0 and i % 20 < 8) for i in range(4800)]  # two in five of the texts with the first word
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    probe, true = pa.array(texts[::4]), np.mean(toxic)
    below, *above = [K.train(df, labels, sample=s) for s in ((5000, 5000), (400, 300), (200, 2500))]
    for machine in (below, *above):
        assert machine.score(pa.array(texts)).mean() == pytest.approx(true, abs=.025)
        assert machine.score(probe).mean() == pytest.approx(.4, abs=.1)
        z = machine.decide(pa.array(texts))
        assert np.mean(machine.decide(probe) > np.median(z)) > .95  # recall


def test_odd_inputs(spark):
    df = spark.createDataFrame([(1, None, "s"), (2, "", "s"), (3, "w " * 60000, "s")], "doc_id long, text string, score string")
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    quality = Q.score(df, Q.train(df, empty)).collect()
    assert [r.score for r in quality] == [0.5] * 3
    toxic = K.score(df, K.train(df, empty)).collect()
    assert [r.score for r in toxic] == [0.0] * 3
    one = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (3, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in K.score(df, K.train(df, one)).collect())
    assert all(0 <= r.score <= 1 for r in Q.score(df, Q.train(df, one.filter("quality = 1"))).collect())
    assert K.score(df.limit(0), K.train(df, one)).count() == 0 == Q.score(df.limit(0), Q.train(df, one)).count()


def test_the_toxicity_fit_reads_few_rows_a_batch(spark, monkeypatch):
    """A batch of the fit's vectors is many times as large as its texts; the session's own setting comes back."""
    from ledgerline.llm import kernel_toxicity as K
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    real = K.fit_sample
    monkeypatch.setattr(K, "fit_sample", lambda *a: (seen.append(int(spark.conf.get(key))), real(*a))[1])
    docs = spark.createDataFrame([(i, "you horrid rotten person" if i % 2 else "a quiet walk by the river") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    K.train(docs, labels)
    assert seen and seen[0] <= 128 < int(spark.conf.get(key))


def test_texts_are_scored_in_small_pieces(monkeypatch):
    """A piece's arrays are many times its size, so a slice of 2 MB is not split at once; scores do not depend on the pieces."""
    toxic, clean = [f"you horrid person {i}" for i in range(9)], [f"a quiet walk {i}" for i in range(9)]
    machine = K.fit(pa.array(toxic), pa.array(clean))
    column, seen, real = pa.array([*toxic, None, "", *["a quiet horrid river. " * 2000] * 40]), [], K.split
    alone = [machine.decide(column.slice(i, 1))[0] for i in range(len(column))]
    monkeypatch.setattr(K, "split", lambda part: (seen.append(part.nbytes), real(part))[1])
    assert machine.decide(column) == pytest.approx(alone, abs=1e-9)
    assert max(seen) < 400_000 < column.nbytes
    assert len(machine.decide(column.slice(0, 0))) == 0


def test_the_toxicity_fit_reads_few_rows_at_a_time(spark, monkeypatch):
    key, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    real = K.fit_sample
    monkeypatch.setattr(K, "fit_sample", lambda *a: (seen.append(int(spark.conf.get(key))), real(*a))[1])
    docs = spark.createDataFrame([(i, "you horrid rotten person" if i % 2 else "a quiet walk by the river") for i in range(40)], "doc_id long, text string")
    K.train(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    assert seen and seen[0] <= 16 < int(spark.conf.get(key)) <= 256


def test_a_newton_step_sends_one_matrix_a_task(spark):
    rows = spark.range(2000).selectExpr("cast(id % 2 as int) as kind", "cast(repeat('x', 10000) as binary) as data").repartition(3)
    sample = K.SpreadSample(rows)
    size = lambda kind, data: np.array([len(kind), kind.sum()])
    assert sample.total(size).tolist() == [2000, 1000]
    assert len(sample.gather(size)) > 3  # blocks
    assert len(sample._found(lambda blocks: [sum(size(*b) for b in blocks)])) <= sample.rows.rdd.getNumPartitions()
    assert K.SpreadSample(rows.limit(0)).total(lambda kind, data: len(kind)) == 0
