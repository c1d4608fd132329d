"""Operator 2 against a plain Python version, and its sensitivity to edits and order."""
import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import order_minhash as O
from ledgerline.llm import queries


def successors(ids):
    order = sorted(set(ids))
    return dict(zip(order, order[1:] + order[:1]))


def odd_texts():
    rng = random.Random(4)
    text = lambda n, v: " ".join(str(rng.randrange(v)) for _ in range(n))
    return ["", " \n", None, "a", "a b", "a b c", "x " * 50, "x y " * 40, "é 😀 ß " * 9] + [text(rng.randint(3, 300), rng.choice([2, 5, 5000])) for _ in range(30)]


def plain(spark, text):
    """Sketches by the definition, with Spark's hash taken value by value."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    if not words:
        return ""
    one = lambda *xs: spark.range(1).select(F.xxhash64(*(F.lit(x) for x in xs))).first()[0]
    grams = [one(*words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [one(" ".join(words), len(words))]
    seen, entries = Counter(), []
    for p, g in enumerate(grams):
        entries.append((g if not seen[g] else one(g, seen[g]), p))
        seen[g] += 1
    out = []
    for k in range(O.SKETCHES):
        point = -2**63 + k * (2**64 // O.SKETCHES)
        least = sorted(entries, key=lambda e: ((e[0] - point) % 2**64, e[1]))
        pair = sorted((least[0], least[1 % len(least)]), key=lambda e: e[1])
        out.append(one(pair[0][0], pair[1][0]) & 0xFFFF)
    return "".join(f"{x:04x}" for x in out)


def test_fingerprints_equal_the_definition(spark):
    texts = ["", "a", "a b", "a b c", "x " * 9, "p q r p q r p q r s"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "i int, text string, fingerprint string")
    got = {r.i: r.fingerprint for r in O.with_fingerprint(df).collect()}
    assert [got[i] for i in range(len(texts))] == [plain(spark, t) for t in texts]


def test_order_and_edits_matter(spark):
    rng = random.Random(1)
    words = [str(rng.randrange(10**6)) for _ in range(400)]
    blocks = [words[i:i + 20] for i in range(0, 400, 20)]
    shuffled = sum(rng.sample(blocks, len(blocks)), [])
    one_edit = words[:200] + ["new"] + words[201:]
    half = words[:200] + [str(rng.randrange(10**6)) for _ in range(200)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate((words, one_edit, half, shuffled))], "i int, text string")
    made = df.select("i", O.fingerprint(F.col("text")).alias("f"))
    near = {r.i: r.x for r in made.crossJoin(made.filter("i = 0").select(F.col("f").alias("g"))).select("i", O.likeness(F.col("f"), F.col("g")).alias("x")).collect()}
    assert near[0] == 1 and near[1] > 0.9 and 0.02 < near[2] < 0.5 and near[2] < near[1] and near[3] < 0.75


@pytest.mark.parametrize("repeat", [False, True])
def test_rows_equal_brute_force(spark, repeat):
    rows = [(i * 7, t) for i, t in enumerate(odd_texts())]
    if repeat:
        rows += [(70, rows[10][1]), (None, "last one")]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, near_next double").repartition(6)
    follow, least = successors(i if i is not None else 2**63 - 1 for i, _ in rows), {}
    for i, t in rows:
        i = i if i is not None else 2**63 - 1
        least[i] = min(least.get(i, t or ""), t or "")
    got = O.edit_sensitivity(df).collect()
    assert len(got) == len(rows)
    prints = {}
    edits = {}
    for i, t in rows:
        t, key = t or "", i if i is not None else 2**63 - 1
        half = len(t) // 2
        edits.setdefault(i, set()).add((len(t), hashlib.sha256((t[:len(t) - half] + least[follow[key]][:half]).encode()).hexdigest()))
    for r in got:
        assert (r.n_chars, r.edited_sha256) in edits[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints[r.doc_id] = r.fingerprint
    text_of = dict(rows)
    by_text = {}
    for i, f in prints.items():
        assert by_text.setdefault(text_of[i] or "", f) == f
    assert O.edit_sensitivity(df.limit(0)).count() == 0


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    follow = successors(texts)
    rows = {r.doc_id: r for r in queries.op2_order_minhash(spark, sf).collect()}
    assert set(rows) == set(texts)
    share = lambda a, b: sum(a[i:i + 4] == b[i:i + 4] for i in range(0, 256, 4)) / 64
    for i, r in rows.items():
        half = len(texts[i]) // 2
        edited = texts[i][:len(texts[i]) - half] + texts[follow[i]][:half]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == share(r.fingerprint, r.edited_fingerprint) and r.near_next == share(r.fingerprint, rows[follow[i]].fingerprint)
    mean = lambda c: sum(r[c] for r in rows.values()) / len(rows)
    assert mean("near_edited") > 3 * mean("near_next")
