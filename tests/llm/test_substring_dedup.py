"""Operator 4 against a brute-force search for repeated windows."""
import hashlib
import random
import re

import pyarrow as pa
import pytest

from ledgerline.llm import queries, recompression as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=20):
    """(doc_id, words, removed flags) of each row; rows of one id don't count as earlier for one another."""
    split = [(i if i is not None else 2**63, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            least[k] = min(least.get(k, i), i)
    out = []
    for i, w in split:
        gone, seen = [False] * len(w), set()
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            if least[k] < i or k in seen:
                gone[p:p + width] = [True] * width
            seen.add(k)
        out.append((i, w, gone))
    return out


def corpus(letters, seed, n=40):
    rng = random.Random(seed)
    words = ["", "é"] + [f"w{i}" for i in range(letters)]
    text = lambda k: [rng.choice(words[1:]) for _ in range(k)]
    shared = [text(rng.randint(15, 60)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 30)) for _ in range(3)]
        body = parts[0] + rng.choice(shared) + parts[1] + (rng.choice(shared) if rng.random() < .5 else []) + parts[2]
        rows.append((i * 3, rng.choice([" ", "\n", " \t "]).join(body)))
    rows += [(1000 + i, rows[5][1]) for i in range(3)] + [(2000, "ha " * 70 + "x " * 25), (2001, "ha " * 45), (2002, None), (2003, ""), (2004, "x " * 19)]
    return rows


@pytest.mark.parametrize("letters", [1, 2, 4, 40, 4000])
def test_equal_windows_have_equal_anchors(letters):
    rows = corpus(letters, letters)
    words = R.Words(pa.array([t for _, t in rows], pa.string()))
    at = words.windows(20)
    anchor_of = {}
    for name, anchor in zip(words.window_names(at, 20)[0].tolist(), R.anchors(words, 20, at).tolist()):
        assert anchor_of.setdefault(name, anchor) == anchor


@pytest.mark.parametrize("letters", [1, 3, 60, 4000])
def test_operator_equals_brute_force(spark, letters):
    rows = corpus(letters, letters + 7)
    if letters == 60:
        rows += [rows[4], rows[4], (None, rows[7][1]), (12, rows[9][1])]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, kept_text string, names int").repartition(5)
    got = sorted(((r.doc_id if r.doc_id is not None else 2**63, r.n_words, r.n_removed, r.kept_text, r.names) for r in R.remove_repeats(df).collect()))
    want = sorted((i, len(w), sum(g), " ".join(x for x, y in zip(w, g) if not y), 1) for i, w, g in brute(rows))
    assert got == want


def test_spans_and_empty_table(spark):
    rows = corpus(50, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in R.remove_repeats(df).collect():
        pairs = list(zip(r.removed_spans[::2], r.removed_spans[1::2]))
        assert sum(b - a for a, b in pairs) == r.n_removed and all(a < b <= r.n_words for a, b in pairs)
    assert R.remove_repeats(df.limit(0)).count() == 0


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: (len(w), sum(g), hashlib.sha256(" ".join(x for x, y in zip(w, g) if not y).encode()).hexdigest()) for i, w, g in brute(rows)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op4_substring_dedup(spark, sf).collect()} == want


def test_rows_beside_a_copy_of_their_id_keep_their_windows(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    passage = " ".join(b.split()[10:40])
    rows = [(3, a), (5, a), (5, b), (9, f"{c} {passage}"), (None, a), (None, f"{passage} {c[::-1]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, len(r.text.split()), r.n_removed) for r in R.remove_repeats(df).collect()]
    assert sorted(got, key=str) == sorted([(3, 60, 0), (5, 60, 60), (5, 60, 0), (9, 90, 30), (None, 60, 60), (None, 90, 30)], key=str)
