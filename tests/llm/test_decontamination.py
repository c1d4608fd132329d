"""Operator 9 against a brute-force search."""
import hashlib
import random
import re

import pyarrow as pa
import pytest

from ledgerline.llm import queries, suffix_decontamination as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items, window=10):
    doc = words(text)
    hit, found = [0] * len(doc), set()
    where = {}
    for size in range(1, window + 1):
        for p in range(len(doc) - size + 1):
            where.setdefault(tuple(doc[p:p + size]), []).append(p)
    for name, item in items:
        item = words(item)
        size = min(window, len(item))
        for j in range(len(item) - size + 1 if size else 0):
            for p in where.get(tuple(item[j:j + size]), ()):
                found.add(name)
                hit[p:p + size] = [1] * size
    return len(doc), sum(hit), sorted(found)


@pytest.mark.parametrize("letters", [1, 2, 4, 6])
def test_shards_equal_brute_force_in_one_block_and_in_two(letters):
    rng = random.Random(letters)
    text = lambda n: " ".join(rng.choice(["ab", "Cd", "é", "x1", "zz", "q"][:letters]) for _ in range(n))
    for _ in range(12):
        items = [(str(i), rng.choice([None, "", "..!", text(rng.randint(1, 30))])) for i in range(6)]
        items += [(str(i), text(rng.randint(3, 40))) for i in range(6, 12)]
        docs = [rng.choice([None, "", text(rng.randint(0, 80))]) for _ in range(14)] + [text(5) + "; " + (items[7][1] or "")]
        batch = pa.RecordBatch.from_arrays([pa.array(docs, pa.string())], ["text"])
        block = lambda part: S.block_of([i for i, _ in part], [x for _, x in part], 10)
        one = S._mark(batch, block(items), 10, "text", ["text"], False).to_pylist()
        half = S._mark(batch, block(items[:5]), 10, "text", ["text"], False)
        two = S._mark(half, block(items[5:]), 10, "text", ["text"], True).to_pylist()
        for doc, a, b in zip(docs, one, two):
            assert (a["n_words"], a["n_hit"], a["items"]) == brute(doc, items) == (b["n_words"], b["n_hit"], b["items"])
            assert a["hit_spans"] == b["hit_spans"]
            assert sum(t - s for s, t in zip(a["hit_spans"][::2], a["hit_spans"][1::2])) == a["n_hit"]


def test_blocks_nulls_clashes_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BYTES", 40)
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (2, "a b c", 5), (3, "x a B c d", 5), (3, "x a B c d", 5), (4, "w " * 3000, 5)],
                                 "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame([(1, "a b c"), (2, "lorem ipsum dolor sit amet consectetur elit sed do eiusmod tempor"), (None, "B C"), (4, None)],
                                  "item_id long, text string")
    rows = S.find_matches(docs, bench).orderBy("doc_id", "n_words").collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.items) for r in rows] == [
        (1, 0, 0, []), (2, 0, 0, []), (2, 3, 3, ["", "1"]), (3, 5, 3, ["", "1"]), (3, 5, 3, ["", "1"]), (4, 3000, 0, [])]
    clean = S.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 3
    assert S.find_matches(docs.limit(0), bench).count() == 0
    assert S.decontaminate(docs, bench.limit(0)).count() == docs.count()


def test_query_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op9_benchmark_decontamination(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
