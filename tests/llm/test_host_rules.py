"""Operator 13 against plain Python: measures, failures, the prior, verdicts."""
import random
import re

from ledgerline.llm import host_rules as R

SCHEMA = "doc_id long, text string, source string, kept string, n_words int, m string"


def plain_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return dict(n_words=len(words), word_chars=sum(map(len, words)), n_symbols=sum(c in R.SYMBOLS for c in text),
                n_lines=len(lines), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(covered))


def plain_fails(m):
    n = m["n_words"]
    return {"few_words": n < 50, "repeated_words": 100 * m["n_repeat_words"] > 50 * n, "symbols": 10 * m["n_symbols"] > n,
            "copied_lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"], "word_length": m["word_chars"] < 3 * n or m["word_chars"] > 10 * n}


def plain_verdicts(rows):
    """{host: its failed rules} by the moments of all hosts' rates."""
    hosts = {}
    for _, text, host in rows:
        if host is not None:
            hosts.setdefault(host, []).append(plain_fails(plain_measures(text)))
    bad = {h: [] for h in hosts}
    for rule in R.RULES:
        rates = {h: (sum(f[rule] for f in fs), len(fs)) for h, fs in hosts.items()}
        k = len(rates)
        mean = sum(f / n for f, n in rates.values()) / k if k else 0
        weight = R.MOST_WEIGHT
        if k > 1 and 0 < mean < 1:
            spread = sum((f / n - mean) ** 2 for f, n in rates.values()) / k
            noise, share = (k - 1) / k * sum(1 / n for _, n in rates.values()) / k, (k - 1) / k
            rho = (spread / (mean * (1 - mean)) - noise) / (share - noise) if share > noise else 0
            if rho > 0:
                weight = min(max(1 / rho - 1, R.LEAST_WEIGHT), R.MOST_WEIGHT)
        for h, (f, n) in rates.items():
            if round((f + mean * weight) / (n + weight), 9) >= R.HOST_LIMIT:
                bad[h].append(rule)
    return bad


def corpus():
    rng = random.Random(8)
    prose = lambda n: "\n".join(" ".join(f"w{rng.randrange(5000):04d}" for _ in range(12)) for _ in range(n // 12 + 1))
    junk = lambda: " | ".join(f"w{rng.randrange(5000)}" for _ in range(80))
    rows = [(i, prose(rng.randint(40, 200)), f"host{i % 7}") for i in range(210)]
    rows += [(i, prose(120) if i % 10 == 0 else junk(), "junk.example") for i in range(300, 400)]  # a bad host with some clean pages
    rows += [(i, junk(), "small.example") for i in range(400, 402)]  # two bad pages
    rows += [(i, prose(100), "large.example") for i in range(500, 700)]
    rows += [(800, None, "host1"), (801, "", "host2"), (802, " \t\n", None), (803, prose(90), None), (None, prose(90), "host3"), (1, prose(90), "host3"), (1, prose(90), "host3"),
             (804, "same line\n" * 60, "host4"), (805, "a b c " * 40, "host5"), (806, "é 😀 ß\x0b\x0c\r" * 30, "host6"), (807, "x" * 3000, "host0"), (808, "# $ % & | < > * " * 20, None)]
    return rows


def test_equals_plain_python(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, h, "old", 5, "m") for i, t, h in rows], SCHEMA).repartition(5)
    got = {(str(r.doc_id), r.n_words, r.word_chars, r.host): r for r in R.judge(df).collect()}
    bad = plain_verdicts(rows)
    assert "symbols" in bad["junk.example"] and not bad["small.example"] and not bad["large.example"]
    assert R.judge(df).count() == len(rows)
    for i, text, host in rows:
        m = plain_measures(text)
        r = got[str(i), m["n_words"], m["word_chars"], host]
        fails = plain_fails(m)
        assert {k: r[k] for k in m} == m
        assert r.failed == [k for k, v in fails.items() if v]
        assert r.base_failed == (fails["few_words"] or fails["repeated_words"])
        assert r.host_failed == bad.get(host, [])
        assert r.kept == (not r.base_failed and not bad.get(host))


def test_repeats_in_long_texts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 9, 60, 700)]
    texts += ["a " * 3, "a " * 4, "a b " * 5, " ".join(map(str, range(100_000))) + " 5 6 7", "q " * 200_000]
    df = spark.createDataFrame([(i, t, "h", "", 0, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.n_repeat_words for r in R.measured(df).collect()}
    assert [got[i] for i in range(len(texts))] == [plain_measures(t)["n_repeat_words"] for t in texts]


def test_empty_table_and_no_hosts(spark):
    assert R.judge(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = spark.createDataFrame([(1, "a b", None, "", 0, ""), (2, " ".join(f"word{i}" for i in range(60)), None, "", 0, "")], SCHEMA)
    assert {r.doc_id: r.kept for r in R.judge(alone).collect()} == {1: False, 2: True}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b c", "h", "", 0, "")], SCHEMA)
    plan = R.measured(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_texts_are_read_in_small_column_batches(spark, tmp_path):
    """A reader's batch of texts is one array; of 4,096 rows it takes tens of MB in a piece."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        spark.createDataFrame([(i, "some words " * 40, f"host{i % 3}") for i in range(600)], "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/d")
        docs = spark.read.parquet(f"{tmp_path}/d")
        assert R.judge(docs).count() == 600
        batches = docs.select("text")._jdf.queryExecution().executedPlan().collectLeaves().head().executeColumnar().count()
        assert batches >= 600 / 256
    finally:
        spark.conf.set(key, before)
