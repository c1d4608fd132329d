"""The pipeline against brute force, stage by stage, and over odd documents."""
import hashlib
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerline.llm import kernel_toxicity, queries
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_near_duplicates import classes
from tests.llm.test_substring_dedup import brute as repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from ledgerline.llm.common import written
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        made = written(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, made))
        docs = made
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay_those_of_documents(spark, stages):
    want = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [made.columns for _, made in stages[:-1]] == [want] * 4


def test_toxicity_drops_what_the_query_predicts(spark, stages):
    predicted = {r.doc_id for r in queries.op8_kernel_toxicity(spark, SF).collect() if r.predicted}
    given, kept = map(rows, stages[0])
    assert set(kept) == set(given) - predicted and all(kept[i] == given[i] for i in kept)


def test_near_dedup_keeps_the_least_id_of_each_class(stages):
    given, kept = map(rows, stages[1])
    assert set(kept) == set(classes([(i, r.text) for i, r in given.items()]).values()) and all(kept[i] == given[i] for i in kept)


def test_substring_dedup_removes_the_words_of_repeats(stages):
    given, kept = map(rows, stages[2])
    assert set(given) == set(kept)
    for i, words, gone in repeats([(i, r.text) for i, r in given.items()]):
        want = " ".join(w for w, g in zip(words, gone) if not g) if any(gone) else given[i].text
        assert (kept[i].text, kept[i].n_chars) == (want, len(want))


def test_decontamination_drops_documents_with_benchmark_windows(spark, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given, kept = map(rows, stages[3])
    assert set(kept) == {i for i, r in given.items() if not leaks(r.text, items)[1]} and all(kept[i] == given[i] for i in kept)


def test_tokens_decode_to_the_text(stages):
    given, made = map(rows, stages[4])
    assert set(given) == set(made)
    for i, r in made.items():
        assert r.decoded_sha256 == hashlib.sha256(given[i].text.encode()).hexdigest()
        assert len(r.ids) == 4 * r.n_tokens and r.ids_sha256 == hashlib.sha256(bytes(r.ids)).hexdigest()


def test_run_equals_its_stages(spark, stages):
    assert {(r.doc_id, r.ids_sha256) for r in P.run(spark, SF).collect()} == {(r.doc_id, r.ids_sha256) for r in stages[-1][1].collect()}


def test_odd_documents_pass_through(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    odd = [(900001, None, None, None, None, "x"), (900002, "", "en", "s", 0, "x"), (900003, "word " * 20, None, "s", 100, None), (None, "no id here", "en", "s", 10, "y"),
           (900004, "z " * 50000, "en", "s", 100000, "x"), (900005, "only once", "en", "s", 9, "x"), (900005, "only once", "en", "s", 9, "x")]
    docs = spark.createDataFrame(odd, schema)
    known = spark.read.parquet(f"{SF}/documents.parquet")
    machine = queries.toxicity_machine(spark, known, SF)
    kept = kernel_toxicity.score(docs, machine, out="toxicity_score").filter(F.col("toxicity_score") < 0.7)
    assert kept.count() == len(odd)
    for _, stage in P.STAGES[1:]:
        docs = stage(spark, docs, SF)
    out = sorted(((r.doc_id or 0, r.n_tokens) for r in docs.collect()))
    assert [i for i, _ in out] == [0, 900001, 900003, 900004, 900005, 900005]  # the empty text is a copy of the null one
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, known.limit(0), SF).count() == 0


def test_the_rest_of_the_library_does_not_import_the_subpackage():
    assert "corpus_pipeline" in sys.modules
    import pathlib
    root = pathlib.Path(P.__file__).parent
    for path in [*root.glob("ledgerline/**/*.py"), *root.glob("tools/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert "ledgerline.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()
