from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from shoplayers.llm import exact_dedup, mixing, packing, quality_classifier, simhash
from test_exact_dedup import normal
from test_packing import check
from test_simhash import expected as near_expected

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after every stage."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        found.append(docs.collect())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
    return found


def test_rejected_documents_go_and_clean_ones_stay(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    predicted = {r["doc_id"]: r["predicted"] for r in quality_classifier.classify(docs, labels).collect()}
    assert {r["doc_id"] for r in stages[1]} == {i for i, p in predicted.items() if p == 1}
    clean = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    assert clean <= {r["doc_id"] for r in stages[1]}


def test_one_document_of_every_text(stages):
    best = defaultdict(int)
    for r in stages[1]:
        best[normal(r["text"])] = max(best[normal(r["text"])], r["doc_id"])
    assert Counter(r["doc_id"] for r in stages[2]) == Counter(best.values())


def test_one_document_of_every_component(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2]]
    assert Counter(r["doc_id"] for r in stages[3]) == Counter(i for i, _, c in near_expected(rows) if i == c)


def test_mix_holds_every_document_as_often_as_taken(spark, stages):
    docs = spark.createDataFrame(stages[3])
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in stages[4]) == Counter(taken)
    texts = {r["doc_id"]: r["text"] for r in stages[3]}
    assert all(r["text"] == texts[r["doc_id"]] for r in stages[4])


def test_everything_is_packed(stages):
    expected = defaultdict(int)
    for r in stages[4]:
        expected[r["doc_id"]] += len(r["text"].encode().split()) + 1
    check(stages[5], dict(expected), packing.LENGTHS)


def test_run_is_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, stages[5]))


def test_stages_take_odd_rows(spark, clashing, nothing):
    for docs in (clashing, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == docs.columns, name
            assert kept.count() <= 2 * docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count()


def test_stages_call_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "mixing", "best-fit packing",
    ]
    assert exact_dedup and simhash
