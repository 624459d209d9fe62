"""Every operator and stage on awkward and on empty tables."""

import pytest

import corpus_pipeline
from lumbung.llm import bpe, digest, mixing, personal_data, quality_rules, secret_scan, sharding, simhash, toxicity
from lumbung.llm.tables import ids_and_texts

NO_LABELS = [(1, 1, 0)]

PER_ROW = {
    "near_duplicates": lambda docs, labels: simhash.near_duplicates(docs),
    "secrets": lambda docs, labels: ids_and_texts(docs).select("doc_id", secret_scan.spans("text")),
    "digests": lambda docs, labels: digest.digests(docs),
    "bpe": lambda docs, labels: ids_and_texts(docs).select("doc_id", bpe.there_and_back("text")),
    "tokenized": lambda docs, labels: bpe.tokenized(docs),
    "toxicity": lambda docs, labels: toxicity.scores(docs, labels),
    "sharded": lambda docs, labels: sharding.sharded(docs),
    "judged": lambda docs, labels: quality_rules.judged(docs),
    "mixed": lambda docs, labels: mixing.mixed(docs),
    "redacted": lambda docs, labels: personal_data.redacted(docs),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_awkward_rows_all_come_out(name, awkward, labels):
    found = PER_ROW[name](awkward, labels(*NO_LABELS)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in awkward.collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_no_rows_no_results(name, nothing, labels):
    assert PER_ROW[name](nothing, labels(*NO_LABELS).limit(0)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_the_columns(name, stage, awkward, nothing, spark, labels, tmp_path):
    labels(*NO_LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (awkward, nothing):
        kept = stage(spark, docs, str(tmp_path))
        if (name, stage) == corpus_pipeline.STAGES[-1]:
            assert kept.columns[:-1] == docs.columns
        else:
            assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        kept.collect()


def test_results_of_awkward_rows(awkward, labels):
    prints = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(awkward).collect()}
    zero = "0" * 16
    assert {(2, zero, 2), (3, zero, 2), (4, zero, 2), (None, zero, 2)} <= prints
    sizes = sorted((r["size"], r["text_crc32"]) for r in sharding.sharded(awkward).filter("doc_id IN (2, 3)").collect())
    assert sizes == [(1, 0), (1, 0)]
    verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.judged(awkward).filter("doc_id IN (2, 3, 4)").collect()}
    assert verdicts == {2: False, 3: False, 4: False}
    empty = [r for r in digest.digests(awkward).collect() if r["doc_id"] in (2, 3)]
    assert [(r["n_chars"], r["fingerprint"]) for r in empty] == [(0, ""), (0, "")]
    texts = {r["doc_id"]: r["text"] for r in personal_data.redacted(awkward).collect()}
    assert texts[2] is None and texts[3] == ""
    once = simhash.one_of_each(awkward).collect()
    assert len([r for r in once if r["doc_id"] == 1]) == 1
    assert {r["doc_id"] for r in once} >= {1, 2, 5} and not {3, 4} & {r["doc_id"] for r in once}


def test_registered_once(spark):
    from lumbung.llm.queries import ORACLE, QUERIES

    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
