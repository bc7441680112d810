import corpus_pipeline
import pytest

from txnmill.llm.simhash import simhash_groups

from .test_simhash import smallest_of_groups

SMALL, MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents after each stage over the smallest tables."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, out[-1], SMALL)
        out.append(spark.createDataFrame(rows.toArrow()) if rows.count() else rows)
    return out


def test_columns_and_decisions(stages):
    docs, clean, unique, mixed, packed = stages
    for frame in (clean, unique, mixed):
        assert frame.columns == docs.columns
    ids = [{r.doc_id for r in frame.select("doc_id").collect()} for frame in stages]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] == ids[4]
    assert len(ids[0]) >= len(ids[1]) > len(ids[2])


def test_toxic_documents_go_and_others_stay(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MORE}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, MORE).select("doc_id").collect()}
    toxic = [i for i, t in labels.items() if t]
    assert sum(i in left for i in toxic) <= 0.1 * len(toxic)
    assert not any(i not in left for i, t in labels.items() if not t)


def test_groups_of_near_fingerprints_keep_one(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = sorted(i for _, i, _ in smallest_of_groups(rows))
    assert sorted(r.doc_id for r in stages[2].collect()) == want


def test_copies_go_and_clean_documents_stay(spark):
    """Exact copies, copies in other case and white space, and all documents of which there is no copy."""
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    rows = docs.collect()
    same = {}
    for r in rows:
        same.setdefault(" ".join((r.text or "").lower().split()), []).append(r.doc_id)
    left = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, MORE).select("doc_id").collect()]
    assert len(left) == len(set(left))
    for ids in same.values():
        assert len(set(ids) & set(left)) <= 1
    gone = {r.doc_id for r in rows} - set(left)
    groups = {r.doc_id: r.component_id for r in simhash_groups(docs).collect()}
    assert gone == {i for i, root in groups.items() if i != root}


def test_odd_tables(spark, odd, none):
    """Nulls, repeated rows, ids that are null or used twice and clashing names go through all stages."""
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, SMALL)
            docs = spark.createDataFrame(result.collect(), result.schema)
        assert docs.count() or docs.columns


def test_run_packs_all_words_of_the_mix(spark, stages):
    words = sum(len(r.text.split()) for r in stages[3].collect())
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert sum(r.length for r in rows) == words == sum(r.length for r in stages[4].collect())


def test_run_leaves_its_result_only(spark):
    """Intermediates of a stage go when it is written, and a stage's documents when the next one is."""
    from pathlib import Path

    from txnmill.session import shared_dir

    before = set(Path(shared_dir(spark)).glob("llm-*"))
    rows = corpus_pipeline.run(spark, SMALL)
    left = set(Path(shared_dir(spark)).glob("llm-*")) - before
    assert [p.name for p in left] == [next(iter(left)).name] and [p.name for p in next(iter(left)).iterdir()] == ["packing"]
    assert rows.count() > 0
