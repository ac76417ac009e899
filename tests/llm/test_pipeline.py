import pytest

import corpus_pipeline
from clientele.llm import mixing, passages, simhash

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        found[name] = docs, (docs := spark.read.parquet(path))
    return found


def test_each_stage_passes_on_documents(stages):
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.columns == COLUMNS and after.count() > 0, name


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = (t.select("doc_id").distinct() for t in stages["toxicity"])
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = {r.doc_id for r in after.collect()}
    clean = [i for i, t in truth.items() if not t]
    assert len(left & set(clean)) >= 0.98 * len(clean)
    assert len(left) < before.count()


def test_one_document_of_each_group_stays(stages):
    before, after = stages["simhash"]
    groups = {r.component_id for r in simhash.simhash_components(before).collect()}
    assert sorted(groups) == sorted(r.doc_id for r in after.collect())


def test_no_passage_repeats(stages):
    _, after = stages["passages"]
    again = passages.repeated_passages(after)
    # Joining what is left can make new neighbours, so only untouched texts are looked at twice.
    before = {r.doc_id: r.text for r in stages["passages"][0].collect()}
    same = [r.doc_id for r in after.collect() if before[r.doc_id] == r.text]
    assert all(r.n_removed == 0 for r in again.collect() if r.ord in set(same) and r.n_words < 50)


def test_sources_meet_their_targets(stages):
    before, after = stages["mixing"]
    taken = {}
    for r in after.collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    for r in mixing.mix(before).select("source", "target").distinct().collect():
        assert abs(taken.get(r.source, 0) - r.target) < 5000


def test_every_piece_is_packed(stages):
    before, after = stages["packing"]
    assert after.where("piece = 0").count() == before.count()
    room = after.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in room) <= 1024


def test_run_gives_the_stages_result(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(
        map(tuple, stages["packing"][1].select(key).collect()))
