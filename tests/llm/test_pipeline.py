import random

import pytest

import corpus_pipeline
from tidemart.llm.common import pin

rng = random.Random(12)
VOCAB = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]


def prose(n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    clean = {i: prose(rng.randint(30, 200)) for i in range(200)}
    toxic = {300 + i: prose(40) + " zounds drat " + prose(30) + " quorl blast zounds" for i in range(60)}
    copies = {400 + i: clean[i] for i in range(20)}
    near = {}
    for i in range(20, 40):
        words = clean[i].split() + prose(60).split()
        clean[i] = " ".join(words)
        words[len(words) // 2] = "edited"
        near[440 + i] = " ".join(words)
    passage = prose(70)
    shared = {500 + i: prose(40) + " " + passage + " " + prose(40) for i in range(6)}
    lined = {600 + i: prose(40) + f"\nAll rights reserved by owner {i} of this.\n" + prose(30) for i in range(20)}
    odd = {700: None, 701: "", 702: prose(6000)}
    rows = [(d, t) for part in (clean, toxic, copies, near, shared, lined, odd) for d, t in part.items()] + [(None, "no id")]
    where = tmp_path_factory.mktemp("tables")
    labels = [(d, 1, int(d in toxic)) for d in [*clean, *toxic] if d % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    parts = dict(clean=clean, toxic=toxic, copies=copies, near=near, shared=shared, lined=lined, odd=odd, passage=passage)
    return rows, parts, str(where)


def test_stages(spark, make_docs, planted):
    rows, parts, where = planted
    docs = pin(make_docs(rows), "test-docs")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = pin(stage(spark, docs, where), f"test-{name}")
        assert docs.columns == columns
        assert all(r.n_chars == len(r.text) for r in docs.where("text is not null").collect())
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    after = seen["toxicity"]
    assert not parts["toxic"].keys() & after.keys()
    assert {d for d, _ in rows} - parts["toxic"].keys() == after.keys()
    lines = [d for d in parts["lined"] if "rights" in seen["line_dedup"][d]]
    assert lines == [min(parts["lined"])]
    assert {d: t for d, t in seen["line_dedup"].items() if d not in parts["lined"]} == {
        d: t for d, t in after.items() if d not in parts["lined"]}
    left = seen["jaccard_join"].keys()
    assert not (parts["copies"].keys() | parts["near"].keys()) & left
    assert parts["clean"].keys() | parts["shared"].keys() | parts["lined"].keys() | {None, 702} <= left
    cut = seen["suffix_dedup"]
    assert [d for d in parts["shared"] if parts["passage"] in cut[d]] == [min(parts["shared"])]
    assert all(len(cut[d]) < 620 for d in parts["shared"] if d != min(parts["shared"]))
    assert all(cut[d] == parts["clean"][d] for d in parts["clean"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, where).collect()
    assert {r.doc_id for r in packed} == cut.keys()


def test_run_and_empty_tables(spark, make_docs, planted, tmp_path):
    rows, _, where = planted
    make_docs(rows[:80]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{where}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 60
    empty = tmp_path / "empty"
    make_docs([]).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{where}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_texts_go_to_workers_in_small_batches(spark, make_docs, planted):
    rows, _, where = planted
    docs = make_docs([(i, "one two three") for i in range(2500)], partitions=1)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            if name != "line_dedup":  # has no Python
                spark.conf.set(key, "10000")
                stage(spark, make_docs(rows[:20]), where)
                n = [r.n for r in docs.select("text").mapInArrow(sizes, "n long").collect()]
                assert sum(n) == 2500 and max(n) <= 1000, name
    finally:
        spark.conf.set(key, before)
