"""Every stage of the corpus pipeline on awkward tables, and the whole of it against its own operators."""

import corpus_pipeline
from tests.llm.test_corpus import EDGE, docs_of, prose

LABELS = "doc_id long, quality int, toxic int"


def _texts():
    lines = lambda k: "\n".join(f"{prose(1000 * k + j, 14)}." for j in range(8))
    near = lines(3).split()
    near[10] = "changed"
    shared = prose(77, 70)
    return [*EDGE, lines(1), lines(1), lines(2), lines(3), " ".join(near), f"{lines(4)}\n{shared}\n{lines(5)}", f"{lines(6)}\n{shared}"]


def _write(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(8, 1, 0), (9, 1, None), (3, 0, 0), (None, 0, 0), (99, 1, 0)], LABELS).write.parquet(f"{folder}/labels.parquet")


def test_stages_keep_the_columns_and_what_they_should(spark, tmp_path):
    docs = docs_of(spark, _texts()).repartition(3)
    docs = docs.unionByName(docs.where("doc_id = 10"))  # a repeated row
    folder = str(tmp_path)
    _write(spark, folder, docs)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    (_, quality), (_, near), (_, passages), (_, mixing), (_, packing) = corpus_pipeline.STAGES
    kept = quality(spark, docs, folder)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids <= set(range(len(_texts()))) and not ids & {0, 1, 2, 3, 4} and {8, 10, 11} <= ids
    first = near(spark, docs, folder)
    left = sorted(r["doc_id"] for r in first.collect())
    assert first.columns == docs.columns and left == [0, 1, 2, 3, 4, 5, 7, 8, 10, 11, 13, 14]
    cut = {r["doc_id"]: r for r in passages(spark, docs, folder).collect()}
    assert cut[14]["text"].split() == _texts()[14].split()[:-70] and cut[13]["text"] == _texts()[13]
    assert cut[9]["text"] == "" and cut[0]["text"] is None and cut[14]["n_chars"] == len(cut[14]["text"])
    mixed = mixing(spark, docs, folder)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= set(range(len(_texts())))
    packed = packing(spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == set(range(len(_texts()))) and max(r["offset"] + r["length"] for r in packed) <= 2048


def test_stages_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    _write(spark, folder, docs_of(spark, ["x"]).limit(0))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES:
        assert apply(spark, docs, folder).count() == 0, name


def test_run_applies_the_stages_in_order(spark, tmp_path):
    folder = str(tmp_path)
    _write(spark, folder, docs_of(spark, _texts()))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, apply) in enumerate(corpus_pipeline.STAGES):
        docs = apply(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
    key = lambda df: sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, folder)) == key(docs)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "substring dedup", "mixing sources", "packing"]
