"""Tables without limits on values, scenarios and regions; forests as tables; quoted CSV; published runs."""

import json
import math
import os

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fixtrail.functions import quantiles
from fixtrail.operators.iforest import IsolationForest, walk_forest
from fixtrail.operators.onehot import INDEX, VECTOR, few_categories, with_category_index
from fixtrail.operators.profile import approximate_entities, column_profile, entity_sketches, merged_sketches
from fixtrail.operators.recurrent import training_table
from fixtrail.operators.scaler import FeatureStats
from fixtrail.operators.scenarios import any_member, has_member, member_rows, membership_bits
from fixtrail.plans.reports import region_records, write_region_report
from fixtrail.sources.sinks import publish, published_run, write_compiled_families, write_csv
from fixtrail.sources.tables import read_csv, read_table, standardize


def test_rank_search_brings_few_buckets_to_the_driver(spark, monkeypatch):
    sizes = []
    holding = quantiles._holding
    monkeypatch.setattr(quantiles, "_holding", lambda *a: sizes.append(len(rows := holding(*a))) or rows)
    monkeypatch.setattr(quantiles, "_TOGETHER", 16)
    df = spark.range(40_000).select(
        (F.rand(5) * 1e6 - 3e5).alias("a"),
        F.exp(F.randn(6) * 40).alias("b"),
        F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.col("id") % 5 - 2.0).alias("c"),
    )
    df = spark.createDataFrame(df.toPandas())
    ps = [0, 0.1, 33.3, 50, 99.9, 100]
    found = quantiles.exact_percentiles(df, {c: F.col(c) for c in df.columns}, ps, direct_limit=50)
    data = df.toPandas()
    for c in df.columns:
        assert [found[c][p] for p in ps] == pytest.approx(np.percentile(data[c], ps).tolist(), rel=1e-15)
    assert sizes and max(sizes) <= 3 * 2 * len(ps)


def test_walk_inside_the_jvm_equals_the_vector_walk(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(rng.normal(size=(600, 3)))]
    rows[5] = (5, None, 1.0, 2.0)
    rows[6] = (6, float("nan"), 1.0, 2.0)
    rows[7] = (7, 1e30, -1e30, float("inf"))
    df = spark.createDataFrame(rows, "row_id long, x double, y double, z double")
    names = ["x", "y", "z"]
    train = df.where("row_id >= 8").withColumn("row_id", F.col("row_id") - 8)
    forest = IsolationForest.fit(train, 592, names, 12, 1)
    scored = walk_forest(forest.with_scores(df, {12: "vector"}), forest.to_df(spark), names, forest.sample_size).collect()
    for r in scored:
        assert (r["vector"] is None) == (r["score"] is None) == (r["path"] is None)
        assert r["score"] is None or math.isclose(r["score"], r["vector"], rel_tol=1e-12)
    assert [r["score"] for r in scored if r["row_id"] in (5, 6)] == [None, None]
    leaves = forest.nodes[forest.nodes["left"] == forest.nodes["node"]]
    assert (leaves.groupby("tree")["size"].sum() == 256).all()
    assert walk_forest(df.limit(0), forest.to_df(spark), names).count() == 0


def test_csv_with_quotes_line_breaks_and_ragged_records(spark, tmp_path):
    texts = ['a "quoted" word', "two\nlines", "comma, quote\" and\r\nbreak", " spaces kept ", '"', 'back\\slash\\"', "ünï 日本"]
    df = spark.createDataFrame([(i, t, float(i)) for i, t in enumerate(texts)], "id long, t string, x double")
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out")).orderBy(F.col("id").cast("int")).collect()
    assert [r["t"] for r in back] == texts
    (tmp_path / "short.csv").write_text('a,b,c\n1,2\n"x,\ny",5,6\n7\n')
    rows = read_csv(spark, str(tmp_path / "short.csv")).collect()
    assert {tuple(r) for r in rows} == {("1", "2", None), ("x,\ny", "5", "6"), ("7", None, None)}
    assert read_csv(spark, str(tmp_path / "short.csv")).count() == 3
    for text in ("a,b\n1,2\n3,4,5\n", 'a,b\n"1,1",2,\n'):
        (tmp_path / "long.csv").write_text(text)
        with pytest.raises(Exception, match="more than 2 cells"):
            read_csv(spark, str(tmp_path / "long.csv")).select("b").collect()
        with pytest.raises(Exception, match="more than 2 cells"):
            read_csv(spark, str(tmp_path / "long.csv")).count()
    (tmp_path / "lines.csv").write_text("a,b\n1,2\n3,4\n")
    assert read_table(spark, str(tmp_path / "lines.csv"), schema="a int, b double", multi_line=False).collect() == [(1, 2.0), (3, 4.0)]
    (tmp_path / "header.csv").write_text("a,b\n")
    assert read_csv(spark, str(tmp_path / "header.csv")).collect() == []


def test_times_of_several_patterns(spark):
    rows = [("A", "2025-12-02 18:30:00"), ("B", "02/12/2025 18:30"), ("C", " 20251202 183000 "), ("D", None)]
    df = spark.createDataFrame(rows, "placa string, timestamp string")
    patterns = ["dd/MM/yyyy HH:mm", "yyyyMMdd HHmmss"]
    found = {r["placa"]: str(r["timestamp"]) for r in standardize(df, {}, time_patterns=patterns).collect()}
    assert found == dict.fromkeys("ABC", "2025-12-02 18:30:00")
    bad = spark.createDataFrame([("Z9", "soon")], "placa string, timestamp string")
    with pytest.raises(Exception, match="soon.*Z9"):
        standardize(bad, {}, time_patterns=patterns).collect()


def test_twenty_thousand_categories(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, F.format_string("v%05d", F.expr("id div 2"))).alias("regiao_adm"))
    assert few_categories(df) is None
    out = with_category_index(df)
    assert out.columns == ["id", INDEX, VECTOR]
    rows = {r["id"]: r for r in out.where("id < 40 OR id > 39990").collect()}
    for k, r in rows.items():
        assert r[INDEX] == (k // 2 if k % 2 == 0 else None)
        assert r[VECTOR].size == 20_000 and r[VECTOR].numNonzeros() == (k % 2 == 0)
        assert k % 2 or r[VECTOR].indices.tolist() == [k // 2]
    small = with_category_index(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "regiao_adm string"))
    dense = small.select(INDEX, vector_to_array(VECTOR).alias("v")).collect()
    assert sorted(((r[INDEX], tuple(r["v"])) for r in dense), key=str) == [(0, (1.0, 0.0)), (1, (0.0, 1.0)), (1, (0.0, 1.0)), (None, (0.0, 0.0))]
    assert with_category_index(df.limit(0)).count() == 0


def test_more_scenarios_than_bits_in_a_word(spark):
    masks = {f"s{i}": F.col("id") % (i + 2) == 0 for i in range(73)}
    df = spark.range(200).select("id")
    bits = df.select("id", membership_bits(list(masks.values())).alias("bits"))
    counts = bits.agg(*[F.count_if(has_member(F.col("bits"), i)).alias(n) for i, n in enumerate(masks)]).first().asDict()
    assert counts == {f"s{i}": -(-200 // (i + 2)) for i in range(73)}
    rows = bits.orderBy("id").collect()
    words = np.array([r["bits"] for r in rows])
    assert member_rows(words, range(73)).sum(1).tolist() == list(counts.values())
    assert bits.where(~any_member(F.col("bits"))).where("id = 1").count() == 1
    windows = df.select(F.col("id").alias("row_id"), F.array(F.col("id") * 1.0, F.lit(0.0)).alias("seq"), "id")
    table, sizes, _ = training_table(windows, masks, "seq", 4096)
    assert sizes == counts and table.count() == bits.where(any_member(F.col("bits"))).count()


def test_sketches_merge_and_stay_near(spark):
    df = spark.range(60_000).select(
        F.concat(F.lit("r"), F.when(F.col("id") < 50_000, 0).otherwise(F.col("id") % 3)).alias("regiao_adm"),
        (F.col("id") % 30_000).alias("placa"),
        (F.col("id") % 7).alias("day"),
    )
    df = df.unionByName(spark.createDataFrame([(None, 1, 0), ("r9", None, 0)], df.schema))
    daily = entity_sketches(df, ("regiao_adm", "day"))
    found = {r["regiao_adm"]: r["veiculos"] for r in approximate_entities(merged_sketches(daily, ("regiao_adm",))).collect()}
    exact = {r["regiao_adm"]: r["n"] for r in df.dropna(subset=["regiao_adm"]).groupBy("regiao_adm").agg(F.count_distinct("placa").alias("n")).collect()}
    assert found.keys() == exact.keys() and found["r9"] == 0
    assert all(abs(found[r] - exact[r]) <= 5 * 1.04 / 64 * exact[r] for r in exact)


def test_twenty_thousand_regions_written(spark, tmp_path):
    df = spark.range(45_000).select(F.concat(F.lit('r"\n{}:é'), F.col("id") % 20_000).alias("regiao_adm"), F.col("id").alias("placa"))
    write_region_report(df, str(tmp_path))
    folder = tmp_path / "quantidade_carros_por_ra.json"
    whole = "".join((folder / f).read_text() for f in sorted(os.listdir(folder)) if f.startswith("part"))
    found = json.loads(whole)
    assert len(found) == 20_000 and found['r"\n{}:é7'] == 3 and sum(found.values()) == 45_000
    assert list(found) == sorted(found)
    assert [r[0] for r in region_records(df.limit(0)).collect()] == ["{}"]
    assert json.loads("".join(r[0] for r in region_records(df.limit(1)).collect())) == {'r"\n{}:é0': 1}


@pytest.mark.parametrize(("count", "mean", "std", "scale"), [(10**12, 1e4, 1.0, 1.0), (10**12, 1e4, 0.01, 0.01), (100, 1e9, 1e-8, 1.0), (10**12, 5.0, 0.0, 1.0)])
def test_spread_of_many_rows_is_no_noise(count, mean, std, scale):
    assert FeatureStats("f", count, mean, std, mean - 3 * std, mean + 3 * std).scale == scale


def test_nan_counts_as_null_in_the_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "c")], "x double, t string")
    assert {r["Coluna"]: r["Nulos"] for r in column_profile(df).collect()} == {"x": 2, "t": 1}


def test_half_written_run_is_not_read(spark, tmp_path):
    root = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        published_run(spark, root)
    write = lambda n: lambda run: spark.range(n).write.parquet(f"{run}/t")
    first = publish(spark, root, write(3))

    def broken(run):
        write(9)(run)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        publish(spark, root, broken)
    assert published_run(spark, root) == first and spark.read.parquet(f"{first}/t").count() == 3
    second = publish(spark, root, write(4))
    third = publish(spark, root, write(5))
    assert published_run(spark, root) == third and spark.read.parquet(f"{third}/t").count() == 5
    assert os.path.isdir(second) and not os.path.isdir(first)


def test_families_compiled_into_one_table_each(spark, tmp_path):
    write_csv(spark.createDataFrame([("a", 1)], "Model string, n int"), str(tmp_path / "describe_ISO_1.csv"))
    write_csv(spark.createDataFrame([("b",)], "Model string"), str(tmp_path / "describe_ISO_2.csv"))
    write_csv(spark.createDataFrame([("c", 3)], "Model string, n int"), str(tmp_path / "describe_LSTM.csv"))
    written = write_compiled_families(spark, f"{tmp_path}/describe_*.csv", str(tmp_path / "out"))
    assert [p.rsplit("/", 1)[1] for p in written] == ["iso_compiled.csv", "lstm_compiled.csv"]
    rows = read_table(spark, written[0]).collect()
    assert {(r["Model"], r["n"]) for r in rows} == {("a", "1"), ("b", None)}
