import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywell.operators import features as ft
from tallywell.operators.nearest import nearest_references
from tallywell.sources.sinks import csv_to_parquet


def test_metadata_and_root_key_are_not_prefixed(spark):
    df = spark.createDataFrame([("A01", 1, 5, 0.5)], "Metadata_Well string, Metadata_Site int, ObjectNumber long, area double")
    assert ft.cell_part_columns(df, "nucleus").columns == ["Metadata_Well", "Metadata_Site", "ObjectNumber", "nucleus_area"]
    assert ft.cell_part_columns(df, "cytoplasm").columns[2] == "cytoplasm_ObjectNumber"


def parts(spark):
    nucleus = spark.createDataFrame([("A01", 1, 5, 0.5), ("A01", 1, 6, 0.7), ("A02", 1, 5, 0.9)], "Metadata_Well string, Metadata_Site int, ObjectNumber long, area double")
    cytoplasm = spark.createDataFrame([("A01", 1, 1, 5, 1.5), ("A02", 1, 1, 5, 1.9), ("A02", 2, 1, 5, 9.0)], "Metadata_Well string, Metadata_Site int, ObjectNumber long, Parent_nucleus long, area double")
    return {"nucleus": nucleus, "cytoplasm": cytoplasm}


def test_cells_join_on_three_keys_and_compounds_are_optional(spark):
    cells = ft.join_cell_parts(parts(spark))
    layout = spark.createDataFrame([("A01", "c1", True)], "well string, compound string, is_reference boolean")
    got = ft.attach_compounds(cells, layout).orderBy("Metadata_Well").collect()
    assert [(r["Metadata_Well"], r["nucleus_area"], r["cytoplasm_area"], r["compound"]) for r in got] == [
        ("A01", 0.5, 1.5, "c1"), ("A02", 0.9, 1.9, None),
    ]


def test_unknown_result_file_fails_the_merge(spark, tmp_path):
    files = spark.createDataFrame([("nucleus.parquet", "p/q/1/nucleus.parquet"), ("odd.parquet", "p/q/1/odd.parquet")], "filename string, s3path string")
    parts(spark)["nucleus"].write.parquet(str(tmp_path / "p/q/1/nucleus.parquet"))
    with pytest.raises(Exception, match="unexpected file name odd.parquet"):
        ft.merge_frames(spark, str(tmp_path), "p/q/*", files)["nucleus"].collect()
    assert ft.route_result_files(files, strict=False).where("route = 'unexpected'").count() == 1


def test_merge_reads_recorded_files_only(spark, tmp_path):
    for batch in (1, 2, 3):
        frame = parts(spark)["nucleus"].withColumn("batch", F.lit(batch))
        frame = frame.drop("area") if batch == 2 else frame
        frame.write.parquet(str(tmp_path / f"a b/q%+/{batch}/nucleus.parquet"))
    files = spark.createDataFrame([("nucleus.parquet", f"a b/q%+/{b}/nucleus.parquet") for b in (1, 2)], "filename string, s3path string")
    merged = ft.merge_frames(spark, str(tmp_path), "a b/q%+/*", files)
    assert set(merged) == {"nucleus"}
    assert sorted((r["batch"], r["n"], r["areas"]) for r in merged["nucleus"].groupBy("batch").agg(F.count("*").alias("n"), F.count("area").alias("areas")).collect()) == [(1, 3, 3), (2, 3, 0)]
    with pytest.raises(FileNotFoundError, match="a b/q%.*/1/nucleus.parquet"):
        ft.merge_frames(spark, str(tmp_path), "none/*", files)
    lost = files.unionByName(spark.createDataFrame([("nucleus.csv", "a b/q%+/9/nucleus.csv")], files.schema))
    with pytest.raises(FileNotFoundError, match="9/nucleus.csv"):
        ft.merge_frames(spark, str(tmp_path), "a b/q%+/*", lost)
    assert ft.reduce_experiment(spark, str(tmp_path), "none/*", files.limit(0), None) is None


def test_components_match_numpy(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 5)) + rng.normal(size=(200, 5)) * 0.1
    table = [(i, *map(float, row), 1.0) for i, row in enumerate(data)] + [(999, None, 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(table, "id int, " + ", ".join(f"f{i} double" for i in range(6))).repartition(4)
    got = ft.reduce_features(df, [f"f{i}" for i in range(6)]).orderBy("id").collect()
    assert got[-1]["component_1"] is None and len(got) == 201
    scaled = (data - data.mean(axis=0)) / data.std(axis=0, ddof=1)
    _, _, vt = np.linalg.svd(scaled, full_matrices=False)
    for j in range(2):
        weights = vt[j] * np.sign(vt[j][abs(vt[j]).argmax()])
        np.testing.assert_allclose([r[f"component_{j + 1}"] for r in got[:-1]], scaled @ weights, atol=1e-8)


def test_thousands_of_features(spark):
    n = 2000
    values = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.sin(F.col("id") * i) + F.col("id") * 0.01)
    wide = spark.range(60).select("id", values.alias("v")).select("id", *[F.get("v", F.lit(i)).alias(f"f{i}") for i in range(n)])
    got = ft.reduce_features(wide, [f"f{i}" for i in range(n)]).select("component_1", "component_2").collect()
    data = np.array([[r["component_1"], r["component_2"]] for r in got])
    assert abs(data.mean(axis=0)).max() < 1e-6 and data.var(axis=0)[0] > data.var(axis=0)[1] > 0


@pytest.mark.parametrize("k,block,group", [(1, 7, 2), (3, 7, 1), (3, 2000, 32), (50, 10, 3)])
def test_nearest_equals_brute_force(spark, k, block, group):
    rng = np.random.default_rng(1)
    # Half of the references are copies of one vector, so one cell is hot and ties are many.
    refs = [rng.integers(-9, 9, size=4) / 2 for _ in range(40)]
    refs += [refs[0]] * 40
    asked = [rng.integers(-9, 9, size=4) / 2 for _ in range(30)] + [refs[0]] * 30
    frame = lambda items, name: spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(items)], f"{name} long, vector array<double>")
    found = nearest_references(frame(asked, "query_id"), frame(refs, "ref_id"), k=k, max_pivots=5, block_rows=block, parts_per_task=group)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((round(r["distance2"], 9), r["ref_id"]))
    for q, vector in enumerate(asked):
        want = sorted((round(float(((vector - r) ** 2).sum()), 9), i) for i, r in enumerate(refs))[:k]
        assert got[q] == want


def test_nearest_without_references(spark):
    empty = spark.createDataFrame([], "ref_id long, vector array<double>")
    asked = spark.createDataFrame([(1, [0.0])], "query_id long, vector array<double>")
    assert nearest_references(asked, empty).collect() == []


def test_group_profiles_are_means(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("b", [5.0, 7.0])], "k string, v array<double>")
    assert sorted(map(tuple, ft.group_profiles(df, "k", "v", 2).collect())) == [("a", 0, 2.0), ("a", 1, 4.0), ("b", 0, 5.0), ("b", 1, 7.0)]
    with pytest.raises(Exception, match="expected a vector of 1, got 2"):
        ft.group_profiles(df, "k", "v", 1).collect()


def test_csv_becomes_partitioned_parquet(spark, tmp_path):
    csv, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(30).selectExpr("'p' AS project", "id % 3 AS batch", "id * 0.5 AS v").write.option("header", "true").csv(csv)
    csv_to_parquet(spark, csv, "project string, batch int, v double", target, ["project", "batch"])
    assert (tmp_path / "out/project=p/batch=2").is_dir()
    assert spark.read.parquet(target).where("batch = 1").count() == 10
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        csv_to_parquet(spark, csv, "project string, batch int, v double", target, ["project", "batch"])
