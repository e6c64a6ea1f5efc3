import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallywell.functions import names
from tallywell.operators import image_sets as sets
from tallywell.operators import progress, skew, warehouse
from tallywell.sources import experiments as ex


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def document(name="e1", project="p", plate="96-CO-3603", stamp="2024-03-05_13.07.09", scope="s1", n=(2, 2, 1, 1),
             wells=("A01", "B02"), ordered=("BF full",), z_unit="mm"):
    config = [("BF full", 10.0), ("BF full", 99.0), ("Fluorescence 405 nm Ex", 20.0), ("Custom", 1.0)]
    units = {"x": "mm", "y": "mm", "z": z_unit, "t": "s"}
    return {
        "project_name": project, "output_path": f"/data/{name}/", "plate_type": plate, "plate_name": "plate",
        "microscope_name": scope, "objective": "10x", "timestamp": stamp, "cell_line": "line",
        "well_list": list(wells), "channels_ordered": list(ordered),
        "channels_config": [
            {"Name": c, "ExposureTime": e, "AnalogGain": 1.0, "IlluminationIntensity": 2.0} for c, e in config
        ],
        "grid_config": {axis: {"unit": units[axis], "N": count, "d": 0.5} for axis, count in zip("xyzt", n)},
    }


def load(spark, tmp_path, *documents):
    for i, d in enumerate(documents):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=2))
    return ex.scan_experiments(spark, str(tmp_path))


NONE = "project_name string, experiment_name string"


def known(spark, *pairs):
    return spark.createDataFrame(list(pairs), NONE)


def wells(spark):
    types = ex.dim_plate_types(spark).select(F.col("model_name").alias("plate_type"), "num_wells")
    return ex.well_grid(types).drop("num_wells").withColumn("id", F.monotonically_increasing_id())


def test_experiment_is_stored_once(spark, tmp_path):
    docs = load(
        spark, tmp_path, document(scope="s2", stamp="2024-03-06_00.00.00"), document(), document("e2"), document("old"),
        document("bad", plate="24-XX"),
    )
    stored, rejected = warehouse.ingest_experiments(docs, known(spark, ("p", "old")), ex.dim_plate_types(spark))
    got = {r["name"]: r for r in stored.collect()}
    assert set(got) == {"e1", "e2"}
    assert got["e1"]["microscope"] == "s1"
    assert got["e1"]["compound_layout_path"] == "p/e1/layout.csv"
    assert (got["e1"]["delta_z_um"], got["e1"]["delta_t_h"]) == (500.0, 0.5 / 3600)
    assert str(got["e1"]["start_time"]) == "2024-03-05 13:07:09"
    assert [r["experiment_name"] for r in rejected.collect()] == ["bad"]


def test_sites_of_new_experiments_only(spark, tmp_path):
    docs = load(spark, tmp_path, document(wells=("A01", "Z99"), n=(2, 2, 1, 2)), document("old"))
    sites, rejected = warehouse.ingest_sites(docs, known(spark, ("p", "old")), wells(spark))
    got = sites.orderBy("site_id").collect()
    assert [(r["well_name"], r["site_id"], r["site_x"], r["site_y"]) for r in got] == [
        ("A01", 1, 1, 0), ("A01", 2, 0, 1), ("A01", 3, 1, 1), ("A01", 4, 0, 0),
    ]
    assert [r["well_name"] for r in rejected.collect()] == ["Z99"]


def test_first_channel_configuration_wins(spark, tmp_path):
    docs = load(spark, tmp_path, document(ordered=("Fluorescence 405 nm Ex", "BF full", "X-ray", "Custom")))
    good, rejected = warehouse.experiment_channels(docs, ex.dim_channels(spark))
    got = [(r["name"], r["imaging_order_index"], r["exposure_time_ms"]) for r in good.orderBy("imaging_order_index").collect()]
    assert got == [("Fluorescence 405 nm Ex", 0, 20.0), ("BF full", 1, 10.0)]
    assert {r["name"]: r["reason"] for r in rejected.collect()} == {"X-ray": "no configuration", "Custom": "unknown channel"}


def test_wrong_units(spark, tmp_path):
    docs = load(spark, tmp_path, document(), document("e2", z_unit="um"))
    good, rejected = ex.validate_units(docs, strict=False)
    assert [r["experiment_name"] for r in good.collect()] == ["e1"]
    assert [r["unit_errors"] for r in rejected.collect()] == [["z: um"]]
    with pytest.raises(Exception, match="wrong grid unit z: um"):
        ex.validate_units(docs)[0].select("experiment_name").collect()


NAMES = {
    "B03_s1_x0_y0_Fluorescence_405_nm_Ex.tif": ("B03", 1, 0, 0, 1, "Fluorescence 405 nm Ex"),
    "/deep/er/C12_s4_x1_y1_z2_BF_full.tiff": ("C12", 4, 1, 1, 2, "BF full"),
    "A01_s1_s12_x3_y4_c.d.tif": ("A01_s1", 12, 3, 4, 1, "c.d"),
    "A01_s1_x0_y0_nosuffix": ("A01", 1, 0, 0, 1, "nosuffix"),
    "snapshot.tif": None,
    "A01_s1_x0_y0.tif": None,
    "A01_s1_x0_y0_.tif": None,
    "A\u0001_s1_x0_y0_c.tif": ("A\u0001", 1, 0, 0, 1, "c"),
    "x_s1_x0_y0_c/plain.tif": None,
}


def test_image_names(spark):
    files = spark.createDataFrame([(n,) for n in NAMES], "path string")
    got = {r["path"]: tuple(r)[1:] for r in warehouse.parse_images(files).collect()}
    assert got == {n: f for n, f in NAMES.items() if f}
    assert {r["path"] for r in warehouse.unnamed_images(files).collect()} == {n for n, f in NAMES.items() if not f}
    with pytest.raises(Exception, match="not an image name"):
        warehouse.parse_images(files, strict=True).collect()


def test_ingest_images_gives_a_reason(spark):
    paths = ["B03_s1_x0_y0_BF_full.tif", "Z99_s1_x0_y0_BF_full.tif", "B03_s1_x0_y0_X.tif", "odd.tif"]
    # The channel "BF left half" exists, but the experiment has not configured it.
    paths.append("B03_s1_x0_y0_BF_left_half.tif")
    files = spark.createDataFrame([("p", "e", "96-CO-3603", p) for p in paths], "project_name string, experiment_name string, plate_type string, path string")
    channels = spark.createDataFrame([(1, "p", "e", "BF full"), (2, "p", "other", "X")], "id long, project_name string, experiment_name string, name string")
    plates = spark.createDataFrame([("p", "e", 77)], "project_name string, experiment_name string, plateid long")
    got = {r["path"]: r for r in warehouse.ingest_images(files, wells(spark), channels, plates, "images").collect()}
    assert [got[p]["reason"] for p in paths] == [None, "unknown well", "unknown channel", "not an image name", "unknown channel"]
    assert got[paths[0]]["plateid"] == 77
    assert got[paths[0]]["s3path"] == "images/p/e/B03_s1_x0_y0_BF_full.tif"
    assert (got[paths[0]]["site_z"], got[paths[0]]["site_t"], got[paths[0]]["experimentchannelid"]) == (1, 1, 1)


def test_result_names(spark):
    df = spark.createDataFrame([("B03_s12_x0_y0_c.tif",), ("B03",), ("B03_sX_y",)], "n string")
    got = df.select(names.result_name(F.col("n")).alias("r")).select("r.*").collect()
    assert [tuple(r) for r in got] == [("B03", 12), ("B03", None), ("B03", None)]


def test_upsert_adds_each_missing_key_once(spark):
    dim = spark.createDataFrame([(7, "a")], "id long, name string")
    offered = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), (None,)], "name string")
    assert rows(warehouse.upsert_dimension(dim, offered, "name")) == [(8, "b"), (9, "c")]
    empty = spark.createDataFrame([], "id long, name string")
    assert rows(warehouse.upsert_dimension(empty, offered, "name")) == [(1, "a"), (2, "b"), (3, "c")]


def test_lookups_fail_on_unknown_names(spark):
    projects = spark.createDataFrame([(1, "p")], "id long, name string")
    experiments = spark.createDataFrame(
        [(1, "e", "p/e/l.csv"), (1, "twice", "x"), (1, "twice", "y")], "projectid long, name string, compound_layout_path string"
    )
    assert rows(warehouse.lookup_layout(projects, experiments, "p", "e")) == [("p/e/l.csv",)]
    for name, n in (("gone", 0), ("twice", 2)):
        with pytest.raises(Exception, match=f"got {n}"):
            warehouse.lookup_layout(projects, experiments, "p", name).collect()
    assert len(warehouse.list_experiments(projects, experiments, "p").collect()) == 3
    with pytest.raises(Exception, match="expected one project q, got 0"):
        warehouse.list_experiments(projects, experiments, "q").collect()
    dim = spark.createDataFrame([("a", 1)], "k string, v int")
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    with pytest.raises(Exception, match="more than one row for a"):
        warehouse.lookup_with_reason(df, dim.unionByName(dim), ["k"], ["v"]).collect()
    matched, rejected = warehouse.lookup_or_reject(df, dim, ["k"], ["v"])
    assert rows(matched) == [("a", 1)] and rows(rejected) == [("z",)]
    with pytest.raises(Exception, match="not found: z"):
        warehouse.lookup_or_reject(df, dim, ["k"], ["v"], strict=True)[0].collect()


def model(spark, nt=1):
    experiments = spark.createDataFrame([(1, 2, 2, 1, nt), (2, 1, 1, 1, 1)], "experiment long, num_images_x int, num_images_y int, num_images_z int, num_images_t int")
    used = spark.createDataFrame([(1, "A01"), (1, "A02"), (1, "A02"), (2, "A01")], "experiment long, well_name string")
    sites = spark.createDataFrame(
        [(10 * e + 5 * w + s, e, f"A0{w}", s) for e in (1,) for w in (1, 2) for s in (1, 2, 3, 4)],
        "id long, experiment long, well_name string, site_id int",
    )
    batches = spark.createDataFrame([(1, 0, "done"), (1, 1, "done"), (1, 2, "registered")], "experiment long, batchid long, status string")
    files = spark.createDataFrame([(1, 0, f) for f in "abcd"] + [(1, 2, "a")], "experiment long, batchid long, filename string")
    done = [r["id"] for r in sites.where("well_name = 'A01' AND site_id <= 2 OR well_name = 'A02' AND site_id = 2").collect()]
    batch_sites = spark.createDataFrame([(1, 0, i) for i in done] + [(1, 0, done[0]), (1, 1, done[0])], "experiment long, batchid long, siteid long")
    return experiments, used, progress.processed_sites(batch_sites, sites, batches, files)


def test_sites_are_not_multiplied_by_files(spark):
    _, _, processed = model(spark)
    assert rows(processed) == [(1, 0, "A01", 1), (1, 0, "A01", 2), (1, 0, "A02", 2)]


@pytest.mark.parametrize("nt", [1, 2])
def test_progress_totals(spark, nt):
    experiments, used, processed = model(spark, nt)
    got = {r["experiment"]: tuple(r)[1:] for r in progress.experiment_progress(experiments, used, processed).collect()}
    # Expected sites count time points, stored ones do not.
    assert got == {1: (8 * nt, 2, 3, 3, round(300 / (8 * nt) + 1e-9)), 2: (1, 0, 0, 0, 0)}
    scaffold = progress.site_scaffold(experiments, used, processed)
    per_experiment = scaffold.groupBy("experiment").agg(F.count("*"), F.sum("processed"))
    assert rows(per_experiment) == [(1, 8 * nt, 3), (2, 1, 0)]
    with pytest.raises(Exception, match="not a well of the plate: A02"):
        progress.progress_matrix(scaffold, ["A01"]).collect()
    matrix = progress.progress_matrix(scaffold, ["A01", "A02"]).where("experiment = 1").orderBy("site_id").collect()
    assert [(r["A01"], r["A02"]) for r in matrix][:3] == [(1, 0), (1, 1), (0, 0)]


def test_batch_results_and_next_id(spark):
    sites = spark.createDataFrame([(5, 1, "A01", 1)], "id long, experiment long, well_name string, site_id int")
    batches = spark.createDataFrame([(1, 4)], "experiment long, batchid long")
    results = spark.createDataFrame(
        [(1, 4, "A01_s1_x"), (1, 4, "A01_s1_y"), (1, 4, "A01_s9_x"), (1, 8, "A01_s1_x")], "experiment long, batchid long, name string"
    )
    got = rows(warehouse.ingest_batch_results(results, sites, batches))
    assert got == [(1, 4, "A01", 1, 5, None), (1, 4, "A01", 9, None, "unknown site"), (1, 8, "A01", 1, None, "unknown batch")]
    with pytest.raises(Exception, match="site not found"):
        warehouse.resolve_sites(results.selectExpr("experiment", "'A01' AS well", "9 AS site"), sites, strict=True).collect()
    experiments = spark.createDataFrame([(1,), (2,)], "experiment long")
    assert rows(warehouse.next_batch_id(experiments, batches)) == [(1, 5), (2, 0)]


def images(spark, n=300):
    # One set holds a third of all images.
    data = [(1, "A01" if i % 3 == 0 else f"B{i % 7:02d}", 1, f"img{i}", i) for i in range(n)]
    return spark.createDataFrame(data, "experiment long, well string, site int, path string, seen long").repartition(5)


def test_hot_sets_keep_every_path_once(spark):
    got = sets.image_sets(images(spark)).collect()
    by_set = {}
    for r in got:
        by_set.setdefault(r["well"], []).append((r["position"], r["path"]))
    assert sorted(p for own in by_set.values() for _, p in own) == sorted(f"img{i}" for i in range(300))
    for own in by_set.values():
        assert [k for k, _ in sorted(own)] == list(range(len(own)))
        assert [p for _, p in sorted(own)] == sorted(p for _, p in own)
    assert len(by_set["A01"]) == 100


def test_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [("a", 1)], "k string, v int")
    parts = skew.split_hot_groups(df, ["k"], ["v"], 10)
    assert parts.count() == 51
    assert parts.where("k IS NULL").select("part").distinct().count() > 1
    assert rows(parts.where("k = 'a'")) == [("a", 1, 0)]


def test_sets_are_numbered_from_next_id(spark):
    next_ids = spark.createDataFrame([(1, 100)], "experiment long, next_id long")
    got = sets.number_image_sets(images(spark), next_ids, "seen").collect()
    assert sorted(r["batchid"] for r in got) == list(range(100, 100 + len(got)))
    assert min(got, key=lambda r: r["batchid"])["well"] == "A01"


@pytest.mark.parametrize("batch", [7, 10_000])
def test_one_result_per_set_at_any_size(spark, batch):
    """A hot set comes in many pieces with small batches and in one with large ones; failing and empty sets keep their row."""

    def partial(frame: pd.DataFrame) -> pd.DataFrame:
        if (frame["well"] == "B01").any():
            raise RuntimeError("out of focus")
        kept = frame[frame["well"] != "B02"]
        return kept.groupby(["experiment", "well", "site"], as_index=False).agg(n=("path", "size"), last=("path", "max"))

    def merge(pieces: pd.DataFrame) -> pd.DataFrame:
        if (pieces["well"] == "B03").any():
            raise RuntimeError("no merge")
        return pieces.groupby(["experiment", "well", "site"], as_index=False).agg(n=("n", "sum"), last=("last", "max"))

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        source = images(spark).select("experiment", "well", "site", "path")
        got = {r["well"]: tuple(r)[3:] for r in sets.map_image_sets(source, partial, merge, "n long, last string", "n long, last string").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {}
    for r in source.groupBy("well").agg(F.count("*").alias("n"), F.max("path").alias("last")).collect():
        want[r["well"]] = ("done", None, r["n"], r["last"])
    want["B01"] = ("failed", "out of focus", None, None)
    want["B02"] = ("done", None, None, None)
    want["B03"] = ("failed", "no merge", None, None)
    assert got == want


def test_sets_with_null_keys_and_no_sets(spark):
    schema = "experiment long, well string, site int, path string"
    count = lambda f: f.groupby(["experiment", "well", "site"], as_index=False, dropna=False).agg(n=("path", "size"))
    add = lambda f: f.groupby(["experiment", "well", "site"], as_index=False, dropna=False).agg(n=("n", "sum"))
    rows_in = [(1, None, 1, "a"), (1, None, 1, "b"), (1, "A01", 1, "c")]
    got = sets.map_image_sets(spark.createDataFrame(rows_in, schema), count, add, "n long", "n long")
    assert rows(got) == [(1, "A01", 1, "done", None, 1), (1, None, 1, "done", None, 2)]
    assert sets.map_image_sets(spark.createDataFrame([], schema), count, add, "n long", "n long").count() == 0


def test_only_out_of_memory_is_tried_again(spark):
    data = [("a", 1, 137), ("a", 2, 137), ("a", 3, 0), ("b", 1, 1), ("c", 1, 0)]
    attempts = spark.createDataFrame(data, "image_set string, ts int, exit_code int")
    got = sets.retry_lineage(attempts, ["image_set"], ["ts"], max_attempts=2).orderBy("image_set", "ts").collect()
    assert [(r["attempt"], r["status"], r["retry"]) for r in got] == [
        (0, "failed.OOM(0)", True), (1, "failed.OOM(1)", False), (2, "done", False), (0, "failed.1", False), (0, "done", False),
    ]


def test_coordinates_are_optional(spark):
    image = spark.createDataFrame([(1, "A01", 1), (1, "A01", 2)], "experiment long, well string, site int")
    stage = spark.createDataFrame([(1, "A01", 1, 0.5, 0.25, 3.0)], "experiment long, well string, site int, x_mm double, y_mm double, z_um double")
    got = warehouse.attach_coordinates(image, stage.withColumn("t", F.lit(None).cast("timestamp")))
    assert rows(got) == [(1, "A01", 1, 0.5, 0.25, 3.0, None), (1, "A01", 2, None, None, None, None)]


def test_a_retry_gets_the_next_batch_id(spark):
    data = [("e", "a", 1, 137), ("e", "b", 1, 137), ("e", "b", 2, 0), ("e", "c", 1, 137), ("e", "c", 2, 137), ("f", "d", 1, 1)]
    attempts = spark.createDataFrame(data, "experiment string, image_set string, ts int, exit_code int")
    lineage = sets.retry_lineage(attempts, ["image_set"], ["ts"])
    next_ids = spark.createDataFrame([("e", 7), ("f", 0)], "experiment string, next_id long")
    assert rows(sets.next_attempts(lineage, next_ids, ["image_set"])) == [("e", "a", 1, 7), ("e", "c", 2, 8)]


def test_append_to_the_table_that_was_read(spark, tmp_path):
    from tallywell.storage import append_rows

    root = str(tmp_path)
    append_rows({"projects": spark.createDataFrame([(1, "a")], "id long, name string")}, root)
    offered = spark.createDataFrame([("a",), ("b",)], "name string")
    for _ in range(2):
        stored = spark.read.parquet(f"{root}/projects")
        append_rows({"projects": warehouse.upsert_dimension(stored, offered, "name")}, root)
    assert rows(spark.read.parquet(f"{root}/projects")) == [(1, "a"), (2, "b")]
