import pytest
from pyspark.sql import functions as F

from tallywell.functions import names, text
from tallywell.operators import loads
from tallywell.operators.loads import LOADED, Model, load_documents
from tallywell.schemas import EXPERIMENT
from tallywell.sources.experiments import dim_channels, dim_plate_types, with_experiment_name
from tallywell.storage import fresh_path


def document(n, project="p", plate_type="96-CO-3603", wells=("A01", "B02"), channels=("BF full",), nx=2, time="2024-01-01_10.00.00"):
    axis = lambda unit, size: {"unit": unit, "N": size, "d": 1.0}
    return {
        "project_name": project, "output_path": f"/data/e{n}", "plate_type": plate_type, "plate_name": f"plate{n // 2}",
        "microscope_name": f"m{n % 2}", "objective": "20x", "timestamp": time, "cell_line": "c", "well_list": list(wells),
        "channels_ordered": list(channels),
        "channels_config": [{"Name": c, "ExposureTime": 1.0, "AnalogGain": 2.0, "IlluminationIntensity": 3.0} for c in {*channels}],
        "grid_config": {"x": axis("mm", nx), "y": axis("mm", 1), "z": axis("mm", 1), "t": axis("s", 1)},
    }


@pytest.fixture(scope="module")
def dims(spark):
    wells = [(i + 1, "96-CO-3603", f"{r}{c:02d}") for i, (r, c) in enumerate((r, c) for r in "ABC" for c in (1, 2, 3))]
    return dim_plate_types(spark), spark.createDataFrame(wells, "id long, plate_type string, well_name string"), dim_channels(spark)


def documents(spark, *rows):
    return with_experiment_name(spark.createDataFrame(list(rows), EXPERIMENT))


def counts(model):
    out = {}
    for table in LOADED:
        ids = sorted(r.id for r in model.read(table).collect())
        assert ids == list(range(1, len(ids) + 1))  # without gaps, each once
        out[table] = len(ids)
    return tuple(out.values())


def test_loads_of_all_tables(spark, dims):
    model = Model(spark, fresh_path(spark, "model"))
    assert counts(model) == (0,) * 8 and model.loads() == []
    one = documents(spark, document(0), document(1, wells=("A01", "Z9")), document(1, time="2023-01-01_00.00.00", nx=3))
    rejected = load_documents(model, "one", one, *dims).collect()
    assert [tuple(r) for r in rejected] == []  # the earliest document of an experiment counts
    assert counts(model) == (1, 1, 2, 1, 2, 4, 2 * 2 + 2 * 3, 2)
    sites = {(r.experiment_wellid, r.site_id) for r in model.read("experiment_well_sites").collect()}
    assert sites == {(w, s) for w, n in ((1, 2), (2, 2), (3, 3), (4, 3)) for s in range(1, n + 1)}
    assert {(r.name, r.num_images_x, r.plateid) for r in model.read("experiments").collect()} == {("e0", 2, 1), ("e1", 3, 1)}

    two = documents(
        spark, document(1), document(2, "q", wells=("A01", "Z9", "A02"), channels=("BF full", "X-ray")), document(3, plate_type="24"),
    )
    want = {("q", "e2", "Z9", "unknown well"), ("q", "e2", "X-ray", "unknown channel"), ("p", "e3", "24", "unknown plate type")}
    assert {tuple(r) for r in load_documents(model, "two", two, *dims).collect()} == want
    after = (2, 2, 2, 1, 3, 6, 14, 3)
    assert counts(model) == after
    # Repeated by the same name, and by another one.
    assert load_documents(model, "two", two, *dims).count() == 0
    load_documents(model, "three", one, *dims)
    assert counts(model) == after and model.loads() == ["one", "three", "two"]


def test_a_load_that_fails_is_not_seen(spark, dims, monkeypatch):
    model = Model(spark, fresh_path(spark, "model"))
    load_documents(model, "one", documents(spark, document(0)), *dims)
    before = counts(model)
    two = documents(spark, document(2, "q"), document(4, "q"))

    def stop(self, load, tables):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(Model, "_mark", stop)  # all tables are written, the mark is not
        with pytest.raises(RuntimeError):
            load_documents(model, "two", two, *dims)
    assert counts(model) == before and model.loads() == ["one"]
    load_documents(model, "two", documents(spark, document(2, "q")), *dims)  # the next attempt has other rows
    assert counts(model) == (2, 2, 1, 1, 2, 4, 8, 2)


def test_appends_of_any_tables(spark):
    model = Model(spark, fresh_path(spark, "model"), {"a": "id long, v string", "b": "id long"})
    assert model.append("x", {"a": spark.range(2).select("id", F.lit(None).alias("v"))})
    assert model.append("y", {"a": spark.range(2, 3).withColumn("v", F.lit("w")), "b": spark.range(5)})
    assert not model.append("y", {"b": spark.range(9)})
    assert sorted(tuple(r) for r in model.read("a").collect()) == [(0, None), (1, None), (2, "w")]
    assert model.read("b").count() == 5
    with pytest.raises(ValueError):
        model.append("../x", {})
    assert loads.LOADED


def test_ascii_of_all_of_unicode(spark):
    pairs = [("𝐀b.tif", "Ab.tif"), ("ﬁle½.tif", "file12.tif"), ("Ångström 細胞.tif", "Angstrom_.tif"), ("𝟙𝟚㎏", "12kg"), ("😀.tif", "tif")]
    got = spark.createDataFrame([(a,) for a, _ in pairs], "t string").select(names.sanitize(F.col("t"))).collect()
    assert [r[0] for r in got] == [b for _, b in pairs]


def test_strip_takes_what_python_takes(spark):
    rows = [f"{c}a{c}b{c}" for c in map(chr, range(0x3100)) if c.isspace() or c in "​﻿\x00"]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select(text.strip(F.col("t"))).collect()
    assert [r[0] for r in got] == [r.strip() for r in rows]
