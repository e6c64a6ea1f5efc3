"""Loads of experiment documents into all tables of the model: whole or not at all, and once however often they are repeated."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.indexing import index_rows
from tallywell.operators.warehouse import (
    experiment_channels,
    ingest_experiments,
    ingest_sites,
    new_experiments,
    upsert_dimension,
)
from tallywell.schemas import TABLES
from tallywell.storage import materialize, names_in

#: Tables that a load of documents appends to.
LOADED = (
    "projects", "plates", "microscopes", "objectives", "experiments", "experiment_wells", "experiment_well_sites",
    "experiment_imaging_channels",
)


class Model:
    """Tables below one folder, each a folder with a part per load.

    A load writes its part of each table, replacing what a failed attempt left, and its mark at last. Readers see the parts of
    marked loads only, so a load is seen in all tables or in none, and a load that is repeated changes nothing.
    One load runs at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str] = TABLES):
        self.spark, self.root, self.schemas = spark, root, schemas

    def loads(self) -> list[str]:
        """Names of the loads that are there."""
        return sorted(name.partition("=")[2] for name in names_in(self.spark, f"{self.root}/_loads") if name.startswith("load="))

    def read(self, table: str) -> DataFrame:
        paths = [f"{self.root}/{table}/load={load}" for load in self.loads() if table in self._tables_of(load)]
        if not paths:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*paths)

    def _tables_of(self, load: str) -> list[str]:
        return [name.removesuffix(".table") for name in names_in(self.spark, f"{self.root}/_loads/load={load}")]

    def append(self, load: str, rows: dict[str, DataFrame]) -> bool:
        """Append ``rows`` (by table) as the load of that name; False, and nothing is done, if it is there already."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", load):
            raise ValueError(f"not a name for a load: {load!r}")
        if load in self.loads():
            return False
        for table, frame in rows.items():
            typed = frame.to(self.spark.createDataFrame([], self.schemas[table]).schema)
            typed.write.mode("overwrite").parquet(f"{self.root}/{table}/load={load}")
        self._mark(load, list(rows))
        return True

    def _mark(self, load: str, tables: list[str]) -> None:
        """Make the load visible: its mark is written beside the others and moved to its place in one step."""
        jvm = self.spark._jvm
        place, own = (jvm.org.apache.hadoop.fs.Path(f"{self.root}/_loads/{name}") for name in (f"load={load}", f"new-{load}"))
        store = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.delete(own, True)
        store.mkdirs(own)
        for table in tables:
            store.create(jvm.org.apache.hadoop.fs.Path(own, f"{table}.table"), True).close()
        if not store.rename(own, place):
            raise OSError(f"the mark of load {load} could not be written")


def _numbered(stored: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the next free ids of ``stored``, in the order of ``order``."""
    last = F.coalesce(stored.agg(F.max("id")).scalar(), F.lit(0))
    return index_rows(rows, order).withColumn("id", F.col("idx") + 1 + last).drop("idx")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def load_documents(
    model: Model, load: str, documents: DataFrame, plate_types: DataFrame, wells: DataFrame, channels: DataFrame
) -> DataFrame:
    """Append the experiments of ``documents`` that the model lacks, with all that belongs to them.

    Names that the model lacks get the next free ids, then experiments, their wells, sites and channels. Experiments are known
    by project and name, so documents that come again, in this load or another, add nothing. Returns what was rejected:
    (project_name, experiment_name, what, reason); the experiment of an unknown plate type is left out whole, an unknown well
    or channel alone. A load that is there already is not looked at again and rejects nothing. ``wells``: (id, plate_type,
    well_name); ``channels``: (id, name).
    """
    if load in model.loads():
        return model.spark.createDataFrame([], "project_name string, experiment_name string, what string, reason string")
    stored = {name: model.read(name) for name in LOADED}
    experiment = ["project_name", "experiment_name"]
    projects = stored["projects"].select(F.col("id").alias("projectid"), F.col("name").alias("project_name"))
    existing = stored["experiments"].select("projectid", F.col("name").alias("experiment_name")).join(projects, "projectid").select(*experiment)
    existing = materialize(existing, "known-experiments")
    fresh = materialize(new_experiments(documents, existing), "new-documents")

    rows, no_type = ingest_experiments(fresh, existing, plate_types)
    rows = materialize(rows, "experiment-rows")
    names = {"projects": "project_name", "microscopes": "microscope", "objectives": "objective"}
    new = {table: upsert_dimension(stored[table], rows.select(F.col(c).alias("name")), "name") for table, c in names.items()}
    new["plates"] = upsert_dimension(stored["plates"], rows.select("barcode", "platetypeid"), "barcode", ["platetypeid"])
    new = {table: materialize(frame, table) for table, frame in new.items()}

    keyed = rows
    for table, column, key, id_name in (
        ("projects", "project_name", "name", "projectid"), ("plates", "barcode", "barcode", "plateid"),
        ("microscopes", "microscope", "name", "microscopeid"), ("objectives", "objective", "name", "objectiveid"),
    ):
        ids = stored[table].select("id", key).unionByName(new[table].select("id", key))
        ids = ids.select(F.col(key).alias("_key"), F.col("id").alias(id_name))
        keyed = keyed.join(ids, _same(column, "_key"), "left").drop("_key")
    numbered = _numbered(stored["experiments"], keyed.withColumn("description", F.lit(None).cast("string")), ["project_name", "name"])
    numbered = materialize(numbered, "experiments")
    ids = numbered.select("project_name", F.col("name").alias("experiment_name"), F.col("id").alias("experimentid"))

    sites, no_well = ingest_sites(fresh, existing, wells.select("plate_type", "well_name"))
    sites = materialize(sites.join(ids, experiment), "sites")
    plates_wells = fresh.select(*experiment, "plate_type").join(wells.select("plate_type", "well_name", F.col("id").alias("wellid")), "plate_type")
    used = sites.select("experimentid", *experiment, "well_name", "cell_line").distinct().join(
        plates_wells.select(*experiment, "well_name", "wellid"), [*experiment, "well_name"])
    used = materialize(_numbered(stored["experiment_wells"], used, ["experimentid", "wellid"]), "wells")
    well_ids = used.select("experimentid", "well_name", F.col("id").alias("experiment_wellid"))
    placed = _numbered(
        stored["experiment_well_sites"], sites.drop("cell_line", *experiment).join(well_ids, ["experimentid", "well_name"]),
        ["experiment_wellid", "site_id"],
    )

    listed, no_channel = experiment_channels(fresh, channels)
    listed = _numbered(stored["experiment_imaging_channels"], listed.join(ids, experiment), ["experimentid", "imaging_order_index"])
    model.append(load, {
        **new, "experiments": numbered, "experiment_wells": used, "experiment_well_sites": placed, "experiment_imaging_channels": listed,
    })
    return (
        no_type.select(*experiment, F.col("plate_type").alias("what"), F.lit("unknown plate type").alias("reason"))
        .unionByName(no_well.join(ids, experiment, "left_semi").select(*experiment, F.col("well_name").alias("what"), F.lit("unknown well").alias("reason")))
        .unionByName(no_channel.join(ids, experiment, "left_semi").select(*experiment, F.col("name").alias("what"), "reason"))
    )
