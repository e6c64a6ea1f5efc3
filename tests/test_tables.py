import pytest
from pyspark.sql import functions as F

from tallywell.functions import names, numbers
from tallywell.operators import indexing, tabular
from tallywell.operators.progress import throughput_report
from tallywell.sources import experiments as ex
from tallywell.sources import tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def fines(spark):
    data = [("AB", "363.0"), ("AB", "363.0"), (None, "abc"), ("CD", ""), ("CD", "12.5"), (None, None)]
    return spark.createDataFrame(data, "Make string, `Fine amount` string")


def test_cast_makes_bad_values_null_and_max_is_counted(spark):
    cast = tabular.cast_column(fines(spark), "Fine amount")
    assert cast.schema["Fine amount"].dataType.simpleString() == "float"
    assert rows(tabular.count_at_max(cast, "Fine amount")) == [(363.0, 2)]


def test_share_counts_nulls(spark):
    shares = {r["Make"]: (r["n"], r["share"]) for r in tabular.group_share(fines(spark), "Make").collect()}
    assert shares == {"AB": (2, 2 / 6), "CD": (2, 2 / 6), None: (2, 2 / 6)}
    assert tabular.top_groups_share(fines(spark), "Make", 2).columns == ["Make", "share"]


def test_drop_ignores_case_and_unknown_names(spark):
    assert tabular.drop_columns(fines(spark), "MAKE", "nothing").columns == ["Fine amount"]


def test_mode_tie_goes_to_smaller_value(spark):
    df = spark.createDataFrame([("T", "b"), ("T", "a"), ("U", "c"), ("U", "c")], "make string, color string")
    assert rows(tabular.mode_where(df, F.col("make") == "T", "color")) == [("a", 1)]


def test_linear_fit_of_recorded_measurements(spark):
    points = [(1, 8.07, 10.11), (2, 16.30, 17.35), (4, 13.40, 14.14), (6, 14.45, 15.10), (8, 15.08, 15.26)]
    df = spark.createDataFrame(points, "workers int, start double, end double")
    minutes = (numbers.clock_hours(F.col("end")) - numbers.clock_hours(F.col("start"))) * 60
    df = df.withColumn("minutes", minutes)
    assert [round(r["minutes"]) for r in df.orderBy("workers").collect()] == [124, 65, 34, 25, 18]
    fit = tabular.linear_fit(df.withColumn("rate", 228 / F.col("minutes")), "workers", "rate").first()
    assert (round(fit["slope"], 4), round(fit["intercept"], 4)) == (1.5124, 0.4156)


def test_throughput_without_duration_is_null(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' AS start, timestamp'2024-01-01' AS end, 5 AS units, 0 AS workers")
    row = throughput_report(df, "units", "workers").first()
    assert row["minutes"] == 0 and row["units_per_minute"] is None and row["units_per_minute_per_worker"] is None


def test_percent_and_fixed_text(spark):
    df = spark.sql("SELECT 1 AS a, 3 AS b, 0 AS z")
    pct = numbers.percent(F.col("a"), F.col("b"))
    got = df.select(
        numbers.percent_text(pct), numbers.percent(F.col("a"), F.col("z")), numbers.fixed_text(F.lit(2.0)), numbers.fixed_text(F.lit(1.239), 0)
    ).first()
    assert tuple(got) == (" 33.33%", None, "2.00", "1")


def test_site_grid_wraps_on_one_based_number(spark):
    df = spark.range(1, 5).select(F.col("id").cast("int").alias("s"))
    two, one = F.lit(2), F.lit(1)
    grid = df.select(numbers.site_grid(F.col("s"), two, two, one, one).alias("g")).select("g.*").collect()
    assert [r["site_x"] for r in grid] == [1, 0, 1, 0]
    assert [r["site_y"] for r in grid] == [0, 1, 1, 0]
    sane = df.select(numbers.site_grid(F.col("s"), two, two, one, one, zero_based=True).alias("g")).select("g.*").collect()
    assert [(r["site_x"], r["site_y"]) for r in sane] == [(0, 0), (1, 0), (0, 1), (1, 1)]


def test_well_grid_sizes_and_unknown_size(spark):
    plates = spark.createDataFrame([(1, 96), (2, 384)], "id int, num_wells int")
    wells = ex.well_grid(plates)
    for plate, size, last in ((1, 96, "H12"), (2, 384, "P24")):
        named = [r["well_name"] for r in wells.where(F.col("id") == plate).collect()]
        assert (len(set(named)), min(named), max(named)) == (size, "A01", last)
    with pytest.raises(Exception, match="unknown number of wells: 24"):
        ex.well_grid(spark.createDataFrame([(3, 24)], "id int, num_wells int")).collect()


def test_path_functions(spark):
    paths = ["b/k/x.tar.gz", "b/.hidden", "plain", "b/UP.TIF", "b/../../we ird (1)é.json", "b/._x_."]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    p = F.col("p")
    got = df.select(names.stem(p), names.suffix(p), names.media_type(p), names.sanitize(names.base_name(p))).collect()
    assert [tuple(r) for r in got] == [
        ("x.tar", ".gz", "application/octet-stream", "x.tar.gz"),
        (".hidden", "", "application/octet-stream", "hidden"),
        ("plain", "", "application/octet-stream", "plain"),
        ("UP", ".TIF", "image/tiff", "UP.TIF"),
        ("we ird (1)é", ".json", "application/json", "we_ird_1e.json"),
        ("._x_.", "", "application/octet-stream", "x"),
    ]


def test_union_by_suffix_and_unknown_suffix(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(3, 5).selectExpr("id", "id * 2 AS twice").write.option("header", "true").csv(str(tmp_path / "b.csv"))
    df = tables.scan_by_suffix(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.csv")], "id long, twice long")
    assert rows(df.select("id", "twice")) == [(0, None), (1, None), (2, None), (3, 6), (4, 8)]
    with pytest.raises(ValueError, match="unknown file suffix"):
        tables.scan_by_suffix(spark, ["x.xlsx"])


def test_csv_types_are_inferred_without_schema(spark, tmp_path):
    (tmp_path / "c.csv").write_text("x_mm,t\n0.5,2024-01-01 00:00:00\n")
    df = tables.scan_csv_typed(spark, str(tmp_path / "c.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["double", "timestamp"]


def test_sql_parameters_are_values(spark):
    df = spark.createDataFrame([("a'b",), ("c",)], "name string")
    assert rows(tables.sql_query(spark, "SELECT name FROM {t} WHERE name = :n", {"t": df}, n="a'b")) == [("a'b",)]


def test_preview_has_at_most_n_rows(spark):
    got = tables.preview_tables({"big": spark.range(100), "small": spark.range(2)}, 5)
    assert {name: frame.count() for name, frame in got.items()} == {"big": 5, "small": 2}


def test_random_columns_are_uniform_and_repeatable(spark):
    df = tables.random_columns(spark.range(20_000), seed=3)
    assert df.columns == ["id", "a", "b", "c", "d"]
    stats = df.agg(F.min("a"), F.max("a"), F.avg("b")).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.02
    assert rows(df.limit(5)) == rows(tables.random_columns(spark.range(20_000), seed=3).limit(5))


def test_zip_columns_pads_the_shorter_side(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "n int, v string")
    b = spark.createDataFrame([(9, "z")], "m int, v string")
    assert rows(indexing.zip_columns(a, b, ["n"], ["m"])) == [(1, "x", 9, "z"), (2, "y", None, None)]


def test_schema_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    assert rows(tabular.schema_rows(df)) == [(0, "a", "int", 2), (1, "b c", "string", 1)]
