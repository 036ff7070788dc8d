"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import headwater.plans  # noqa: F401
from headwater.operators import joins as J
from headwater.operators import projects as P
from headwater.operators import raster as R
from headwater.operators import reshape
from headwater.plans.bindings import Tables
from headwater.plans.registry import REGISTRY

# queries that write files or iterate while they are built
EAGER = ("src_", "sink_", "stream_", "incremental", "partition_", "table_copy", "schema_diff", "dataset_", "vec_dissolve", "vec_bounds", "rme_wide_dissolved")
LAZY = [n for n in REGISTRY if not n.startswith(EAGER)]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_udf(spark, sf_dir, name):
    text = plan(REGISTRY[name].run(spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "RoundRobin"):
        assert operator not in text
    if not name.startswith(("vec_", "geometry_", "ras_zone")):
        assert "Python" not in text and "ArrowEval" not in text


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    Tables(spark, sf_dir).search_index.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_search_filters_reach_the_scan(spark, stored):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    params = {"createdOn": {"from": "1996-01-01"}, "visibility": "PUBLIC", "bbox": [-120, 26, -70, 47], "ownedBy": {"id": "0" * 36, "type": "USER"}}
    text = plan(P.search_projects(stored, params).select("project_id"))
    for pushed in ("GreaterThanOrEqual(created_on", "EqualTo(visibility,PUBLIC)", "LessThanOrEqual(xmin", "EqualTo(owner_id", "EqualTo(owner_type,USER)"):
        assert pushed in text
    assert "attributed_org_id" not in text.split("ReadSchema")[1]


def test_page_is_a_top_k(stored):
    assert "TakeOrderedAndProject" in plan(P.search_page(stored, "NAME_ASC", limit=10))


def test_statistics_read_each_table_once(spark, sf_dir):
    text = plan(REGISTRY["huc_statistics"].run(spark, sf_dir))
    assert text.count("/lineitem.parquet") <= 1 and "l_extendedprice" not in text


def test_epochs_without_repeats_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, 2.0)], "fid int, wet_5yr_1989_1993_68pc_area double")
    assert "Exchange" not in plan(reshape.epoch_table(df, unique=True))
    assert plan(reshape.epoch_table(df)).count("Exchange") == 1


def test_cells_cross_one_exchange_for_all_averages(spark):
    """Ragged edges, several factors: the averages are those of the cells, and cells are dealt once."""
    cells = spark.range(37 * 23).select((F.col("id") % 2).cast("int").alias("raster_id"), F.floor(F.col("id") / 23).alias("r"), (F.col("id") % 23).alias("c"), (F.col("id") * 7 % 31).cast("double").alias("value"))
    cells = cells.unionByName(cells.withColumn("raster_id", F.lit(3)).limit(50))
    head = spark.createDataFrame([(0, 37, 23), (1, 90, 99), (3, 5, 5)], "raster_id int, n_rows int, n_cols int")
    out = R.overviews(cells, head, 2, "AVERAGE")
    rows, want = cells.collect(), {}
    for raster, factors in ((0, R.overview_levels(37, 23, 2)), (1, R.overview_levels(90, 99, 2)), (3, R.overview_levels(5, 5, 2))):
        for f in factors:
            for x in rows:
                if x.raster_id == raster:
                    want.setdefault((raster, f, x.r // f, x.c // f), []).append(x.value)
    assert {(x.raster_id, x.factor, x.r, x.c): round(x.value, 9) for x in out.collect()} == {k: round(sum(v) / len(v), 9) for k, v in want.items()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    found = plan(R.overviews(cells, head, 2, "AVERAGE"))
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert found.count("Exchange hashpartitioning") == 1


def test_nearest_overviews_need_no_shuffle(spark):
    cells = spark.createDataFrame([(1, 0, 0, 1.0)], "raster_id int, r int, c int, value double")
    head = spark.createDataFrame([(1, 512, 512)], "raster_id int, n_rows int, n_cols int").hint("broadcast")
    assert "hashpartitioning" not in plan(R.overviews(cells, head, 64))


def test_hot_watershed_is_counted_before_it_moves(spark):
    target = spark.range(100000).select(F.lit("1").alias("huc10"), F.col("id").cast("string").alias("project_id"), F.lit("b").alias("bounds_id"))
    source = target.limit(5).select("*", F.lit("t").alias("project_type_id"), F.lit("o").alias("owner_name"))
    text = plan(J.match_by_huc(source, target))
    assert "partial_count" in text and "collect_list" not in text
