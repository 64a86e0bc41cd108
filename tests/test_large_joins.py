import pytest
from pyspark.sql import functions as F

from ticketloom import fixtures
from ticketloom.operators import joins
from ticketloom.session import materialise, scratch_path


@pytest.fixture(scope="module")
def zipf(spark):
    """A third of all rows has one key, the next keys have ever fewer."""
    n = 30_000
    rank = F.floor(F.pow(F.lit(2.0), F.rand(3) * 14)) - 1
    key = F.when(F.col("id") % 3 == 0, "k0").when(F.col("id") % 1000 == 1, None).otherwise(F.concat(F.lit("k"), rank.cast("string")))
    return materialise(spark.range(n).select("id", key.alias("term"), F.lit(1.0).alias("weight")).repartition(4), "zipf")


@pytest.fixture(scope="module")
def dim(spark):
    return materialise(spark.range(5000).select(F.concat(F.lit("k"), F.col("id") * 2).alias("term"), F.col("id").alias("idx")), "dim")


def test_equals_a_plain_join(spark, zipf, dim, monkeypatch):
    want = sorted(map(tuple, zipf.join(dim, "term").select("id", "term", "idx").collect()))
    assert sorted(map(tuple, joins.heavy_hitter_join(zipf, dim, "term").select("id", "term", "idx").collect())) == want
    monkeypatch.setattr(joins, "HEAVY_KEYS", 3)
    assert sorted(map(tuple, joins.heavy_hitter_join(zipf, dim, "term").select("id", "term", "idx").collect())) == want
    assert joins.heavy_hitter_join(zipf.limit(0), dim, "term").collect() == []


def test_frequent_keys_are_broadcast_and_the_rest_is_even(spark, zipf, dim, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_KEYS", 50)
    keys = [r.term for r in joins.heavy_keys(zipf, "term").collect()]
    assert "k0" in keys and len(keys) <= 50
    joined = joins.heavy_hitter_join(zipf, dim, "term")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    left = zipf.filter(F.col("term").isNotNull()).join(F.broadcast(spark.createDataFrame([(k,) for k in keys], "term string")), "term", "left_anti")
    sizes = [r["count"] for r in left.groupBy(F.pmod(F.xxhash64("term"), F.lit(8)).alias("task")).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_copies_of_a_large_dimension_are_not_broadcast(spark, zipf, dim, how):
    """Spark takes the copies to be no larger than the dimension, which alone it would broadcast."""
    joined = joins.dim_join(zipf, dim, ["term"], how, F.col("id"), small=False)
    got = sorted(map(tuple, joined.select("id", "term", "idx").collect()), key=str)
    assert got == sorted(map(tuple, zipf.join(dim, "term", how).select("id", "term", "idx").collect()), key=str)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_large_table_in_a_small_file_is_not_broadcast(spark):
    """Customers of a few MB in the file, over the rows that a broadcast may have."""
    sf = scratch_path(spark, "tables")
    n = joins.BROADCAST_ROWS + 50
    spark.range(n).select(
        F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"),
        F.lit(1).alias("c_nationkey"), F.lit("FURNITURE").alias("c_mktsegment")).write.parquet(f"{sf}/customer.parquet")
    spark.sql("SELECT 1 AS n_nationkey, 'FRANCE' AS n_name").write.parquet(f"{sf}/nation.parquet")
    docs = spark.createDataFrame(
        [(1, "un", "fr", "web"), (None, "rien", None, None), (3, None, "en", "web"), (4, "vier", "de", "mail"), (4, "vier", "de", "mail")],
        "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(
        [(1, n - 1, "1-URGENT"), (3, n + 7, "5-LOW"), (4, None, None)], "o_orderkey long, o_custkey long, o_orderpriority string",
    ).write.parquet(f"{sf}/orders.parquet")
    joined = fixtures.incidents(spark, sf)
    plain = spark.sql(fixtures.INCIDENTS, **{t: spark.read.parquet(f"{sf}/{t}.parquet") for t in fixtures.TABLES})
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [o_custkey" in plan
    assert [(r.demandeur is None, r.service) for r in joined.where("incident_id = 1").collect()] == [(False, "FRANCE")]
