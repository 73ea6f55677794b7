"""A third of all rows on one key: results stay whole and the hot partition is split."""

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import order_stats
from sparkmart.operators.lookup import resolve_key_or
from sparkmart.operators.order_stats import quantiles, rank_in_group
from sparkmart.plans import clients, fact, products
from sparkmart.session import stored


@contextmanager
def small_partitions(spark):
    """Thresholds scaled down so that a few thousand rows count as a large partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    df.collect()
    return execution.executedPlan().toString()


@pytest.fixture(scope="module")
def hot_orders(spark):
    """30,000 lines; client, courier and city 0 hold a third of them."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    lines = spark.range(30000, numPartitions=8).select(
        F.col("id").cast("string").alias("id_commande"),
        hot.cast("string").alias("id_client"), hot.cast("string").alias("id_produit"),
        hot.cast("string").alias("ville_livraison"), hot.cast("string").alias("id_livreur"),
        F.lit(date(2024, 1, 1)).alias("date_commande"), F.col("id").alias("quantite"),
        F.lit(1).cast("decimal(18,2)").alias("montant_ht"), F.lit(1).cast("decimal(18,2)").alias("montant_ttc"),
        F.lit(1).alias("delai_livraison_jours"), F.lit("livré").alias("statut"),
    )
    return stored(lines)


def dimension(spark, natural, surrogate):
    return stored(
        spark.range(1000).select(F.col("id").cast("string").alias(natural), (F.col("id") + 1).alias(surrogate), F.lit(True).alias("est_actif"))
    )


def test_fact_splits_hot_clients_and_couriers(spark, hot_orders):
    with small_partitions(spark):
        sales = fact.build_sales_fact(
            hot_orders,
            dimension(spark, "id_client_nk", "id_client_sk"), dimension(spark, "id_produit_nk", "id_produit_sk"),
            dimension(spark, "ville", "id_region"), dimension(spark, "id_livreur_nk", "id_livreur"),
        )
        text = final_plan(sales)
        assert text.count("SortMergeJoin(skew=true)") >= 4
        assert sales.count() == 30000
        assert sales.filter("id_client = 1 AND id_livreur = 1 AND id_region = 1 AND id_produit = 1").count() == 10020


def test_lookup_with_default_splits_a_hot_key(spark, hot_orders):
    with small_partitions(spark):
        df = resolve_key_or(hot_orders, "id_livreur", dimension(spark, "nk", "sk").filter("sk > 1"), "nk", "sk", "r", 1)
        assert "SortMergeJoin(skew=true)" in final_plan(df)
        assert df.filter("r = 1").count() == 10020


def test_hot_email_is_whole(spark):
    data = spark.range(9000).select(
        F.col("id").cast("string").alias("id_client"),
        F.when(F.col("id") % 3 == 0, "hot@x.ma").otherwise(F.concat(F.col("id").cast("string"), F.lit("@x.ma"))).alias("email"),
        F.lit("2024-01-01").alias("date_inscription"),
    )
    with small_partitions(spark):
        assert clients.keep_latest_email(data).count() == 6001
        merged = clients.merged_clients(data)
        assert merged.count() == 9000
        assert merged.select("id_survivant").distinct().count() == 6001


def test_statistics_of_a_hot_group(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 AS string)) AS g", "cast(id AS double) AS v")
    with small_partitions(spark):
        medians = {r._group.g: r.m for r in quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
        assert medians["hot"] == 14998.5 and len(medians) == 51
        ranked = rank_in_group(df, ["g"], "v", "rk")
        assert ranked.filter("g = 'hot'").agg(F.max("rk"), F.countDistinct("rk")).first()[:] == (10000, 10000)


def test_narrow_range_of_a_hot_group(spark):
    """100,000 values with the same leading digits lie in one bucket; it is cut into parts."""
    df = spark.range(100000, numPartitions=4).selectExpr("'g' AS g", "1000000000 + id / 1000 AS v")
    keyed = order_stats._keyed(df, ["g"], "v")
    assert keyed.select("_bucket").distinct().count() == 1
    with small_partitions(spark):
        ranked = rank_in_group(df, ["g"], "v", "rk").withColumn("task", F.spark_partition_id())
        assert ranked.agg(F.min("rk"), F.max("rk"), F.countDistinct("rk")).first()[:] == (1, 100000, 100000)
        counts = keyed.groupBy("_group", "_bucket", "_value").agg(F.count(F.lit(1)).alias("_count")).withColumn("_in_front", F.lit(0))
        windows = order_stats._place(counts).select(F.spark_partition_id().alias("task")).distinct().count()
        assert windows > 1
        assert quantiles(df, ["g"], "v", {"m": 0.5}).first().m == pytest.approx(1000000049.9995, abs=1e-6)


def test_segments_of_a_hot_client(spark, hot_orders):
    got = {r.id_client: r.ca_12m for r in clients.client_segments(hot_orders).collect()}
    assert got["0"] == 10020.0 and len(got) == 1000


def test_dense_values_are_cut_evenly(spark):
    """All values but one lie close together: cuts of equal width would leave them in one part."""
    n = 200_000
    df = spark.range(n + 1).select(F.lit("g").alias("g"), F.when(F.col("id") == n, 1.9).otherwise(1.0 + F.col("id") * 1e-12).alias("v"), "id")
    counts = order_stats._keyed(df, ["g"], "v").groupBy("_group", "_bucket", "_value").agg(F.count(F.lit(1)).alias("_count"))
    parted = order_stats._parted(counts.withColumn("_part", F.lit(0).cast("bigint")), ["_group", "_bucket", "_part"])
    assert parted.groupBy("_bucket", "_part").count().agg(F.max("count")).first()[0] <= 2 * order_stats._PART
    assert quantiles(df, ["g"], "v", {"m": 0.5}).first().m == 1.0 + (n // 2) * 1e-12
    assert rank_in_group(df, ["g"], "v", "rk").filter(F.col("rk") != n + 1 - F.col("id")).isEmpty()


def test_products_of_one_task_are_cleaned_by_many(spark):
    fields = ["id_produit", "nom", "categorie", "sous_categorie", "marque", "fournisseur", "prix_catalogue", "origine_pays", "date_creation", "actif"]
    rows = spark.range(0, 1000, 1, 1).select(*[F.col("id").cast("string").alias(name) for name in fields])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few rows are put together again
    try:
        cleaned = products.clean_products(rows).select("id_produit", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len({r.id_produit for r in cleaned}) == len(cleaned) == 1000 and len({r.part for r in cleaned}) > 1
