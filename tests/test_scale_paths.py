"""The ways taken beyond the size checks give the rows of the simple ways."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import lookup
from starloom.operators.ranking import rank_desc
from starloom.plans.audit import client_rule_audit, order_rule_audit


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_join_with_a_hot_key_and_null_keys(spark):
    facts = spark.range(6000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500)).alias("cle"),
    )
    table = spark.range(400).select(F.concat(F.lit("k"), F.col("id")).alias("cle"), F.col("id").alias("sk")).union(
        spark.createDataFrame([("hot", -5)], "cle string, sk bigint")
    )
    simple = lookup.attach_by_key(facts, table, "cle", F.col("id"), lookup_rows=401, limit=1000)
    spread = lookup.attach_by_key(facts, table, "cle", F.col("id"), lookup_rows=401, limit=0)
    assert rows(simple) == rows(spread) and spread.count() == 6000
    assert spread.filter("sk = -5").count() == 2000


def test_hot_rows_are_spread_over_the_shuffle(spark):
    facts = spark.range(40000).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("cle"))
    assert "hot" in lookup.hot_keys(facts, ["cle"], 0.01)["cle"]
    table = facts.select("cle").distinct().withColumn("sk", F.length("cle"))
    joined = lookup.attach_by_key(facts, table, "cle", F.col("id"), lookup_rows=20001, limit=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "_sel" in plan
    assert joined.filter("cle = 'hot' and sk = 3").count() == 20000


def test_no_task_gets_much_more_than_its_share(spark):
    """A third of the rows on one key and a tenth without a key."""
    facts = spark.range(0, 60000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 != 1, F.concat(F.lit("k"), F.col("id") % 7001)).alias("cle"),
    )
    table = spark.range(7001).select(F.concat(F.lit("k"), "id").alias("cle"), F.col("id").alias("sk"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        spread = lookup.attach_by_key(facts, table, "cle", F.col("id"), lookup_rows=7001, limit=0)
        loads = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(loads) == 60000 and max(loads) < 1.5 * 60000 / 16


def test_a_large_lookup_is_shuffled_however_small_its_files(spark, tmp_path):
    spark.range(50000).select("id", F.lit("always the same name").alias("nom")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    facts = spark.range(200000).select((F.col("id") % 50000).alias("id"), F.col("id").alias("ligne"))
    joined = lookup.attach_by_key(facts, table, "id", F.col("ligne"), lookup_rows=50000, limit=1000, hot=[3])
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.filter("nom is not null").count() == 200000


def test_products_per_quarter_and_city_are_shuffled_twice(spark, small):
    from starloom.plans import catalogue, reports

    w = catalogue.warehouse(spark, small)
    plan = reports.top_products(w.star, w.rows, catalogue.SETTINGS)._jdf.queryExecution().executedPlan().toString()
    # Once for the totals and once for both ranks; products, days and cities are broadcast.
    assert plan.count("Exchange hashpartitioning") == 2


def test_rank_in_bands_equals_rank(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 50 != 1, "b").alias("g"),
        F.when(F.col("id") % 97 != 0, (F.col("id") * 7919 % 1201 - 300) * F.lit(0.25)).cast("decimal(12,2)").alias("v"),
        "id",
    )
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))).cast("int"))
    banded = rank_desc(df, ["g"], "v", "r", group_rows=10, limit=0)
    assert rows(plain) == rows(banded)
    assert rows(plain) == rows(rank_desc(df, ["g"], "v", "r", group_rows=10))


def test_checked_broadcast(spark):
    small = spark.range(10)
    assert "ResolvedHint" in lookup.checked_broadcast(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in lookup.checked_broadcast(small, 9)._jdf.queryExecution().analyzed().toString()


def test_reports_agree_whatever_the_size_checks_say(spark, small):
    from dataclasses import replace

    from starloom.plans import catalogue, reports

    star, sizes = catalogue.warehouse(spark, small).star, catalogue.warehouse(spark, small).rows
    strict = replace(catalogue.SETTINGS, broadcast_rows=0, rank_group_rows=0)
    for build in reports.REPORTS.values():
        assert rows(build(star, sizes, strict)) == rows(build(star, sizes, catalogue.SETTINGS))


def test_fact_agrees_without_broadcast(spark, small):
    from dataclasses import replace

    from starloom.plans import catalogue, facts

    w = catalogue.warehouse(spark, small)
    strict = replace(catalogue.SETTINGS, broadcast_rows=0)
    assert rows(facts.sales_fact(w.orders, w.dimensions, w.rows, strict)) == rows(w.fact)


def test_audit_reads_each_source_once(spark, tmp_path):
    orders = ", ".join(f"{c} string" for c in schemas.ORDER_COLUMNS) + f", {schemas.ARRIVAL} long"
    clients = ", ".join(f"{c} string" for c in schemas.CLIENT_COLUMNS) + f", {schemas.ARRIVAL} long"
    lookup = spark.createDataFrame([("x", "X")], "variante string, ville string")
    for name, schema, audit in (("o", orders, order_rule_audit), ("c", clients, client_rule_audit)):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        lines = audit(spark.read.schema(schema).parquet(str(tmp_path / name)), lookup)
        assert lines._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
        assert {(r.avant, r.apres) for r in lines.collect()} == {(0, 0)}


def test_shuffles_start_with_more_partitions_for_more_rows(spark):
    from starloom.session import ADVISORY, FIRST_PARTITIONS, HUGE_METHOD, fit_to_rows

    before = {k: spark.conf.get(k, None) for k in (ADVISORY, FIRST_PARTITIONS, HUGE_METHOD)}
    try:
        for key in before:
            spark.conf.unset(key)
        fit_to_rows(spark, 60_000)
        assert spark.conf.get(FIRST_PARTITIONS, None) is None and spark.conf.get(HUGE_METHOD) == "8000"
        fit_to_rows(spark, 216_000_000)
        assert spark.conf.get(FIRST_PARTITIONS) == "864"
        fit_to_rows(spark, 36_000_000)
        assert spark.conf.get(FIRST_PARTITIONS) == "864"
        spark.conf.set(ADVISORY, "8m")
        fit_to_rows(spark, 36_000_000)
        assert spark.conf.get(ADVISORY) == "8m"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _tables_built(spark, folder, monkeypatch, query):
    """The names of the tables that a query stages on a warehouse of its own."""
    from starloom.plans import catalogue, dimensions, facts

    built = []
    for module, name in ((dimensions, "product_dimension"), (dimensions, "client_dimension"), (facts, "sales_fact")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, plain=plain, name=name, **b: built.append(name) or plain(*a, **b))
    monkeypatch.setattr(catalogue, "_warehouses", {})
    assert catalogue.QUERIES[query](spark, folder).count() > 0
    return built


def test_queries_on_dimensions_alone_build_no_sales(spark, small, monkeypatch):
    assert "sales_fact" not in _tables_built(spark, small, monkeypatch, "scd2_active_uniqueness")


def test_client_history_merges_no_products(spark, small, monkeypatch):
    built = _tables_built(spark, small, monkeypatch, "dim_client_history")
    assert built.count("product_dimension") == 1 and built.count("client_dimension") == 4


def test_lines_are_shuffled_with_the_keys_of_small_dimensions(spark, small):
    from dataclasses import replace

    from starloom.plans import catalogue, facts

    w = catalogue.warehouse(spark, small)
    sizes = {name: 10 if name != "dim_produit" else 1000 for name in w.rows}
    built = facts.sales_fact(w.orders, w.dimensions, sizes, replace(catalogue.SETTINGS, broadcast_rows=500))
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    # Below the window over products lie the joins to the small dimensions; their names go before it.
    above, below = plan.split("Window [last(", 1)
    assert "ville_livraison" not in above and "ville_livraison" in below
    union = below.split("Union", 1)[1].split("Project [", 1)[1].split("\n", 1)[0]
    assert "_sk_id_region" in union and "quantite_vendue" in union and "ville_livraison" not in union
    assert rows(built) == rows(w.fact)


def test_staged_tables_are_compressed_as_the_session_says(spark):
    from starloom.session import CODEC, stage

    assert all(".zstd." in path for path in stage(spark.range(3), "t").inputFiles())
    spark.conf.set(CODEC, "snappy")
    try:
        assert all(".snappy." in path for path in stage(spark.range(3), "t").inputFiles())
    finally:
        spark.conf.unset(CODEC)
