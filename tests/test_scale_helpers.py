"""Skew and ordering helpers against plain Spark forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from grantflow.functions import ordered as od
from grantflow.functions.paging import paged_lists
from grantflow.functions.skew import spread_join


def skewed(spark):
    """A third of the rows share key 0."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"), F.col("id").alias("v")
    )


def test_spread_join_equals_join(spark):
    big = skewed(spark)
    other = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    other = other.where("k % 7 <> 3").unionByName(other.where("k = 0"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = spread_join(big, other, ["k"], how=how, rows=3000, rows_per_task=200)
        want = big.join(other, ["k"], how)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_spread_join_splits_the_hot_key(spark):
    big = skewed(spark)
    other = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plan = spread_join(big, other, ["k"], rows=3000, rows_per_task=200)._jdf.queryExecution().toString()
    assert "_salt" in plan
    assert "_salt" not in spread_join(big, other, ["k"], rows=3000, rows_per_task=2000)._jdf.queryExecution().toString()


def test_spread_join_bounds_the_rows_of_a_salt(spark):
    from grantflow.functions.skew import hot_keys

    hot = hot_keys(skewed(spark), ["k"], 200).collect()
    assert [tuple(r) for r in hot] == [(0, 5)]
    big = skewed(spark).where("k = 0").withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(5)))
    assert max(r["count"] for r in big.groupBy("_salt").count().collect()) < 300


def test_chunked_neighbours_and_running_values(spark):
    df = skewed(spark).withColumn("x", (F.col("v") * 7919) % 101)
    w = Window.partitionBy("k").orderBy("v")
    want = df.select(
        "k", "v", F.lag("x").over(w).alias("p"), F.lead("x").over(w).alias("n"),
        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.max("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
    )
    chunk = od.block_chunk(F.col("v"), 37)
    got = od.with_previous(df, ["k"], ["v"], ["x"], chunk)
    got = od.with_next(got, ["k"], ["v"], ["x"], chunk)
    got = od.with_running(got, ["k"], ["v"], {"s": ("sum", F.col("x")), "m": ("max", F.col("x"))}, chunk)
    got = got.select("k", "v", F.col("prev_x").alias("p"), F.col("next_x").alias("n"), "s", "m")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_running_max_with_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("a", 4, 3), ("a", 9, None)], "k string, o int, x int")
    got = od.with_running(df, ["k"], ["o"], {"m": ("max", F.col("x"))}, od.block_chunk(F.col("o"), 2))
    assert [r.m for r in got.orderBy("o").collect()] == [None, 5, 5, 5, 5]


def test_paged_lists_keep_everything(spark):
    rows = skewed(spark).select("k", F.col("v").cast("string").alias("v"))
    out = paged_lists(rows, ["k"], "v", "vs", page=100)
    assert out.where("k = 0").count() == 10 and out.where("k <> 0").agg(F.max("pages")).first()[0] == 1
    flat = out.select("k", F.explode("vs").alias("v"))
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, rows.distinct().collect()))


def test_pages_are_ranges_of_the_sorted_list(spark):
    rows = skewed(spark).select("k", F.format_string("%05d", "v").alias("v")).repartition(7)
    out = paged_lists(rows, ["k"], "v", "vs", page=30).collect()
    for k in {r.k for r in out}:
        mine = sorted((r for r in out if r.k == k), key=lambda r: r.page)
        want = sorted(r.v for r in rows.where(F.col("k") == k).collect()) if k < 3 else sorted(v for r in mine for v in r.vs)
        assert [v for r in mine for v in r.vs] == want
        assert [r.page for r in mine] == list(range(len(mine))) and {r.pages for r in mine} == {len(mine)}
        assert all(len(r.vs) == 30 for r in mine[:-1])


def test_pages_in_order_are_the_whole_sorted_list(spark):
    rows = skewed(spark).select("k", F.when(F.col("v") % 7 > 0, F.format_string("%05d", "v")).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, "a"), (-1, None)], "k long, v string"))
    paged = paged_lists(rows, ["k"], "v", "vs", page=30)
    assert [(r.page, r.pages, r.vs) for r in paged.where("k = -1").collect()] == [(0, 1, [])]
    assert paged.where("size(vs) = 0 and k >= 0").count() == 0
    lists = {}
    for r in sorted(paged.collect(), key=lambda r: r.page):
        lists.setdefault(r.k, []).extend(r.vs)
    got = [(k, ",".join(vs)) for k, vs in lists.items()]
    want = rows.groupBy("k").agg(F.concat_ws(",", F.sort_array(F.collect_set("v"))).alias("vs")).collect()
    assert sorted(got, key=str) == sorted(map(tuple, want), key=str)


def dense(spark):
    """A series with half of all rows, most of them in one minute, and some at one moment, beside twenty thin ones."""
    hot = spark.range(2000).select(
        F.lit("hot").alias("series"),
        (F.when(F.col("id") < 1500, F.col("id") * 40_000).when(F.col("id") < 1510, 70_000_000).otherwise(F.col("id") * 50_000_000) + 1_700_000_000_000_000).alias("us"), "id")
    thin = spark.range(2000).select(F.concat(F.lit("s"), F.col("id") % 20).alias("series"), (F.col("id") * 97_000_000 + 1_700_000_000_000_000).alias("us"), "id")
    return hot.unionByName(thin).withColumn("ts", F.timestamp_micros("us"))


def test_time_chunks_are_bounded_by_rows(spark):
    df = dense(spark)
    got = od.sized_chunks(df, ["series"], "ts", 86_400, rows=50)
    sizes = {(r.series, r["_slice"]): r["count"] for r in got.groupBy("series", "_slice").count().collect()}
    assert sum(sizes.values()) == 4000 and max(sizes.values()) <= 50
    slices = got.groupBy("series", "_slice").agg(F.min("us").alias("a"), F.max("us").alias("b")).orderBy("series", "_slice").collect()
    assert all(x["b"] < y["a"] for x, y in zip(slices, slices[1:]) if x.series == y.series)
    tied = od.sized_chunks(df, ["series"], "ts", 86_400, rows=5).groupBy("series", "_slice").agg(
        F.count("*").alias("n"), F.countDistinct("us").alias("moments")).where("n > 5").collect()
    assert [(r.series, r.n, r.moments) for r in tied] == [("hot", 10, 1)]


def test_states_of_a_dense_series(spark):
    from grantflow.operators.alerts import alert_states

    df = dense(spark).dropDuplicates(["series", "ts"]).withColumn("active", F.xxhash64("series", "us") % 7 != 0).drop("us", "id")
    plain, cut_up = (sorted(map(tuple, alert_states(df, 3, step_s=100, rows_per_task=n).select("series", "ts", "since", "state").collect()), key=str) for n in (10**9, 20))
    assert plain == cut_up and {r[3] for r in plain} == {"inactive", "pending", "firing"}


def test_group_alerts_has_its_pages(spark):
    from grantflow.operators.alerts import group_alerts

    rows = spark.range(25).select(
        F.lit("a").alias("alertname"), F.lit(None).cast("string").alias("cluster"), F.lit("s").alias("service"),
        F.lit("2024-01-01").cast("timestamp").alias("ts"), F.format_string("%02d", "id").alias("series"))
    out = sorted(group_alerts(rows, page=10).collect(), key=lambda r: r.page)
    assert [(r.page, r.pages, r.alerts, len(r.members)) for r in out] == [(0, 3, 25, 10), (1, 3, 25, 10), (2, 3, 25, 5)]
    assert [m for r in out for m in r.members] == [f"{i:02d}" for i in range(25)]


def test_cut_uses_the_configured_folder(spark):
    from grantflow.session import cut_table

    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    t = cut_table(spark.range(10))
    assert t.path.startswith(folder) and t.rows == 10


def test_exact_percentiles(spark):
    df = skewed(spark).withColumn("x", (F.col("v") * 7919) % 1013)
    got = od.exact_percentiles(df, ["k"], "x", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}, od.block_chunk(F.col("x"), 100))
    want = df.groupBy("k").agg(
        F.percentile("x", 0.5).alias("p50"), F.percentile("x", 0.95).alias("p95"), F.percentile("x", 0.0).alias("p0"),
        F.percentile("x", 1.0).alias("p100"),
    )
    rounded = lambda d: sorted((r.k, *(round(r[c], 6) for c in ("p50", "p95", "p0", "p100"))) for r in d.collect())
    assert rounded(got) == rounded(want)
