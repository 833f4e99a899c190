import random

from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import plan_of
from wavetrawl.operators.dedup import first_by
from wavetrawl.operators.ordering import fetch_plan, number_rows, rank_within, schedule_bound
from wavetrawl.operators.skew import drop_frequent
from wavetrawl.sources.manifests import assign_shards, read_manifest, with_shard, write_manifest


def _hot_rows(n=4000):
    """A third of all rows under one key."""
    rng = random.Random(7)
    return [("hot" if rng.random() < 0.34 else f"k{rng.randrange(50)}", rng.randrange(200), i) for i in range(n)]


def test_number_rows(spark):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(7)
    got = {r.i: r.idx for r in number_rows(df, ["k", "v", "i"]).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda p: p[1])] == [i for _, _, i in sorted(rows)]
    assert sorted(got.values()) == list(range(len(rows)))


def test_rank_within_a_hot_group_that_spans_partitions(spark):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "k string, v int, i int").repartition(5)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = rank_within(df, "k", ["v", "i"])
        got = {r.i: r["rank"] for r in ranked.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    expected, seen = {}, {}
    for k, _, i in sorted(rows):
        seen[k] = seen.get(k, 0) + 1
        expected[i] = seen[k]
    assert got == expected


def test_rank_window_is_never_over_a_whole_group(spark):
    df = spark.createDataFrame(_hot_rows(50), "k string, v int, i int")
    assert "windowspecdefinition(k#" not in plan_of(rank_within(df, "k", ["v", "i"])).split("row_number")[1].split("\n")[0]


def test_fetch_plan(spark):
    links = [("http://a/2", 1), ("http://a/1", 2), ("http://b/1", 3), ("", 4), (None, 5), ("http://a/1", 6)]
    df = spark.createDataFrame(links, "audio_url string, link_pos int")
    rows = fetch_plan(df, delay=2.0).orderBy("host", "slot").collect()
    assert [(r.host, r.link_pos, r.slot, r.start_second) for r in rows] == [
        ("a", 2, 1, 0.0),
        ("a", 6, 2, 2.0),
        ("a", 1, 3, 4.0),
        ("b", 3, 1, 0.0),
    ]


def test_fetch_plan_never_has_too_many_requests_at_a_time(spark):
    rng = random.Random(3)
    for weights in ([1] * 40, [30, *[1] * 5], [5, 4, 3, *[1] * 60], [200, 1]):
        hosts = rng.choices([f"h{i}" for i in range(len(weights))], weights, k=200)
        links = [(f"http://{host}/{i}", i) for i, host in enumerate(hosts)]
        df = spark.createDataFrame(links, "audio_url string, link_pos int").repartition(5)
        rows = fetch_plan(df).collect()
        longest = max(map(hosts.count, hosts))
        assert len(rows) == 200 and len({(r.host, r.start_second) for r in rows}) == 200
        at = [r.start_second for r in rows]
        assert max(map(at.count, at)) <= 16 and max(r.lane for r in rows) < 16
        assert max(at) + 1 == max(longest, -(-200 // 16)) == schedule_bound(df).first().finish_second
    assert fetch_plan(df.limit(0)).count() == 0 and schedule_bound(df.limit(0)).first().finish_second == 0


def test_manifest_comes_out_of_one_write(spark, tmp_path):
    cuts = spark.range(1000).select(
        F.format_string("audio_%08d", "id").alias("id"), F.lit(0.0).alias("start"), F.lit(1.5).alias("duration"),
        F.lit("mono").alias("kind"), F.array(F.lit(0)).alias("channel"),
        F.struct(F.format_string("audio_%08d", "id").alias("id"), F.lit(16).alias("sampling_rate"),
                 F.col("id").alias("num_samples"), F.array(F.lit(0)).alias("channel_ids")).alias("recording"),
        F.map_from_arrays(F.array(F.lit("title")), F.array(F.lit("日本"))).alias("custom"),
    )
    seen = Observation()
    write_manifest(with_shard(cuts.repartition(6), 100).observe(seen, F.count("*").alias("n")), str(tmp_path))
    assert seen.get["n"] == 1000
    for table in ("cuts", "recordings"):
        folders = sorted((tmp_path / f"table={table}").glob("shard=*"))
        assert len(folders) == 10 and all(len(list(f.glob("part-*"))) == 1 for f in folders)
    got = read_manifest(spark, str(tmp_path)).drop("shard")
    assert sorted(got.select(F.to_json(F.struct(*cuts.columns))).collect()) == sorted(
        cuts.select(F.to_json(F.struct(*cuts.columns))).collect()
    )


def test_first_by_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(_hot_rows(), "k string, v int, i int")
    once = sorted(first_by(df, ["k"], ["v", "i"]).collect())
    assert once == sorted(first_by(df.repartition(13, "v"), ["k"], ["v", "i"]).collect())
    assert once == sorted(first_by(spark.createDataFrame(once, df.schema), ["k"], ["v", "i"]).collect())
    best = {}
    for k, v, i in _hot_rows():
        best[k] = min(best.get(k, (v, i)), (v, i))
    assert {r.k: (r.v, r.i) for r in once} == best


def test_drop_frequent(spark):
    rows = [*_hot_rows(), *(("once", 0, -1), ("twice", 0, -2), ("twice", 0, -3), (None, 0, -4))]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    assert sorted(r.i for r in drop_frequent(df, "k", 2).collect()) == [-4, -3, -2, -1]


def test_shards(spark):
    df = spark.range(250).withColumn("key", F.lpad(F.col("id").cast("string"), 4, "0")).drop("id")
    rows = assign_shards(df, ["key"], 100).collect()
    assert {int(r.key): (r.id, r.shard) for r in rows} == {n: (f"audio_{n:08d}", n // 100) for n in range(250)}
