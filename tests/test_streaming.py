import glob
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from sentilake.operators.archives import dedupe_posts
from sentilake.operators.summary import sentiment_summary
from sentilake.plans import inputs as I, queries as Q
from sentilake.schemas import EMOTIONS
from sentilake.streaming import history as TH
from sentilake.streaming.posts import stream_best_copy, stream_dedupe


def shown(df):
    return {r["hour_key"]: ([round(r[e], 9) for e in EMOTIONS],
                            [[(p["post_id"], round(p["contribution"], 9)) for p in t["top_posts"]] for t in r["top_contributors"] or []])
            for r in df.collect()}


def test_batches_add_up_and_replays_change_nothing(spark, sf_dir, tmp_path):
    posts = I.event_posts(spark, sf_dir)
    parts = posts.randomSplit([1.0, 1.0, 1.0], seed=5)
    path = str(tmp_path / "out")
    for n, part in enumerate(parts):
        part.write.parquet(f"{tmp_path}/in{n}")
    batch = lambda n: spark.read.parquet(f"{tmp_path}/in{n}")
    for n in (0, 1, 1, 2, 0):
        TH.merge_batch(batch(n), n, path)
    assert shown(spark.read.parquet(f"{path}/history")) == shown(sentiment_summary(posts, ["hour_key"]))


def test_states_stay_as_many_over_many_batches(spark, sf_dir, tmp_path):
    """Twenty batches that all touch the same days; now and then one is replayed."""
    posts = I.event_posts(spark, sf_dir).where("hour_key < '2024-01-03'")
    posts.withColumn("n", F.pmod(F.xxhash64("position"), F.lit(20))).write.partitionBy("n").parquet(f"{tmp_path}/in")
    path, files = str(tmp_path / "out"), []
    for n in range(20):
        for _ in range(2 if n % 7 == 3 else 1):
            TH.merge_batch(spark.read.schema(posts.schema).parquet(f"{tmp_path}/in/n={n}"), n, path)
        files.append(len(glob.glob(f"{path}/**/*.parquet", recursive=True)))
    assert max(files[2:]) <= files[2] <= 2 * 2 * 2 + 2
    assert shown(spark.read.parquet(f"{path}/history")) == shown(sentiment_summary(posts, ["hour_key"]))
    TH.merge_batch(posts.where("1 = 0"), 20, path)
    TH.merge_batch(posts.limit(5), 0, path, run="other")
    assert len(glob.glob(f"{path}/state/sums/day=*/run=other/upto=0/*.parquet")) >= 1


def test_stream_picks_up_late_files(spark, sf_dir, tmp_path):
    events = I.table(spark, sf_dir, "events")
    early, late = events.filter("event_id >= 100"), events.filter("event_id < 100")
    landed, out, ckpt = (str(tmp_path / d) for d in ("landed", "out", "ckpt"))
    early.write.parquet(landed)
    stream = I.as_event_posts(spark.readStream.schema(events.schema).parquet(landed))
    TH.stream_history(stream, out, ckpt).awaitTermination()
    late.write.mode("append").parquet(landed)
    TH.stream_history(stream, out, ckpt).awaitTermination()
    assert shown(spark.read.parquet(f"{out}/history")) == shown(sentiment_summary(I.as_event_posts(events), ["hour_key"]))


def test_stream_dedupe(spark, tmp_path):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(f"p{i % 3}", at + timedelta(minutes=i)) for i in range(9)]
    spark.createDataFrame(rows, "post_id string, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("post_id string, ts timestamp").parquet(str(tmp_path / "in"))
    unique = stream_dedupe(stream, "ts", "1 hour")
    unique.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "o")) \
        .trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["post_id"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["p0", "p1", "p2"]


def test_most_discussed_copy(spark, tmp_path):
    """Every column equals the batch choice; an id stays open until no copy can come."""
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(f"p{i % 5}", at + timedelta(minutes=7 * i), (i * 7) % 4, f"text {i}", i) for i in range(40)]
    rows += [("p0", at + timedelta(days=9), 0, "again", 100), ("late", at + timedelta(days=30), 1, "open", 101)]
    schema = "post_id string, ts timestamp, n int, text string, place int"
    for k, part in enumerate((rows[:20], rows[20:40], rows[40:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/part{k}")
    landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/part*")
    best = stream_best_copy(landed, "ts", "2 days", F.col("n"), ("place",))
    best.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "o")) \
        .trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.schema(best.schema).parquet(str(tmp_path / "o")).collect())
    batch = dedupe_posts(spark.createDataFrame(rows[:40], schema), size=F.col("n"), tie_cols=("place",))
    want = sorted([tuple(r) for r in batch.select(*best.columns).collect()] + [("p0", at.replace(tzinfo=None) + timedelta(days=9), 0, "again", 100)])
    assert [(g[0], *g[2:]) for g in got] == [(w[0], *w[2:]) for w in want] and best.columns == schema.replace(",", "").split()[::2]


def test_landed_files_grow_with_the_input_and_batches_do_not(spark, tmp_path, monkeypatch):
    """The table takes about eight of the files that a batch may consist of."""
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).repartition(2).write.parquet(f"{tmp_path}/in")
    table = spark.read.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(Q, "LANDED_FILE", Q.input_bytes(table) // 8 + 1)
    assert Q.files_per_batch(table, 2) == 4 and Q.files_per_batch(table.where("id < 0"), 100) == 1
    Q._landed_stream(table, str(tmp_path), 2).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c") \
        .option("path", f"{tmp_path}/o").trigger(availableNow=True).start().awaitTermination()
    landed = spark.read.parquet(f"{tmp_path}/landed").groupBy(F.input_file_name()).count().collect()
    assert len(landed) == 8 and max(r["count"] for r in landed) <= 2600
    assert len(glob.glob(f"{tmp_path}/c/commits/[0-9]*")) == 2
    assert spark.read.parquet(f"{tmp_path}/o").exceptAll(table).isEmpty() and spark.read.parquet(f"{tmp_path}/o").count() == 20_000


def test_listings_land_in_more_files_when_there_are_more(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "LANDED_FILE", Q.input_bytes(I.listings(spark, sf_dir)) // 6 + 1)
    monkeypatch.setattr(Q, "shared_dir", lambda _, name: f"{tmp_path}/{name}")
    assert Q.q_stream_listings(spark, sf_dir).count() == I.listings(spark, sf_dir).count()
    names = {f.rpartition("/")[2] for f in glob.glob(f"{tmp_path}/stream-listings/**/part-*.json", recursive=True)}
    assert len(names) == 6 and len(glob.glob(f"{tmp_path}/stream-listings/ckpt/commits/[0-9]*")) == 2
