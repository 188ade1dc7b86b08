from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sentilake.operators import labelling as L
from sentilake.operators.numbering import running_offsets
from sentilake.operators.posts import conform_posts
from sentilake.plans.runs import finish_labels, label_progress, label_records, label_run
from sentilake.schemas import SCORES
from sentilake.sinks import archives as KA, labelling as KL
from sentilake.sources import stores as R

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)


@pytest.mark.parametrize("n", [0, 1, 4096, 4097, 5000])
def test_manifest(spark, n):
    rows = L.shard_manifest(spark, n, NOW).orderBy("shard_id").collect()
    want = []
    for start in range(0, n, 2048):
        end = min(start + 2048, n) - 1
        want.append((f"shard-{start // 2048 + 1:06d}", start, end, -(-(end - start + 1) // 256)))
    assert [(r["shard_id"], r["start_idx"], r["end_idx"], r["chunk_total"]) for r in rows] == want
    assert all(r["status"] == "PENDING" and r["chunk_done"] == 0 and r["attempts"] == 0 for r in rows)


def test_chunks_resume_after_finished_records(spark):
    tasks = L.shard_manifest(spark, 600, NOW, 300, 100).withColumn(
        "chunk_done", F.when(F.col("start_idx") == 0, F.lit(150)).otherwise(F.lit(300)).cast("bigint"))
    assert [tuple(r) for r in L.chunk_ranges(tasks, 100).orderBy("lo").collect()] == [
        ("shard-000001", 150, 249, "chunk-0000150-0000249"), ("shard-000001", 250, 299, "chunk-0000250-0000299")]


def test_row_numbers_follow_the_published_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("k"))
    KA.publish_dataset(df.orderBy("k"), str(tmp_path), "r1")
    stored = R.read_dataset(spark, str(tmp_path), "r1")
    rows = L.assign_shards(L.index_rows(stored), 300)
    assert rows.filter("k <> row_idx").count() == 0 and rows.count() == 1000
    assert {r["shard_id"]: r["count"] for r in rows.groupBy("shard_id").count().collect()} == {
        "shard-000001": 300, "shard-000002": 300, "shard-000003": 300, "shard-000004": 100}


def test_lease_candidates_limit_before_they_look(spark):
    hour = timedelta(hours=1)
    tasks = [(f"s{i:02d}", "IN_PROGRESS", NOW - (100 - i) * hour, NOW + hour) for i in range(24)]
    tasks += [("t1", "PENDING", NOW - 50 * hour, None), ("t2", "PENDING", NOW, None), ("t3", "COMPLETED", NOW - 999 * hour, None),
              ("t4", "IN_PROGRESS", NOW - 200 * hour, NOW - hour), ("t5", "IN_PROGRESS", NOW - 201 * hour, None)]
    df = spark.createDataFrame(tasks, "shard_id string, status string, updated_at timestamp, lease_expires_at timestamp")
    assert {r["shard_id"] for r in L.lease_candidates(df, NOW).collect()} == {"t4", "t5"}
    assert {r["shard_id"] for r in L.lease_candidates(df, NOW, 99).collect()} == {"t1", "t2", "t4", "t5"}
    full = df.withColumns({"chunk_done": F.lit(2), "attempts": F.lit(1)})
    got = {r["status"]: (r["n_shards"], r["expired_leases"]) for r in L.annotation_progress(full, NOW).collect()}
    assert got == {"PENDING": (2, 0), "COMPLETED": (1, 0), "IN_PROGRESS": (26, 2)}


def test_records_write_once_and_resume(spark, tmp_path):
    posts = spark.createDataFrame([("a", (1, 2, 3, 4, 5, 6)), ("b", None)], f"post_id string, scores {SCORES.simpleString()}")
    records = L.annotation_records(posts.withColumn("shard_id", F.lit("shard-000001")), "r", "m", "w", keep=("shard_id",))
    path = str(tmp_path / "out")
    KL.write_annotations(records, path)
    with pytest.raises(Exception, match="(?i)exist"):
        KL.write_annotations(records, path)
    back = spark.read.schema(records.schema).json(path)
    assert tuple(L.annotation_metrics(back).first()) == (2, 1)
    more = posts.unionByName(posts.limit(1).withColumn("post_id", F.lit("c")))
    left = L.pending_rows(more, back.withColumnRenamed("id", "post_id"))
    assert [r["post_id"] for r in left.collect()] == ["c"]
    both = {r["post_id"]: r["scores"] for r in L.combine_annotations(more.drop("scores"), back).collect()}
    assert tuple(both["a"]) == (1, 2, 3, 4, 5, 6) and both["b"] is None and both["c"] is None


def test_manifest_is_replaced(spark, tmp_path):
    run = spark.range(1).withColumn("model", F.lit("m"))
    for n in (5000, 100):
        KL.write_manifest(run, L.shard_manifest(spark, n, NOW), str(tmp_path), "r")
    assert R.read_shard_tasks(spark, str(tmp_path), "r").count() == 1
    assert R.read_run(spark, str(tmp_path), "r").first()["model"] == "m"


def test_row_numbers_over_many_files(spark, tmp_path):
    """Offsets add up in groups of files; no window runs over all of them."""
    spark.range(0, 900, 1, 300).select((F.col("id") * 7).alias("k")).write.parquet(f"{tmp_path}/revision=r1")
    stored = R.read_dataset(spark, str(tmp_path), "r1")
    rows = L.index_rows(stored)
    assert rows.where("k <> 7 * row_idx").isEmpty() and rows.count() == 900
    assert "SinglePartition" not in rows._jdf.queryExecution().executedPlan().toString()
    counts = spark.range(0, 1000, 1, 9).select("id", (F.col("id") % 5).alias("n")).withColumn("tie", -F.col("id"))
    for groups in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", groups)
        got = {r["id"]: r["before"] for r in running_offsets(counts, ["tie", "id"], "n", "before").collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert got == {i: sum(k % 5 for k in range(i + 1, 1000)) for i in range(1000)}


@pytest.mark.parametrize("broadcast_bytes", [L.BROADCAST_BYTES, 0])
def test_resume_by_bitmap(spark, broadcast_bytes):
    rows = spark.range(70_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("post_id"), F.col("id").alias("row_idx"), F.lit("text").alias("post_text"))
    done = [0, 1, 2, 7, 8, 32_766, 32_767, 32_768, 65_535, 65_536, 69_999]
    records = spark.createDataFrame([(i,) for i in done * 2] + [(None,)], "row_idx long")
    left = L.pending_by_index(rows, records, broadcast_bytes=broadcast_bytes)
    assert left.columns == rows.columns
    assert {r["row_idx"] for r in left.select("row_idx").collect()} == set(range(70_000)) - set(done)
    plan = left._jdf.queryExecution().executedPlan().toString()
    if broadcast_bytes:
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert L.pending_by_index(rows, records.limit(0)).count() == 70_000


def test_rows_without_an_id_are_labelled_once(spark, tmp_path):
    posts = spark.createDataFrame([(None, "a"), ("x", "b"), (None, "c")], "post_id string, post_text string")
    KA.publish_dataset(conform_posts(posts), f"{tmp_path}/set", "r1")
    load = lambda: lambda prompts: ['{"joy": 1}'] * len(prompts)
    for _ in range(3):
        metrics = label_run(spark, f"{tmp_path}/set", "r1", f"{tmp_path}/run", "run", NOW, load, "m", "w", only=F.col("row_idx") < 9)
    assert metrics.first()["items_annotated"] == 3
    assert sorted(r["row_idx"] for r in label_records(spark, f"{tmp_path}/run", "run").collect()) == [0, 1, 2]


def test_a_finished_run_is_published_once(spark, tmp_path):
    posts = spark.createDataFrame([(None, "a"), ("x", "b"), (None, "c"), ("x", "d"), ("y", "e")], "post_id string, post_text string")
    KA.publish_dataset(conform_posts(posts.coalesce(1)), f"{tmp_path}/set", "r1")
    load = lambda: lambda prompts: ['{"joy": %d}' % (2 + "abcde".index(p[p.index("POST: ") + 6])) if "POST: " in p else "none" for p in prompts]
    step = lambda only: label_run(spark, f"{tmp_path}/set", "r1", f"{tmp_path}/run", "run", NOW, load, "m", "w", shard_size=2, only=only)
    step(F.col("row_idx") < 3)
    assert {r["status"]: r["n_shards"] for r in label_progress(spark, f"{tmp_path}/run", "run", NOW).collect()} == \
        {"COMPLETED": 1, "IN_PROGRESS": 1, "PENDING": 1}
    with pytest.raises(ValueError, match="2 unfinished"):
        finish_labels(spark, f"{tmp_path}/set", "r1", f"{tmp_path}/run", "run")
    step(None)
    # A second record of a row, as a lost worker leaves it.
    label_records(spark, f"{tmp_path}/run", "run").where("row_idx = 1").withColumn("scores", F.lit(None).cast(SCORES)).drop("run_id") \
        .write.mode("append").json(f"{tmp_path}/run/records/run_id=run")
    rows = finish_labels(spark, f"{tmp_path}/set", "r1", f"{tmp_path}/run", "run").orderBy("row_idx").collect()
    assert [(r["post_id"], r["post_text"], r["shard_id"]) for r in rows] == [
        (None, "a", "shard-000001"), ("x", "b", "shard-000001"), (None, "c", "shard-000002"), ("x", "d", "shard-000002"), ("y", "e", "shard-000003")]
    assert len({r["scores"]["joy"] for r in rows}) == 5 and all(r["model_id"] == "m" for r in rows)
    with pytest.raises(Exception, match="(?i)exist"):
        finish_labels(spark, f"{tmp_path}/set", "r1", f"{tmp_path}/run", "run")
