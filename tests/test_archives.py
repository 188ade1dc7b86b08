import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sentilake.operators import archives as A
from sentilake.plans.runs import build_dataset, clean_up_source
from sentilake.schemas import POST
from sentilake.sinks import archives as KA
from sentilake.sources import archives as RA, stores as R

NOW = datetime(2024, 1, 31, 5, tzinfo=timezone.utc)

FILES = {
    "list.json": json.dumps([{"id": "a", "comments": [{"body": "1"}], "score": 3}, 7, None, "x"], indent=2),
    "data.json": json.dumps({"data": [{"post_id": "b", "post_score": 4, "post_comments": []}]}),
    "one.json": json.dumps({"id": "c", "created": 1_690_000_000, "sentiment": {"joy": 0.5}}),
    "odd.json": json.dumps({"data": 5, "id": "d"}),
    "number.json": "5", "broken.json": "[{", "tail.json": '{"id": "e"} {"id": "f"}', "single.json": "{'id': 'g'}",
    "null.json": "null", "empty.json": "",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_all_document_shapes(spark, folder):
    records = RA.read_archives(spark, folder)
    assert records.count() == 7
    posts = A.posts_from_records(A.only_objects(records)).orderBy("post_id").collect()
    assert [p["post_id"] for p in posts] == ["a", "b", "c", "d"]
    assert [p["post_score"] for p in posts] == [3, 4, None, None]
    assert posts[0]["post_comments"][0]["body"] == "1" and posts[2]["sentiment"]["joy"] == 0.5
    assert posts[1]["post_comments"] == [] and posts[3]["post_comments"] is None
    docs = RA.read_documents(spark, folder)
    stats = RA.ingest_stats(docs).first()
    assert (stats["failed_files"], stats["n_records"]) == (5, 7)
    assert stats["n_bytes"] == sum(len(t) for t in FILES.values())
    assert RA.require_min_files(docs, 9) is docs
    with pytest.raises(ValueError):
        RA.require_min_files(docs, 11)


def test_committed_archives_are_cleaned_up(spark, folder, tmp_path_factory):
    out = tmp_path_factory.mktemp("staged")
    def run():
        records = A.only_objects(RA.read_archives(
            spark, folder, streaming=True, clean_source="archive", archive_dir=f"{out}/old", glob="*.json"))
        A.posts_from_records(records).writeStream.format("parquet").option("path", f"{out}/posts") \
            .option("checkpointLocation", f"{out}/ckpt").trigger(availableNow=True).start().awaitTermination()
    run()
    with open(f"{folder}/later.json", "w") as f:
        f.write('{"id": "z"}')
    run()
    ids = {r["post_id"] for r in spark.read.parquet(f"{out}/posts").collect()}
    assert ids == {"a", "b", "c", "d", "z"}


def posts(spark, rows):
    """rows of (id, number of comments, hours before NOW)."""
    data = [{**dict.fromkeys(POST.names), "post_id": i, "post_text": f"{i}{n}", "processing_timestamp": NOW - timedelta(hours=h),
             "post_comments": None if n is None else [{"body": "c", "author": None, "score": 1, "created_utc": NOW}] * n}
            for i, n, h in rows]
    return spark.createDataFrame(data, POST)


def test_dedupe_keeps_the_most_discussed_copy(spark):
    df = posts(spark, [("a", 1, 0), ("a", 3, 5), ("a", 3, 2), ("a", None, 0), ("b", None, 1), (None, 9, 0), (None, 9, 0)])
    got = {r["post_id"]: (r["post_text"], r["processing_timestamp"]) for r in A.dedupe_posts(df).collect()}
    assert set(got) == {"a", "b"} and got["a"][0] == "a3"
    assert A.dedupe_posts(df).filter("post_id = 'a'").select(F.unix_seconds("processing_timestamp")).first()[0] == \
        (NOW - timedelta(hours=2)).timestamp()
    known, missing = A.split_missing_ids(df)
    assert (known.count(), missing.count()) == (5, 2)
    assert tuple(A.dataset_stats(df).first()) == (7, 2) == tuple(A.dataset_stats(df, approximate=True).first())
    ordered = [r["post_text"] for r in A.order_by_comments(known).collect()]
    assert ordered[:3] == ["a3", "a3", "a1"]


def test_copies_of_one_id_are_limited_before_the_shuffle(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("post_id"),
                                           F.col("id").alias("n"))
    unique = A.dedupe_posts(df, size=F.col("n"), tie_cols=())
    assert unique._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert unique.count() == 2001 and unique.filter("post_id = 'hot'").first()["n"] == 2997


def test_archives_round_trip_into_a_dataset(spark, tmp_path):
    for hours, n in ((2, 1), (1, 2)):
        run = NOW - timedelta(hours=hours)
        KA.write_archive(posts(spark, [("a", n, hours), (f"only{n}", 0, hours)]), str(tmp_path / "runs"), run)
    build_dataset(spark, str(tmp_path / "runs" / "*"), str(tmp_path / "set"), "r1", min_files=2, lines=True)
    got = {r["post_id"]: len(r["post_comments"]) for r in R.read_dataset(spark, str(tmp_path / "set"), "r1").collect()}
    assert got == {"a": 2, "only1": 0, "only2": 0}
    with pytest.raises(Exception, match="(?i)exist"):
        build_dataset(spark, str(tmp_path / "runs" / "*"), str(tmp_path / "set"), "r1", lines=True)


def test_clean_up_takes_only_what_was_published(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "set")
    source.mkdir()
    for name, text in {"a": '[{"id": "1"}]', "b": '{"id": "2"}', "bad": "[{", "grown": '{"id": "3"}', "empty": "[]"}.items():
        (source / f"{name}.json").write_text(text)
    with pytest.raises(ValueError, match="no finished build"):
        clean_up_source(spark, target, "r1")
    report = build_dataset(spark, str(source), target, "r1").first()
    assert report["bytes"] == sum(p.stat().st_size for p in source.glob("*.json"))
    (source / "grown.json").write_text('[{"id": "3"}, {"id": "4"}]')
    (source / "a.json").unlink()  # as if an earlier call had been interrupted
    assert clean_up_source(spark, target, "r1") == {"removed": 2, "kept": 2, "gone": 1}
    assert sorted(p.name for p in source.glob("*.json")) == ["bad.json", "grown.json"]
    assert clean_up_source(spark, target, "r1") == {"removed": 0, "kept": 2, "gone": 3}


def test_hourly_archive(spark, tmp_path):
    df, path = posts(spark, [("a", 1, 0), ("b", 0, 0), ("c", 0, 2)]), str(tmp_path / "h")
    KA.write_hourly_post_archive(df, path, NOW)
    KA.write_hourly_post_archive(df.limit(0), path, NOW + timedelta(hours=1))
    index = {r["hour_id"]: (r["count"], r["archived_at"]) for r in spark.read.parquet(f"{path}/index").collect()}
    assert index == {2024013105: (3, "2024-01-31T05:00:00+00:00"), 2024013106: (0, "2024-01-31T06:00:00+00:00")}
    KA.write_hourly_post_archive(df, path, "processing_timestamp")
    index = {r["hour_id"]: r["count"] for r in spark.read.parquet(f"{path}/index").collect()}
    assert index == {2024013103: 1, 2024013105: 2, 2024013106: 0}
    assert spark.read.parquet(f"{path}/posts").count() == 3
