from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Observation, functions as F

from sentilake.operators import summaries as H
from sentilake.plans.runs import latest_sentiment, past_days, warehouse_days
from sentilake.schemas import EMOTIONS, SUMMARY
from sentilake.sinks import summaries as KS
from sentilake.sources import stores as R

NOW = datetime(2024, 1, 31, 5, 30, tzinfo=timezone.utc)
FLAT = (0.5, 0.1, 0.1, 0.1, 0.1, 0.1)


def post(pid, text="words", **kw):
    fields = dict(post_id=pid, post_title="t", post_text=text, post_score=3, contribution=0.25, post_comments=[])
    return {**{f: None for f in SUMMARY["top_contributors"].dataType.elementType["top_posts"].dataType.elementType.names},
            **fields, **kw}


def summaries(spark, rows):
    """rows of (averages, contributors, timestamp)."""
    data = [{**dict(zip(EMOTIONS, (v if v is None else float(v) for v in a))), "top_contributors": tc, "timestamp": ts, "updatedAt": ts} for a, tc, ts in rows]
    return spark.createDataFrame(data, SUMMARY)


def one(spark, averages=FLAT, tc=None):
    return summaries(spark, [(averages, [{"emotion": "joy", "top_posts": [post("p1")]}] if tc is None else tc, None)])


def test_snapshot_is_replaced_and_guarded(spark, tmp_path):
    path = str(tmp_path / "current")
    assert R.read_latest(spark, path).count() == 0
    assert KS.write_current(one(spark), path, NOW)
    assert KS.write_current(one(spark, (0.0, 1.0, 0, 0, 0, 0)), path, NOW + timedelta(hours=1))
    assert not KS.write_current(one(spark).limit(0), path, NOW)
    assert not KS.write_current(one(spark, (2.0, 0, 0, 0, 0, 0)), path, NOW)
    zero = one(spark, (0.0,) * 6).withColumn("top_contributors", F.lit(None).cast(SUMMARY["top_contributors"].dataType))
    assert not KS.write_current(zero, path, NOW)
    row = R.read_latest(spark, path).withColumn("at", F.unix_seconds("timestamp")).collect()
    assert len(row) == 1 and row[0]["sadness"] == 1.0 and row[0]["at"] == (NOW + timedelta(hours=1)).timestamp()
    old = latest_sentiment(spark, str(tmp_path)).first()
    assert [p["id"] for p in old["_top_contributor"]["joy"]] == ["p1"]


def test_snapshot_written_last_is_current(spark, tmp_path):
    """Also when its time is an earlier one; old versions do not pile up."""
    path = str(tmp_path / "current")
    for hours, joy in ((0, 0.5), (3, 0.6), (1, 0.7), (-5, 0.8)):
        assert KS.write_current(one(spark, (joy, 0.1, 0.1, 0.1, 0.05, 0.05)), path, NOW + timedelta(hours=hours))
        assert R.read_latest(spark, path).first()["joy"] == joy
    assert len([p for p in (tmp_path / "current").iterdir() if p.name.startswith("version=")]) == 2


def test_invalid_rows_are_counted_in_the_same_pass(spark, tmp_path):
    root = str(tmp_path)
    times = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            times.add(b.num_rows)
            yield b

    rows = summaries(spark, [(FLAT, [], NOW), ((2.0, 0, 0, 0, 0, 0), [], NOW), (FLAT, [], NOW + timedelta(hours=1))])
    rows = rows.withColumn("hour_key", F.date_format("timestamp", "yyyy-MM-dd'T'HH"))
    watched = rows.mapInArrow(seen, rows.schema)
    assert KS.upsert_history(watched, f"{root}/history") == 1 and times.value == 3
    assert KS.append_warehouse(one(spark, (2.0, 0, 0, 0, 0, 0)), f"{root}/warehouse", NOW) == 1
    rows.drop("hour_key").withColumnRenamed("updatedAt", "updated_at").write.mode("overwrite").parquet(f"{root}/warehouse")
    counts = Observation()
    found = warehouse_days(spark, root, NOW.date(), NOW.date(), counts=counts).collect()
    assert len(found) == 2 and counts.get == {"rows": 3, "skipped": 1}
    counts = Observation()
    assert past_days(spark, root, NOW + timedelta(hours=2), 1, "current", counts=counts).count() == 2 and counts.get["skipped"] == 0


def test_history_keeps_the_last_write_of_an_hour(spark, tmp_path):
    path = str(tmp_path / "history")
    KS.upsert_history(one(spark), path, NOW - timedelta(days=3))
    KS.upsert_history(one(spark), path, NOW)
    KS.upsert_history(one(spark, (0.0, 0.0, 1.0, 0, 0, 0)), path, NOW + timedelta(minutes=20))
    KS.upsert_history(one(spark).limit(0), path, NOW + timedelta(minutes=25))
    rows = R.read_history(spark, path).orderBy("hour_key").collect()
    assert [(r["hour_key"], r["anger"]) for r in rows] == [("2024-01-28T05", 0.1), ("2024-01-31T05", 1.0)]
    read = lambda days: past_days(spark, str(tmp_path), NOW + timedelta(minutes=30), days, "current").count()
    assert (read(1), read(7), read(31)) == (1, 2, 2)
    plan = H.recent_history(R.read_history(spark, path), NOW, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_key" in plan and ">= 2024-01-30T05" in plan


def test_time_bounds(spark):
    rows = [(FLAT, [], NOW - timedelta(hours=h)) for h in (0, 24, 25, 31 * 24)]
    df = summaries(spark, rows)
    assert H.recent_history(df, NOW, 1).count() == 2
    days = lambda a, b, **kw: H.history_by_day_range(df, a, b, **kw).count()
    assert days(date(2024, 1, 30), date(2024, 1, 31)) == 3
    assert days(date(2024, 1, 31), date(2024, 1, 31)) == 1
    assert days(date(2023, 12, 31), date(2024, 1, 31), limit=2) == 2


def test_warehouse_rows(spark, tmp_path):
    tc = [{"emotion": "joy", "top_posts": [post("p1", "x" * 2000), post("p2", "")]}]
    path = str(tmp_path / "warehouse")
    KS.append_warehouse(one(spark, tc=tc), path, NOW)
    KS.append_warehouse(one(spark, tc=tc), path, NOW)
    KS.append_warehouse(one(spark, (1.5, 0, 0, 0, 0, 0), tc), path, NOW)
    rows = warehouse_days(spark, str(tmp_path), NOW.date(), NOW.date()).collect()
    assert len(rows) == 2 and rows[0]["timestamp"] == rows[0]["updated_at"]
    first, second = rows[0]["top_contributors"][0]["top_posts"]
    assert len(first["post_text_preview"]) == 1024 and second["post_text_preview"] is None
    assert "post_text" not in first.asDict()


def test_layouts_convert_both_ways(spark):
    tc = [{"emotion": "joy", "top_posts": [post("a", None, post_comments=None)]}, {"emotion": "", "top_posts": [post("x")]},
          {"emotion": None, "top_posts": [post("y")]}, {"emotion": "joy", "top_posts": [post("b")]},
          {"emotion": "fear", "top_posts": None}]
    old = H.to_legacy_summary(one(spark, (0.5, None, 0.1, 0.1, 0.1, 0.1), tc))
    row = old.first()
    assert row["sadness"] == 0.0 and set(row["_top_contributor"]) == {"joy", "fear"}
    assert [(p["id"], p["text"], p["comments"]) for p in row["_top_contributor"]["joy"]] == [("a", "", []), ("b", "words", [])]
    new = H.to_new_summary(old).first()
    assert [(t["emotion"], [p["post_id"] for p in t["top_posts"]]) for t in new["top_contributors"]] == \
        [("joy", ["a", "b"]), ("fear", [])]
    both = one(spark).withColumn("_top_contributor", F.lit(None).cast(old.schema["_top_contributor"].dataType))
    assert H.to_new_summary(both).first()["top_contributors"][0]["emotion"] == "joy"
    assert H.to_new_summary(both.drop("top_contributors")).first()["top_contributors"] == []


def test_invalid_summaries_are_skipped(spark):
    good, skipped = H.validate_summaries(summaries(spark, [
        (FLAT, [], None), ((1.2, 0, 0, 0, 0, 0), [], None), ((None,) * 6, [], None),
        (FLAT, [{"emotion": "joy", "top_posts": [post("p", post_comment_count=-1)]}], None),
        (FLAT, [{"emotion": None, "top_posts": []}], None)]))
    assert good.count() == 2 and skipped.count() == 3


def test_text_times_are_repaired(spark):
    df = spark.createDataFrame(
        [("2024-01-31T02:00:00+02:00", True), ("2024-01-31T00:00:00+00:00", False), ("never", True)],
        "timestamp string, stored_as_text boolean").withColumn("updatedAt", F.lit(None).cast("timestamp"))
    got = H.normalize_history_timestamps(df, NOW).select(F.unix_seconds("timestamp").alias("t"), "updatedAt").collect()
    midnight = int(datetime(2024, 1, 31, tzinfo=timezone.utc).timestamp())
    assert [r["t"] for r in got] == [midnight, midnight, None]
    assert [r["updatedAt"] is not None for r in got] == [True, False, False]


def test_rollup_and_latest(spark):
    rows = [((v, 0, 0, 0, 0, 0), [], NOW + timedelta(hours=h)) for v, h in [(0.2, 0), (0.4, 1), (1.0, 24)]]
    daily = H.rollup_history(summaries(spark, rows)).orderBy("period_start").collect()
    assert [(r["n_rows"], round(r["joy"], 9)) for r in daily] == [(2, 0.3), (1, 1.0)]
    same = summaries(spark, [(FLAT, [], NOW), ((1.0, 0, 0, 0, 0, 0), [], NOW + timedelta(minutes=1))])
    assert H.latest_per_hour(same.withColumn("hour_key", F.lit("h"))).first()["joy"] == 1.0
