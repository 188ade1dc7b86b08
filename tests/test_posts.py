from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sentilake.operators import posts as P
from sentilake.operators.taxonomy import posts_per_community
from sentilake.schemas import LISTING, POST
from sentilake.sources.listings import read_listings
from sentilake.sources.taxonomy import read_taxonomy

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
EPOCH = NOW.timestamp()


def comment(body="hi", author="ann", score=1, created=100.0):
    return (body, author, score, created)


def listing(i, sub="s", title="t", text="b", age_days=1.0, comments=None, rank=None, method="hot"):
    return (f"p{i}", title, text, EPOCH - age_days * 86400, f"/r/{i}", 10 + i, 3, sub, method,
            i if rank is None else rank, [comment()] * 2 if comments is None else comments)


def collect(spark, rows, **kw):
    df = spark.createDataFrame(rows, LISTING)
    return P.quality_posts(df, NOW, **{"comment_limit": 2, **kw}).orderBy("post_subreddit", "listing_pos").collect()


def test_comment_rules(spark):
    mixed = [comment("ok", "ann", 5), comment("no", "AutoModerator"), comment("  　"), comment(None),
             comment("anon", None, -2, None), comment("late", "", 9)]
    rows = collect(spark, [listing(1, comments=mixed), listing(2, comments=mixed[:2])])
    assert [r["post_id"] for r in rows] == ["p1"]
    first, second = rows[0]["post_comments"]
    assert (first["body"], first["author"], first["score"]) == ("ok", "ann", 5)
    assert (second["body"], second["author"], second["score"]) == ("anon", "[deleted]", 0)
    assert second["created_utc"] == datetime.fromtimestamp(0)
    assert rows[0]["post_url"] == "https://reddit.com/r/1"


def test_content_age_and_limits(spark):
    rows = [listing(1, title=" ", text="\n"), listing(2, text=""), listing(3, age_days=7.0), listing(4, age_days=7.001),
            listing(5), listing(6), listing(7, sub="z")]
    assert [r["post_id"] for r in collect(spark, rows)] == ["p2", "p3", "p5", "p6", "p7"]
    # The buffer counts rows before the filters, the number of posts after them.
    assert [r["post_id"] for r in collect(spark, rows, fetch_buffer=3)] == ["p2", "p3", "p7"]
    assert [r["post_id"] for r in collect(spark, rows, required_posts=2)] == ["p2", "p3", "p7"]


def test_flat_comments_give_the_same_posts(spark):
    rows = [listing(i, sub=f"s{i % 3}", comments=[comment(f"c{j}", "AutoModerator" if j == 1 else None, j - 2)
                                                  for j in range(i % 5)]) for i in range(30)]
    nested = spark.createDataFrame(rows, LISTING)
    flat = nested.select("id", F.posexplode("comments").alias("comment_order", "c")).select("id", "comment_order", "c.*")
    one = P.quality_posts(nested, NOW, comment_limit=2).orderBy("post_id")
    two = P.quality_posts(nested.drop("comments"), NOW, comment_limit=2, comments=flat).orderBy("post_id")
    show = lambda df: [(r["post_id"], r["listing_pos"], r["post_comments"]) for r in df.collect()]
    assert show(one) == show(two) and len(show(one)) > 5


def test_a_hot_community_is_limited_before_the_shuffle(spark):
    rows = [listing(i, sub="hot" if i % 3 else "cold") for i in range(400)]
    df = spark.createDataFrame(rows, LISTING).repartition(6)
    head = P.listing_head(P.order_listing(df, "hot"), 100)
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {r["subreddit"]: r["count"] for r in head.groupBy("subreddit").count().collect()} == {"hot": 100, "cold": 100}


def test_listing_order(spark):
    rows = [listing(i, rank=9 - i, method=m) for i, m in enumerate(["hot", "new", "hot", "top"])]
    df = spark.createDataFrame(rows, LISTING)
    ids = lambda d: [r["id"] for r in d.orderBy("listing_order").collect()]
    assert ids(P.order_listing(df, "hot")) == ["p2", "p0"]
    bare = df.drop("listing_rank", "method")
    assert ids(P.order_listing(bare, "top")) == ["p3", "p2", "p1", "p0"]
    with pytest.raises(ValueError):
        P.order_listing(bare, "hot")
    with pytest.raises(ValueError):
        P.order_listing(df, "best")


def test_legacy_names_and_epochs(spark):
    old = spark.createDataFrame([("a", "T", 1_690_000_000, 4, None), ("b", None, None, 5, 1_690_000_001)],
                                "id string, title string, created long, score long, created_utc long")
    got = P.conform_posts(P.unify_legacy_posts(old)).orderBy("post_id")
    assert got.schema == POST
    rows = got.select("post_id", "post_title", "post_score", F.unix_seconds("post_created_ts").alias("at")).collect()
    assert [tuple(r) for r in rows] == [("a", "T", 4, 1_690_000_000), ("b", None, 5, 1_690_000_001)]
    mixed = spark.createDataFrame([("n", None), (None, "o")], "post_id string, id string")
    assert [r["post_id"] for r in P.unify_legacy_posts(mixed).collect()] == ["n", "o"]
    text = spark.createDataFrame([("2024-01-01T02:00:00+02:00",), ("1704067200.5",), ("x",)], "post_created_ts string")
    at = P.coerce_timestamps(text).select(F.unix_millis("post_created_ts").alias("m"))
    assert [r["m"] for r in at.collect()] == [1704067200000, 1704067200500, None]


def test_stamp_and_json(spark):
    posts = P.conform_posts(spark.createDataFrame([("a", ""), ("b", None), ("c", "s")], "post_id string, post_subreddit string"))
    run = P.stamp_run(posts, NOW).orderBy("post_id")
    assert [r["post_subreddit"] for r in run.collect()] == ["unknown", "unknown", "s"]
    text = run.select(P.post_json(run).alias("j")).first()["j"]
    assert '"post_id":"a"' in text and "post_title" not in text
    assert '"processing_timestamp":"2024-01-31T00:00:00.000000Z"' in text


def test_validation_splits_rows(spark):
    mood = lambda joy: (joy, 0.0, 0.0, 0.0, 0.0, 0.0)
    early, late = NOW - timedelta(hours=1), NOW
    rows = [("ok", 1, [comment()], mood(1.0), early, late), ("bare", None, None, None, None, None),
            ("count", -1, [], None, early, late), ("score", 1, [comment(score=-1)], None, early, late),
            ("body", 1, [comment(body=None)], None, early, late), ("mood", 1, [], mood(1.5), early, late),
            ("time", 1, [], None, late, early)]
    rows = [(r[0], r[1], r[2] and [(c[0], c[1], c[2], NOW) for c in r[2]] if r[2] is not None else None, *r[3:]) for r in rows]
    df = spark.createDataFrame(rows, "post_id string, post_comment_count long, post_comments array<struct<body:string,"
                               "author:string,score:long,created_utc:timestamp>>, sentiment struct<joy:double,sadness:double,"
                               "anger:double,fear:double,love:double,surprise:double>, post_created_ts timestamp, "
                               "processing_timestamp timestamp")
    good, bad = P.validate_posts(df)
    assert {r["post_id"] for r in good.collect()} == {"ok", "bare"}
    assert {r["post_id"]: len(r["broken_rules"]) for r in bad.collect()} == dict.fromkeys(["count", "score", "body", "mood", "time"], 1)


def test_taxonomy_and_counts(spark, tmp_path):
    path = tmp_path / "tax.json"
    path.write_text('{\n "A": ["x", "y"],\n "B": ["x"]\n}')
    tax = read_taxonomy(spark, str(path))
    assert [tuple(r) for r in tax.orderBy("category_pos", "community_pos").collect()] == \
        [("A", "x", 0, 0), ("A", "y", 0, 1), ("B", "x", 1, 0)]
    posts = spark.createDataFrame([("x",)] * 3, "post_subreddit string")
    got = {(r["category"], r["post_subreddit"]): (r["n_posts"], r["shortfall"])
           for r in posts_per_community(posts, tax, required=2).collect()}
    assert got == {("A", "x"): (3, 0), ("A", "y"): (0, 2), ("B", "x"): (3, 0)}
    path.write_text('["x"]')
    with pytest.raises(Exception, match="JSON object"):
        read_taxonomy(spark, str(path)).collect()


def test_read_listings(spark, tmp_path):
    rows = spark.createDataFrame([listing(1)], LISTING)
    rows.write.json(str(tmp_path / "l"))
    assert read_listings(spark, str(tmp_path / "l")).collect() == rows.collect()
    assert read_listings(spark, str(tmp_path / "l"), streaming=True).isStreaming


def test_landed_rows_without_a_rank_are_kept(spark):
    rows = [listing(1), (*listing(2)[:9], None, listing(2)[10]), listing(3), (None, *listing(4)[1:]), listing(5), listing(5)]
    df = spark.createDataFrame(rows, LISTING).repartition(3)
    got = P.quality_posts(df, NOW, comment_limit=2).orderBy("listing_pos").collect()
    # NULL comes last, rows equal in everything are one post.
    assert [r["post_id"] for r in got] == ["p1", "p3", None, "p5", "p2"]
    assert [r["post_id"] for r in P.quality_posts(df, NOW, comment_limit=2, fetch_buffer=2).orderBy("listing_pos").collect()] == ["p1", "p3"]


def test_listings_send_a_few_rows_per_community(spark):
    df = spark.createDataFrame([listing(i, sub="s") for i in range(50)], LISTING)
    plan = P.quality_posts(df, NOW)._jdf.queryExecution().executedPlan().toString()
    first = plan.split("WindowGroupLimit")[-1]
    assert "Final" in plan and "Partial" in plan and plan.count("WindowGroupLimit") >= 2 and "HashAggregate" not in first
