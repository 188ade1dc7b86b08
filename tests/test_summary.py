import math
import random

import pytest
from pyspark.sql import functions as F

from sentilake.functions.sentiment import labels_to_struct, normalize_sentiment
from sentilake.operators.summary import category_summary, community_partials, sentiment_summary, softmax_weights, top_contributors
from sentilake.operators.taxonomy import flatten_categories
from sentilake.schemas import EMOTIONS

SCHEMA = "g string, position long, post_id string, post_text string, post_score long, sentiment struct<" + \
    ",".join(f"{e}:double" for e in EMOTIONS) + ">"


def restated(posts, k=3, temperature=1.5):
    """Averages and top posts of one group in plain Python."""
    kept = sorted((p for p in posts if p[5] is not None and p[4] is not None and p[4] > 0), key=lambda p: p[1])
    if not kept:
        return None
    logs = [math.log1p(p[4]) / temperature for p in kept]
    exps = [math.exp(x - max(logs)) for x in logs]
    weights = [x / sum(exps) for x in exps]
    totals = {e: sum(p[5][i] * w for p, w in zip(kept, weights)) for i, e in enumerate(EMOTIONS)}
    whole = sum(totals.values())
    if whole == 0:
        return {e: 0.0 for e in EMOTIONS}, None
    top = {}
    for i, e in enumerate(EMOTIONS):
        ranked = sorted(((p[5][i] * w, p[1], p[2]) for p, w in zip(kept, weights)), reverse=True)
        top[e] = [(pid, c) for c, _, pid in ranked[:k]]
    return {e: v / whole for e, v in totals.items()}, top


def as_result(row):
    averages = {e: row[e] for e in EMOTIONS}
    if row["top_contributors"] is None:
        return averages, None
    assert [t["emotion"] for t in row["top_contributors"]] == list(EMOTIONS)
    return averages, {t["emotion"]: [(p["post_id"], p["contribution"]) for p in t["top_posts"]]
                      for t in row["top_contributors"]}


def assert_same(got, want):
    assert got[0] == pytest.approx(want[0], abs=1e-12)
    if want[1] is None:
        assert got[1] is None
        return
    for e in EMOTIONS:
        assert [p for p, _ in got[1][e]] == [p for p, _ in want[1][e]], e
        assert [c for _, c in got[1][e]] == pytest.approx([c for _, c in want[1][e]], abs=1e-12)


def random_posts(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        raw = [rnd.choice([0, 0, 1, 2, 5]) for _ in EMOTIONS]
        total = sum(raw) or 1
        mood = tuple(v / total for v in raw) if rnd.random() > 0.1 else None
        score = rnd.choice([None, -3, 0, 1, 1, 7, 7, 1000, 5_000_000_000])
        out.append(("hot" if rnd.random() < 0.4 else f"g{i % 5}", i, f"p{i}", f"text {i}", score, mood))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_summary_agrees_with_a_restatement(spark, seed):
    posts = random_posts(300, seed)
    df = spark.createDataFrame(posts, SCHEMA).repartition(5)
    assert_same(as_result(sentiment_summary(df).first()), restated(posts))
    grouped = {r["g"]: as_result(r) for r in sentiment_summary(df, ["g"]).collect()}
    assert set(grouped) == {p[0] for p in posts}
    for g, got in grouped.items():
        assert_same(got, restated([p for p in posts if p[0] == g]))


def test_details_come_from_a_second_table(spark):
    df = spark.createDataFrame(random_posts(100, 3), SCHEMA)
    whole, split = sentiment_summary(df).first(), sentiment_summary(
        df.drop("post_text"), details=df.select("post_id", "post_text")).first()
    texts = lambda r: [[p["post_text"] for p in t["top_posts"]] for t in r["top_contributors"]]
    assert texts(whole) == texts(split) and texts(split)[0][0].startswith("text")


ZERO, JOY = (0.0,) * 6, (1.0, 0.0, 0.0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("posts, rows", [
    ([], 0),
    ([("a", 1, "p1", "", 5, None), ("a", 2, "p2", "", None, JOY)], 0),
    ([("a", 1, "p1", "", 0, JOY), ("a", 2, "p2", "", -4, JOY)], 0),
    ([("a", 1, "p1", "", 5, ZERO)], 1),
])
def test_empty_and_zero_branches(spark, posts, rows):
    df = spark.createDataFrame(posts, SCHEMA)
    for keys in ([], ["g"]):
        got = sentiment_summary(df, keys).collect()
        assert len(got) == rows
        for r in got:
            assert [r[e] for e in EMOTIONS] == [0.0] * 6 and r["top_contributors"] is None
        assert top_contributors(df, keys).count() == 0


def test_zero_posts_shrink_contributions_but_not_averages(spark):
    alone = [("a", 1, "p1", "", 7, JOY)]
    both = alone + [("a", 2, "p2", "", 7, ZERO)]
    one, two = (as_result(sentiment_summary(spark.createDataFrame(p, SCHEMA)).first()) for p in (alone, both))
    assert one[0]["joy"] == two[0]["joy"] == 1.0
    assert one[1]["joy"][0][1] == pytest.approx(1.0) and two[1]["joy"][0][1] == pytest.approx(0.5)


def test_later_position_wins_ties(spark):
    posts = [("a", i, f"p{i}", "", 7, JOY) for i in range(6)]
    top = as_result(sentiment_summary(spark.createDataFrame(posts, SCHEMA)).first())[1]
    assert [p for p, _ in top["joy"]] == ["p5", "p4", "p3"] == [p for p, _ in top["fear"]]


def test_communities_in_two_categories_weigh_twice(spark):
    posts = [("a", i, f"p{i}", "", 7 + i, JOY if i else (0.0, 1.0, 0.0, 0.0, 0.0, 0.0)) for i in range(2)]
    df = spark.createDataFrame(posts, SCHEMA).withColumns(
        {"post_subreddit": F.concat(F.lit("s"), "position"), "listing_pos": F.col("position")})
    tax = spark.createDataFrame([("c0", "s0", 0, 0), ("c1", "s0", 1, 0), ("c1", "s1", 1, 1)],
                                "category string, subreddit string, category_pos int, community_pos int")
    got = as_result(sentiment_summary(flatten_categories(df, tax)).first())
    u0, u1 = 8 ** (2 / 3), 9 ** (2 / 3)
    assert got[0]["joy"] == pytest.approx(u1 / (2 * u0 + u1))
    assert [p for p, _ in got[1]["sadness"]] == ["p0", "p0", "p1"]


@pytest.mark.parametrize("keys", [["category"], []])
def test_categories_from_community_partials(spark, keys):
    """The same as a summary of all posts joined to their categories."""
    posts = spark.createDataFrame(random_posts(400, 9), SCHEMA).withColumnRenamed("g", "post_subreddit").withColumn("listing_pos", F.col("position"))
    tax = spark.createDataFrame([("c0", "hot", 0, 0), ("c0", "g1", 0, 1), ("c1", "hot", 1, 0), ("c1", "g2", 1, 1), ("c2", "none", 2, 0)],
                                "category string, subreddit string, category_pos int, community_pos int")
    want = {r["category"] if keys else 0: as_result(r) for r in sentiment_summary(flatten_categories(posts, tax), keys).collect()}
    got = {r["category"] if keys else 0: as_result(r) for r in category_summary(posts.drop("post_text"), tax, keys, details=posts).collect()}
    assert got.keys() == want.keys() and len(want) == (2 if keys else 1)
    for key, result in want.items():
        assert_same(got[key], result)
    assert category_summary(posts.limit(0), tax, keys).count() == 0


def test_only_community_rows_meet_the_taxonomy(spark):
    posts = spark.createDataFrame(random_posts(50, 9), SCHEMA).withColumnRenamed("g", "post_subreddit").withColumn("listing_pos", F.col("position"))
    sums, top = community_partials(posts)
    assert sums.count() == posts.where("sentiment is not null and post_score > 0").select("post_subreddit").distinct().count()
    assert top.groupBy("post_subreddit", "emotion").count().agg(F.max("count")).first()[0] <= 3


def test_weights_of_a_power_law(spark):
    scores = [s for s, n in [(0, 100), (100, 50), (200, 25), (300, 12), (400, 6), (500, 3)] for _ in range(n)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, post_score long")
    out = softmax_weights(df, temperature=2).agg(F.sum("weight"), F.min("weight"), F.count("*")).first()
    assert out[0] == pytest.approx(1.0) and out[1] > 0 and out[2] == 96


def test_plan_combines_before_the_shuffle(spark, sf_dir):
    from sentilake.plans import inputs as I

    posts = I.event_posts(spark, sf_dir)
    plan = top_contributors(posts)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Only combined rows, never posts, go to a single partition.
    for block in plan.split("SinglePartition")[1:]:
        assert block.lstrip(", ").split("+-")[1].lstrip().startswith(("HashAggregate", "*"))


def test_normalize_sentiment(spark):
    rows = [(0, (1 / 6,) * 6), (1, (0.1, 0.1, 0.2, 0.4, 0.2, 0.4)), (2, ZERO), (3, (2.0, 0.1, 0.2, 0.4, 1.1, 0.4)),
            (4, None), (5, (0.5, None, 0.5, None, None, None)), (6, (0.5, 0.5 + 5e-7, 0.0, 0.0, 0.0, 0.0))]
    df = spark.createDataFrame(rows, "i int, s struct<" + ",".join(f"{e}:double" for e in EMOTIONS) + ">")
    got = {r["i"]: r["n"] and tuple(r["n"]) for r in df.select("i", normalize_sentiment(F.col("s")).alias("n")).collect()}
    assert got[0] == rows[0][1] and got[2] == ZERO and got[3] is None and got[4] is None
    assert sum(got[1]) == pytest.approx(1) and got[1][2] == pytest.approx(2 * got[1][0])
    assert got[5] == (0.5, 0.0, 0.5, 0.0, 0.0, 0.0) and got[6] == rows[6][1]


def test_labels_to_struct(spark):
    pairs = [("joy", 0.2), ("other", 0.9), ("joy", 0.6)]
    arr = F.array(*[F.struct(F.lit(k).alias("label"), F.lit(v).alias("score")) for k, v in pairs])
    assert tuple(spark.range(1).select(labels_to_struct(arr).alias("s")).first()["s"]) == (0.6, 0, 0, 0, 0, 0)
