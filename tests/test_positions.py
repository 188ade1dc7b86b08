"""Rows fetched by their place, sketches that merge, and sums of which longer times are made."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from sentilake.operators import archives as A, positions as P, sketches as K, totals as T
from sentilake.operators.summary import category_summary, sentiment_summary
from sentilake.plans.runs import archive_stats, build_dataset
from sentilake.schemas import EMOTIONS
from sentilake.session import materialize

START = datetime(2024, 1, 28, 22, tzinfo=timezone.utc)
SCORED = "post_id string, position long, post_subreddit string, post_text string, post_created_ts timestamp, post_score long, " \
    "sentiment struct<" + ",".join(f"{e}:double" for e in EMOTIONS) + ">"


def scored(spark, n, seed=5):
    rng = random.Random(seed)
    rows = [(f"p{i}", i, rng.choice(["hot", "hot", "g1", "g2"]), "t" * (i % 50), None if i % 17 == 0 else START + timedelta(minutes=rng.randrange(6000)),
             rng.choice([None, -3, 0, 1, 5, 900]), None if i % 13 == 0 else tuple(rng.choice([0.0, rng.random()]) for _ in EMOTIONS))
            for i in range(n)]
    return spark.createDataFrame(rows, SCORED)


# ---- copies and winners --------------------------------------------------------

def copies(spark, n=4000):
    """A third of all rows under one id, ties, equal rows and rows without an id, over several files."""
    rng = random.Random(1)
    rows = [(rng.choice(["hot", f"u{rng.randrange(600)}", f"v{rng.randrange(2000)}"]) if i % 40 else None, rng.randrange(6),
             rng.choice([None, 1, 2]), f"text {rng.randrange(50)}") for i in range(n)]
    return spark.createDataFrame(rows, "post_id string, n int, seen int, post_text string").repartition(7)


@pytest.mark.parametrize("broadcast_bytes", [P.BROADCAST_BYTES, 0])
def test_stored_copies_as_ranked_whole(spark, broadcast_bytes):
    df = materialize(copies(spark), "copies")
    stored = materialize(A.with_rank_columns(df, F.col("n")), "ranked")
    got = A.dedupe_stored(stored, tie_cols=("seen",), broadcast_bytes=broadcast_bytes)
    assert got.columns == df.columns
    rows = [tuple(r) for r in got.collect()]
    best = {}
    for i, n, seen, _ in map(tuple, df.collect()):
        if i is not None:
            best[i] = max(best.get(i, (-1, -1)), (n, -1 if seen is None else seen))
    assert {r[0]: (r[1], -1 if r[2] is None else r[2]) for r in rows} == best and len(rows) == len(best)
    again = [tuple(r) for r in A.dedupe_stored(materialize(A.with_rank_columns(df.repartition(3), F.col("n")), "ranked"), tie_cols=("seen",)).collect()]
    assert Counter(rows) == Counter(again)  # whatever file a copy lies in
    few = A.dedupe_stored(stored, tie_cols=("seen",), only=F.col("post_id") == "hot", broadcast_bytes=broadcast_bytes)
    assert [tuple(r) for r in few.collect()] == [r for r in rows if r[0] == "hot"]
    assert A.dedupe_stored(stored, tie_cols=("seen",), only=F.lit(False), broadcast_bytes=broadcast_bytes).count() == 0


def test_copies_are_ranked_without_texts_and_kept_without_a_shuffle(spark):
    stored = materialize(A.with_rank_columns(copies(spark), F.col("n")), "ranked")
    ranked = A.best_places(stored, tie_cols=("seen",))._jdf.queryExecution().executedPlan().toString()
    assert "post_text" not in ranked and ranked.count("WindowGroupLimit") == 2
    kept = A.dedupe_stored(stored, tie_cols=("seen",))._jdf.queryExecution().executedPlan().toString()
    assert "post_text" in kept and "BroadcastHashJoin" in kept and "hashpartitioning" not in kept and "Sort" not in kept


def test_every_place_is_a_bit(spark):
    """More rows in a file than a bitmap holds."""
    stored = materialize(spark.range(100_000).coalesce(1), "many")
    wanted = P.with_position(stored).where("id % 7 = 3 or id > 99990 or id between 32760 and 32775").select(P.FILE, P.ROW)
    got = sorted(r[0] for r in P.keep_rows(stored, wanted).collect())
    assert got == [i for i in range(100_000) if i % 7 == 3 or i > 99990 or 32760 <= i <= 32775]


def test_only_files_with_wanted_rows_are_opened(spark):
    stored = materialize(spark.range(0, 1000, 1, 10).withColumn("text", F.repeat(F.lit("x"), 10)), "wide")
    wanted = materialize(P.with_position(stored).where("id in (5, 17, 950)").select(P.FILE, P.ROW, (F.col("id") * 2).alias("twice")), "found")
    found = P.fetch_rows(stored, wanted)
    whole = P.fetch_rows(stored, wanted, few=1)
    assert sorted(map(tuple, whole.collect())) == [(5, "x" * 10, 10), (17, "x" * 10, 34), (950, "x" * 10, 1900)]
    named = {r[0] for r in wanted.select(P.FILE).distinct().collect()}
    for f in stored.inputFiles():
        if f not in named and unquote(urlparse(f).path) not in {unquote(urlparse(n).path) for n in named}:
            Path(unquote(urlparse(f).path)).unlink()
    assert sorted(map(tuple, found.collect())) == [(5, "x" * 10, 10), (17, "x" * 10, 34), (950, "x" * 10, 1900)]
    assert P.fetch_rows(stored, wanted.limit(0)).count() == 0


@pytest.mark.parametrize("keys", [["category"], []])
def test_summary_of_a_stored_table(spark, keys):
    posts = materialize(scored(spark, 500).repartition(5), "scored")
    tax = spark.createDataFrame([("c0", "hot", 0, 0), ("c0", "g1", 0, 1), ("c1", "hot", 1, 0), ("c2", "none", 2, 0)],
                                "category string, subreddit string, category_pos int, community_pos int")
    want = category_summary(posts, tax, keys, position_col="position")
    got = category_summary(posts, tax, keys, position_col="position", stored=True)
    shown = lambda df: sorted((r[keys[0]] if keys else "", [(t["emotion"], [(p["post_id"], p["post_text"], round(p["contribution"], 12)) for p in t["top_posts"]])
                                                            for t in r["top_contributors"]], [round(r[e], 12) for e in EMOTIONS]) for r in df.collect())
    assert shown(got) == shown(want) and len(shown(got)) == (2 if keys else 1)
    assert category_summary(materialize(posts.limit(0), "none"), tax, keys, position_col="position", stored=True).count() == 0


# ---- sketches --------------------------------------------------------------------

def test_sketches_merge_over_parts_that_overlap(spark):
    parts = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("part"), F.when(F.col("id") % 5 > 0, (F.col("id") % 20_011).cast("string")).alias("post_id"))
    stored = materialize(K.id_sketches(parts, ["part"]), "sketches")
    assert stored.count() == 3
    for chosen in ("part in ('0', '1', '2')", "part <> '1'", "part = '2'"):
        exact = parts.where(chosen).agg(F.count("*"), F.count_distinct("post_id")).first()
        got = K.sketched_stats(stored.where(chosen)).first()
        assert got["n_rows"] == exact[0] and abs(got["n_ids"] - exact[1]) <= 4 * K.STANDARD_ERROR * exact[1]
    twice = K.sketched_stats(stored.union(stored)).first()
    assert twice["n_ids"] == K.sketched_stats(stored).first()["n_ids"] and twice["n_rows"] == 120_000
    by_half = {r["half"]: r["n_rows"] for r in K.sketched_stats(stored.withColumn("half", F.col("part") == "0"), ["half"]).collect()}
    assert by_half == {True: 20_000, False: 40_000}
    assert tuple(K.sketched_stats(stored.limit(0)).first()) == (0, 0)
    nameless = K.id_sketches(spark.createDataFrame([("a", None)], "part string, post_id string"), ["part"])
    assert tuple(K.sketched_stats(nameless).first()) == (1, 0)


def test_builds_keep_a_sketch_of_each_archive(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "set")
    source.mkdir()
    for name, ids in (("a", [1, 2, 2]), ("b", [2, 3])):
        (source / f"{name}.json").write_text("\n".join(f'{{"id": "{i}"}}' for i in ids) + '\n{"text": "unnamed"}\n')
    build_dataset(spark, f"{source}/*", target, "r1", lines=True)
    (source / "c.json").write_text('{"id": "9"}')
    build_dataset(spark, f"{source}/*", target, "r2", lines=True)
    for f in source.glob("*.json"):
        f.unlink()  # nothing is read again
    assert tuple(archive_stats(spark, target, ["r1"]).first()) == (7, 3)
    assert tuple(archive_stats(spark, target, ["r1", "r2"]).first()) == (8, 4)
    assert tuple(archive_stats(spark, target, ["r1", "r2"], F.col("file_path").endswith("b.json")).first()) == (3, 2)


# ---- sums by hour -------------------------------------------------------------------

@pytest.mark.parametrize("group", [[], ["post_subreddit"]])
def test_a_period_is_the_summary_of_its_posts(spark, tmp_path, group):
    posts = materialize(scored(spark, 900), "scored")
    late = F.col("position") % 4 == 0
    for part in (~late, late):
        T.append_totals(T.hourly_totals(posts.where(part), group_cols=group), str(tmp_path / "totals"))
    got = {(r["level"], r["period_start"], *[r[g] for g in group]): r for r in
           T.rollup_totals(spark.read.parquet(str(tmp_path / "totals")), group_cols=group).collect()}
    n = 0
    for level in T.LEVELS:
        timed = posts.where("post_created_ts is not null").withColumn("period", F.date_trunc(level, "post_created_ts"))
        for r in sentiment_summary(timed, ["period", *group]).collect():
            own = got[(level, r["period"], *[r[g] for g in group])]
            assert [own[e] for e in EMOTIONS] == pytest.approx([r[e] for e in EMOTIONS], abs=1e-12)
            n += 1
    assert n == len(got) > 100
    taking_part = posts.where("post_created_ts is not null and sentiment is not null and post_score > 0").count()
    assert all(sum(r["n_posts"] for k, r in got.items() if k[0] == level) == taking_part for level in T.LEVELS)


def test_some_levels_and_no_posts(spark):
    totals = T.hourly_totals(scored(spark, 60))
    assert {r["level"] for r in T.rollup_totals(totals, ["week"]).collect()} == {"week"}
    assert T.rollup_totals(totals.limit(0)).count() == 0
    plan = T.rollup_totals(totals, ["day", "week"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan
    with pytest.raises(ValueError, match="decade"):
        T.rollup_totals(totals, ["day", "decade"])
