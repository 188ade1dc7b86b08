"""Registered queries: each runs one or more operators over whole test tables.

Outputs are flat rows with text keys and rounded doubles so that they compare with
SQL. Limits appear only where they are the operator's own.
"""

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sentilake.functions.keys import iso_timestamp, output_prefix
from sentilake.functions.parsing import parse_scores
from sentilake.functions.sentiment import labels_to_struct, normalize_sentiment
from sentilake.functions import text as X
from sentilake.operators import archives as A, labelling as L, posts as P
from sentilake.operators import scoring as S, sketches as K, summaries as H, taxonomy as T, totals as HT
from sentilake.operators.summary import category_summary, sentiment_summary, softmax_weights, top_contributors
from sentilake.plans import inputs as I
from sentilake.plans.runs import build_dataset, clean_up_source, finish_labels, label_progress, label_records, label_run, past_days, sentiment_run, warehouse_days
from sentilake.schemas import EMOTIONS, SCORES, SENTIMENT
from sentilake.session import input_bytes, materialize, shared_dir, spread, use_utc
from sentilake.sinks import archives as KA, labelling as KL, summaries as KS
from sentilake.sources import archives as RA, listings as RL, stores as R
from sentilake.sources.taxonomy import read_taxonomy
from sentilake.streaming import history as TH, posts as TP

SHOWN_TS = "yyyy-MM-dd HH:mm:ss"
RUN_ID, MODEL_ID, WORKER_ID = "run1", "fixed", "w0"
LANDED_FILE = 8 << 20


def r6(c: Column) -> Column:
    return F.round(c, 6)


def shown(ts: Column) -> Column:
    return F.date_format(ts, SHOWN_TS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.lexicon_scores(spread(I.posts(spark, sf_dir)), I.LEXICON, "post_text")


def written_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores without texts, computed once and written: summaries read them several times."""
    narrow = scored(spark, sf_dir).select("post_id", "position", "post_subreddit", "post_score", "sentiment")
    return materialize(narrow, "scores")


def text_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_summary(written_scores(spark, sf_dir), details=I.posts(spark, sf_dir))


def flatten_summary(summary: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, emotion, average, rank, post_id, contribution)."""
    averages = F.array(*[F.struct(F.lit(e).alias("emotion"), F.col(e).alias("average")) for e in EMOTIONS])
    rows = summary.select(*keys, "top_contributors", F.inline(averages))
    own = F.filter("top_contributors", lambda t: t["emotion"] == F.col("emotion"))
    top = F.try_element_at(own, F.lit(1))["top_posts"]
    ranked = rows.select(*keys, "emotion", "average", F.posexplode_outer(top).alias("pos", "p"))
    return ranked.select(*keys, "emotion", r6("average").alias("average"), (F.col("pos") + 1).alias("rank"),
                         F.col("p.post_id").alias("post_id"), r6(F.col("p.contribution")).alias("contribution"))


# ---- summaries ----------------------------------------------------------------

def q_sentiment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_summary(text_summary(spark, sf_dir))


def q_top_contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_contributors(written_scores(spark, sf_dir), carry=["post_id"])
    return top.select("emotion", "rank", "post_id", r6("contribution").alias("contribution"))


def q_summary_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = category_summary(written_scores(spark, sf_dir), I.taxonomy(spark, sf_dir), ["category"], position_col="position", run_order=False)
    return flatten_summary(summary, "category")


def q_flattened_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary in which posts of a community in two categories weigh twice."""
    return flatten_summary(category_summary(written_scores(spark, sf_dir), I.taxonomy(spark, sf_dir), position_col="position"))


def q_summary_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_summary(sentiment_summary(I.event_posts(spark, sf_dir), ["hour_key"]), "hour_key")


def q_softmax_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = I.posts(spark, sf_dir)
    overall = softmax_weights(posts).select("post_id", F.col("weight").alias("w_all"))
    own = softmax_weights(posts, ["post_subreddit"]).select("post_id", F.col("weight").alias("w_own"))
    return overall.join(own, "post_id").select(
        "post_id", F.round("w_all", 10).alias("w_all"), F.round("w_own", 10).alias("w_own"))


def q_zero_and_negative_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that give no row, zeros without contributors, and a normal summary."""
    hits = sum((F.col(f"sentiment.{e}") for e in EMOTIONS[1:]), F.col("sentiment.joy"))
    branch = F.when(F.col("post_score") <= 0, "no positive score").when(hits == 0, "all zero") \
        .otherwise("normal")
    return flatten_summary(
        sentiment_summary(written_scores(spark, sf_dir).withColumn("branch", branch), ["branch"]), "branch")


# ---- scoring ------------------------------------------------------------------

def _emotions(df: DataFrame, *keys: str, digits: int | None = 6) -> DataFrame:
    """Six columns from the struct; shares that are one division need no rounding."""
    value = lambda e: F.col(f"sentiment.{e}")
    return df.select(*keys, *[
        (value(e) if digits is None else F.round(value(e), digits)).alias(e) for e in EMOTIONS])


def q_lexicon_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emotions(scored(spark, sf_dir), "post_id", digits=None)


def q_lexicon_scores_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores with the word list as a table."""
    words = S.lexicon_table(use_utc(spark), I.LEXICON)
    return _emotions(S.lexicon_scores(spread(I.posts(spark, sf_dir)), words, "post_text"), "post_id", digits=None)


def load_letter_scorer() -> S.Scorer:
    """A fixed scorer: share of six letters among them."""

    def score(texts: list[str]) -> list[dict[str, float]]:
        out = []
        for t in texts:
            counts = {e: t.count(letter) for e, letter in zip(EMOTIONS, "jsaflu")}
            total = sum(counts.values()) or 1
            out.append({**{e: n / total for e, n in counts.items()}, "other": 1.0})
        return out

    return score


def q_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = I.posts(spark, sf_dir)
    predicted = S.score_emotions(spread(docs.select("post_id", "post_text")), load_letter_scorer, "post_text",
                                 max_chars=None).select("post_id", "sentiment")
    return _emotions(S.attach_predictions(docs.select("post_id"), predicted), "post_id", digits=None)


def q_normalize_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    pairs = [("joy", n % 10 / 10), ("sadness", n % 7 / 10), ("anger", n % 13 / 10), ("other", n % 3 / 1.0),
             ("love", n % 5 / 10), ("love", n % 4 / 10)]
    predictions = F.array(*[F.struct(F.lit(k).alias("label"), v.alias("score")) for k, v in pairs])
    docs = I.table(spark, sf_dir, "documents")
    scaled = docs.withColumn("sentiment", normalize_sentiment(labels_to_struct(predictions)))
    return _emotions(scaled, "doc_id")


# ---- collection ---------------------------------------------------------------

def _collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.quality_posts(I.listings(spark, sf_dir), I.NOW, comment_limit=I.COMMENTS_WANTED,
                           comments=I.comments(spark, sf_dir))


def q_quality_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _collected(spark, sf_dir)
    rows = posts.select("post_subreddit", "listing_pos", "post_id", "post_score",
                        F.posexplode("post_comments").alias("comment_no", "c"))
    return rows.select("post_subreddit", "listing_pos", "post_id", "post_score", "comment_no",
                       F.col("c.author").alias("author"), F.col("c.score").alias("score"),
                       shown(F.col("c.created_utc")).alias("created"), F.md5(F.col("c.body")).alias("body_md5"))


def q_posts_per_subreddit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.posts_per_community(_collected(spark, sf_dir), I.taxonomy(spark, sf_dir)).select(
        "category", "post_subreddit", "n_posts", "shortfall")


def q_listing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing buffer under each method; new and top without a landed rank."""
    landed = I.listings(spark, sf_dir)
    out = None
    for method in ("hot", "new", "top"):
        source = landed if method == "hot" else landed.drop("listing_rank")
        head = P.listing_head(P.order_listing(source, method), P.FETCH_BUFFER,
                              order_cols=("listing_order", "id"))
        rows = head.select(F.lit(method).alias("method"), "subreddit", "listing_pos", "id")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_normalize_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed and older field names to one layout, stamped with the run."""
    landed = P.normalize_post(I.listings(spark, sf_dir).withColumn("comments", F.lit(None)))
    older = I.listings(spark, sf_dir).select(
        "id", F.concat(F.lit(P.SITE_BASE_URL), "permalink").alias("url"), "title",
        F.col("selftext").alias("text"), "created_utc", "score", "num_comments",
        F.lit("").alias("subreddit"))
    both = P.conform_posts(landed).unionByName(P.conform_posts(P.unify_legacy_posts(older)))
    run = P.stamp_run(both, I.NOW)
    return run.select(
        "post_id", "post_url", "post_subreddit", "post_score", "post_comment_count",
        F.md5("post_title").alias("title_md5"), F.md5("post_text").alias("text_md5"),
        iso_timestamp(F.col("post_created_ts")).alias("created_iso"),
        iso_timestamp(F.col("processing_timestamp")).alias("processed_iso"), "sentiment_analysis_model")


def q_validate_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, doc = F.col("post_score") + 20, F.col("position")
    hour = F.make_dt_interval(hours=(doc % 7).cast("int") - F.lit(1))
    first = P.nest_first_comments(
        I.comments(spark, sf_dir), "id", "comment_order", None,
        comment=F.struct("body", "author", "score", F.timestamp_seconds("created_utc").alias("created_utc")))
    posts = I.posts(spark, sf_dir).join(first.withColumnRenamed("id", "post_id"), "post_id", "left").withColumns({
        "post_comment_count": n % 50 - 1,
        "sentiment": F.struct((n / 900).alias("joy"), *[F.lit(0.0).alias(e) for e in EMOTIONS[1:]]).cast(SENTIMENT),
        "processing_timestamp": F.col("post_created_ts") + hour,
    })
    good, bad = P.validate_posts(posts)
    return good.select("post_id", F.lit("").alias("broken")).unionByName(
        bad.select("post_id", F.array_join("broken_rules", ",").alias("broken")))


def q_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(use_utc(spark), "taxonomy")
    tax = I.taxonomy(spark, sf_dir)
    objects = tax.select(F.to_json(F.create_map("category", F.array("subreddit"))).alias("value"))
    objects.write.text(path)
    return read_taxonomy(spark, path, lines=True).select("category", "subreddit")


# ---- text ---------------------------------------------------------------------

def noisy_text() -> Column:
    """Quote mark, link, URL, entity, no-break and doubled spaces, a control character."""
    return F.concat(F.lit("> "), "text", F.lit("\n>> see [the page](https://a.example/x?y=1)  now "),
                    F.lit(f"http://b.example/z tail{X.NBSP}&amp;  end\x01"))


def q_clean_text_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(I.table(spark, sf_dir, "documents")).select("doc_id", noisy_text().alias("t"))
    t = F.col("t")
    steps = {
        "nbsp": X.strip_nbsp(t), "quotes": X.strip_blockquotes(t), "links": X.remove_markdown_links(t),
        "urls": X.drop_bare_urls(t), "controls": X.remove_control_chars(t), "spaces": X.collapse_whitespace(t),
        "cleaned": X.clean_text(t), "cleaned_ascii": X.clean_text(t, strip_controls=True),
    }
    return docs.select("doc_id", *[F.md5(c).alias(n) for n, c in steps.items()])


def q_clean_text_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return spread(I.table(spark, sf_dir, "pages")).select(
        "page_id", F.md5(X.clean_text(html)).alias("cleaned"),
        F.md5(X.decode_html_entities(html)).alias("decoded"),
        F.md5(X.normalize_unicode(html)).alias("nfkc"))


def _discussed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with up to 300 valid comments."""
    nested = P.nest_first_comments(
        I.comments(spark, sf_dir), "id", "comment_order", X.COMMENT_COUNT,
        P.valid_comment(F.col("body"), F.col("author")),
        P.normalize_comment(F.struct("body", "author", "score", "created_utc")))
    return spread(I.posts(spark, sf_dir)).join(nested.withColumnRenamed("id", "post_id"), "post_id", "left")


def q_prepare_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = _discussed(spark, sf_dir)
    parts = F.col("post_title"), F.col("post_text"), X.comment_bodies(F.col("post_comments"))
    made = posts.select("post_id", X.prepare_for_input(*parts).alias("t"),
                        X.prepare_for_input(*parts, post_limit=None).alias("whole"))
    return made.select("post_id", F.md5("t").alias("input_md5"), F.md5("whole").alias("whole_md5"),
                       F.md5(X.truncate_chars(F.col("t"))).alias("model_md5"))


def q_build_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.col("post_title"), F.col("post_text"), X.comment_bodies(F.col("post_comments"))
    made = _discussed(spark, sf_dir).select("post_id", X.build_prompt(*parts).alias("p"), X.build_prompt(*parts, None, None).alias("whole"))
    return made.select("post_id", F.length("p").alias("n_chars"), F.md5("p").alias("prompt_md5"), F.md5("whole").alias("whole_md5"))


# ---- history ------------------------------------------------------------------

def _recent(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    rows = H.recent_history(I.history(spark, sf_dir), I.NOW, days)
    return rows.select("event_id", "hour_key", shown(F.col("timestamp")).alias("ts"), *[r6(e).alias(e) for e in EMOTIONS])


def q_recent_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, 1)


def q_recent_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, 7)


def q_recent_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recent(spark, sf_dir, 31)


def q_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = H.history_by_day_range(I.history(spark, sf_dir), date(2024, 1, 10), date(2024, 1, 12))
    good, _ = H.validate_summaries(rows)
    return good.select("event_id", shown(F.col("timestamp")).alias("ts"))


def q_day_range_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same days without a limit."""
    rows = H.history_by_day_range(I.history(spark, sf_dir), date(2024, 1, 10), date(2024, 1, 12), None)
    return H.validate_summaries(rows)[0].select("event_id", shown(F.col("timestamp")).alias("ts"))


def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second snapshot replaces the first; an empty one changes nothing."""
    path = shared_dir(use_utc(spark), "current")
    posts = written_scores(spark, sf_dir)
    KS.write_current(sentiment_summary(I.event_posts(spark, sf_dir)), path, I.NOW - timedelta(hours=1))
    KS.write_current(sentiment_summary(posts), path, I.NOW)
    KS.write_current(sentiment_summary(posts.filter("post_score < 0")), path, I.NOW + timedelta(hours=1))
    latest = R.read_latest(spark, path)
    return latest.select(shown(F.col("timestamp")).alias("ts"), *[r6(e).alias(e) for e in EMOTIONS])


def q_history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours written from all other events, then again from clicks where there are any."""
    path = shared_dir(use_utc(spark), "history")
    rows, _ = H.validate_summaries(I.history(spark, sf_dir))
    for part in (F.col("event_type") != "click", F.col("event_type") == "click"):
        KS.upsert_history(rows.filter(part), path)
    return R.read_history(spark, path).select("hour_key", "event_id", "event_type")


def q_latest_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.latest_per_hour(I.history(spark, sf_dir)).select("hour_key", "event_id")


def q_history_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = H.rollup_history(I.history(spark, sf_dir))
    return daily.select(shown(F.col("period_start")).alias("day"), "n_rows", *[r6(e).alias(e) for e in EMOTIONS])


def q_history_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours, days, weeks and months from hourly sums, some of which came late."""
    path = shared_dir(use_utc(spark), "totals")
    posts = scored(spark, sf_dir).select("post_id", "post_created_ts", "post_score", "sentiment")
    late = F.col("post_id").cast("long") % 3 == 0
    for part in (~late, late):
        HT.append_totals(HT.hourly_totals(posts.where(part)), path)
    rolled = HT.rollup_totals(spark.read.parquet(path))
    return rolled.select("level", shown(F.col("period_start")).alias("period"), "n_posts", *[r6(e).alias(e) for e in EMOTIONS])


def q_fix_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views were stored as text two hours ahead of UTC."""
    as_text = F.col("event_type").isin("click", "view")
    ahead = F.date_format(F.col("timestamp") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stored = F.when(as_text, F.concat(ahead, F.lit("+02:00"))).otherwise(iso_timestamp(F.col("timestamp")))
    rows = I.history(spark, sf_dir).withColumns({"stored_as_text": as_text, "timestamp": stored})
    fixed = H.normalize_history_timestamps(rows, I.NOW)
    return fixed.select("event_id", shown(F.col("timestamp")).alias("ts"), shown(F.col("updatedAt")).alias("updated"))


def _contributing(df: DataFrame, *fields: Column) -> DataFrame:
    rows = df.select(F.inline("top_contributors")) \
        .select("emotion", F.posexplode("top_posts").alias("pos", "p"))
    return rows.select("emotion", (F.col("pos") + 1).alias("rank"), *fields)


def q_warehouse_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(use_utc(spark), "warehouse")
    KS.append_warehouse(text_summary(spark, sf_dir), f"{root}/warehouse", I.NOW)
    rows = warehouse_days(spark, root, I.NOW.date(), I.NOW.date())
    return _contributing(rows, F.col("p.post_id").alias("post_id"),
                         F.length("p.post_text_preview").alias("preview_chars"),
                         F.md5("p.post_text_preview").alias("preview_md5"))


def q_legacy_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = H.to_legacy_summary(text_summary(spark, sf_dir).withColumns({
        "timestamp": F.lit(I.NOW), "updatedAt": F.lit(I.NOW)}))
    entries = older.select(F.explode(F.map_entries(H.LEGACY_CONTRIBUTORS)).alias("kv"))
    in_map = entries.select(F.col("kv.key").alias("emotion"), F.posexplode("kv.value").alias("pos", "p")).select(
        F.lit("legacy").alias("layout"), "emotion", (F.col("pos") + 1).alias("rank"),
        F.col("p.id").alias("post_id"), F.md5("p.text").alias("text_md5"), F.size("p.comments").alias("n_comments"))
    back = _contributing(H.to_new_summary(older), F.col("p.post_id").alias("post_id"),
                         F.md5("p.post_text").alias("text_md5"), F.size("p.post_comments").alias("n_comments"))
    return in_map.unionByName(back.withColumn("layout", F.lit("current")))


def q_sentiment_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, read back from its hourly history."""
    root = shared_dir(use_utc(spark), "run")
    sentiment_run(I.listings(spark, sf_dir), I.taxonomy(spark, sf_dir), root, I.NOW, I.LEXICON,
                  num_comments=I.COMMENTS_WANTED, comments=I.comments(spark, sf_dir))
    return flatten_summary(past_days(spark, root, I.NOW, 1, layout="current"))


# ---- archives and dataset -----------------------------------------------------

def q_archive_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = KA.write_archive(scored(spark, sf_dir), shared_dir(use_utc(spark), "archive"), I.NOW)
    records = A.only_objects(RA.read_archives(spark, path, lines=True))
    posts = A.posts_from_records(records)
    return posts.groupBy("post_subreddit").agg(
        F.count("*").alias("n_posts"), F.sum("post_score").alias("score_sum"),
        F.sum(F.length("post_text")).alias("text_chars"), F.max("post_id").alias("max_id"),
        shown(F.max("post_created_ts")).alias("newest"), F.round(F.sum("sentiment.joy"), 4).alias("joy"))


def q_split_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array per community, each read in pieces and put together again."""
    path = shared_dir(use_utc(spark), "arrays")
    docs = I.table(spark, sf_dir, "documents")
    w = Window.partitionBy("source").orderBy("doc_id")
    record = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text", F.col("source").alias("subreddit"), F.col("n_chars").alias("score")))
    begin = F.when(F.lag("doc_id").over(w).isNull(), "[").otherwise(",")
    end = F.when(F.lead("doc_id").over(w).isNull(), "]").otherwise("")
    docs.select("source", "doc_id", F.concat(begin, record, end).alias("value")).repartition("source") \
        .sortWithinPartitions("source", "doc_id").select("value", "source").write.partitionBy("source").text(path)
    posts = A.posts_from_records(RA.read_archives(spark, f"{path}/*", split_bytes=1 << 12))
    return posts.select("post_id", "post_subreddit", "post_score", F.md5("post_text").alias("text_md5"))


def q_ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive file per document and per page; pages are no JSON and count as failed."""
    path = shared_dir(use_utc(spark), "mixed")
    docs = I.table(spark, sf_dir, "documents")
    record = F.to_json(F.struct("doc_id", "text"))
    docs.select(record.alias("value")).write.text(path)
    I.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("["), F.to_json(F.struct("conv_id", "text")), F.lit("]")).alias("value")) \
        .write.mode("append").text(path)
    I.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit('{"data": ['), F.to_json(F.struct("item_id", "text")), F.lit("]}")).alias("value")) \
        .write.mode("append").text(path)
    I.table(spark, sf_dir, "pages").select(F.regexp_replace("html", "[\r\n]", " ").alias("value")) \
        .write.mode("append").text(path)
    read = RA.read_documents(spark, path, lines=True)
    per_doc = read.agg(F.count("*").alias("n_documents"), F.count_if(F.col("records").isNull()).alias("failed"))
    return per_doc.withColumn("n_records", RA.ingest_stats(read).select("n_records").scalar())


def q_hourly_post_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(use_utc(spark), "hourly")
    KA.write_hourly_post_archive(I.posts(spark, sf_dir), path, "post_created_ts")
    stored = spark.read.parquet(f"{path}/posts").groupBy("hour_id").agg(F.count("*").alias("n_stored"))
    index = spark.read.parquet(f"{path}/index").join(stored, "hour_id", "left")
    return index.select(F.col("hour_id").cast("string").alias("hour_id"), F.col("count").alias("n_posts"),
                        "archived_at", "n_stored")


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under an id that equal texts share, with their comment counts."""
    n = I.comments(spark, sf_dir).groupBy("id").agg(F.count("*").alias("n_comments"))
    posts = I.posts(spark, sf_dir).withColumnRenamed("post_id", "id").join(n, "id", "left")
    return posts.withColumn("post_id", F.md5("post_text")).withColumn(
        "n_comments", F.coalesce("n_comments", F.lit(0)))


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dedupe_posts(_copies(spark, sf_dir), size=F.col("n_comments"), tie_cols=("position",))


def q_dedupe_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir).select("post_id", "id", "n_comments")


def q_dedupe_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies ranked without their texts, which are read for the rows that stay."""
    ranked = A.with_rank_columns(_copies(spark, sf_dir), F.col("n_comments"))
    kept = A.dedupe_stored(materialize(ranked, "copies"), tie_cols=("position",))
    return kept.select("post_id", "id", "n_comments", F.md5("post_text").alias("text_md5"))


def q_published_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers of a dataset published by number of comments, most first."""
    root = shared_dir(use_utc(spark), "ordered")
    posts = _copies(spark, sf_dir).withColumn("post_comments", F.expr("array_repeat(named_struct('body', 'c'), cast(n_comments as int))"))
    KA.publish_dataset(A.order_by_comments(posts, "position"), root, "r1")
    return L.index_rows(R.read_dataset(spark, root, "r1")).select("row_idx", "id", "n_comments")


def q_dataset_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids of all archives and of one in two, from a stored sketch per archive."""
    path = shared_dir(use_utc(spark), "sketches")
    copies = _copies(spark, sf_dir)
    K.id_sketches(copies, ["post_subreddit"]).write.parquet(path)
    n = F.regexp_extract("post_subreddit", "[0-9]+", 0).cast("int")

    def one(name: str, chosen: Column) -> DataFrame:
        exact = copies.where(chosen).agg(F.count_distinct("post_id"))
        got = K.sketched_stats(spark.read.parquet(path).where(chosen)).withColumn("exact", exact.scalar())
        near = F.abs(F.col("n_ids") - F.col("exact")) <= 4 * K.STANDARD_ERROR * F.col("exact")
        return got.select(F.lit(name).alias("archives"), "n_rows", F.col("exact").alias("n_ids"), near.alias("within_error"))

    return one("all", n.isNotNull()).unionByName(one("even", n % 2 == 0))


def q_dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(use_utc(spark), "dataset")
    KA.publish_dataset(_unique(spark, sf_dir), root, "r1")
    before = A.dataset_stats(_copies(spark, sf_dir)).withColumn("stage", F.lit("archives"))
    after = A.dataset_stats(R.read_dataset(spark, root, "r1")).withColumn("stage", F.lit("dataset"))
    return before.unionByName(after)


def q_build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build over old and new layouts, unknown fields, missing ids, non-objects and broken lines."""
    root = shared_dir(use_utc(spark), "report")
    docs = I.table(spark, sf_dir, "documents")
    n = F.col("doc_id") % 4
    new = F.to_json(F.struct(F.col("doc_id").cast("string").alias("post_id"), F.col("text").alias("post_text"), "lang"))
    old = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text", "source"))
    unnamed = F.to_json(F.struct(F.col("text").alias("post_text")))
    docs.select(F.when(n == 0, new).when(n == 1, old).when(n == 2, unnamed).otherwise(F.concat(F.lit("["), "doc_id", F.lit("]"))).alias("value")) \
        .unionByName(docs.filter(n == 1).select(new.alias("value"))).unionByName(docs.filter(n == 3).select(F.lit("{broken").alias("value"))) \
        .write.text(f"{root}/archives/a1")
    report = build_dataset(spark, f"{root}/archives/*", f"{root}/dataset", "r1", lines=True).drop("bytes")
    extra = R.read_dataset(spark, f"{root}/dataset", "r1").agg(F.count("extra").alias("with_extra"))
    return report.withColumn("with_extra", extra.scalar())


def q_build_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written twice, read, deduplicated and published."""
    root = shared_dir(use_utc(spark), "build")
    posts = I.posts(spark, sf_dir)
    for hours in (1, 2):
        run = I.NOW - timedelta(hours=hours)
        KA.write_archive(P.stamp_run(posts, run), f"{root}/archives", run)
    build_dataset(spark, f"{root}/archives/*", f"{root}/dataset", "r1", min_files=2, lines=True)
    return R.read_dataset(spark, f"{root}/dataset", "r1").select(
        "post_id", "post_score", shown(F.col("processing_timestamp")).alias("processed"),
        F.md5("post_text").alias("text_md5"))


def q_clean_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives left after a build that failed, a build, its clean-up and a second clean-up.

    A file per community; those of even number end in a broken document and are kept.
    """
    root = shared_dir(use_utc(spark), "clean-up")
    docs = I.table(spark, sf_dir, "documents")
    record = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text"))
    broken = docs.select("source").distinct().where(F.regexp_extract("source", "[0-9]+", 0).cast("int") % 2 == 0)
    lines = docs.select("source", record.alias("value")).unionByName(broken.withColumn("value", F.lit("{broken")))
    lines.repartition("source").write.partitionBy("source").text(f"{root}/archives")

    def left(stage: str) -> DataFrame:
        files = RA.list_files(spark, f"{root}/archives/*").select(F.regexp_extract("file_path", "source=([^/]*)/", 1).alias("source"))
        return materialize(files.select(F.lit(stage).alias("stage"), "source"), "left")

    stages = []
    try:
        build_dataset(spark, f"{root}/archives/*", f"{root}/dataset", "r1", min_files=10**6, lines=True)
    except ValueError:
        stages.append(left("failed"))
    build_dataset(spark, f"{root}/archives/*", f"{root}/dataset", "r1", lines=True)
    stages.append(left("built"))
    for stage in ("cleaned", "again"):
        clean_up_source(spark, f"{root}/dataset", "r1")
        stages.append(left(stage))
    return reduce(DataFrame.unionByName, stages)


# ---- labelling ----------------------------------------------------------------

def _manifest(spark: SparkSession, sf_dir: str, shard_size: int = 256) -> DataFrame:
    n = I.table(spark, sf_dir, "documents").count()
    return L.shard_manifest(use_utc(spark), n, I.NOW, shard_size=shard_size, chunk_size=64)


def q_shard_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(use_utc(spark), "manifest")
    run = I.table(spark, sf_dir, "documents").agg(F.count("*").alias("n_rows")).withColumns(
        {"shard_size": F.lit(256), "chunk_size": F.lit(64), "created_at": F.lit(I.NOW)})
    KL.write_manifest(run, _manifest(spark, sf_dir), root, RUN_ID)
    tasks = R.read_shard_tasks(spark, root, RUN_ID)
    return tasks.select("shard_id", "status", "start_idx", "end_idx", "chunk_total", "chunk_done", "attempts",
                        shown(F.col("updated_at")).alias("updated"))


def q_shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(use_utc(spark), "sharded")
    KA.publish_dataset(I.table(spark, sf_dir, "documents").orderBy("doc_id"), root, "r1")
    rows = L.assign_shards(L.index_rows(R.read_dataset(spark, root, "r1")), 256)
    return rows.select("doc_id", "row_idx", "shard_id")


def _done_per_shard(spark: SparkSession, sf_dir: str, shard_size: int) -> DataFrame:
    shard = L.shard_name(F.floor(F.col("doc_id") / shard_size))
    return I.table(spark, sf_dir, "labels").groupBy(shard.alias("shard_id")).agg(F.count("*").alias("n_done"))


def _tasks(spark: SparkSession, sf_dir: str, shard_size: int) -> DataFrame:
    """A manifest under way: progress from the labelled documents, states by shard number."""
    n = F.regexp_extract("shard_id", "[0-9]+", 0).cast("int")
    done = _done_per_shard(spark, sf_dir, shard_size)
    joined = _manifest(spark, sf_dir, shard_size).join(done, "shard_id", "left")
    hours = lambda k: F.timestamp_seconds(F.lit(I.NOW_EPOCH) + k * 3600)
    status = F.element_at(F.array(F.lit(L.PENDING), F.lit(L.IN_PROGRESS), F.lit(L.COMPLETED)), n % 3 + 1)
    return joined.withColumns({
        "chunk_done": F.coalesce("n_done", F.lit(0)).cast("bigint"),
        "status": status,
        "lease_expires_at": F.when(status == L.IN_PROGRESS, hours(n % 5 - 2)),
        "attempts": n % 4,
        "updated_at": hours(-(n * 7 % 50)),
    }).drop("n_done")


def q_chunk_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = L.chunk_ranges(_tasks(spark, sf_dir, 256), 64)
    prefix = output_prefix(F.lit("annotations"), F.lit(RUN_ID), F.col("shard_id"), F.lit(WORKER_ID))
    return chunks.select("shard_id", "lo", "hi", "chunk", prefix.alias("prefix"))


def q_lease_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.lease_candidates(_tasks(spark, sf_dir, 16), I.NOW).select(
        "shard_id", "status", shown(F.col("updated_at")).alias("updated"))


def q_annotation_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.annotation_progress(_tasks(spark, sf_dir, 16), I.NOW)


def q_pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.pending_rows(I.table(spark, sf_dir, "documents"), I.table(spark, sf_dir, "labels"), "doc_id") \
        .select("doc_id", "source")


def q_resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a published dataset left to label, from a bit per labelled row number."""
    root = shared_dir(use_utc(spark), "resume")
    KA.publish_dataset(I.table(spark, sf_dir, "documents").orderBy("doc_id"), root, "r1")
    rows = L.index_rows(R.read_dataset(spark, root, "r1"))
    done = rows.join(I.table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id").select("row_idx")
    return L.pending_by_index(rows, done).select("doc_id", "row_idx", "source")


def raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated text for every turn: plain, fenced, out of range, quoted, broken, with null."""
    n = F.col("turn").cast("string")
    plain = F.concat(F.lit('{"joy": '), n, F.lit(', "sadness": 2, "anger": 12, "fear": 0, "love": 4.9}'))
    quoted = F.concat(F.lit('{"joy": "'), n, F.lit('", "surprise": " 7 "}'))
    beyond = F.concat(F.lit('Scores: {"joy": -'), n, F.lit(', "surprise": 1'), n, F.lit("} done"))
    null = F.concat(F.lit('{"joy": null, "love": '), n, F.lit("}"))
    raw = F.element_at(F.array(plain, F.concat(F.lit("```json\n"), plain, F.lit("\n```")), beyond, quoted,
                               F.lit("not json"), null), (F.col("conv_id") % 6 + 1).cast("int"))
    return I.table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("raw"))


def q_parse_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = raw_answers(spark, sf_dir).withColumn("s", parse_scores(F.col("raw")))
    return parsed.select("conv_id", "turn", *[F.col(f"s.{e}").alias(e) for e in EMOTIONS])


def load_length_generator() -> S.Generator:
    """A fixed generator: scores from the prompt length, nonsense for every tenth length."""

    def generate(prompts: list[str]) -> list[str]:
        return ["no answer" if len(p) % 10 == 0 else
                "```json\n{" + ", ".join(f'"{e}": {len(p) % (7 + i)}' for i, e in enumerate(EMOTIONS)) + "}\n```"
                for p in prompts]

    return generate


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    shard = L.shard_name(F.floor(F.col("position") / 256))
    done = S.annotate_posts(_discussed(spark, sf_dir).withColumn("shard_id", shard), load_length_generator)
    return L.annotation_records(done, RUN_ID, MODEL_ID, WORKER_ID, keep=("shard_id",))


def q_annotation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(use_utc(spark), "annotations")
    records = _records(spark, sf_dir)
    KL.write_annotations(records, path)
    back = spark.read.schema(records.schema).json(path)
    return back.select("id", "shard_id", "model_id", "run_id", *[F.col(f"scores.{e}").alias(e) for e in EMOTIONS])


def q_label_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelling run in two calls, the second of which goes on with what the first left."""
    root = shared_dir(use_utc(spark), "label-run")
    KA.publish_dataset(P.conform_posts(_discussed(spark, sf_dir)).orderBy(F.col("post_id").cast("bigint")), f"{root}/dataset", "r1")
    for only in (F.col("row_idx") % 3 == 0, None):
        label_run(spark, f"{root}/dataset", "r1", f"{root}/run", RUN_ID, I.NOW, load_length_generator, MODEL_ID, WORKER_ID,
                  shard_size=256, chunk_size=64, only=only, post_limit=None)
    return label_records(spark, f"{root}/run", RUN_ID).select(
        "id", "shard_id", "model_id", "worker_id", *[F.col(f"scores.{e}").alias(e) for e in EMOTIONS])


def q_label_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress of a run whose first shard is done and whose others have a row in three."""
    root = shared_dir(use_utc(spark), "label-progress")
    KA.publish_dataset(P.conform_posts(I.posts(spark, sf_dir)).orderBy(F.col("post_id").cast("bigint")), f"{root}/dataset", "r1")
    label_run(spark, f"{root}/dataset", "r1", f"{root}/run", RUN_ID, I.NOW, load_length_generator, MODEL_ID, WORKER_ID,
              shard_size=64, chunk_size=16, only=F.expr("row_idx < 64 or row_idx % 3 = 0 and row_idx < 320"), post_limit=None)
    return label_progress(spark, f"{root}/run", RUN_ID, I.NOW).select("status", "n_shards", "records_done")


def q_finish_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts of a run made in two calls, each with its scores."""
    root = shared_dir(use_utc(spark), "finish-labels")
    KA.publish_dataset(P.conform_posts(_discussed(spark, sf_dir)).orderBy(F.col("post_id").cast("bigint")), f"{root}/dataset", "r1")
    for only in (F.col("row_idx") % 2 == 0, None):
        label_run(spark, f"{root}/dataset", "r1", f"{root}/run", RUN_ID, I.NOW, load_length_generator, MODEL_ID, WORKER_ID,
                  shard_size=256, chunk_size=64, only=only, post_limit=None)
    return finish_labels(spark, f"{root}/dataset", "r1", f"{root}/run", RUN_ID).select(
        "post_id", "shard_id", F.md5("post_text").alias("text_md5"), *[F.col(f"scores.{e}").alias(e) for e in EMOTIONS])


def q_annotation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = parse_scores(F.col("raw"))
    return L.annotation_metrics(raw_answers(spark, sf_dir).select(scores.alias("scores")))


def q_combine_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the scores of the answers to all turns, a run per turn."""
    answers = raw_answers(spark, sf_dir).select(
        F.col("conv_id").alias("id"), parse_scores(F.col("raw")).alias("scores"),
        F.lit(MODEL_ID).alias("model_id"), F.concat(F.lit(RUN_ID + ":"), "turn").alias("run_id"))
    both = L.combine_annotations(I.table(spark, sf_dir, "documents"), answers, "doc_id")
    return both.select("doc_id", "run_id", *[F.col(f"scores.{e}").alias(e) for e in EMOTIONS])


# ---- streams ------------------------------------------------------------------

def files_per_batch(df: DataFrame, batches: int) -> int:
    """Files to land for each batch of a stream: one for every ``LANDED_FILE`` bytes that ``df`` is made from."""
    return max(1, -(-input_bytes(df) // (batches * LANDED_FILE)))


def _landed_stream(df: DataFrame, root: str, batches: int) -> DataFrame:
    """``df`` written as files and read back as a stream in several batches, each a mixture of all rows."""
    n = files_per_batch(df, batches)
    df.repartition(batches * n).write.parquet(f"{root}/landed")
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", n).parquet(f"{root}/landed")


def q_stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly history from events that arrive in three batches, each touching every hour."""
    root = shared_dir(use_utc(spark), "stream-history")
    events = _landed_stream(I.table(spark, sf_dir, "events"), root, 3)
    TH.stream_history(I.as_event_posts(events), f"{root}/out", f"{root}/ckpt").awaitTermination()
    return flatten_summary(spark.read.parquet(f"{root}/out/history"), "hour_key")


def q_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user seen within the watermark."""
    root = shared_dir(use_utc(spark), "stream-dedupe")
    events = _landed_stream(I.table(spark, sf_dir, "events"), root, 2)
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    unique = TP.stream_dedupe(rows, "ts", "60 days", "user_id")
    unique.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt") \
        .option("path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(unique.schema).parquet(f"{root}/out").select("user_id")


def q_stream_best_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the most discussed one, once no copy can follow; every column is compared.

    The last event, far later, lets the watermark pass all others.
    """
    root = shared_dir(use_utc(spark), "stream-best")
    copies = _copies(spark, sf_dir).select("post_id", "id", "position", "post_created_ts", "post_score", "post_subreddit", "n_comments")
    n = files_per_batch(copies, 3)
    copies.repartition(3 * n).write.parquet(f"{root}/landed/1")
    end = copies.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in copies.schema])
    end.withColumns({"post_id": F.lit("end"), "post_created_ts": F.lit(I.NOW + timedelta(days=400))}).write.parquet(f"{root}/landed/2")
    landed = spark.readStream.schema(copies.schema).option("maxFilesPerTrigger", n).parquet(f"{root}/landed/*")
    best = TP.stream_best_copy(landed, "post_created_ts", "60 days", F.col("n_comments"), ("position",))
    best.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt").option("path", f"{root}/out") \
        .trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(best.schema).parquet(f"{root}/out")
    return rows.select("post_id", "id", "position", shown(F.col("post_created_ts")).alias("created"), "post_score", "post_subreddit", "n_comments")


def q_stream_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(use_utc(spark), "stream-annotate")
    posts = _landed_stream(_discussed(spark, sf_dir), root, 2)
    TP.stream_annotations(posts, load_length_generator, f"{root}/out", f"{root}/ckpt", RUN_ID, MODEL_ID,
                          WORKER_ID).awaitTermination()
    back = spark.read.schema(L.annotation_records(
        posts.withColumn("scores", F.lit(None).cast(SCORES)), RUN_ID, MODEL_ID, WORKER_ID).schema).json(f"{root}/out")
    return back.select("id", "run_id", *[F.col(f"scores.{e}").alias(e) for e in EMOTIONS])


def q_stream_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed listing files as a stream; committed files go to an archive folder."""
    root = shared_dir(use_utc(spark), "stream-listings")
    landed = I.listings(spark, sf_dir).withColumn("method", F.lit("hot"))
    n = files_per_batch(landed, 2)
    landed.repartition(2 * n).write.json(f"{root}/landed")
    stream = RL.read_listings(spark, f"{root}/landed", streaming=True, max_files=n, clean_source="archive",
                              archive_dir=f"{root}/archived")
    posts = P.conform_posts(P.normalize_post(stream))
    posts.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt") \
        .option("path", f"{root}/out").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(posts.schema).parquet(f"{root}/out").select(
        "post_id", "post_subreddit", "post_score", shown(F.col("post_created_ts")).alias("created"),
        F.md5("post_text").alias("text_md5"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("q_") and callable(f)}
