"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentilake.llm import (
    context_tree, conversation_repair, decontamination, embedding_near_dups, language_id, merkle, mixing, near_duplicates,
    oracle, personal_data, sharding, token_counts, toxicity, warc,
)
from sentilake.llm.common import fold_column, read_table
from sentilake.session import shared_dir

#: How far a vector is turned towards its mirror image in turned_embeddings; the second is about the limit.
TURNS = (0.1, 0.205)


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, values = context_tree.score_documents(read_table(spark, sf_dir, "documents"))
    full = context_tree.base_scores(scored, values)
    return full.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score",
                       "score", "n_bytes", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))


def op2_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    derived = warc.derive(warc.responses_from_pages(pages))
    return derived.select("record_id", "type", "refers_to", "target_uri", "date", "content_type", "content_length", "block_digest",
                          "source_digest", "digest_fits", F.decode("block", "utf-8").alias("content"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = sharding.external_shuffle(read_table(spark, sf_dir, "documents"), 24)
    path = shared_dir(spark, "shards")
    sharding.write_shards(shuffled, path)
    rows = sharding.read_shards(spark, path, shuffled.schema)
    return rows.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    models = language_id.train(docs, where=fold_column("doc_id", 4) != 2)
    found = language_id.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", (fold_column("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_near_dups.near_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def turned_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5's operator over each vector, its double and two turned copies, so that there are links on both sides of the limit."""
    table = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"), "label")

    def turned(by: float):
        return F.zip_with("e", F.reverse("e"), lambda x, y: x + y * F.lit(by))

    copies = [F.col("e"), F.transform("e", lambda x: x * 2.0), *map(turned, TURNS)]
    each = table.select("vec_id", "label", F.posexplode(F.array(*copies)).alias("copy", "embedding"))
    each = each.select((F.col("vec_id") * 4 + F.col("copy")).alias("vec_id"), "embedding", "label")
    found = embedding_near_dups.near_vectors(each)
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "score", "item_words", "first_word", "last_word")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    fixed = F.filter("spans", lambda s: s["by_pattern"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(fixed, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(fixed), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    queued = mixing.fair_queue(read_table(spark, sf_dir, "documents"))
    return queued.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "virtual_finish")


def damaged_conversations(rows: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a hash of conversation and turn."""
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(named.cast("binary")) % 20).alias("h"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return marked.where("h <> 0").select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), F.explode(copies).alias("copy"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    found = conversation_repair.repair(damaged_conversations(rows))
    key = conversation_repair.conversation_key(F.col("conv_id"))
    ids = rows.groupBy(key.alias("key")).agg(F.first("conv_id").alias("conv_id"))
    joined = ids.join(found.summary.drop("id"), "key", "left").join(conversation_repair.transcripts(found.blocks), "key", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    nodes = merkle.manifest(docs, altered=(tampered, {"text": merkle.lower_ascii(F.col("text"))}))
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("path"))
    checked = nodes.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.digest(merkle.proof(F.col("path"))).alias("proof_sha256"),
                           folded.alias("folded_root"))
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), where=fold_column("doc_id", 5) != 0)
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_column("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "log_toxic", "log_ordinary")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {f.__name__: f for f in (
        op1_context_tree, op2_derivatives, op3_shards, op4_language, op5_embeddings, turned_embeddings, op6_tokens, op7_leaks, op8_personal_data,
        op9_near_duplicates, op10_mix, op11_repair, op12_merkle, op13_toxicity, pipeline)}
    return named


#: Links found by comparing all pairs, classes by following links: what the two joins must equal.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
k AS (SELECT doc_id, len(w) AS n, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM t),
h AS (SELECT doc_id, n, i, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS g
  FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
x AS (SELECT DISTINCT doc_id, g FROM h WHERE i <= greatest(n - 4, 1)),
s AS (SELECT t.doc_id, count(x.g) AS n FROM t LEFT JOIN x ON t.doc_id = x.doc_id GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
  WHERE 100 * p.n >= 85 * (sa.n + sb.n - p.n)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT s.doc_id, any_value(s.n) AS n_shingles, min(r.seen) AS component_id, s.doc_id = min(r.seen) AS kept
FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id
"""
EMBEDDINGS_SQL = """
WITH RECURSIVE o AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (SELECT * FROM o),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND list_bool_and(list_transform(e, lambda x: coalesce(isfinite(x), false))) AND list_bool_or(list_transform(e, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(vec_id, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, min(r.seen) AS component_id, v.vec_id = min(r.seen) AS kept
FROM v JOIN r ON v.vec_id = r.vec_id GROUP BY v.vec_id
"""


#: The same over each vector, its double and two turned copies.
TURNED_SQL = EMBEDDINGS_SQL.replace("v AS (SELECT * FROM o)", """v AS (SELECT vec_id * 4 AS vec_id, label, e FROM o
  UNION ALL SELECT vec_id * 4 + 1, label, list_transform(e, lambda x: x * 2) FROM o""" + "".join(f"""
  UNION ALL SELECT vec_id * 4 + {k}, label, list_transform(e, lambda x, i: x + e[len(e) + 1 - i] * CAST({turn} AS DOUBLE)) FROM o"""
  for k, turn in enumerate(TURNS, 2)) + ")", 1)


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {"op5_embeddings": EMBEDDINGS_SQL, "turned_embeddings": TURNED_SQL, "op9_near_duplicates": NEAR_DUPLICATES_SQL,
             "op11_repair": oracle.repair_sql(), "op12_merkle": oracle.merkle_sql()}
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
