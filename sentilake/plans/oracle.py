"""DuckDB SQL for the registered queries, over the same tables."""

from sentilake.functions import text as X
from sentilake.plans.inputs import COMMENTS_WANTED, LEXICON
from sentilake.schemas import EMOTIONS

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SHOWN = "'%Y-%m-%d %H:%M:%S'"


def each(template: str, sep: str = ", ") -> str:
    return sep.join(template.format(e=e, i=i) for i, e in enumerate(EMOTIONS))


def hits(e: str) -> str:
    return ", ".join(f"'{w}'" for w, label in LEXICON.items() if label == e)


def created(doc: str) -> str:
    return f"({NOW} - to_hours({doc} * 37 % 240))"


def shown(ts: str) -> str:
    return f"strftime({ts}, {SHOWN})"


def lexicon(texts: str) -> str:
    """CTEs turning ``texts`` (doc_id, text) into ``emo`` (doc_id, six shares)."""
    counts = ", ".join(f"count(*) FILTER (w IN ({hits(e)})) AS {e}" for e in EMOTIONS)
    total = each("{e}", " + ")
    return f"""tok AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM {texts}),
cnt AS (SELECT doc_id, {counts} FROM tok GROUP BY doc_id),
emo AS (SELECT doc_id, {each("{e} / greatest(" + total + ", 1)::DOUBLE AS {e}")} FROM cnt)"""


SCORED = f"""{lexicon("documents")},
scored AS (SELECT d.doc_id, d.source, d.text, d.n_chars % 997 - 20 AS score, {each("emo.{e}")}
           FROM documents d JOIN emo USING (doc_id))"""


def summary(source: str, keys: str = "", position: str = "doc_id") -> str:
    """CTEs from ``source`` (keys, id, score, six emotions) to ``flat`` rows."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {k}emotion"
    join = f"USING ({keys})" if keys else "ON true"
    total = each("{e}", " + ")
    group = f"GROUP BY {keys}" if keys else "HAVING count(*) > 0"
    sides = " UNION ALL ".join(
        f"SELECT {k}id, {position} AS pos, '{e}' AS emotion, u * {e} AS strength FROM kept" for e in EMOTIONS)
    means = " UNION ALL ".join(
        f"SELECT {k}wt, tot, '{e}' AS emotion, CASE WHEN tot = 0 THEN 0.0 ELSE {e} / tot END AS average FROM tots"
        for e in EMOTIONS)
    on = " AND ".join([f"m.{c} = t.{c}" for c in keys.split(", ") if c] + ["m.emotion = t.emotion"])
    show = ", ".join(f"m.{c}" for c in keys.split(", ") if c)
    show = f"{show}, " if show else ""
    return f"""kept AS (SELECT *, pow(1 + score, 1 / 1.5) AS u FROM {source} WHERE score > 0),
tots AS (SELECT {k}sum(u) AS wt, {each("sum(u * {e}) AS {e}")}, {each("sum(u * {e})", " + ")} AS tot
         FROM kept {group}),
sides AS ({sides}),
ranked AS (SELECT *, row_number() OVER ({part} ORDER BY strength DESC, pos DESC) AS rank FROM sides),
means AS ({means}),
flat AS (SELECT {show}m.emotion, round(m.average, 6) AS average,
                CAST(CASE WHEN m.tot > 0 THEN t.rank END AS INTEGER) AS rank,
                CASE WHEN m.tot > 0 THEN t.id END AS post_id,
                CASE WHEN m.tot > 0 THEN round(t.strength / m.wt, 6) END AS contribution
         FROM means m LEFT JOIN ranked t ON {on} AND t.rank <= CASE WHEN m.tot > 0 THEN 3 ELSE 1 END)"""


TAXONOMY = """tax AS (SELECT 'cat' || c AS category, c AS category_pos, n AS community_pos, source AS subreddit FROM (
    SELECT source, n, unnest(CASE WHEN source = 'src0' THEN [0, 4] ELSE [n % 5] END) AS c
    FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS n FROM documents)))"""

BY_ID = "(SELECT *, CAST(doc_id AS VARCHAR) AS id FROM scored)"

EVENT_POSTS = f"""ep AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id, ts, CAST(floor(value) AS BIGINT) AS score,
    strftime(ts, '%Y-%m-%dT%H') AS hour_key,
    {each("CASE WHEN event_id % 6 = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS {e}")} FROM events)"""

HISTORY = f"""hist AS (SELECT event_id, event_type, ts, strftime(ts, '%Y-%m-%dT%H') AS hour_key,
    {each("CASE WHEN event_id % 6 = {i} THEN value / 100 ELSE 0.0 END AS {e}")}, value FROM events)"""

COMMENTS = f"""com AS (SELECT conv_id AS doc_id, turn, text AS body, role AS author, turn * 3 - 2 AS score,
    {created("conv_id")} + to_minutes(turn) AS created,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth
    FROM conversations WHERE role <> 'system' AND trim(text) <> '')"""

COLLECTED = f"""{COMMENTS},
head AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place FROM documents),
passed AS (SELECT * FROM head WHERE place <= 100 AND doc_id * 37 % 240 <= 168
           AND doc_id IN (SELECT doc_id FROM com GROUP BY doc_id HAVING count(*) >= {COMMENTS_WANTED})),
ranked_posts AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY place) AS listing_pos FROM passed),
got AS (SELECT * FROM ranked_posts WHERE listing_pos <= 15)"""


def clean(c: str) -> str:
    """Quote marks, links, URLs, white space; the other steps change nothing in plain text."""
    for pattern, new in ((rf"(?m)^>+[{SPACES}]*", ""), (X.MARKDOWN_LINK, r"\1"), (rf"https?://[^{SPACES}]+", ""),
                         (rf"[{SPACES}]+", " ")):
        c = f"regexp_replace({c}, '{pattern}', '{new}', 'g')"
    return f"trim({c})"


def model_text(title: str, body: str, comments: str) -> str:
    pad = X.INPUT_INDENT
    return (f"('TITLE: ' || {clean(title)} || chr(10) || '{pad}POST: ' || {clean(body)} || chr(10) || "
            f"'{pad}COMMENTS: ' || coalesce({comments}, ''))")


def joined_comments(limit: int) -> str:
    return (f"cj AS (SELECT doc_id, string_agg({clean('body')}, '{X.COMMENT_SEPARATOR}' ORDER BY turn) AS joined "
            f"FROM com WHERE nth <= {limit} GROUP BY doc_id)")


TITLE = "split_part(d.text, chr(10), 1)"
PREPARED = f"""{COMMENTS}, {joined_comments(300)},
prep AS (SELECT d.doc_id, {model_text(TITLE, "left(d.text, 1400)", "cj.joined")} AS t,
                {model_text(TITLE, "d.text", "cj.joined")} AS whole
         FROM documents d LEFT JOIN cj USING (doc_id))"""
PROMPT = (f"('{X.PROMPT_INTRO}' || chr(10) || '{X.PROMPT_INDENT}{X.PROMPT_RULES}' || chr(10) || '{X.PROMPT_INDENT}' "
          f"|| t || chr(10) || '{X.PROMPT_INDENT}{X.PROMPT_END}')")

NOISY = ("('> ' || text || chr(10) || '>> see [the page](https://a.example/x?y=1)  now ' || "
         "'http://b.example/z tail' || chr(160) || '&amp;  end' || chr(1))")


def step(pattern: str, new: str = "", of: str = "t") -> str:
    return f"regexp_replace({of}, '{pattern}', '{new}', 'g')"


NBSP_OUT = "replace({}, chr(160), ' ')"
PLAIN = f"replace({NBSP_OUT.format('t')}, '&amp;', '&')"
NOISE_OUT = step(rf"https?://[^{SPACES}]+", of=step(X.MARKDOWN_LINK, r"\1", of=step(rf"(?m)^>+[{SPACES}]*", of=PLAIN)))

HTML = "html"
for entity, char in (("copy", "chr(169)"), ("middot", "chr(183)"), ("quot", "chr(34)"), ("amp", "chr(38)")):
    HTML = f"regexp_replace({HTML}, '&{entity};?', {char}, 'g')"

ANSWER = """ans AS (SELECT conv_id, turn, CASE conv_id % 6
    WHEN 0 THEN plain WHEN 1 THEN plain
    WHEN 2 THEN [-turn, 1, 1, 1, 1, CAST('1' || turn AS BIGINT)]
    WHEN 3 THEN [turn, 1, 1, 1, 1, 7] END AS v
    FROM (SELECT *, [turn, 2, 12, 0, 4, 1] AS plain FROM conversations))"""
PARSED = f"""{ANSWER}, parsed AS (SELECT conv_id, turn,
    {each("CAST(CASE WHEN v IS NOT NULL THEN greatest(1, least(10, v[{i} + 1])) END AS INTEGER) AS {e}")} FROM ans)"""


def generated(n: str) -> str:
    return ", ".join(f"CAST(CASE WHEN {n} % 10 <> 0 THEN greatest(1, least(10, {n} % {7 + i})) END AS INTEGER) AS {e}"
                     for i, e in enumerate(EMOTIONS))


def manifest(shard_size: int) -> str:
    return f"""man AS (SELECT printf('shard-%06d', CAST(i + 1 AS INTEGER)) AS shard_id, i + 1 AS n, i * {shard_size} AS start_idx,
    least((i + 1) * {shard_size}, total) - 1 AS end_idx
    FROM (SELECT count(*) AS total FROM documents),
         LATERAL (SELECT unnest(range(CAST(ceil(total / {shard_size}) AS BIGINT))) AS i)),
done AS (SELECT doc_id // {shard_size} + 1 AS n, count(*) AS n_done FROM labels GROUP BY 1),
tasks AS (SELECT man.*, coalesce(n_done, 0) AS chunk_done,
    ['PENDING', 'IN_PROGRESS', 'COMPLETED'][n % 3 + 1] AS status,
    CASE WHEN n % 3 = 1 THEN {NOW} + to_hours(CAST(n % 5 - 2 AS BIGINT)) END AS lease,
    n % 4 AS attempts, {NOW} - to_hours(CAST(n * 7 % 50 AS BIGINT)) AS updated_at
    FROM man LEFT JOIN done USING (n))"""


COPIES = """copies AS (SELECT md5(text) AS post_id, CAST(doc_id AS VARCHAR) AS id, doc_id,
    coalesce(n, 0) AS n_comments FROM documents LEFT JOIN
    (SELECT conv_id AS doc_id, count(*) AS n FROM conversations GROUP BY 1) USING (doc_id)),
uniq AS (SELECT * FROM copies QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY n_comments DESC, doc_id DESC) = 1)"""


def recent(days: int) -> str:
    return f"""WITH {HISTORY} SELECT event_id, hour_key, {shown('ts')} AS ts, {each('round({e}, 6) AS {e}')}
FROM hist WHERE ts >= {NOW} - to_days({days})"""


HOURLY_SUMMARY = f"WITH {EVENT_POSTS}, {summary('ep', 'hour_key', 'event_id')} SELECT * FROM flat"

SENTIMENT = f"WITH {SCORED}, {summary(BY_ID)}"

RUN = f"""WITH {TAXONOMY}, {COLLECTED}, {joined_comments(COMMENTS_WANTED)},
texts AS (SELECT d.doc_id, {model_text(TITLE, "left(d.text, 1400)", "cj.joined")} AS text FROM got d JOIN cj USING (doc_id)),
{lexicon("texts")},
run AS (SELECT CAST(got.doc_id AS VARCHAR) AS id, n_chars % 997 - 20 AS score, (category_pos, community_pos, listing_pos) AS p,
        {each("emo.{e}")} FROM got JOIN emo USING (doc_id) JOIN tax ON subreddit = source),
{summary("run", position="p")} SELECT * FROM flat"""

_letters = ", ".join(f"length(text) - length(replace(text, '{c}', '')) AS {e}" for e, c in zip(EMOTIONS, "jsaflu"))
_total = each("{e}", " + ")

# Predicted values per document; the later of two equal labels counts.
_pairs = {"joy": "n_chars % 10 / 10.0", "sadness": "n_chars % 7 / 10.0", "anger": "n_chars % 13 / 10.0",
          "fear": "0.0", "love": "n_chars % 4 / 10.0", "surprise": "0.0"}


def queries() -> dict[str, str]:
    return {
        "q_sentiment_summary": f"{SENTIMENT} SELECT * FROM flat",
        "q_top_contributors": f"{SENTIMENT} SELECT emotion, rank, post_id, contribution FROM flat",
        "q_summary_by_category": f"""WITH {SCORED}, {TAXONOMY},
            twice AS (SELECT category, CAST(doc_id AS VARCHAR) AS id, doc_id, score, {each("{e}")}
                     FROM scored JOIN tax ON subreddit = source),
            {summary("twice", "category")} SELECT * FROM flat""",
        "q_flattened_summary": f"""WITH {SCORED}, {TAXONOMY},
            twice AS (SELECT (category_pos, community_pos, doc_id) AS p, CAST(doc_id AS VARCHAR) AS id, score, {each("{e}")}
                     FROM scored JOIN tax ON subreddit = source),
            {summary("twice", position="p")} SELECT * FROM flat""",
        "q_summary_by_hour": HOURLY_SUMMARY,
        "q_stream_history": HOURLY_SUMMARY,
        "q_softmax_weights": """WITH kept AS (SELECT CAST(doc_id AS VARCHAR) AS post_id, source,
                pow(1 + n_chars % 997 - 20, 1 / 1.5) AS u FROM documents WHERE n_chars % 997 - 20 > 0)
            SELECT post_id, round(u / sum(u) OVER (), 10) AS w_all,
                   round(u / sum(u) OVER (PARTITION BY source), 10) AS w_own FROM kept""",
        "q_zero_and_negative_scores": f"""WITH {SCORED},
            b AS (SELECT *, CAST(doc_id AS VARCHAR) AS id, CASE WHEN score <= 0 THEN 'no positive score'
                  WHEN {_total} = 0 THEN 'all zero' ELSE 'normal' END AS branch FROM scored),
            {summary("b", "branch")} SELECT * FROM flat""",
        "q_lexicon_scores": f"WITH {SCORED} SELECT CAST(doc_id AS VARCHAR) AS post_id, {each('{e}')} FROM scored",
        "q_lexicon_scores_joined":
            f"WITH {SCORED} SELECT CAST(doc_id AS VARCHAR) AS post_id, {each('{e}')} FROM scored",
        "q_model_scores": f"""WITH n AS (SELECT doc_id, {_letters} FROM documents)
            SELECT CAST(doc_id AS VARCHAR) AS post_id, {each("{e} / greatest(" + _total + ", 1)::DOUBLE AS {e}")} FROM n""",
        "q_normalize_sentiment": f"""WITH p AS (SELECT doc_id, {", ".join(f"({v})::DOUBLE AS {e}" for e, v in _pairs.items())} FROM documents),
            t AS (SELECT *, {_total} AS total FROM p)
            SELECT doc_id, {each("CASE WHEN anger <= 1 THEN round({e} / CASE WHEN total = 0 THEN 1 ELSE total END, 6) END AS {e}")} FROM t""",
        "q_quality_posts": f"""WITH {COLLECTED}
            SELECT source AS post_subreddit, CAST(listing_pos AS INTEGER) AS listing_pos, CAST(doc_id AS VARCHAR) AS post_id,
                   n_chars % 997 - 20 AS post_score, CAST(nth - 1 AS INTEGER) AS comment_no, author,
                   greatest(score, 0) AS score, {shown("created")} AS created, md5(body) AS body_md5
            FROM got JOIN com USING (doc_id) WHERE nth <= {COMMENTS_WANTED}""",
        "q_posts_per_subreddit": f"""WITH {TAXONOMY}, {COLLECTED}
            SELECT category, subreddit AS post_subreddit, count(doc_id) AS n_posts, greatest(15 - count(doc_id), 0) AS shortfall
            FROM tax LEFT JOIN got ON subreddit = source GROUP BY ALL""",
        "q_listing_order": f"""WITH l AS (SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, source, {created("doc_id")} AS made,
                n_chars % 997 - 20 AS score FROM documents),
            r AS (SELECT 'hot' AS method, source, id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos FROM l
                  UNION ALL SELECT 'new', source, id, row_number() OVER (PARTITION BY source ORDER BY made DESC, id) FROM l
                  UNION ALL SELECT 'top', source, id, row_number() OVER (PARTITION BY source ORDER BY score DESC, id) FROM l)
            SELECT method, source AS subreddit, CAST(pos AS INTEGER) AS listing_pos, id FROM r WHERE pos <= 100""",
        "q_normalize_posts": f"""SELECT CAST(doc_id AS VARCHAR) AS post_id, 'https://reddit.com/r/' || source || '/' || doc_id AS post_url,
                s.name AS post_subreddit, n_chars % 997 - 20 AS post_score, n_chars % 50 AS post_comment_count,
                md5({TITLE}) AS title_md5, md5(text) AS text_md5,
                strftime({created("doc_id")}, '%Y-%m-%dT%H:%M:%S+00:00') AS created_iso,
                strftime({NOW}, '%Y-%m-%dT%H:%M:%S+00:00') AS processed_iso, 'bert' AS sentiment_analysis_model
            FROM documents d, LATERAL (SELECT unnest([d.source, 'unknown']) AS name) s""",
        "q_validate_posts": f"""SELECT CAST(doc_id AS VARCHAR) AS post_id, concat_ws(',',
                CASE WHEN n_chars % 997 % 50 - 1 < 0 THEN 'negative comment count' END,
                CASE WHEN doc_id IN (SELECT conv_id FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS nth
                     FROM conversations) WHERE turn * 3 - 2 < 0) THEN 'invalid comment' END,
                CASE WHEN n_chars % 997 / 900.0 > 1 THEN 'sentiment out of range' END,
                CASE WHEN doc_id % 7 - 1 < 0 THEN 'processed before created' END) AS broken FROM documents""",
        "q_taxonomy": f"WITH {TAXONOMY} SELECT category, subreddit FROM tax",
        "q_clean_text_steps": f"""WITH n AS (SELECT doc_id, {NOISY} AS t FROM documents)
            SELECT doc_id, md5({NBSP_OUT.format("t")}) AS nbsp, md5({step(rf"(?m)^>+[{SPACES}]*")}) AS quotes,
                   md5({step(X.MARKDOWN_LINK, chr(92) + "1")}) AS links, md5({step(rf"https?://[^{SPACES}]+")}) AS urls,
                   md5({step(X.NON_PRINTABLE)}) AS controls, md5(trim({step(rf"[{SPACES}]+", " ")})) AS spaces,
                   md5(trim({step(rf"[{SPACES}]+", " ", NOISE_OUT)})) AS cleaned,
                   md5(trim({step(rf"[{SPACES}]+", " ", step(X.NON_PRINTABLE, of=NOISE_OUT))})) AS cleaned_ascii FROM n""",
        "q_clean_text_full": f"SELECT page_id, md5({clean(HTML)}) AS cleaned, md5({HTML}) AS decoded, md5(html) AS nfkc FROM pages",
        "q_prepare_input": f"""WITH {PREPARED} SELECT CAST(doc_id AS VARCHAR) AS post_id, md5(t) AS input_md5,
            md5(whole) AS whole_md5, md5(left(t, 512)) AS model_md5 FROM prep""",
        "q_build_prompt": f"""WITH {PREPARED} SELECT CAST(doc_id AS VARCHAR) AS post_id,
            CAST(length({PROMPT}) AS INTEGER) AS n_chars, md5({PROMPT}) AS prompt_md5,
            md5({PROMPT.replace("|| t ||", "|| whole ||")}) AS whole_md5 FROM prep""",
        "q_label_run": f"""WITH {PREPARED}, n AS (SELECT doc_id, length({PROMPT.replace("|| t ||", "|| whole ||")}) AS len FROM prep)
            SELECT CAST(doc_id AS VARCHAR) AS id, printf('shard-%06d', CAST((row_number() OVER (ORDER BY doc_id) - 1) // 256 + 1 AS INTEGER)) AS shard_id,
                   'fixed' AS model_id, 'w0' AS worker_id, {generated("len")} FROM n""",
        "q_label_progress": """WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
            s AS (SELECT i // 64 AS shard, count(*) AS n, count(*) FILTER (i < 64 OR i % 3 = 0 AND i < 320) AS done FROM r GROUP BY 1)
            SELECT CASE WHEN done = n THEN 'COMPLETED' WHEN done > 0 THEN 'IN_PROGRESS' ELSE 'PENDING' END AS status,
                   count(*) AS n_shards, CAST(sum(done) AS BIGINT) AS records_done FROM s GROUP BY 1""",
        "q_finish_labels": f"""WITH {PREPARED}, n AS (SELECT doc_id, length({PROMPT.replace("|| t ||", "|| whole ||")}) AS len FROM prep)
            SELECT CAST(doc_id AS VARCHAR) AS post_id, printf('shard-%06d', CAST((row_number() OVER (ORDER BY doc_id) - 1) // 256 + 1 AS INTEGER)) AS shard_id,
                   md5(text) AS text_md5, {generated("len")} FROM n JOIN documents USING (doc_id)""",
        "q_published_order": f"""WITH {COPIES} SELECT row_number() OVER (ORDER BY n_comments DESC, doc_id) - 1 AS row_idx, id, n_comments FROM copies""",
        "q_build_report": """WITH d AS (SELECT doc_id % 4 AS n FROM documents)
            SELECT 1 AS archives, count(*) FILTER (n = 3) AS failed, count(*) + count(*) FILTER (n = 1) AS records,
                   count(*) FILTER (n = 3) AS non_objects, count(*) FILTER (n = 2) AS quarantined,
                   count(*) FILTER (n < 2) AS published, count(*) FILTER (n = 1) AS copies,
                   count(*) FILTER (n < 2) AS with_extra FROM d""",
        "q_recent_day": recent(1),
        "q_recent_week": recent(7),
        "q_recent_month": recent(31),
        "q_day_range": f"""WITH {HISTORY}, l AS (SELECT * FROM hist WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
            ORDER BY ts LIMIT 100) SELECT event_id, {shown("ts")} AS ts FROM l WHERE value <= 100""",
        "q_day_range_all": f"""WITH {HISTORY} SELECT event_id, {shown("ts")} AS ts FROM hist
            WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND value <= 100""",
        "q_latest_snapshot": f"""{SENTIMENT} SELECT {shown(NOW)} AS ts,
            {each("round(max(CASE WHEN emotion = '{e}' THEN average END), 6) AS {e}")} FROM flat""",
        "q_history_upsert": f"""WITH {HISTORY} SELECT hour_key, event_id, event_type FROM hist
            WHERE value <= 100
            QUALIFY row_number() OVER (PARTITION BY hour_key ORDER BY event_type = 'click' DESC, ts DESC) = 1""",
        "q_latest_per_hour": f"""WITH {HISTORY} SELECT hour_key, event_id FROM hist
            QUALIFY row_number() OVER (PARTITION BY hour_key ORDER BY ts DESC) = 1""",
        "q_history_rollup": f"""WITH {HISTORY} SELECT {shown("date_trunc('day', ts)")} AS day, count(*) AS n_rows,
            {each("round(avg({e}), 6) AS {e}")} FROM hist GROUP BY 1""",
        "q_history_totals": f"""WITH {SCORED}, k AS (SELECT *, pow(1 + score, 1 / 1.5) AS u, {created("doc_id")} AS made FROM scored WHERE score > 0),
            p AS (SELECT *, unnest(['hour', 'day', 'week', 'month']) AS level FROM k),
            s AS (SELECT level, date_trunc(level, made) AS start, count(*) AS n_posts, {each("sum(u * {e}) AS {e}")} FROM p GROUP BY 1, 2)
            SELECT level, {shown("start")} AS period, n_posts,
                {each("round({e} / CASE WHEN " + each("{e}", " + ") + " = 0 THEN 1 ELSE " + each("{e}", " + ") + " END, 6) AS {e}")} FROM s""",
        "q_fix_timestamps": f"""SELECT event_id, {shown("ts")} AS ts,
            CASE WHEN event_type IN ('click', 'view') THEN {shown(NOW)} ELSE {shown("ts")} END AS updated FROM events""",
        "q_warehouse_shape": f"""{SENTIMENT} SELECT emotion, rank, post_id, CAST(least(length(text), 1024) AS INTEGER) AS preview_chars,
            md5(left(text, 1024)) AS preview_md5 FROM flat JOIN documents ON post_id = CAST(doc_id AS VARCHAR)""",
        "q_legacy_round_trip": f"""{SENTIMENT} SELECT layout, emotion, rank, post_id, md5(text) AS text_md5, 0 AS n_comments
            FROM flat JOIN documents ON post_id = CAST(doc_id AS VARCHAR), (SELECT unnest(['legacy', 'current']) AS layout)""",
        "q_sentiment_run": RUN,
        "q_archive_read": f"""WITH {SCORED} SELECT source AS post_subreddit, count(*) AS n_posts, CAST(sum(score) AS BIGINT) AS score_sum,
            CAST(sum(length(text)) AS BIGINT) AS text_chars, max(CAST(doc_id AS VARCHAR)) AS max_id,
            {shown(f"max({created('doc_id')})")} AS newest, round(sum(joy), 4) AS joy FROM scored GROUP BY 1""",
        "q_ingest_stats": """WITH n AS (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(*) FROM conversations) AS c,
                (SELECT count(*) FROM benchmark) AS b, (SELECT count(*) FROM pages) AS p)
            SELECT d + c + b + p AS n_documents, p AS failed, d + c + b AS n_records FROM n""",
        "q_hourly_post_archive": f"""WITH p AS (SELECT {created("doc_id")} AS made FROM documents)
            SELECT strftime(made, '%Y%m%d%H') AS hour_id, count(*) AS n_posts,
                   strftime(max(made), '%Y-%m-%dT%H:%M:%S+00:00') AS archived_at, count(*) AS n_stored FROM p GROUP BY 1""",
        "q_dedupe_posts": f"WITH {COPIES} SELECT post_id, id, n_comments FROM uniq",
        "q_dedupe_stored": f"""WITH {COPIES} SELECT post_id, id, n_comments, post_id AS text_md5 FROM uniq""",
        "q_dataset_sketch": f"""WITH {COPIES}, n AS (SELECT post_id, CAST(regexp_extract(source, '[0-9]+') AS INTEGER) AS n
                FROM copies JOIN documents USING (doc_id))
            SELECT 'all' AS archives, count(*) AS n_rows, count(DISTINCT post_id) AS n_ids, true AS within_error FROM n
            UNION ALL SELECT 'even', count(*), count(DISTINCT post_id), true FROM n WHERE n % 2 = 0""",
        "q_dataset_stats": f"""WITH {COPIES} SELECT count(*) AS n_rows, count(DISTINCT post_id) AS n_ids, 'archives' AS stage FROM copies
            UNION ALL SELECT count(*), count(DISTINCT post_id), 'dataset' FROM uniq""",
        "q_clean_up": """SELECT DISTINCT stage, source FROM documents, (VALUES ('failed'), ('built'), ('cleaned'), ('again')) s(stage)
            WHERE stage IN ('failed', 'built') OR CAST(regexp_extract(source, '[0-9]+') AS INTEGER) % 2 = 0""",
        "q_split_archive": """SELECT CAST(doc_id AS VARCHAR) AS post_id, source AS post_subreddit, n_chars AS post_score,
            md5(text) AS text_md5 FROM documents""",
        "q_build_dataset": f"""SELECT CAST(doc_id AS VARCHAR) AS post_id, n_chars % 997 - 20 AS post_score,
            {shown(f"{NOW} - to_hours(1)")} AS processed, md5(text) AS text_md5 FROM documents""",
        "q_shard_manifest": f"""WITH {manifest(256)} SELECT shard_id, 'PENDING' AS status, start_idx, end_idx,
            CAST(ceil((end_idx - start_idx + 1) / 64) AS BIGINT) AS chunk_total, CAST(0 AS BIGINT) AS chunk_done,
            0 AS attempts, {shown(NOW)} AS updated FROM man""",
        "q_shard_rows": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)
            SELECT doc_id, row_idx, printf('shard-%06d', CAST(row_idx // 256 + 1 AS INTEGER)) AS shard_id FROM r""",
        "q_chunk_ranges": f"""WITH {manifest(256)},
            c AS (SELECT shard_id, end_idx, unnest(range(start_idx + chunk_done, end_idx + 1, 64)) AS lo FROM tasks),
            d AS (SELECT shard_id, lo, least(lo + 63, end_idx) AS hi FROM c)
            SELECT shard_id, lo, hi, printf('chunk-%07d-%07d', lo, hi) AS chunk, 'annotations/run1/' || shard_id || '/w0' AS prefix FROM d""",
        "q_lease_candidates": f"""WITH {manifest(16)}, w AS (SELECT * FROM tasks WHERE status <> 'COMPLETED' ORDER BY updated_at, shard_id LIMIT 25)
            SELECT shard_id, status, {shown("updated_at")} AS updated FROM w WHERE status = 'PENDING' OR lease IS NULL OR lease < {NOW}""",
        "q_annotation_progress": f"""WITH {manifest(16)} SELECT status, count(*) AS n_shards, CAST(sum(chunk_done) AS BIGINT) AS records_done,
            count(*) FILTER (status = 'IN_PROGRESS' AND (lease IS NULL OR lease < {NOW})) AS expired_leases,
            CAST(sum(attempts) AS BIGINT) AS attempts FROM tasks GROUP BY 1""",
        "q_resume_rows": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, source FROM documents)
            SELECT * FROM r WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "q_pending_rows": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "q_parse_scores": f"WITH {PARSED} SELECT * FROM parsed",
        "q_annotation_records": f"""WITH {PREPARED}, n AS (SELECT doc_id, length({PROMPT}) AS len FROM prep)
            SELECT CAST(doc_id AS VARCHAR) AS id, printf('shard-%06d', CAST(doc_id // 256 + 1 AS INTEGER)) AS shard_id,
                   'fixed' AS model_id, 'run1' AS run_id, {generated("len")} FROM n""",
        "q_annotation_metrics": f"""WITH {PARSED} SELECT count(*) AS items_annotated,
            count(*) FILTER (joy IS NULL) AS json_parse_failures FROM parsed""",
        "q_combine_annotations": f"""WITH {PARSED} SELECT d.doc_id, CASE WHEN p.conv_id IS NOT NULL THEN 'run1:' || p.turn END AS run_id,
            {each("p.{e}")} FROM documents d LEFT JOIN parsed p ON p.conv_id = d.doc_id""",
        "q_stream_dedupe": "SELECT DISTINCT user_id FROM events",
        "q_stream_best_copy": f"""WITH {COPIES} SELECT post_id, id, doc_id AS position, {shown(created("doc_id"))} AS created,
            n_chars % 997 - 20 AS post_score, source AS post_subreddit, n_comments FROM uniq JOIN documents USING (doc_id)""",
        "q_stream_annotate": f"""WITH {PREPARED}, n AS (SELECT doc_id, length({PROMPT}) AS len FROM prep)
            SELECT CAST(doc_id AS VARCHAR) AS id, 'run1' AS run_id, {generated("len")} FROM n""",
        "q_stream_listings": f"""SELECT CAST(doc_id AS VARCHAR) AS post_id, source AS post_subreddit, n_chars % 997 - 20 AS post_score,
            {shown(created("doc_id"))} AS created, md5(text) AS text_md5 FROM documents""",
    }
