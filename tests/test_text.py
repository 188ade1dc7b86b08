"""Cleaning rules on inputs of our own, with literal results."""

import random
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentilake.functions import text as X


def column(spark, make, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r["o"] for r in df.select("i", make(F.col("t")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize("rule, pairs", [
    (X.normalize_unicode, {"Ⅷ": "VIII", "ｶﾞ": "ガ", "é": "é", "naïve Straße": "naïve Straße", "½ m²": "1⁄2 m2", None: None}),
    (X.collapse_whitespace, {"\t\tTab\tstops\t": "Tab stops", "line\r\nbreak": "line break", "один  два": "один два", "\n": "", None: None}),
    (X.strip_blockquotes, {"> > inner": "> inner", ">\nnext": "next", "no\n>quote\nyes": "no\nquote\nyes", "5 > 3": "5 > 3"}),
    (X.remove_markdown_links, {"[x](y)[z](w)": "xz", "![pic](p.png)": "!pic", "[open](never closed": "[open](never closed",
                               "[two words](http://h/p \"t\")": "two words"}),
    (X.drop_bare_urls, {"(https://h.example/p)": "(", "ftp://h.example": "ftp://h.example", "httpx://a": "httpx://a",
                        "один https://h.example/ü два": "один  два"}),
    (X.decode_html_entities, {"&eacute;t&#233;": "été", "3 &lt 4": "3 < 4", "&#x41;&#66;": "AB", "R&D": "R&D", "&unknown;": "&unknown;"}),
    (X.strip_nbsp, {"10 km": "10 km", " ": " ", "plain space": "plain space"}),
    (X.remove_control_chars, {"tab\there": "tabhere", "null\x00byte": "nullbyte", "naïve": "nave", "~ok~": "~ok~"}),
])
def test_rule(spark, rule, pairs):
    assert column(spark, rule, list(pairs)) == list(pairs.values())


@pytest.mark.parametrize("flags, want", [
    ({}, "Read the manual é & more"),
    ({"remove_md_links": False}, "Read [the manual]( é & more"),
    ({"decode_entities": False}, "Read the manual &eacute; &amp; more"),
    ({"strip_quotes": False}, "> Read the manual é & more"),
    ({"strip_controls": True}, "Read the manual & more"),
    ({"remove_urls": False}, "Read the manual é & more http://h.example/q"),
])
def test_rules_together(spark, flags, want):
    text = "> Read [the manual](http://h.example/m)  &eacute; &amp;   more http://h.example/q"
    assert column(spark, lambda c: X.clean_text(c, **flags), [text]) == [want]


def test_model_input_joins_its_parts(spark):
    def made(title, body, comments, **limits):
        c = F.array(*[F.lit(x) for x in comments]).cast("array<string>")
        lines = spark.range(1).select(X.prepare_for_input(F.lit(title), F.lit(body), c, **limits).alias("o")).first()["o"].split("\n")
        return [line.strip() for line in lines]

    assert made("Rain", "wet &amp; cold", ["> yes", "no"]) == ["TITLE: Rain", "POST: wet & cold", "COMMENTS: yes | no"]
    assert made("Rain", None, []) == ["TITLE: Rain", "POST:", "COMMENTS:"]
    assert made("Rain", "abcdef", ["1", "2", "3"], post_limit=4, comment_limit=2)[1:] == ["POST: abcd", "COMMENTS: 1 | 2"]
    assert made("Rain", "ab" * 900, ["7"] * 400, post_limit=None, comment_limit=None)[1:] == ["POST: " + "ab" * 900, "COMMENTS: " + " | ".join(["7"] * 400)]


def test_body_is_cut_before_it_is_cleaned(spark):
    body = "[" + "y" * 1396 + "](http://h.example/long)"
    made = spark.range(1).select(X.prepare_for_input(F.lit(""), F.lit(body), F.lit(None).cast("array<string>")).alias("o")).first()["o"]
    assert "POST: [" + "y" * 1396 + "](h" in made and "example" not in made


def test_prompt_frames_the_input(spark):
    prompt = spark.range(1).select(X.build_prompt(F.lit("Rain"), F.lit("wet"), F.array(F.lit("yes"))).alias("o")).first()["o"]
    assert prompt.index("TITLE: Rain") < prompt.index("POST: wet") < prompt.index("COMMENTS: yes")
    assert prompt.split("\n")[0].strip() and not prompt.endswith("COMMENTS: yes")


def test_lengths_count_characters(spark):
    assert [len(x) for x in column(spark, X.truncate_chars, ["ß" * 700, "short"])] == [512, 5]
    assert column(spark, lambda c: X.truncate_chars(c, None), ["ß" * 700]) == ["ß" * 700]
    assert [x and len(x) for x in column(spark, X.text_preview, ["ö" * 1500, "", None])] == [1024, None, None]


STABLE = ["naïve Straße “quoted” — ‘x’ • €5", "Ωμέγα και άλφα".replace("ά", "ά"), "Привет, мир", "日本語のテキスト", "한국어", "żółw", "é", "👍🏽 ok", ""]
UNSTABLE = ["Ⅷ", "ｶﾞ", "e\u0301", "½", "a\u00a0b", "ﬁ", "\u1100\u1161", "x\u0323\u0307", "²", "\u2026", "\u212b", "\U0001d400"]


def test_only_texts_that_nfkc_can_change_are_sent(spark):
    df = spark.createDataFrame([(t,) for t in STABLE + UNSTABLE], "t string")
    sent = {r.t for r in df.where(X._may_change(F.col("t"), True, False)).collect()}
    assert set(UNSTABLE) <= sent and not sent & set(STABLE[:1] + STABLE[2:])
    assert {r.t: r.n for r in df.select("t", X.normalize_unicode(F.col("t")).alias("n")).collect()} == \
        {t: unicodedata.normalize("NFKC", t) for t in STABLE + UNSTABLE}


def test_texts_that_are_not_sent_are_their_own_nfkc_form(spark):
    """Every character alone, and mixtures of letters, marks and Hangul parts in any order."""
    rng = random.Random(4)
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    marks = [c for c in every if unicodedata.category(c)[0] == "M"]
    pools = [marks, every, [chr(c) for c in range(0x41, 0x600)], [chr(c) for c in range(0x1100, 0x1200)], [chr(c) for c in range(0x900, 0xE00)]]
    mixed = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.choice([2, 3]))) for _ in range(60_000)]
    df = spark.createDataFrame([(t,) for t in every + mixed], "t string").repartition(8)
    kept = [r.t for r in df.where(~X._may_change(F.col("t"), True, False)).collect()]
    assert len(kept) > 100_000 and [t for t in kept if unicodedata.normalize("NFKC", t) != t] == []


def test_elements_of_an_array_are_sent_one_by_one(spark):
    rows = [(["plain", "½ &amp; é", None, "ｶﾞ"],), ([None],), ([],), (None,), (["é", "no change"],)]
    got = [r[0] for r in spark.createDataFrame(rows, "t array<string>").coalesce(1).select(X.clean_texts(F.col("t"))).collect()]
    assert got == [["plain", "1⁄2 & é", None, "ガ"], [None], [], None, ["é", "no change"]]


def test_a_worker_holds_a_few_texts_at_a_time():
    """20 MB of texts in one batch, of which a slice is Python objects at once."""
    texts = pa.array([None, *(f"{i} &amp; " + "x" * 10_000 for i in range(2000))], pa.string())
    tracemalloc.start()
    got = X._in_slices(texts, lambda t: X._decode(t, True, True, True), pa.string())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [None, *(f"{i} & " + "x" * 10_000 for i in range(2000))] and peak < 8 << 20
    assert X._in_slices(pa.array([], pa.string()), str, pa.string()).to_pylist() == []
