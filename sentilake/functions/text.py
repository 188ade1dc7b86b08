"""Text cleaning and model-input assembly as column expressions.

Everything is built-in regular-expression work except NFKC and HTML5 entity
decoding, which Spark has no function for. Those two share one Arrow UDF hop, and
only texts that can change are sent through it, of an array only those elements: text
without an ampersand or a character that NFKC changes, joins to others or puts in another
order is handed over as NULL and taken from the original column.
"""

import functools
import html
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from sentilake.functions.sentiment import bind
from sentilake.schemas import COMMENT_COUNT, MODEL_CHARS, POST_CHARS, PREVIEW_CHARS

# White space is the Unicode property, which (?U) gives \s, and four
# separators that it leaves out.
WS = r"[\s\x1c-\x1f]"
NOT_WS = r"[^\s\x1c-\x1f]"
NBSP = "\u00a0"

# Cleaning patterns. (?d) makes only \n start a line. White space is
# collapsed by a pattern that matches nothing in runs of single spaces.
VISIBLE = f"(?U){NOT_WS}"
WS_EDGES = rf"(?U)\A{WS}+|{WS}+\z"
SPACE_RUN = rf"(?U){WS}{{2,}}|[^\S ]|[\x1c-\x1f]"
QUOTE_MARKS = f"(?mdU)^>+{WS}*"
MARKDOWN_LINK = r"\[([^\]]+)\]\([^)]+\)"
BARE_URL = f"(?U)https?://{NOT_WS}+"
NON_PRINTABLE = r"[^\x20-\x7e]+"

# Text put to the annotator.
PROMPT_INTRO = "You are an expert annotator of emotional tone in Reddit content."
PROMPT_RULES = (
    "Score each sentiment as an integer 1..10 (1=absent, 5=noticeable, 10=dominant). "
    "Output ONLY JSON with keys: joy, sadness, anger, fear, love, surprise."
)
PROMPT_END = "Return JSON only."
INPUT_INDENT = " " * 16
PROMPT_INDENT = " " * 12
COMMENT_SEPARATOR = " | "

# Fixed value: texts that a Python worker holds as objects at a time.
SLICE = 128


def _decode(text: str | None, nfkc: bool, nbsp: bool, entities: bool) -> str | None:
    if text is None:
        return None
    if nfkc:
        text = unicodedata.normalize("NFKC", text)
    if nbsp:
        text = text.replace(NBSP, " ")
    return html.unescape(text) if entities else text


def _in_slices(values: pa.Array, use, kind: pa.DataType) -> pa.Array:
    """``use`` of every value, a few at a time: only those are Python objects at once."""
    cut = [values.slice(k, SLICE) for k in range(0, len(values), SLICE)]
    return pa.concat_arrays([pa.array([use(v) for v in part.to_pylist()], kind) for part in cut] or [pa.array([], kind)])


def _decoder(nfkc: bool, nbsp: bool, entities: bool, many: bool = False):
    """Arrow UDF for one text, or for every text of an array."""

    def decode(text: str | None) -> str | None:
        return _decode(text, nfkc, nbsp, entities)

    if many:

        @F.arrow_udf(T.ArrayType(T.StringType()))
        def decode_all(texts: pa.Array) -> pa.Array:
            return _in_slices(texts, lambda row: None if row is None else [decode(t) for t in row], pa.list_(pa.string()))

        return decode_all

    @F.arrow_udf(T.StringType())
    def decode_one(texts: pa.Array) -> pa.Array:
        return _in_slices(texts, decode, pa.string())

    return decode_one


@functools.cache
def unstable_characters(gap: int = 4) -> str:
    """A pattern for characters without which a text is its own NFKC form.

    They are those that NFKC replaces, those that combine and so may change places, and
    those that may join to the character before. Ranges that lie close together are put
    together, which sends a few texts more. ASCII and C1 characters are stable.
    """
    joining = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # Hangul vowels and finals, composed by rule
    changed = set()
    for code in range(0xA0, sys.maxunicode + 1):
        c = chr(code)
        if 0xD800 <= code <= 0xDFFF:
            continue
        if unicodedata.combining(c) or unicodedata.normalize("NFKC", c) != c:
            changed.add(code)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            joining.add(int(parts[1], 16))
    ranges = []
    for code in sorted(changed | joining):
        # Letters with accents lie between the first ones, so those stay apart.
        if ranges and code - ranges[-1][1] <= (gap if ranges[-1][0] > 0x250 else 1):
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    inside = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges)
    return rf"[\x{{a0}}-\x{{10ffff}}&&[{inside}]]"


def _may_change(c: Column, nfkc: bool, entities: bool) -> Column:
    touched = F.lit(False)
    if nfkc:
        touched = touched | c.rlike(unstable_characters())
    if entities:
        touched = touched | c.contains("&")
    return touched


def normalize_unicode(c: Column) -> Column:
    """NFKC form."""
    return F.coalesce(_decoder(True, False, False)(F.when(_may_change(c, True, False), c)), c)


def decode_html_entities(c: Column) -> Column:
    """HTML5 entities to characters, also those without a closing semicolon."""
    return F.coalesce(_decoder(False, False, True)(F.when(_may_change(c, False, True), c)), c)


def strip_nbsp(c: Column) -> Column:
    return F.replace(c, F.lit(NBSP), F.lit(" "))


def strip_text(c: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(c, WS_EDGES, "")


def is_blank(c: Column) -> Column:
    return F.coalesce(~c.rlike(VISIBLE), F.lit(True))


def collapse_whitespace(c: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE_RUN, " "))


def _replace_where(c: Column, sign: str, pattern: str, new: str) -> Column:
    """Replace a pattern, skipping texts without the ``sign`` every match contains."""
    return F.when(c.contains(sign), F.regexp_replace(c, pattern, new)).otherwise(c)


def strip_blockquotes(c: Column) -> Column:
    return _replace_where(c, ">", QUOTE_MARKS, "")


def remove_markdown_links(c: Column) -> Column:
    return _replace_where(c, "](", MARKDOWN_LINK, "$1")


def drop_bare_urls(c: Column) -> Column:
    return _replace_where(c, "://", BARE_URL, "")


def remove_control_chars(c: Column) -> Column:
    """Drop control characters and everything outside ASCII."""
    return F.regexp_replace(c, NON_PRINTABLE, "")


def _clean_decoded(
    c: Column, strip_quotes: bool, remove_md_links: bool, remove_urls: bool,
    strip_controls: bool, collapse_ws: bool,
) -> Column:
    steps = (
        (strip_quotes, strip_blockquotes),
        (remove_md_links, remove_markdown_links),
        (remove_urls, drop_bare_urls),
        (strip_controls, remove_control_chars),
        (collapse_ws, collapse_whitespace),
    )
    for wanted, step in steps:
        if wanted:
            c = bind(c, step)
    return c


def clean_text(
    c: Column, *, normalize: bool = True, strip_nbsp: bool = True,
    decode_entities: bool = True, strip_quotes: bool = True,
    remove_md_links: bool = True, remove_urls: bool = True,
    collapse_ws: bool = True, strip_controls: bool = False,
) -> Column:
    """The whole cleaning sequence; each flag switches one step."""
    plain = F.replace(c, F.lit(NBSP), F.lit(" ")) if strip_nbsp else c
    decoded = plain
    if normalize or decode_entities:
        send = F.when(_may_change(c, normalize, decode_entities), c)
        decoded = F.coalesce(_decoder(normalize, strip_nbsp, decode_entities)(send), plain)
    return _clean_decoded(
        decoded, strip_quotes, remove_md_links, remove_urls, strip_controls, collapse_ws
    )


def clean_texts(texts: Column) -> Column:
    """``clean_text`` with default flags on every element, in one UDF hop per row."""
    send = F.transform(texts, lambda t: F.when(_may_change(t, True, True), t))
    some = F.when(F.exists(send, lambda t: t.isNotNull()), send)
    changed = _decoder(True, True, True, many=True)(some)
    decoded = F.coalesce(F.zip_with(changed, texts, lambda new, old: F.coalesce(new, old)), texts)
    return F.transform(decoded, lambda t: _clean_decoded(t, True, True, True, False, True))


def comment_bodies(comments: Column) -> Column:
    return F.transform(comments, lambda c: c["body"])


def prepare_for_input(
    title: Column, body: Column, comments: Column,
    post_limit: int | None = POST_CHARS, comment_limit: int | None = COMMENT_COUNT,
) -> Column:
    """Model input from title, body and comment bodies.

    ``post_limit`` counts characters of the uncleaned body, ``comment_limit`` counts
    comments; 0 or None lifts either. NULL text counts as empty.
    """
    empty = F.lit("")
    body = F.coalesce(body, empty)
    if post_limit:
        body = F.substring(body, 1, post_limit)
    comments = F.coalesce(comments, F.array().cast("array<string>"))
    if comment_limit:
        comments = F.slice(comments, 1, comment_limit)
    comments = F.transform(comments, lambda c: F.coalesce(c, empty))
    texts = F.concat(F.array(F.coalesce(title, empty), body), comments)

    def labelled(t: Column, i: Column) -> Column:
        label = (
            F.when(i == 0, "TITLE: ")
            .when(i == 1, f"\n{INPUT_INDENT}POST: ")
            .when(i == 2, f"\n{INPUT_INDENT}COMMENTS: ")
            .otherwise(COMMENT_SEPARATOR)
        )
        return F.concat(label, t)

    no_comments = F.when(F.size(comments) == 0, f"\n{INPUT_INDENT}COMMENTS: ").otherwise("")
    return F.concat(F.array_join(F.transform(clean_texts(texts), labelled), ""), no_comments)


def build_prompt(
    title: Column, body: Column, comments: Column,
    post_limit: int | None = POST_CHARS, comment_limit: int | None = COMMENT_COUNT,
) -> Column:
    """Annotator instruction around the model input."""
    return F.concat(
        F.lit(f"{PROMPT_INTRO}\n{PROMPT_INDENT}{PROMPT_RULES}\n{PROMPT_INDENT}"),
        prepare_for_input(title, body, comments, post_limit, comment_limit),
        F.lit(f"\n{PROMPT_INDENT}{PROMPT_END}"),
    )


def truncate_chars(c: Column, n: int | None = MODEL_CHARS) -> Column:
    """What the classifier accepts of a text, counted in characters."""
    return F.substring(c, 1, n) if n else c


def text_preview(c: Column, n: int = PREVIEW_CHARS) -> Column:
    """Leading characters, NULL for empty text."""
    return F.when(F.length(c) > 0, F.substring(c, 1, n))
