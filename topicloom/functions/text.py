"""Text clean-up, reply parsing and prompt building as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters counted as white space when text is trimmed.
SPACES = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Separators, limits and prefixes of the text formats.
EXAMPLE_SEPARATOR = "\n---\n"
TITLE_BODY_SEPARATOR = " - "
KEYWORD_SEPARATOR = "; "
EXCERPT_LIMIT = 280
KEYWORD_LIMIT = 12
REPLY_LABEL_LIMIT = 120
SITE_PREFIX = "https://www.reddit.com"

# The prompt texts.
TOPIC_PROMPT = (
    "You are labeling a topic cluster from Reddit posts.\n"
    "Topic id: {topic}\n"
    "Provide a concise topic label (5-8 words) and a 1-2 sentence summary.\n"
    "Examples:\n"
    "{examples}\n"
    "Return JSON with keys: label, summary."
)
GROUP_PROMPT = (
    "You are labeling a {level} topic group.\n"
    "Existing label/keywords: {label}\n"
    "Provide a concise label (5-8 words) and a 1-2 sentence summary.\n"
    "Examples:\n"
    "{examples}\n"
    "Return JSON with keys: label, summary."
)
SPLIT_PROMPT = (
    "You are reviewing a topic cluster from Reddit posts.\n"
    "Topic id: {topic}\n"
    "Decide whether this topic should be split into two themes.\n"
    "Return JSON with keys: action ('keep' or 'split'), reason.\n"
    "Examples:\n"
    "{examples}\n"
)
MERGE_PROMPT = (
    "You are comparing two topic clusters from Reddit posts.\n"
    "Topic A: {topic_a}\n"
    "{examples_a}\n"
    "Topic B:\n"
    "{examples_b}\n"
    "Return JSON with keys: merge (true/false), reason.\n"
)
ANCHOR_PROMPT = (
    "You are defining subtopics for a large Reddit topic cluster.\n"
    "Parent L2 label: {l2_label}\n"
    "Create {max_anchors} or fewer L3 anchors that capture distinct intents.\n"
    "Return JSON with key: anchors (list of objects with keys label, keywords).\n"
    "Each keywords value should be a list of 3-6 search phrases.\n"
    "Examples:\n"
    "{examples}\n"
)
KEYWORD_PROMPT = (
    "You are creating Google search keyword ideas from Reddit posts.\n"
    "L2 theme: {l2_label}\n"
    "L3 theme: {l3_label}\n"
    "Return JSON with key: keywords (list of 8-12 phrases).\n"
    "Examples:\n"
    "{examples}\n"
)


def strip(text: Column) -> Column:
    """Trim white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def non_empty(text: Column) -> Column:
    """Trimmed text, or null when nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def build_text(title: Column, body: Column) -> Column:
    """Title, blank line, body; a missing part counts as empty."""
    return F.concat(F.coalesce(title.cast("string"), F.lit("")), F.lit("\n\n"), F.coalesce(body.cast("string"), F.lit("")))


def title_and_body(title: Column, body: Column) -> Column:
    """The non-empty trimmed parts joined by a dash; empty text when both are missing."""
    return F.concat_ws(TITLE_BODY_SEPARATOR, non_empty(title), non_empty(body))


def make_excerpt(title: Column, body: Column, limit: int = EXCERPT_LIMIT) -> Column:
    """The joined text; when longer than ``limit``, cut there, right-trimmed, and marked with dots."""
    text = title_and_body(title, body)
    cut = F.rtrim(F.substring(text, 1, limit), F.lit(SPACES))
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(cut, F.lit("...")))


def build_permalink(link: Column, prefix: str = SITE_PREFIX) -> Column:
    """Absolute links as they are, other text behind the site prefix, missing -> empty."""
    absolute = link.startswith("http://") | link.startswith("https://")
    return F.when(link.isNull(), F.lit("")).when(absolute, link).otherwise(F.concat(F.lit(prefix), link))


def _drop_json_word(text: Column) -> Column:
    """Trimmed text without a leading ``json``."""
    rest = F.ltrim(F.substr(text, F.lit(5)), F.lit(SPACES))
    return F.when(F.lower(F.substring(text, 1, 4)) == "json", rest).otherwise(text)


FENCE = "```"


def strip_code_fences(text: Column) -> Column:
    """Reply text without a Markdown fence, leading quotes, or the word ``json`` before or after them."""
    trimmed = strip(F.coalesce(text, F.lit("")))
    fenced = trimmed.startswith(FENCE) & trimmed.endswith(FENCE) & (F.char_length(trimmed) >= 6)
    inside = strip(F.substr(trimmed, F.lit(4), F.char_length(trimmed) - 6))
    body = F.when(fenced, strip(_drop_json_word(inside))).otherwise(trimmed)
    unquoted = F.ltrim(F.ltrim(_drop_json_word(body), F.lit("'\"")), F.lit(SPACES))
    return _drop_json_word(unquoted)


def _is_object(text: Column) -> Column:
    braces = text.startswith("{") & text.endswith("}")
    return braces & F.try_parse_json(F.when(braces, text)).isNotNull()


def reply_value(text: Column, key: str | None = None) -> Column:
    """The value under ``key`` of a JSON reply (missing or null -> empty); other replies as cleaned text."""
    cleaned = strip_code_fences(text)
    if key is None:
        return cleaned
    found = F.coalesce(strip(F.get_json_object(cleaned, f"$.{key}")), F.lit(""))
    return F.when(_is_object(cleaned), found).otherwise(cleaned)


def _unfence(text: Column) -> Column:
    trimmed = strip(text)
    bare = F.when(trimmed.startswith(FENCE), strip(F.btrim(trimmed, F.lit("`")))).otherwise(trimmed)
    return _drop_json_word(bare)


def clean_label(text: Column) -> Column:
    """Label text without fence, leading ``json``, and outer quotes or spaces."""
    return F.btrim(_unfence(text), F.lit("'\" "))


def _braced(text: Column) -> Column:
    first = F.instr(text, "{")
    last = F.char_length(text) - F.instr(F.reverse(text), "}") + 1
    return F.when((first > 0) & (last > first) & F.contains(text, F.lit("}")), F.substr(text, first, last - first + 1))


def json_block(text: Column) -> Column:
    """From the first opening to the last closing brace; the unfenced text when there is no such pair."""
    return F.coalesce(_braced(text), _unfence(text))


def parse_keywords(reply: Column, limit: int = KEYWORD_LIMIT) -> Column:
    """Keywords of a JSON reply, fenced or not; the first ``limit`` parts of comma-separated text.

    Text that begins with a brace is no list of keywords, so broken JSON gives none.
    """
    cleaned = _unfence(F.coalesce(reply, F.lit("")))
    listed = F.from_json(F.when(_is_object(cleaned), cleaned), "keywords array<string>")["keywords"]
    from_list = F.filter(F.transform(listed, strip), lambda k: k.isNotNull() & (k != ""))
    parts = F.filter(F.transform(F.split(cleaned, ","), strip), lambda k: k != "")
    empty = F.array().cast("array<string>")
    return F.when(cleaned.startswith("{"), F.coalesce(from_list, empty)).otherwise(F.slice(parts, 1, limit))


ANCHOR_SCHEMA = "anchors array<struct<label:string,keywords:array<string>>>, raw string"


def parse_anchors(reply: Column) -> Column:
    """Anchors of a reply given as JSON, as fenced JSON, or as JSON wrapped under ``raw``; bad -> empty."""
    outer = F.from_json(_braced(reply), ANCHOR_SCHEMA)
    inner = F.from_json(_braced(outer["raw"]), ANCHOR_SCHEMA)
    empty = F.array().cast("array<struct<label:string,keywords:array<string>>>")
    return F.coalesce(outer["anchors"], inner["anchors"], empty)


def anchor_text(label: Column, keywords: Column) -> Column:
    """The text an anchor is embedded as."""
    return F.concat(label, F.lit(". Keywords: "), F.array_join(keywords, ", "))


def keyword_list(keywords: Column) -> Column:
    """Keywords as one stored string."""
    return F.array_join(keywords, KEYWORD_SEPARATOR)


def fill_prompt(template: str, **values: Column) -> Column:
    """A prompt text with its named places filled by columns."""
    pieces, rest = [], template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            pieces.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        pieces.append(values[name].cast("string"))
    return F.concat(*pieces)


def join_examples(examples: Column) -> Column:
    """Examples as one block of a prompt."""
    return F.array_join(examples, EXAMPLE_SEPARATOR)


def reply_label(reply: Column, limit: int = REPLY_LABEL_LIMIT) -> Column:
    """The label of a reply; a reply that is not JSON gives its first ``limit`` characters."""
    trimmed = strip(reply)
    value = F.coalesce(F.get_json_object(trimmed, "$.label"), F.lit(""))
    return F.when(_is_object(trimmed), value).otherwise(F.substring(trimmed, 1, limit))


def reply_summary(reply: Column) -> Column:
    """The summary of a reply; a reply that is not JSON gives its whole text."""
    trimmed = strip(reply)
    value = F.coalesce(F.get_json_object(trimmed, "$.summary"), F.lit(""))
    return F.when(_is_object(trimmed), value).otherwise(trimmed)


def reply_or_raw(reply: Column) -> Column:
    """The reply when it is JSON, otherwise an object holding it under ``raw``."""
    trimmed = strip(reply)
    return F.when(_is_object(trimmed), trimmed).otherwise(F.to_json(F.struct(trimmed.alias("raw"))))


def split_decision(action: Column) -> Column:
    """The action of a split reply in lower case; missing means keep."""
    return F.lower(F.coalesce(action, F.lit("keep")))


def merge_decision(value: Column) -> Column:
    """Only a true boolean (or its spelling) approves a merge."""
    return F.coalesce(F.lower(strip(value.cast("string"))) == "true", F.lit(False))


def numeric_score(value: Column) -> Column:
    """A number, or 0 for anything missing or unreadable."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)
