"""Column functions over texts, titles, numbers and URLs. All of them are built-in expressions: nothing leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def any_of(text: Column, words: Iterable[str]) -> Column:
    """Whether the text holds one of the words (null: no)."""
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return F.coalesce(hit, F.lit(False))


def first_of(text: Column, words: Iterable[str]) -> Column:
    """The first word, in list order, that the text holds; null if none."""
    return F.coalesce(*[F.when(text.contains(w), F.lit(w)) for w in words])


def first_pattern(text: Column, patterns: Iterable[str], value=None) -> Column:
    """The first pattern, in list order, that the text matches (or value(pattern)); null if none. Letters and digits are those of all scripts."""
    return F.coalesce(*[F.when(text.rlike(f"(?U){p}"), F.lit(p if value is None else value(p))) for p in patterns])


def host(url: Column) -> Column:
    """Lower-cased host, '' if there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2), r"^.*@", ""), r":\d*$", ""))


def host_in(url: Column, domains: Iterable[str]) -> Column:
    """Whether the host is one of the domains or lies below one (B2)."""
    return host(url).rlike(r"(^|\.)(" + "|".join(d.replace(".", r"\.") for d in domains) + ")$")


def host_ends(url: Column, suffixes: Iterable[str]) -> Column:
    return host(url).rlike("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$")


def normalize_url(url: Column, drop: Iterable[str] = rules.TRACKING_PARAMS) -> Column:
    """Scheme and host in lower case, no fragment, no slash at the end, no tracking parameters, the others sorted; '' for null (G1)."""
    u = F.coalesce(url, F.lit(""))
    part = lambda k: F.regexp_extract(u, _URL, k)
    scheme, netloc, path, query = part(1), part(2), F.regexp_replace(part(3), "/$", ""), part(4)
    decoded = lambda c: F.coalesce(F.try_url_decode(c), c)  # noqa: E731  a malformed escape stays as it is
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""),
        lambda x: F.struct(decoded(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), decoded(F.regexp_extract(x, "=(.*)$", 1)).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*drop)))
    sorted_query = F.array_join(F.transform(kept, lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"]))), "&")
    return F.concat(
        F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(F.lit("")),
        F.when(netloc != "", F.concat(F.lit("//"), F.lower(netloc))).otherwise(F.lit("")),
        path,
        F.when(sorted_query != "", F.concat(F.lit("?"), sorted_query)).otherwise(F.lit("")),
    )


def normalize_number(s: Column) -> Column:
    """Official number without blanks, brackets and its year and number words."""
    return F.lower(F.regexp_replace(F.coalesce(s, F.lit("")), rules.NUMBER_NOISE, ""))


def normalize_title(s: Column) -> Column:
    """Title without blanks and punctuation."""
    return F.lower(F.regexp_replace(F.coalesce(s, F.lit("")), rules.TITLE_NOISE, ""))


def short_hash(s: Column, n: int = 16) -> Column:
    """First n hex digits of SHA-1; '' for null and '' (G4)."""
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("")).otherwise(F.substring(F.sha1(s.cast("binary")), 1, n))


def key_id(prefix: str, *parts: Column, n: int = 16, sha2: bool = False) -> Column:
    """prefix + first hex digits of the hash of the parts joined by '|'."""
    joined = F.concat_ws("|", *parts)
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256) if sha2 else F.sha1(joined.cast("binary")), 1, n))


def squeeze(s: Column) -> Column:
    """Blanks in a row become one, none at the ends."""
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def sanitize(s: Column) -> Column:
    """Control characters and U+FFFD become blanks, then squeeze; null is '' (G15)."""
    return squeeze(F.regexp_replace(F.coalesce(s, F.lit("")), "[\x00-\x08\x0b\x0c\x0e-\x1f�]", " "))


def file_name(title: Column) -> Column:
    """A title as a file name: no separators or control characters, 80 characters at most."""
    t = F.trim(F.substring(F.regexp_replace(F.coalesce(title, F.lit("")), '[\\\\/:*?"<>|\x00-\x1f]', "_"), 1, 80))
    return F.when(t == "", F.lit("untitled")).otherwise(t)


def window_around(text: Column, start: Column, length: Column, before: int = 80, after: int = 120) -> Column:
    """Evidence: the text around 1-based `start`, squeezed."""
    lo = F.greatest(F.lit(1), start - before)
    return squeeze(F.substring(text, lo, start + length + after - lo))


def window_from_anchor(text: Column, anchors: Iterable[str] = rules.WINDOW_ANCHORS, length: int = 280) -> Column:
    """Evidence from the first anchor word on, or from the beginning."""
    t = F.coalesce(text, F.lit(""))
    at = F.array_min(F.filter(F.array(*[F.locate(a, t) for a in anchors]), lambda p: p > 0))
    return squeeze(F.substring(t, F.coalesce(at, F.lit(1)), F.lit(length)))


def window_at_keyword(text: Column, keyword: Column, before: int = 45, after: int = 75, head: int = 120) -> Column:
    """Evidence around a keyword in the sanitized text; its head if the keyword is missing."""
    t = sanitize(text)
    at = F.when(F.coalesce(keyword, F.lit("")) == "", F.lit(0)).otherwise(F.instr(t, keyword))
    lo = F.greatest(F.lit(1), at - before)
    return F.when(at > 0, F.substring(t, lo, at + after - lo)).otherwise(F.substring(t, 1, head))


def char_set(s: Column) -> Column:
    """The distinct characters of a text as an array."""
    return F.array_distinct(F.filter(F.split(F.coalesce(s, F.lit("")), ""), lambda c: c != ""))


def set_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values; 0 for two empty ones."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(all_ > 0, both / all_).otherwise(F.lit(0.0))


def char_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of the sets of characters; 0 for two empty titles."""
    return set_jaccard(char_set(a), char_set(b))


def classify(text: Column, groups: Mapping[str, Iterable[str]], default: str) -> Column:
    """The first group, in order, of which the text holds a keyword."""
    c = None
    for name, words in groups.items():
        c = F.when(any_of(text, words), F.lit(name)) if c is None else c.when(any_of(text, words), F.lit(name))
    return c.otherwise(F.lit(default))


def role_of(text: Column, roles: Mapping[str, Iterable[str]] = rules.ROLE_KEYWORDS) -> Column:
    """STRUCT<role, keyword>: the first keyword in order of roles and of their words."""
    flat = [(r, w) for r, words in roles.items() for w in words]
    hit = F.coalesce(*[F.when(text.contains(w), F.struct(F.lit(r).alias("role"), F.lit(w).alias("keyword"))) for r, w in flat])
    return F.coalesce(hit, F.struct(F.lit("interpretation").alias("role"), F.lit("").alias("keyword")))


def signal_type_of(title: Column, body: Column, kinds: Mapping[str, Iterable[str]] = rules.SIGNAL_KEYWORDS) -> Column:
    """By the title first, then by title and body."""
    by_title = classify(title, kinds, "")
    return F.when(by_title != "", by_title).otherwise(classify(F.concat_ws(" ", title, body), kinds, "unknown"))


def themes_of(text: Column, registry: Mapping[str, Iterable[str]]) -> Column:
    """Themes whose id or an alias occurs in the text, case ignored, in registry order (G18). For registries as tables see operators.signals."""
    low = F.lower(text)
    hits = [F.when(any_of(low, [str(x).strip().lower() for x in (t, *aliases) if str(x).strip()]), F.lit(t)) for t, aliases in registry.items()]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def lines_of(themes: Column, lines: Mapping[str, Iterable[str]] = rules.BUSINESS_LINES) -> Column:
    """Business lines of themes, without repeats, in order."""
    table = F.create_map(*[x for k, v in lines.items() for x in (F.lit(k), F.array(*[F.lit(y) for y in v]))])
    return F.array_distinct(F.flatten(F.transform(themes, lambda t: F.coalesce(F.try_element_at(table, t), F.array().cast("array<string>")))))


def time_validity(signal_type: Column, title: Column, body: Column) -> Column:
    return F.when(signal_type == "price_signal", "price_window").when(any_of(F.concat_ws(" ", title, body), ("季度", "Q1", "Q2", "Q3", "Q4")), "quarterly").when(signal_type == "unknown", "unknown").otherwise("point_in_time")


def readable(body: Column, share: float = 0.96) -> Column:
    """False for binary remains: a PDF head, NUL or U+FFFD early on, or too few printable characters among the first 1000."""
    b = F.coalesce(body, F.lit(""))
    head, sample = F.substring(b, 1, 500), F.substring(b, 1, 1000)
    odd = head.contains("%PDF-") | head.contains("\x00") | head.contains("�")
    good = F.length(F.regexp_replace(sample, r"[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Zs}\s]", ""))
    return (F.trim(b) == "") | (~odd & (good / F.greatest(F.length(sample), F.lit(1)) >= share))


def low_quality(text: Column, markers: Iterable[str] = (), min_len: int = 200, short_len: int = 500) -> Column:
    """Shorter than min_len, or shorter than short_len with a marker."""
    n = F.length(F.trim(F.coalesce(text, F.lit(""))))
    return (n < min_len) | ((n < short_len) & any_of(text, markers))


def strip_html(html: Column, min_len: int = 500, tags: str = "script|style|nav|header|footer") -> Column:
    """Main text of a stored page: the given elements cut out, tags to blanks, entities decoded; null when short."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), rf"(?is)<({tags})\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->|<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    t = squeeze(t)
    return F.when(F.length(t) >= min_len, t)


def json_block(text: Column, schema: str) -> Column:
    """The outermost {...} of a free text, parsed; null fields where it isn't JSON of that schema."""
    return F.from_json(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?s)(\{.*\})", 1), schema, {"mode": "PERMISSIVE"})


def quoted_title(title: Column) -> Column:
    """The title in the first pair of title marks, else the title without an interpretation tail."""
    inner = F.regexp_extract(F.coalesce(title, F.lit("")), r"《([^》]+)》", 1)
    return F.when(inner != "", inner).otherwise(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"(的)?(政策|文字)?(解读|问答|图解).*$", "")))


def references(text: Column) -> Column:
    """Titles in title marks, first appearances, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"《([^》]{4,80})》"), F.lit(1)))


def id_segments(pid: Column) -> Column:
    """STRUCT<year, issuer, tail> of an id P_<year>_<issuer parts>_<tail>."""
    p = F.split(pid, "_")
    n = F.size(p)
    return F.struct(F.get(p, F.lit(1)).alias("year"), F.when(n > 3, F.array_join(F.slice(p, F.lit(3), F.greatest(F.lit(0), n - 3)), "_")).otherwise(F.lit("")).alias("issuer"), F.when(n > 3, F.element_at(p, -1)).otherwise(F.lit("")).alias("tail"))


def flat_list(values: Column) -> Column:
    """A list of names as one string: blanks trimmed, empty ones left out, joined by the enumeration comma."""
    return F.array_join(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")), "、")


def year_of(date: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(F.coalesce(date, F.lit("")), r"^(\d{4})", 1), F.lit("")), F.lit("9999")).cast("int")


def reasons(*pairs: tuple[Column, Column | str]) -> Column:
    """The reasons whose condition holds, in the given order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), r if isinstance(r, Column) else F.lit(r)) for c, r in pairs]))


def title_of_file(name: Column) -> Column:
    """A title out of a file name (G28): what 【】 at its beginning hold, else the name without .md, a host at the end and the extension of a page; never empty where the stem isn't."""
    stem = F.regexp_replace(name, r"\.md(?!.*\.md).*$", "")
    bare = F.trim(F.regexp_replace(F.regexp_replace(stem, r"\s*-\s*[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_.]+$", ""), r"(?i)\.(pdf|html|htm|shtml)$", ""))
    marked = F.regexp_extract(stem, "^【(.*?)】", 1)
    return F.when(stem.rlike("^【.*?】"), F.trim(marked)).otherwise(F.coalesce(F.nullif(bare, F.lit("")), F.trim(stem)))


def region_or_empty(region: Column) -> Column:
    """A region struct without nulls; a missing region has empty fields."""
    return F.struct(*[sanitize(F.coalesce(region[k], F.lit(""))).alias(k) for k in ("level", "code", "name")])


def first_url(*urls: Column) -> Column:
    """The first URL that isn't empty, '' if none."""
    return sanitize(F.coalesce(*[F.nullif(u, F.lit("")) for u in urls], F.lit("")))
