"""Column builders for text: whitespace, tags, titles, paragraphs, dates, URLs, model output.

All are built-in expressions. Java classes carry ``(?U)`` where Unicode white
space or digits are meant; trimming uses patterns, as SQL ``trim`` knows only
the plain space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A private character, between paragraphs that lie in one string.
SEPARATOR = "\U000f0004"
#: All that Java's ``(?U)\\s`` matches, the plain space first.
SPACES = " \t\n\v\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# ---- Fixed values: limits and patterns that results depend on.
SUMMARY_SOURCE, SUMMARY, BACKFILL, BODY_CAP = 600, 500, 400, 200_000
GALLERY = r"(?iU)\s*[\[(]\s*Image\s+\d+\s+of\s+\d+\s*[\])]\s*"
SENTENCE_END = "[.!?。！？\"”')\\]]$"
COLON_TAIL = "^[^:：]{1,30}[:：]$"
ALL_CAPS = "^[A-Z0-9 .,'&()/-]{1,40}$"
NUMBERS_ONLY = r"^[\d\s.,xX×/|:+-]+$"
CAPS_PLACE = r"^[A-Z0-9 .,'&()/-]{4,80},\s*UNITED STATES\.?\s*$"
#: Lines that are page furniture when they make up the whole line, any case.
FURNITURE_LINES = [
    r"(?:IMAGE|AUDIO|VIDEO|GRAPHIC)\s+INFO\s*",
    r"(?:Date Taken|Date Posted|Photo ID|VIRIN|Resolution|Size|Location|Web Views|Downloads|High-Res\.?\s*Downloads|Category|Filename|Length|Originator|Content ?type|Status|Not Released)\s*[:：].*",
    r"\d{1,2}\.\d{1,2}\.\d{4}\s*",
    r"PUBLIC DOMAIN\s*",
    r"Photo ?(?:by|By)\s*[:：]?\s*.*",
    r"(?:Video|Audio|Film|Graphic)\s+?by\s*[:：]?\s*.*",
    r"Courtesy\s+(?:Audio|Video|Photo|Image|Graphic)s?\s*[:：]?\s*.*",
    r"This work, .*must comply with.*",
    r"MORE LIKE THIS\s*",
    r"CONTROLLED VOCABULARY KEYWORDS\s*",
    r"TAGS\s*",
    r"OPTIONS\s*",
    r"RELATED\s+(?:LINKS|PRODUCTS|ARTICLES|IMAGES|VIDEOS|NEWS)\s*",
    r"NEWS INFO\s*",
    r"Register/Login to Download.*",
    r"Register to Download.*",
    r"Validate Your Account.*",
    r"Connect (?:My )?Placements.*",
    r"Add to (?:My )?Albums.*",
    r"Download (?:Audio|Video|Image|High-Res|Closed Caption|Transcript|Photo|Assets|Now).*",
    r"Close Download Panel.*",
    r"VIEW (?:IMAGE|VIDEO|AUDIO) PAGE\s*",
    r"VIEW ORIGINAL\s*",
    r"DOWNLOAD PUBLICATION\s*",
    r"Download the publication.*",
    r"From: .{2,80}Published: \d{1,2} \w+ \d{4}.*",
    r"READ MORE\s*",
    r"SEE LESS\s*",
    r"Share this.*",
    r"PRINT\s*",
    r"EMAIL\s*",
    r"SUBSCRIBE\s*",
    r"Click (?:here|photo) .*",
    r"View the full story.*",
    r"See the full story.*",
    r"\d+\s*/\s*\d+\s*",
]
FURNITURE = rf"^\s*(?:{'|'.join(FURNITURE_LINES)})\s*$"
#: IPv4 networks that are not of the public internet.
NOT_PUBLIC = r"^(?:0|10|127|22[4-9]|23\d|24\d|25[0-5])\.\d+\.\d+\.\d+$|^192\.168\.\d+\.\d+$|^169\.254\.\d+\.\d+$|^172\.(?:1[6-9]|2\d|3[01])\.\d+\.\d+$|^100\.(?:6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.\d+\.\d+$|^192\.0\.[02]\.\d+$|^198\.(?:1[89]\.\d+|51\.100)\.\d+$|^203\.0\.113\.\d+$"
PRIVATE_HOST = r"^(?:localhost|.*\.local|.*\.internal|.*\.localhost)$"
# ----


def strip(c: Column) -> Column:
    """Without white space at its ends; no pattern, which would be tried at each character."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    """Runs of white space to one space, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def strip_gallery(c: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), GALLERY, ""))


def title_key(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def summary(html: Column) -> Column:
    """Cut, strip tags, collapse, cut again (in this order)."""
    return F.substring(collapse(strip_tags(F.substring(html, 1, SUMMARY_SOURCE))), 1, SUMMARY)


def or_else(c: Column, *others: Column) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (c, *others)], F.lit(""))


def backfilled_summary(summary_: Column, body: Column) -> Column:
    return or_else(summary_, F.substring(body, 1, BACKFILL))


def authors(author: Column, names: Column) -> Column:
    """The author, else the listed names joined."""
    return or_else(author, F.array_join(F.filter(names, lambda x: x.isNotNull() & (x != "")), "、"))


def timestamp(value: Column) -> Column:
    """RFC 822 or ISO 8601 text as a timestamp; without zone: UTC; else null."""
    v = strip(value)
    day = F.regexp_replace(v, r"^[A-Za-z]{3},\s*", "")
    zone = F.regexp_replace(F.regexp_replace(day, r"\s(?:GMT|UT|UTC|Z)$", " +0000"), r"^(\d\s)", "0$1")
    plain = F.when(zone.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}$"), F.concat(zone, F.lit(" +0000"))).otherwise(zone)
    iso = F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}"), F.regexp_replace(v, "Z", "+00:00"))
    return F.coalesce(F.try_to_timestamp(plain, F.lit("dd MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(iso))


def paragraphs(body: Column, separator: str = r"\n{2,}") -> Column:
    """Trimmed non-blank paragraphs, in order."""
    return F.filter(F.transform(F.split(F.coalesce(body, F.lit("")), separator), strip), lambda x: x != "")


def last_segment(uri: Column) -> Column:
    return F.substring_index(uri, "/", -1)


def furniture_line(line: Column) -> Column:
    """Whether a whole line is page furniture or an all-capitals place."""
    bare = strip(line)
    return bare.rlike(f"(?iU){FURNITURE}") | bare.rlike(CAPS_PLACE)


def without_furniture(body: Column, separator: str = "\n\n") -> Column:
    """The text without furniture lines; paragraphs that lose all lines go."""
    kept = lambda p: F.array_join(F.filter(F.split(p, "\n"), lambda x: ~furniture_line(x) & (strip(x) != "")), "\n")
    return F.array_join(F.filter(F.transform(F.split(F.coalesce(body, F.lit("")), separator), lambda p: kept(strip(p))), lambda p: p != ""), separator)


def n_words(p: Column) -> Column:
    """Words of a collapsed paragraph."""
    return F.when(p == "", 0).otherwise(F.size(F.split(p, " ")))


def ends_sentence(p: Column) -> Column:
    return p.rlike(SENTENCE_END)


def junk_paragraph(p: Column) -> Column:
    """Whether a collapsed paragraph is a fragment of page furniture."""
    n, end = n_words(p), ends_sentence(p)
    return p.rlike(f"(?U){NUMBERS_ONLY}") | ((n <= 2) & ~end) | (p.rlike(COLON_TAIL) & (n <= 3)) | ((n <= 4) & p.rlike(ALL_CAPS) & ~end)


def short_sentence(p: Column) -> Column:
    return (n_words(p) <= 2) & ends_sentence(p)


def without_title_line(paras: Column, title: Column) -> Column:
    """Paragraphs without the first if that repeats the title and others follow."""
    same = (title_key(F.get(paras, F.lit(0))) == title_key(title)) & (title_key(title) != "")
    return F.when((F.size(paras) >= 2) & same, F.slice(paras, F.lit(2), F.greatest(F.size(paras) - 1, F.lit(1)))).otherwise(paras)


# ------------------------------------------------------------------------- URLs


def url_host(url: Column) -> Column:
    return F.rtrim(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit("."))


def url_allowed(url: Column, schemes: tuple[str, ...] = ("http", "https"), hosts: list[str] | None = None) -> Column:
    """The static part of an outbound URL guard; name resolution is the fetcher's."""
    host = url_host(url)
    ok = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin(*schemes) & (host != "") & ~host.rlike(PRIVATE_HOST) & ~_private_address(host)
    ok = ok & host.isin(*hosts) if hosts else ok
    return F.coalesce(ok, F.lit(False))


def _private_address(host: Column) -> Column:
    """Address literals that are not of the public internet, and numbers that resolvers read as one."""
    quad = host.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$") & ~host.rlike(r"(?:^|\.)0\d")
    return host.rlike(NOT_PUBLIC) | host.startswith("[") | (host.rlike(r"(?i)^(?:0x[0-9a-f]*|\d+)(?:\.(?:0x[0-9a-f]*|\d+))*$") & ~quad)


def media_asset(url: Column, site: str = "media.example", articles: str = "/news/") -> Column:
    """Whether a url of ``site`` is an asset page and not an article."""
    return url.contains(site) & ~url.contains(articles)


# ----------------------------------------------------------------- model output


def ratio_ok(source: Column, target: Column, lo: float, hi: float) -> Column:
    """Whether the lengths of a text and its translation are in proportion."""
    r = F.length(target) / F.greatest(F.length(F.coalesce(source, F.lit(""))), F.lit(1))
    return F.coalesce((target != "") & r.between(lo, hi), F.lit(False))


def clean_output(c: Column, strip_number: bool = True) -> Column:
    """Model output without label prefix, bracketed number and wrapping quotes."""
    s = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"^(?:第[一二三四五六七八九十]+行|译文|标题|摘要)\s*[：:]\s*", "")
    if strip_number:
        s = F.regexp_replace(s, r"^[\[［(（]\s*\d{1,2}\s*[\]］)）]\s*", "")
    return strip(F.regexp_replace(strip(s), r'^["“”「」]+|["“”「」]+$', ""))


def without_bracket(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s*\[[^\]]*\]\s*", "")


def parse_array(text: Column, n: Column) -> Column:
    """The JSON array of ``n`` non-blank strings inside a text, else null."""
    found = F.transform(F.from_json(F.regexp_extract(text, r"(\[[\s\S]*\])", 1), "array<string>"), strip)
    return let(found, lambda f: F.when((F.size(f) == n) & F.forall(f, lambda x: F.coalesce(x != "", F.lit(False))), f))


def parse_titles(text: Column, n: Column) -> Column:
    """The JSON array of ``n`` objects with non-empty ``t`` and ``s``, else null."""
    found = F.from_json(F.regexp_extract(text, r"(\[[\s\S]*\])", 1), "array<struct<t:string,s:string>>")
    return F.when((F.size(found) == n) & F.forall(found, lambda x: F.coalesce((x["t"] != "") & (x["s"] != ""), F.lit(False))), found)


def parse_field(raw: Column, key: str, strip_number: bool = True) -> Column:
    """A field of model output: JSON, else repaired JSON, else a ``key: value`` line,
    else plain text; empty if none."""
    raw = F.coalesce(raw, F.lit(""))

    def of_json(inner: Column) -> Column:
        parsed = F.from_json(inner, f"struct<{key}:string>", {"mode": "PERMISSIVE"})
        fragment = F.regexp_extract(inner, rf'"?\s*{key}\s*"?\s*:\s*"([\s\S]*)\}}', 1)
        fragment = F.regexp_replace(F.regexp_replace(F.regexp_replace(fragment, r'\\"', '"'), r"\\n", "\n"), r"\\t", " ")
        repaired = clean_output(F.regexp_replace(strip(fragment), '"$', ""), strip_number)
        return F.when(F.try_parse_json(F.nullif(inner, F.lit(""))).isNotNull(), clean_output(parsed[key], strip_number)).otherwise(repaired)

    line = clean_output(F.regexp_extract(raw, rf'(?m)^\s*["“]?\s*{key}["”]?\s*[：:]\s*(.+)$', 1), strip_number)
    whole = strip(raw) if key == "p" else F.regexp_extract(strip(raw), r"^([^\r\n]*)", 1)
    plain = F.when(~raw.contains("{") & ~raw.contains("}"), clean_output(whole, strip_number))
    # each step once: null if of equals would make its text anew
    told = let(F.regexp_extract(raw, r"(?s)(\{.*\})", 1), of_json)
    return let(told, lambda t: F.when(t != "", t).otherwise(or_else(line, plain)))


def parse_slots(text: Column, n: Column) -> Column:
    """``n`` slots from ``[{i, p}]`` by 1-based ``i``; the last of equal numbers wins;
    numbers out of range and empty values are skipped; empty slots are ''."""
    found = F.from_json(F.regexp_extract(text, r"(\[[\s\S]*\])", 1), "array<struct<i:int,p:string>>")
    loose = F.transform(
        F.regexp_extract_all(text, F.lit(r'(\{[^{}]*"i"\s*:\s*\d+[^{}]*\})'), 1),
        lambda x: F.struct(F.regexp_extract(x, r'"i"\s*:\s*(\d+)', 1).cast("int").alias("i"), F.regexp_extract(x, r'"p"\s*:\s*"([\s\S]*?)"\s*[,}]', 1).alias("p")),
    )
    # of a sound array the last of equal numbers, of what is found loose the first: the last of the reverse
    said = let(found, lambda f: F.when(f.isNotNull() & F.coalesce(F.forall(f, lambda x: x["i"].isNotNull()), F.lit(False)), f).otherwise(F.reverse(loose)))
    said = F.filter(F.transform(said, lambda x: F.struct(x["i"].alias("i"), strip(x["p"]).alias("p"))), lambda x: x["p"] != "")
    slot = lambda s, k: F.coalesce(F.try_element_at(F.filter(s, lambda x: x["i"] == k), F.lit(-1))["p"], F.lit(""))
    return let(said, lambda s: F.transform(F.sequence(F.lit(1), n), lambda k: slot(s, k)))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# ------------------------------------------------------- paragraph arrays in a row


def clean_array(paras: Column) -> Column:
    """The paragraph cleaner over an array: for bodies that are one row already."""
    kept = F.filter(F.transform(paras, collapse), lambda p: (p != "") & ~junk_paragraph(p))
    apart = let(kept, lambda k: F.filter(k, lambda p, i: (i == 0) | (p != F.get(k, i - 1))))

    def step(acc: Column, p: Column) -> Column:
        # a 1 for a paragraph that joins the one before it
        return F.struct(F.concat(acc["joins"], F.when(acc["open"], "1").otherwise("0")).alias("joins"), (~acc["open"] & short_sentence(p)).alias("open"))

    def merged(all_: Column) -> Column:
        start = F.struct(F.lit("").alias("joins"), F.lit(False).alias("open"))
        lead = lambda joins: lambda p, i: F.concat(F.when(F.substr(joins, i + 1, F.lit(1)) == "1", " ").otherwise(SEPARATOR), p)
        text = F.aggregate(all_, start, step, lambda acc: F.array_join(F.transform(all_, lead(acc["joins"])), ""))
        return F.when(F.size(all_) == 0, F.array().cast("array<string>")).otherwise(F.split(F.substr(text, F.lit(2)), SEPARATOR))

    return F.when(paras.isNotNull(), let(apart, merged))


def clean_body(body: Column) -> Column:
    """Furniture lines out, then the paragraph cleaner, cut at the body cap."""
    paras = F.split(without_furniture(body), "\n\n")
    return F.substring(F.array_join(clean_array(paras), "\n\n"), 1, BODY_CAP)
