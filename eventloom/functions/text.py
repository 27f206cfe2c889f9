"""Scalar text functions as columns: normalizers, term predicates, identities, small decision lists.

Unless said otherwise a null gives null, and everything stays in the JVM; the three normalizers that Spark has no
function for (NFKC with case folding, HTML entities, Ratcliff/Obershelp similarity) are Arrow functions at the end.
"""

from __future__ import annotations

import difflib
import html
import re
import unicodedata
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from . import markup

FULL_DIGITS = ("０１２３４５６７８９", "0123456789")


def clean_text(c: Column) -> Column:
    """Unicode white space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s　]+", " "))


def blank_to_null(c: Column) -> Column:
    cleaned = clean_text(c)
    return F.when(cleaned != "", cleaned)


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def has_any(c: Column, terms: Iterable[str]) -> Column:
    """Whether one of the terms is in the lower-cased text; null has none."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return any_of(F.contains(low, F.lit(t.lower())) for t in terms)


def matched_terms(c: Column, terms: list[str]) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.filter(F.array(*(F.lit(t) for t in terms)), lambda t: F.contains(low, F.lower(t)))


def width_folded(c: Column) -> Column:
    """Full-width punctuation of dates and clocks as plain."""
    return F.translate(c, "：／．－〜～", ":/.-~~")


def short_hash(payload: Column, n: int = 20) -> Column:
    return F.substring(F.sha2(payload.cast("binary"), 256), 1, n)


def event_identity(source: Column, source_id: Column, organizer: Column, title: Column, starts_at: Column, location: Column) -> Column:
    """20 hex digits of source:source_id, else of the lower-cased descriptive fields."""
    fallback = F.lower(F.concat_ws("|", *(F.coalesce(x, F.lit("")) for x in (organizer, title, starts_at, location))))
    return short_hash(F.when(F.coalesce(source_id, F.lit("")) != "", F.concat_ws(":", source, source_id)).otherwise(fallback))


def source_record_id(existing: Column, source: Column, source_id: Column, url: Column, event_id: Column) -> Column:
    def filled(c: Column) -> Column:
        t = F.trim(F.coalesce(c, F.lit("")))
        return F.when(t != "", t)

    origin = F.coalesce(filled(source), F.lit("unknown"))
    payload = F.coalesce(
        F.concat(origin, F.lit("|source-id|"), filled(source_id)),
        F.concat(origin, F.lit("|url|"), canonical_url_strict(url)),
        F.concat(origin, F.lit("|event-id|"), F.coalesce(filled(event_id), F.lit(""))),
    )
    return F.coalesce(filled(existing), F.concat(F.lit("src_"), short_hash(payload)))


def url_host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def _query_without(url: Column, prefixes: tuple[str, ...]) -> Column:
    parts = F.filter(F.split(url_query(url), "&"), lambda p: (p != "") & ~any_of(F.startswith(F.lower(p), F.lit(x)) for x in prefixes))
    joined = F.array_join(parts, "&")
    return F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise("")


def canonical_url_strict(url: Column) -> Column:
    """https only; one host name for the same network; no utm_ parameters, fragment or trailing slashes."""
    raw = F.trim(url)
    host = F.when(url_host(raw).isin("twitter.com", "www.twitter.com", "www.x.com"), F.lit("x.com")).otherwise(url_host(raw))
    return F.when(F.startswith(raw, F.lit("https://")) & host.isNotNull(), F.concat(F.lit("https://"), host, F.rtrim(url_path(raw), F.lit("/")), _query_without(raw, ("utm_",))))


def canonical_url_lenient(url: Column) -> Column:
    """http or https; no utm_, ref= or source= parameters, no fragment; an empty path is '/'."""
    raw = clean_text(url)
    scheme, netloc = F.lower(F.regexp_extract(raw, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lower(F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.rtrim(url_path(raw), F.lit("/"))
    return F.when(
        scheme.isin("http", "https") & (netloc != ""),
        F.concat(scheme, F.lit("://"), netloc, F.when(path == "", "/").otherwise(path), _query_without(raw, ("utm_", "ref=", "source="))),
    )


def canonical_https(url: Column) -> Column:
    """https with a host, without closing punctuation; otherwise null."""
    raw = F.regexp_replace(F.trim(url), r"[)\]}>.,;:!?'\"]+$", "")
    return F.when(F.startswith(raw, F.lit("https://")) & url_host(raw).isNotNull(), F.regexp_replace(raw, "#.*$", ""))


def page_url(url: Column) -> Column:
    """A page's own address: no parameters, query or fragment."""
    return F.regexp_replace(url, r"[;?#].*$", "")


#: Hosts of each kind of link.
LINK_HOSTS = {
    "forms": ("forms.gle", "docs.google.com"),
    "world": ("vrchat.com", "www.vrchat.com"),
    "community": ("discord.gg", "discord.com"),
    "stream": ("youtube.com", "www.youtube.com", "youtu.be", "twitch.tv", "www.twitch.tv"),
    "post": ("x.com", "www.x.com", "twitter.com", "www.twitter.com"),
}


def link_kind(url: Column) -> Column:
    host, path = F.coalesce(url_host(url), F.lit("")), F.lower(url_path(url))
    return (
        F.when((host == "forms.gle") | (host.isin(*LINK_HOSTS["forms"]) & F.contains(path, F.lit("form"))), "application")
        .when(host.isin(*LINK_HOSTS["world"]) & F.contains(path, F.lit("/home/group/")), "vrchat_group")
        .when(host.isin(*LINK_HOSTS["world"]) & F.contains(path, F.lit("/home/world/")), "vrchat_world")
        .when(host.isin(*LINK_HOSTS["community"]), "community")
        .when(host.isin(*LINK_HOSTS["stream"]), "stream")
        .when(host.isin(*LINK_HOSTS["post"]) & F.contains(path, F.lit("/status/")), "announcement")
        .when(host.isin(*LINK_HOSTS["post"]), "official_x")
        .otherwise("related_web")
    )


EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE = r"(?<![0-9])(?:\+?[0-9][0-9 .()_-]{7,}[0-9])(?![0-9])"


def sensitive(c: Column) -> Column:
    return c.rlike(EMAIL) | c.rlike(PHONE)


def position_band(c: Column) -> Column:
    return F.when(c <= 3, "1-3").when(c <= 10, "4-10").when(c <= 20, "11-20").when(c <= 50, "21-50").otherwise("51+")


def truncate(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.left(c, F.lit(n - 1))), F.lit("…"))).otherwise(c)


def status_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"(?i)(?:https?://)?(?:www\.)?(?:x|twitter)\.com/[^\s\"'<>\\]+/status/([0-9]+)", 1), F.lit(""))


def author_of(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"(?i)^https?://(?:www\.)?(?:x|twitter)\.com/([^/?#]+)", 1), F.lit(""))


def guarded_long(c: Column) -> Column:
    """A whole number without thousands commas, or null."""
    return F.expr("try_cast(null as bigint)") if c is None else F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("long")


def marker(c: Column, base: str) -> Column:
    """Whether #base or base stands in the text and no letter a-z follows."""
    return c.rlike(rf"(?i)#?{re.escape(base)}(?![a-z])")


def event_ordinal(c: Column) -> Column:
    """The number in 第N回, full-width digits folded."""
    return F.nullif(F.regexp_extract(F.translate(c, *FULL_DIGITS), "第\\s*([0-9]{1,4})\\s*回", 1), F.lit(""))


def title_line(c: Column, wanted: str, limit: int = 96) -> Column:
    """The first line that matches, else the first that isn't blank, cut to the limit."""
    lines = F.filter(F.transform(F.split(c, "\n"), clean_text), lambda x: x != "")
    return truncate(F.coalesce(F.get(F.filter(lines, lambda x: x.rlike(wanted)), F.lit(0)), F.get(lines, F.lit(0))), limit)


def modality(text: Column, category: Column, terms: dict[str, list[str]]) -> Column:
    """How an event takes place, by precedence of its terms."""
    hybrid, offline, stream, inside = (has_any(text, terms.get(k, [])) for k in ("hybrid", "offline", "stream", "in_world"))
    return (
        F.when(category == "recruitment_deadline", "deadline")
        .when(hybrid | (offline & stream) | (~offline & stream & inside), "hybrid")
        .when(offline, "offline")
        .when(stream, "stream")
        .when(inside, "in_world")
        .otherwise("unknown")
    )


def meta_content(page: Column, name: str) -> Column:
    """A page's meta content by name or property, however the attributes stand and are quoted."""
    return markup.meta_of(markup.tags(page), name)


@F.arrow_udf(StringType())
def nfkc_folded(c: pa.Array) -> pa.Array:
    """NFKC and case folding."""
    return pa.array([None if v is None else unicodedata.normalize("NFKC", v).casefold() for v in c.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def html_unescaped(c: pa.Array) -> pa.Array:
    return pa.array([None if v is None else html.unescape(v) for v in c.to_pylist()], pa.string())


@F.arrow_udf(DoubleType())
def ratcliff(left: pa.Array, right: pa.Array) -> pa.Array:
    """Ratcliff/Obershelp similarity; 0 if either side is empty or null. Not symmetric: the earlier row goes left."""
    out = []
    for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True):
        out.append(difflib.SequenceMatcher(None, a, b, autojunk=False).ratio() if a and b else 0.0)
    return pa.array(out, pa.float64())


def title_key(c: Column) -> Column:
    """Folded text with only its letters and digits, of any script."""
    return F.regexp_replace(nfkc_folded(clean_text(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}]", "")


def search_text_cleaned(c: Column) -> Column:
    """A search page's text: entities read, marks of highlighted words gone."""
    marked = F.replace(F.replace(html_unescaped(c), F.lit("\tSTART\t"), F.lit(" ")), F.lit("\tEND\t"), F.lit(" "))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(marked, r"^\s*START(?=\s)", ""), r"(?<=\s)END\s*$", ""), r"^\s+|\s+$", "")


GROUP_PAGE = r"(?i)^https://(?:www\.)?vrchat\.com/home/group/grp_[A-Za-z0-9-]+(?:[/?#].*)?$"


def group_url(links: Column, *others: Column) -> Column:
    """The first link of kind vrchat_group, else other address, that is a group's page; without query and fragment. links: array<struct<url, kind>>."""
    kept = F.filter(links, lambda x: (x["kind"] == "vrchat_group") & x["url"].rlike(GROUP_PAGE))
    found = F.coalesce(F.get(F.transform(kept, lambda x: x["url"]), F.lit(0)), *(F.when(c.rlike(GROUP_PAGE), c) for c in others))
    return F.regexp_replace(found, r"(?s)[?#].*$", "")


def group_image(page: Column) -> Column:
    """The address of a page's image (og:image) if it is https with a host."""
    url = F.trim(meta_content(page, "og:image"))
    return F.when(F.startswith(F.lower(url), F.lit("https://")) & url_host(url).isNotNull(), url)


def match_key(c: Column, extra: str = "") -> Column:
    """Folded text with only digits, Latin letters, kana and kanji (and extra characters)."""
    return F.regexp_replace(nfkc_folded(c), rf"[^0-9a-zぁ-んァ-ヶ一-龠{extra}]", "")


def dedup_key(c: Column) -> Column:
    """match_key without addresses."""
    plain = F.regexp_replace(nfkc_folded(F.coalesce(c, F.lit(""))), r"https?://\S+", "")
    return F.regexp_replace(plain, r"[^0-9a-zぁ-んァ-ヶ一-龠]+", "")
