"""Addresses, links and pages as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from .text import BLANKS, bounded, squeeze, without_tags

# Query parameters that say where a visitor came from.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "spm", "from", "source", "share_token", "tracking_id")
# Path words of pages that hold no content of their own.
REJECTED_WORDS = (
    "login", "signin", "signup", "register", "auth", "account", "profile", "user", "users",
    "comment", "comments", "tag", "tags", "category", "search", "share", "about", "privacy",
    "terms", "contact", "issues", "pulls", "commits", "actions", "stargazers", "forks", "network",
    "releases", "archive", "download",
)
# Endings of files that are no pages.
REJECTED_SUFFIXES = (
    ".7z", ".avi", ".css", ".csv", ".doc", ".docx", ".exe", ".gif", ".gz", ".ico",
    ".jpeg", ".jpg", ".js", ".json", ".mov", ".mp3", ".mp4", ".pdf", ".png", ".rar",
    ".rss", ".svg", ".tar", ".webp", ".xml", ".zip",
)
_ADDRESS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
_HIDDEN = ("script", "style", "noscript", "svg", "canvas", "template")
_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"
# The zones that RFC 2822 has names for.
_ZONES = {"GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value worked out once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _ADDRESS, k)


def _decoded(c: Column) -> Column:
    """Percent signs that begin no code stand for themselves."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, "%(?![0-9a-fA-F]{2})", "%25")), c)


def _encoded(c: Column) -> Column:
    """Decoded, then encoded: blanks as plus signs, tilde kept."""
    plain = _decoded(c)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def kept_query(query: Column, ignored: Sequence[str] = TRACKING) -> Column:
    """The parameters that stay, in their order and encoded anew; blank values stay."""
    name = lambda p: F.substring_index(p, "=", 1)
    value = lambda p: F.when(F.contains(p, F.lit("=")), F.substring(p, F.length(name(p)) + 2, F.length(p))).otherwise("")
    own = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(_decoded(name(p))).isin(*ignored))
    return F.array_join(F.transform(own, lambda p: F.concat(_encoded(name(p)), F.lit("="), _encoded(value(p)))), "&")


def normal_url(url: Column, ignored: Sequence[str] = TRACKING) -> Column:
    """One spelling per address: scheme and host in lower case, no fragment, no tracking, single slashes, none at the end."""
    def whole(p: Column) -> Column:
        path = F.when(p["path"].isin("", "/"), "/").otherwise(F.regexp_replace(p["path"], "/+$", ""))
        return F.concat(
            F.when(p["scheme"] != "", F.concat(p["scheme"], F.lit(":"))).otherwise(""),
            F.when(p["host"] != "", F.concat(F.lit("//"), p["host"])).otherwise(""),
            F.when((p["host"] != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path),
            F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise(""),
        )

    def parts(u: Column) -> Column:
        fields = {"scheme": F.lower(_part(u, 1)), "host": F.lower(_part(u, 2)), "path": F.regexp_replace(_part(u, 3), "/{2,}", "/"), "query": kept_query(_part(u, 4), ignored)}
        return let(F.struct(*(v.alias(k) for k, v in fields.items())), whole)

    return let(F.regexp_replace(url, rf"^{BLANKS}|{BLANKS}$", ""), parts)


def host_of(url: Column) -> Column:
    """Host in lower case, without user and port; empty where there is none."""
    return F.lower(F.regexp_extract(_part(F.coalesce(url, F.lit("")), 2), r"^(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1))


def in_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith(f".{domain}")


def in_any_domain(host: Column, domains: Sequence[str]) -> Column:
    out = F.lit(False)
    for d in domains:
        out = out | in_domain(host, d)
    return out


def absolute(base: Column, href: Column) -> Column:
    """A reference against its page: full, by scheme, from the root, as a query, or beside the page (dot segments resolved once)."""
    origin = F.concat(_part(base, 1), F.lit("://"), _part(base, 2))
    folder = F.regexp_replace(_part(base, 3), "[^/]*$", "")
    beside = F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), href), r"/\./", "/")
    for _ in range(4):
        beside = F.regexp_replace(beside, r"/[^/?#.][^/?#]*/\.\./", "/")
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(_part(base, 1), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(origin, _part(base, 3), href))
        .otherwise(F.concat(origin, beside))
    )


def safe_link(base: Column, href: Column, domains: Sequence[str]) -> Column:
    """The normal form of a link that leads to an allowed host's content page; null for any other."""
    def fine(u: Column) -> Column:
        return u.rlike("^https?://") & let(host_of(u), lambda h: in_any_domain(h, domains)) & let(F.lower(F.coalesce(F.try_url_decode(_part(u, 3)), _part(u, 3))), content_path)

    def content_path(p: Column) -> Column:
        ends = F.lit(False)
        for s in REJECTED_SUFFIXES:
            ends = ends | p.endswith(s)
        return ~ends & ~F.arrays_overlap(F.split(p, "[/_.\\-]+"), F.array(*map(F.lit, REJECTED_WORDS)))

    raw = F.trim(href)
    url = F.when((raw != "") & ~raw.rlike("^(#|mailto:|tel:|javascript:|data:)"), normal_url(absolute(base, raw)))
    return let(url, lambda u: F.when(fine(u), u))


def unescaped(c: Column) -> Column:
    """Character references, by number or by name, as their characters; each once. Numbers of no character become U+FFFD."""
    # Each one expression, so that building a plan takes no call for every entry.
    names = F.expr("map(" + ", ".join(f"'{name}', {code}" for name, code in {**name2codepoint, "apos": 39}.items()) + ")")
    west = F.expr("array(" + ", ".join(str(ord(bytes([k]).decode("cp1252", "ignore") or chr(k))) for k in range(128, 160)) + ")")

    def number(key: Column) -> Column:
        code = F.when(key.rlike("^#[xX]"), F.conv(F.substring(key, 3, 10), 16, 10)).otherwise(F.substring(key, 2, 10)).cast("int")
        return let(code, lambda n: F.when(n.between(128, 159), F.element_at(west, n - 127)).when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), n).otherwise(0xFFFD))

    def char(code: Column) -> Column:
        return F.when(code < 128, F.char(code)).otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def piece(p: Column) -> Column:
        def one(key: Column) -> Column:
            code = F.when(key.startswith("#"), number(key)).otherwise(F.try_element_at(names, key))
            return let(code, lambda n: F.when(n.isNotNull(), F.concat(char(n), F.substring(p, F.length(key) + 3, F.length(p)))).otherwise(p))

        return let(F.substring_index(F.substring(p, 2, 40), ";", 1), one)

    def pieces(text: Column) -> Column:
        parts = F.split(text, f"(?={_ENTITY})")
        return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(f"^{_ENTITY}"), piece(p)).otherwise(p)), "")

    return let(c, lambda text: F.when(F.contains(text, F.lit("&")), pieces(text)).otherwise(text))


def visible_text(html: Column, limit: int) -> Column:
    """What a reader sees of a page: no comments, no scripts and the like, entities decoded, tags as blanks."""
    t = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in _HIDDEN:
        t = F.regexp_replace(t, rf"(?is)<{tag}\b[^>]*>.*?(</{tag}\s*>|\z)", " ")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    return without_tags(unescaped(t), limit)


def page_links(html: Column) -> Column:
    """array<struct<pos, href, anchor>> of a page's closed links in their order, without those marked nofollow; a title stands for an empty anchor.

    Attribute values may be quoted in either way or bare.
    """
    found = F.regexp_extract_all(html, F.lit(r"(?is)<a\b((?:(?!<a\b).)*?)</a\s*>"), 1)

    def attr(head: Column, name: str) -> Column:
        value = F.regexp_extract(head, rf"""(?is)(?:^|[\s"'/]){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
        return unescaped(let(value, lambda v: F.when(F.left(v, F.lit(1)).isin('"', "'"), F.substring(v, 2, F.length(v) - 2)).otherwise(v)))

    def one(t: Column, k: Column) -> Column:
        def of(head: Column) -> Column:
            text = unescaped(F.regexp_replace(F.regexp_replace(t, r"(?s)^[^>]*>", ""), "<[^>]+>", " "))
            anchor = let(without_tags(text, 240), lambda a: F.when(a != "", a).otherwise(without_tags(attr(head, "title"), 240)))
            return F.struct(k.alias("pos"), attr(head, "href").alias("href"), anchor.alias("anchor"), attr(head, "rel").alias("rel"))

        return let(F.regexp_extract(t, r"(?s)^([^>]*)>", 1), of)

    fine = lambda x: (x["href"] != "") & ~F.lower(x["rel"]).contains("nofollow")
    return F.transform(F.filter(F.transform(found, one), fine), lambda x: F.struct(x["pos"], x["href"], x["anchor"]))


def content_links(html: Column, page: Column, domains: Sequence[str]) -> Column:
    """array<struct<pos, url, anchor>>: a page's links to content of the domains, each address once and in the order of its first link, without the page's own."""
    made = F.transform(page_links(html), lambda x: F.struct(x["pos"].alias("pos"), safe_link(page, x["href"], domains).alias("url"), x["anchor"].alias("anchor")))
    own = normal_url(page)

    def first_of_each(links: Column) -> Column:
        urls = F.transform(links, lambda x: x["url"])
        return F.filter(links, lambda x, k: F.array_position(urls, x["url"]) == k + 1)

    return let(F.filter(made, lambda x: x["url"].isNotNull() & (x["url"] != own)), first_of_each)


def link_title(anchor: Column, url: Column) -> Column:
    """The anchor, else the last part of the path, else the address."""
    last = F.element_at(F.split(F.regexp_replace(_part(url, 3), "/+$", ""), "/"), -1)
    return F.coalesce(F.nullif(bounded(anchor, 220), F.lit("")), F.nullif(bounded(last, 220), F.lit("")), url)


def feed_address(url: Column, query: Column, prefix: str) -> Column:
    """An explicit address, else the search prefix with the encoded query, else null."""
    asked = F.concat(F.lit(prefix), _encoded(query))
    return F.coalesce(F.nullif(F.trim(url), F.lit("")), F.when(F.nullif(F.trim(query), F.lit("")).isNotNull(), asked))


def iso_time(c: Column) -> Column:
    """ISO-8601 text with Z or an offset to a timestamp; null for anything else."""
    return F.try_to_timestamp(F.replace(c, F.lit("Z"), F.lit("+00:00")))


def epoch_time(c: Column) -> Column:
    return F.timestamp_seconds(c.try_cast("bigint"))


def feed_date(c: Column) -> Column:
    """An RFC 2822 date as ISO text in UTC, with or without weekday and seconds, its zone a number or a name (none: UTC); another text as it is, cut; null for an empty one."""
    t = F.regexp_replace(squeeze(c), r"^[A-Za-z]{3,9},?\s*|\s*\([^()]*\)$", "")
    for pattern, to in ((r"^(\d{1,2} \w{3}) ([0-6]\d)(?= )", "$1 20$2"), (r"^(\d{1,2} \w{3}) ([7-9]\d)(?= )", "$1 19$2"), (r"^(\d{1,2} \w{3} \d{4} \d{1,2}:\d{2})(?= |$)", "$1:00"), (r"(:\d{2})$", "$1 +0000")):
        t = F.regexp_replace(t, pattern, to)
    zone = F.substring_index(t, " ", -1)
    zones = F.create_map(*(F.lit(x) for kv in _ZONES.items() for x in kv))
    number = F.coalesce(F.try_element_at(zones, F.upper(zone)), zone)
    at = F.try_to_timestamp(F.concat(F.left(t, F.length(t) - F.length(zone)), number), F.lit("d MMM yyyy H:mm:ss Z"))
    return F.when(squeeze(c) == "", None).otherwise(F.coalesce(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), without_tags(c, 80)))
