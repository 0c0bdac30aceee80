"""URL expressions. A URL is a scheme, a host and the rest; anything else is invalid and gives ''.

As a browser's parser does, tabs and line ends go, hosts are written in one way (hosts.py), ports are numbers, dot segments
are resolved, and characters that can't stand in a path, query or fragment are percent-encoded. Web schemes may have any
number of slashes, of either kind, before the host.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .hosts import canonical
from .text import WS, col, first_of, let, trimmed

_URL = r"(?is)^(?:(https?|ftp|wss?):[/\\]*|([a-z][a-z0-9+.-]*)://)([^/\\?#]*@)?(\[[^\]/\\?#@]*\]|[^/\\?#:@\[\]]+)(?::(?:0+(?=\d))?(\d{0,5}))?([/\\][^?#]*)?(\?[^#]*)?(#.*)?\z"
_DEFAULT_PORTS = {"http": 80, "https": 443, "ftp": 21, "ws": 80, "wss": 443}

#: What is percent-encoded in paths and in fragments, besides all that isn't printable ASCII.
_IN_PATH, _IN_FRAGMENT = r'[^\x21-\x7E]|["<>`{}]', r'[^\x21-\x7E]|["<>`]'
_DOTS, _TWO_DOTS = r"(?i)(?:\.|%2e)", r"(?i)(?:\.|%2e){2}"


def _plain(url: Column | str) -> Column:
    return F.regexp_replace(trimmed(F.coalesce(col(url), F.lit(""))), r"[\t\n\r\x01]", "")


def parsed(url: Column | str) -> Column:
    """struct<scheme, user, host, port, path, query, fragment>, null if the URL is invalid; the port is '' for the scheme's own."""
    fields = F.split(F.regexp_replace(_plain(url), _URL, "\x01".join(f"${k}" for k in range(1, 9))), "\x01")

    def with_host(p: Column) -> Column:
        special = p[0] != ""
        scheme = F.lower(F.when(special, p[0]).otherwise(p[1]))
        known = F.array(*[F.lit(f"{s} {n}") for s, n in _DEFAULT_PORTS.items()])
        port = F.when(F.array_contains(known, F.concat_ws(" ", scheme, p[4])), "").otherwise(p[4])
        path_ = F.when(special, F.translate(p[5], "\\", "/")).otherwise(p[5])
        whole = lambda h: F.struct(scheme.alias("scheme"), p[2].alias("user"), h.alias("host"), port.alias("port"), path_.alias("path"), p[6].alias("query"), p[7].alias("fragment"))
        good = (p[4] == "") | (p[4].cast("int") < 65536)
        return let(canonical(F.lower(p[3])), lambda h: F.when((h != "") & good, whole(h)))

    return let(fields, lambda p: F.when(F.size(p) == 8, with_host(p)))


def host(url: Column | str) -> Column:
    """The host as a browser writes it, '' if the URL is invalid."""
    return F.coalesce(parsed(url)["host"], F.lit(""))


def bare(host_: Column) -> Column:
    return F.regexp_replace(host_, r"^www\.", "")


def host_in(host_: Column, domains) -> Column:
    """Whether the host is one of the domains or below it; a leading www. doesn't count."""
    h = bare(host_)
    # One pass over the host instead of a test for each domain.
    either = "|".join(d.replace(".", r"\.") for d in domains)
    return h.rlike(rf"(?:^|\.)(?:{either})\z")


def _encoded(text: Column, unsafe: str) -> Column:
    one = lambda c: F.when(c == " ", "%20").when(c.rlike(unsafe), F.url_encode(c)).otherwise(c)
    return F.when(text.rlike(unsafe), F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one), "")).otherwise(text)


def _without_dots(path_: Column) -> Column:
    """The path with dot segments resolved; what they leave at its end is stripped later anyway."""

    def step(done: Column, segment: Column) -> Column:
        up = F.regexp_replace(done, r"/[^/]*\z", "")
        return F.when(segment.rlike(rf"^{_TWO_DOTS}\z"), up).when(segment.rlike(rf"^{_DOTS}\z"), done).otherwise(F.concat(done, F.lit("/"), segment))

    segments = F.split(path_, "/")
    resolved = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.lit(""), step)
    return F.when(path_.rlike(rf"/{_DOTS}{{1,2}}(?:/|\z)"), resolved).otherwise(path_)


def _form(text: Column) -> Column:
    """A name or value of a query, as a form would write it."""
    return F.url_encode(F.coalesce(F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")), text))


def _pair(q: Column) -> Column:
    name, at = F.substring_index(q, "=", 1), F.instr(q, F.lit("="))
    value = F.when(at > 0, _form(F.substring(q, at + 1, F.length(q)))).otherwise("")
    return F.when(q.rlike(r"^[A-Za-z0-9*._-]*=[A-Za-z0-9*._-]*\z"), q).otherwise(F.concat(_form(name), F.lit("="), value))


#: Paths and queries that stay as they are.
_ODD_PATH, _ODD_QUERY = r'[^\x21-\x7E]|["<>`{}]|/\.|/%2[eE]', r"[^A-Za-z0-9*._=&?-]|&&|[?&][^=&]*(?:&|\z)|=[^&]*=|&\z"


def rebuilt(p: Column) -> Column:
    """The URL of parsed() parts: no trailing slashes but the root's, no tracking parameters; '' for null."""
    path_, query, fragment = p["path"], p["query"], p["fragment"]
    clean = F.when(path_.rlike(_ODD_PATH), let(_without_dots(path_), lambda x: _encoded(x, _IN_PATH))).otherwise(path_)
    pairs = F.filter(F.split(F.substring(query, F.lit(2), F.length(query)), "&"), lambda q: q != "")
    pairs = F.filter(F.when(query.rlike(_ODD_QUERY), F.transform(pairs, _pair)).otherwise(pairs), lambda q: ~F.substring_index(q, "=", 1).isin(*fixed.TRACKING))
    return F.when(p.isNull(), "").otherwise(F.concat(
        p["scheme"], F.lit("://"), p["user"], p["host"], F.when(p["port"] == "", "").otherwise(F.concat(F.lit(":"), p["port"])),
        let(F.regexp_replace(clean, r"/+\z", ""), lambda s: F.when(s == "", "/").otherwise(s)),
        F.when(query == "", "").otherwise(let(F.array_join(pairs, "&"), lambda kept: F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))),
        F.when(fragment.isin("", "#"), "").otherwise(_encoded(fragment, _IN_FRAGMENT)),
    ))


def normalized(url: Column | str) -> Column:
    """The host in one form, no default port, no trailing slashes but the root's, no tracking parameters."""
    return let(parsed(url), rebuilt)


def source(url: Column | str) -> Column:
    return host(url)


def platform_of(host_: Column) -> Column:
    names: dict[str, list[str]] = {}
    for domain, name in fixed.PLATFORMS:
        names.setdefault(name, []).append(domain)
    chain = F
    for name, domains in names.items():
        chain = chain.when(host_in(host_, domains), name)
    return chain.otherwise("Website")


def platform(url: Column | str) -> Column:
    return let(host(url), platform_of)


def junk(normal: Column) -> Column:
    """Cached copies, PDF files and search pages, by the normalized URL."""
    is_pdf = F.lower(F.substring_index(normal, "?", 1)).endswith(".pdf")
    return F.contains(normal, F.lit("webcache")) | is_pdf | F.contains(normal, F.lit("google.com/search"))


def blocked(p: Column) -> Column:
    """Whether parsed() parts are of a page of the block-list."""
    found = host_in(p["host"], fixed.BLOCKED_HOSTS)
    for domain, start in fixed.BLOCKED_PATHS:
        found = found | (host_in(p["host"], [domain]) & F.lower(_without_dots(p["path"])).startswith(start))
    return found


def social_author(url: Column | str, title: Column | str, platform_: Column) -> Column:
    t, u = F.coalesce(col(title), F.lit("")), F.coalesce(col(url), F.lit(""))
    pipe = F.regexp_extract(t, rf"^([^|]{{2,40}}){WS}*\|", 1)
    name = trimmed(pipe)
    good = (pipe != "") & (F.size(F.split(name, f"{WS}+")) <= 4) & ~pipe.rlike(f"(?i){fixed.SOCIAL_WORDS}")
    on = trimmed(F.regexp_extract(t, r"""^"?([A-Za-z@][\w .'@&-]{1,40}?) on (?:Instagram|Facebook|TikTok)""", 1))
    slug = F.regexp_extract(u, r"facebook\.com/([^/?#]+)/", 1)
    slug = F.when(slug.isin(*fixed.FACEBOOK_PATHS), "").otherwise(slug)
    return F.when(platform_ == "Website", "").otherwise(F.when(good, name).otherwise(first_of(on, slug)))
