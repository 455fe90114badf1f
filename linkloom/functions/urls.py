"""URL predicates, normalisation and reference resolution as Column expressions."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column, functions as F

from .bind import bind

# Substrings that mark a URL as not worth fetching.
EXCLUDED_PARTS = (
    ".css", ".js", ".png", ".jpg", ".jpeg", ".gif", ".svg", ".ico",
    ".pdf", ".zip", ".exe", ".dmg", "mailto:", "tel:",
)
# Content types that are analysed.
RELEVANT_TYPES = ("text/html", "application/xhtml+xml", "text/plain")

_CONTROL = r"[\x00-\x1F\x7F]"
_UNRESERVED = string.ascii_letters + string.digits + "-_.~"
# Characters a printed path or fragment may hold without being re-escaped ...
_LEGAL = r"A-Za-z0-9\-_.~!$&'()*+,;=:@/\[\]%"
# ... and the ones that stay as they are when it has to be re-escaped.
_PATH_KEPT = r"A-Za-z0-9\-_.~$&+,/:;=@"
_FRAGMENT_KEPT = _PATH_KEPT + r"?!()*"

_HOST_CHARS = r"(?:[A-Za-z0-9\-_.~!$&'()*+,;=<>\"]|[^\x00-\x7F]|%[89A-Fa-f][0-9A-Fa-f])*+"
_AUTHORITY = rf"(?:[A-Za-z0-9\-._:~!$&'()*+,;=%@]*@)?(?:\[[^\]/?#]*\]|{_HOST_CHARS})(?::[0-9]*)?"
_ESCAPES_OK = r"(?:[^%]++|%[0-9A-Fa-f]{2})*+"


def _any_of(parts) -> str:
    """Alternation of literals, those with a leading dot sharing it."""
    dotted = "|".join(p[1:] for p in parts if p.startswith("."))
    others = [re.escape(p) for p in parts if not p.startswith(".")]
    return "|".join(([rf"\.(?:{dotted})"] if dotted else []) + others)


def parse_url(url: Column) -> Column:
    """Split a URL reference; the struct is NULL when it cannot be parsed.

    Rejected are control characters, an empty scheme, bad percent escapes in path or fragment, an
    ill-formed authority, and a colon in the first segment of a relative path.
    """
    has_fragment = F.contains(url, F.lit("#"))
    before = F.substring_index(url, "#", 1)
    fragment = F.when(has_fragment, F.substr(url, F.length(before) + 2)).otherwise("")
    scheme = F.regexp_extract(before, r"\A([A-Za-z][A-Za-z0-9+.\-]*+):", 1)

    def split_rest(head: Column) -> Column:
        rest, scheme_, fragment_ = head["rest"], head["scheme"], head["fragment"]
        location = F.substring_index(rest, "?", 1)
        has_query = F.contains(rest, F.lit("?"))
        query = F.when(has_query, F.substr(rest, F.length(location) + 2)).otherwise("")
        opaque = (scheme_ != "") & ~F.startswith(rest, F.lit("/"))
        hosted = F.startswith(location, F.lit("//")) & (
            (scheme_ != "") | ~F.startswith(location, F.lit("///"))
        )
        authority = F.when(
            hosted, F.regexp_extract(location, r"(?s)\A//([^/]*)", 1)
        ).otherwise("")
        return F.struct(
            scheme_.alias("scheme"),
            opaque.alias("is_opaque"),
            F.when(opaque, location).otherwise("").alias("opaque"),
            hosted.alias("has_authority"),
            authority.alias("authority"),
            F.when(opaque, "")
            .when(hosted, F.substr(location, F.length(authority) + 3))
            .otherwise(location)
            .alias("path"),
            has_query.alias("has_query"),
            query.alias("query"),
            fragment_.alias("fragment"),
        )

    parts = bind(
        F.struct(
            F.lower(scheme).alias("scheme"),
            F.when(scheme != "", F.substr(before, F.length(scheme) + 2))
            .otherwise(before)
            .alias("rest"),
            fragment.alias("fragment"),
        ),
        split_rest,
    )

    def checked(p: Column) -> Column:
        ok = (
            ~url.rlike(_CONTROL)
            & ~F.startswith(url, F.lit(":"))
            & p["path"].rlike(rf"(?s)\A{_ESCAPES_OK}\z")
            & p["fragment"].rlike(rf"(?s)\A{_ESCAPES_OK}\z")
            & p["authority"].rlike(rf"\A{_AUTHORITY}\z")
            & ((p["scheme"] != "") | ~p["path"].rlike(r"\A[^/]*:"))
        )
        return F.when(ok, p)

    return bind(parts, checked)


def _escape(text: Column, legal: str, kept: str) -> Column:
    """Text verbatim if all characters are legal, else decoded and escaped afresh."""
    kept_table = F.str_to_map(
        F.lit("\u0002".join(
            f"%{ord(c):02X}\u0001{c}"
            for c in _UNRESERVED + "$&+,/:;=@" + ("?!()*" if kept == _FRAGMENT_KEPT else "")
        )),
        F.lit("\u0002"), F.lit("\u0001"),
    )
    pieces = F.regexp_extract_all(
        text, F.lit(rf"(?s)%[0-9A-Fa-f]{{2}}|[{kept}]++|[^%{kept}]++"), 0
    )

    def rewrite(piece: Column) -> Column:
        triplet = F.upper(piece)
        encoded = F.replace(
            F.replace(F.url_encode(piece), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")
        )
        return (
            F.when(F.startswith(piece, F.lit("%")),
                   F.coalesce(F.element_at(kept_table, triplet), triplet))
            .when(piece.rlike(rf"\A[{kept}]"), piece)
            .otherwise(encoded)
        )

    return F.when(
        text.rlike(rf"[^{legal}]"), F.array_join(F.transform(pieces, rewrite), "")
    ).otherwise(text)


def escape_path(path: Column) -> Column:
    return _escape(path, _LEGAL, _PATH_KEPT)


def _escape_fragment(fragment: Column) -> Column:
    return _escape(fragment, _LEGAL + "?", _FRAGMENT_KEPT)


def _escape_host(authority: Column) -> Column:
    encoded = F.transform(
        F.split(authority, ""), lambda c: F.when(c > "\x7f", F.url_encode(c)).otherwise(c)
    )
    return F.when(authority.rlike(r"[^\x00-\x7F]"), F.array_join(encoded, "")).otherwise(authority)


def _print(p: Column, path: Column) -> Column:
    """URL text of parsed parts with the given, already escaped path."""
    fragment = F.when(
        p["fragment"] != "", F.concat(F.lit("#"), _escape_fragment(p["fragment"]))
    ).otherwise("")
    return F.concat(
        F.when(p["scheme"] != "", F.concat(p["scheme"], F.lit(":"))).otherwise(""),
        F.when(p["is_opaque"], p["opaque"])
        .when((p["authority"] != "") | (p["scheme"] != "") & (path != ""),
              F.concat(F.lit("//"), _escape_host(p["authority"]), path))
        .otherwise(path),
        F.when(p["has_query"], F.concat(F.lit("?"), p["query"])).otherwise(""),
        fragment,
    )


def remove_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; a non-empty result starts with ``/``."""

    def add(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == ".", done)
            .when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(segment)))
        )

    def remove(p: Column) -> Column:
        kept = F.aggregate(F.split(p, "/"), F.array().cast("array<string>"), add)
        tail = F.when(p.rlike(r"(?:\A|/)\.\.?\z"), "/").otherwise("")
        text = F.concat(F.lit("/"), F.array_join(kept, "/"), tail)
        return (
            F.when(p == "", p)
            .when(p.rlike(r"(?:\A|/)\.\.?(?:/|\z)"), F.regexp_replace(text, r"\A//", "/"))
            .when(F.startswith(p, F.lit("/")), p)
            .otherwise(F.concat(F.lit("/"), p))
        )

    return bind(path, remove)


def _decoded(path: Column) -> Column:
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), F.coalesce(plain, path)).otherwise(path)


# Hrefs that resolution leaves as they are: plain characters and no dot segments.
_PLAIN_PATH = r"/(?:[A-Za-z0-9\-_~][A-Za-z0-9\-_~.]*+/?+)*+"
_PLAIN_ROOTED = rf"\A{_PLAIN_PATH}\z"
_PLAIN_ABSOLUTE = (
    rf"\Ahttps?://[A-Za-z0-9][A-Za-z0-9.\-]*+(?::[0-9]++)?{_PLAIN_PATH}(?:\?[^#\x00-\x1F\x7F]*+)?\z"
)


def resolve_url(base: Column, href: Column, drop_same_page: bool = False) -> Column:
    """Absolute URL of ``href`` on the page ``base`` (RFC 3986, section 5.2).

    NULL when either cannot be parsed. With ``drop_same_page`` also NULL when the result has a
    fragment, no query and the path of ``base``; the host is not compared.
    """
    return bind(parse_url(base), lambda b: resolve_on(b, href, drop_same_page))


def resolve_on(base: Column, href: Column, drop_same_page: bool = False) -> Column:
    """:func:`resolve_url` for a base that is already parsed, as for all links of one page."""

    def resolve(h: Column) -> Column:
        hosted = (base["scheme"] != "") & (base["authority"] != "")
        general = bind(parse_url(h), lambda r: _resolve_parts(base, r, drop_same_page))
        return (
            F.when(base.isNull(), None)
            .when(
                hosted & h.rlike(_PLAIN_ROOTED),
                F.concat(base["scheme"], F.lit("://"), _escape_host(base["authority"]), h),
            )
            .when(h.rlike(_PLAIN_ABSOLUTE), h)
            .otherwise(F.when(general != "", general))
        )

    return bind(href, resolve)


def _resolve_parts(b: Column, r: Column, drop_same_page: bool) -> Column:
    absolute = (r["scheme"] != "") | (r["authority"] != "")
    inherits_query = (r["path"] == "") & ~r["has_query"] & ~absolute
    paths = F.struct(
        escape_path(r["path"]).alias("own"), escape_path(b["path"]).alias("base"),
        absolute.alias("absolute"),
    )
    merged = bind(
        paths,
        lambda p: F.when(p["absolute"] | F.startswith(p["own"], F.lit("/")), p["own"])
        .when(p["own"] == "", p["base"])
        .otherwise(F.concat(F.regexp_extract(p["base"], r"(?s)\A(.*/)?", 0), p["own"])),
    )
    target = F.struct(
        F.when(r["scheme"] != "", r["scheme"]).otherwise(b["scheme"]).alias("scheme"),
        F.when(absolute, r["is_opaque"])
        .otherwise((r["path"] == "") & b["is_opaque"]).alias("is_opaque"),
        F.when(absolute, r["opaque"]).otherwise(b["opaque"]).alias("opaque"),
        F.when(absolute, r["authority"]).otherwise(b["authority"]).alias("authority"),
        remove_dot_segments(merged).alias("path"),
        F.when(inherits_query, b["query"] != "").otherwise(r["has_query"]).alias("has_query"),
        F.when(inherits_query, b["query"]).otherwise(r["query"]).alias("query"),
        F.when(inherits_query & (r["fragment"] == ""), b["fragment"])
        .otherwise(r["fragment"]).alias("fragment"),
    )

    def finish(t: Column) -> Column:
        text = _print(t, t["path"])
        if not drop_same_page:
            return text
        same_page = (
            (t["fragment"] != "") & (t["query"] == "")
            & (_decoded(t["path"]) == _decoded(b["path"]))
        )
        return F.when(~same_page, text)

    return F.when(r.isNotNull(), bind(target, finish))


def normalize_url(url: Column) -> Column:
    """Drop the fragment and write an empty path as ``/``; unparsable input is unchanged."""

    def normalize(p: Column) -> Column:
        bare = bind(p.withField("fragment", F.lit("")), lambda q: bind(
            F.when(q["path"] == "", F.lit("/")).otherwise(escape_path(q["path"])),
            lambda path: _print(q, path),
        ))
        return F.when(p.isNull(), url).otherwise(bare)

    return bind(parse_url(url), normalize)


def is_valid_url(url: Column, strict: bool = False) -> Column:
    """HTTP(S) URL with a host that does not look like an asset or a non-web link.

    The excluded parts count anywhere in the URL, as in ``/data.json`` for ``.js``. With
    ``strict`` an extension counts only at the end of the path.
    """
    if strict:
        extensions = "|".join(p[1:] for p in EXCLUDED_PARTS if p.startswith("."))
        excluded = url.rlike(rf"(?i)\A[^?#]*\.(?:{extensions})(?:[?#]|\z)")
    else:
        excluded = F.lower(url).rlike(_any_of(EXCLUDED_PARTS))
    path = r"(?:/(?:[^%?#\x00-\x1F\x7F]++|%[0-9A-Fa-f]{2})*+)?"
    query = r"(?:\?[^#\x00-\x1F\x7F]*+)?"
    fragment = r"(?:#(?:[^%\x00-\x1F\x7F]++|%[0-9A-Fa-f]{2})*+)?"
    well_formed = url.rlike(
        rf"\A[hH][tT][tT][pP][sS]?://(?:[A-Za-z0-9\-._:~!$&'()*+,;=%@]*@)?(?=[^/?#@])"
        rf"(?:\[[^\]/?#]*\]|{_HOST_CHARS})(?::[0-9]*)?{path}{query}{fragment}\z"
    )
    return F.coalesce(well_formed & ~excluded, F.lit(False))


def guess_content_type(url: Column) -> Column:
    lower = F.lower(url)
    return (
        F.when(lower.rlike("/blog/|/article/"), "article")
        .when(F.contains(lower, F.lit("/news/")), "news")
        .when(lower.rlike("/doc|/help/"), "documentation")
        .otherwise("general")
    )


def is_relevant_content(content_type: Column) -> Column:
    return F.coalesce(content_type, F.lit("")).rlike(_any_of(RELEVANT_TYPES))
