"""URL parsing as native Column expressions.

``parse_url`` is not used: it throws (or, as ``try_parse_url``, returns NULL) on
hosts with spaces, ``|`` or ``_``, which a lenient URL splitter accepts.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import INTERNAL_SUFFIXES, SEARCH_ENGINES
from .text import _col, strip_text, url_decode

# Leading C0 controls / spaces are dropped and tab, CR and LF removed anywhere
# before splitting, as URL splitters following the WHATWG rules do.
C0_OR_SPACE = "".join(chr(i) for i in range(0x21))
UNSAFE_URL_CHARS = "\t\r\n"
# Authority: text after '//' that directly follows an optional scheme.
_AUTHORITY = "^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)"
_HAS_AUTHORITY = "^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//"
# Query: after the first '?' that precedes any '#'.
_QUERY = "^[^?#]*\\?([^#]*)"
_HAS_QUERY = "^[^?#]*\\?"


def _ipv6_pattern() -> str:
    """IPv6 literal (RFC 3986 ``IPv6address``), optional zone id, built by rule."""
    h16 = "[0-9A-Fa-f]{1,4}"
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    ipv4 = f"(?:{octet}\\.){{3}}{octet}"
    ls32 = f"(?:{h16}:{h16}|{ipv4})"
    forms = [f"(?:{h16}:){{6}}{ls32}", f"::(?:{h16}:){{5}}{ls32}"]
    # [ *k( h16 ":" ) h16 ] "::" tail, for k = 0..6
    tails = [f"(?:{h16}:){{4}}{ls32}", f"(?:{h16}:){{3}}{ls32}", f"(?:{h16}:){{2}}{ls32}",
             f"{h16}:{ls32}", ls32, h16, ""]
    for k, tail in enumerate(tails):
        head = f"(?:(?:{h16}:){{0,{k}}}{h16})?" if k else f"(?:{h16})?"
        forms.append(f"{head}::{tail}")
    return "^(?:" + "|".join(forms) + ")(?:%[^%]+)?$"


@cache
def delimiter_lookalikes() -> str:
    """A class of the code points whose compatibility form (NFKC) holds a URL
    delimiter, such as a full-width colon; built by rule."""
    beyond = (chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF)
    return "[" + "".join(c for c in beyond if set("/?#@:") & set(unicodedata.normalize("NFKC", c))) + "]"


_IPV6 = _ipv6_pattern()
_IPVFUTURE = "^v[a-fA-F0-9]+\\..+$"


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a Column -> Column
    function that may use it many times) - keeps nested helpers from
    re-inlining a large expression at every use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_url(c) -> Column:
    return F.ltrim(F.translate(_col(c), UNSAFE_URL_CHARS, ""), F.lit(C0_OR_SPACE))


def url_authority(c) -> Column:
    """Network location of a URL; ``''`` when there is none."""
    return F.regexp_extract(clean_url(c), _AUTHORITY, 1)


def url_query(c) -> Column:
    """Query string of a URL; ``''`` when it has no '?'."""
    return F.regexp_extract(clean_url(c), _QUERY, 1)


def _host_part(authority: Column) -> Column:
    # drop user info: everything up to the last '@'
    return F.substring_index(authority, "@", -1)


def _host_from_part(hp: Column) -> Column:
    bracketed = F.regexp_extract(hp, "\\[([^\\]]*)", 1)
    plain = F.substring_index(hp, ":", 1)
    return F.lower(F.when(F.instr(hp, "[") > 0, bracketed).otherwise(plain))


def url_hostname(c) -> Column:
    """Lower-cased host name; NULL when absent or when the URL is malformed
    (a standard splitter raises there, so no host is known)."""

    def from_auth(auth):
        host = _host_from_part(_host_part(auth))
        return F.when((host != "") & ~_malformed_authority(auth), host)

    return _let(url_authority(c), from_auth)


def _drop_www(h: Column) -> Column:
    return F.when(h.startswith("www."), F.substring(h, 5, 1 << 30)).otherwise(h)


def referrer_host(c) -> Column:
    """Host used for engine matching: lower case, one leading ``www.`` removed (F1)."""
    return _drop_www(url_hostname(c))


def _malformed_authority(auth: Column) -> Column:
    """Bracket and look-alike rules of a standard URL splitter on an authority
    (see url_is_malformed).

    The regex checks run only when the authority holds a bracket, or something
    that isn't ASCII, at all.
    """
    has_open = F.instr(auth, "[") > 0
    has_close = F.instr(auth, "]") > 0
    # text between the authority's first '[' and the next ']'
    literal = F.regexp_extract(auth, "\\[([^\\]]*)", 1)
    bad_literal = F.when(literal.startswith("v"), ~literal.rlike(_IPVFUTURE)).otherwise(
        ~literal.rlike(_IPV6)
    )
    lookalike = (F.octet_length(auth) > F.length(auth)) & auth.rlike(delimiter_lookalikes())
    return F.coalesce(
        F.when(has_open | has_close, (has_open != has_close) | bad_literal),
        F.lit(False),
    ) | F.coalesce(lookalike, F.lit(False))


def url_is_malformed(c) -> Column:
    """True when a standard URL splitter rejects the URL (trap 16).

    Rejected: an authority with '[' but no ']' or the reverse; or, with both,
    a bracketed literal (from the first '[' to the next ']') that is neither an
    IPv6 address (optional zone) nor an IPvFuture literal; or a character in the
    authority whose NFKC form holds one of ``/?#@:``.
    """
    return _malformed_authority(url_authority(c))


def query_param(query, name) -> Column:
    """First value of parameter ``name`` whose raw value is non-empty, decoded.

    Pairs split on '&'; a pair without '=' is ignored; the name is decoded
    before comparing.  Duplicate names are fine (no map is built).
    """
    q = _col(query)
    n = F.lit(name) if isinstance(name, str) else name
    pairs = F.split(q, "&")
    hits = F.filter(
        pairs,
        lambda p: (F.instr(p, "=") > 0)
        & (F.instr(p, "=") < F.length(p))
        & (
            (F.substring_index(p, "=", 1) == n)
            | (
                F.substring_index(p, "=", 1).rlike("[%+]")
                & (url_decode(F.substring_index(p, "=", 1)) == n)
            )
        ),
    )
    first = F.get(hits, 0)
    return url_decode(F.regexp_extract(first, "(?s)^[^=]*=(.*)$", 1))


def engine_lookup(
    host, engines: Sequence[tuple[str, str, str]] = SEARCH_ENGINES, bind: bool = True
) -> Column:
    """Struct(display domain, query parameter) of the first engine whose suffix
    equals the host or is a dot-suffix of it; NULL when none matches (F2, J3).

    ``host`` is used twice per engine; an expression is bound once unless
    ``bind=False`` (pass a plain column then) or it is given by name."""

    def chain(h):
        out = None
        for suffix, param, display in engines:
            cond = (h == suffix) | h.endswith("." + suffix)
            val = F.struct(F.lit(display).alias("domain"), F.lit(param).alias("param"))
            out = F.when(cond, val) if out is None else out.when(cond, val)
        return out

    h = _col(host)
    return chain(h) if isinstance(host, str) or not bind else _let(h, chain)


def search_referrer(referrer, engines: Sequence[tuple[str, str, str]] = SEARCH_ENGINES) -> Column:
    """Struct(domain, keyword) for a search-engine referrer with a keyword, else NULL.

    For whole DataFrames prefer :func:`with_referrer_parts` (staged columns).
    """
    r = _col(referrer)

    def from_engine(eng):
        keyword = strip_text(query_param(url_query(r), eng["param"]))
        return F.when(
            eng.isNotNull() & (F.coalesce(F.length(keyword), F.lit(0)) > 0),
            F.struct(eng["domain"].alias("domain"), keyword.alias("keyword")),
        )

    return _let(engine_lookup(referrer_host(r), engines), from_engine)


def with_referrer_parts(
    df: DataFrame,
    col: str = "referrer",
    engines: Sequence[tuple[str, str, str]] = SEARCH_ENGINES,
) -> DataFrame:
    """Parse a URL column in stages and add ``ref_host`` (lower-cased host or
    NULL), ``ref_malformed`` and ``touch`` (struct domain, keyword or NULL).

    Same results as :func:`url_hostname`, :func:`url_is_malformed` and
    :func:`search_referrer`, but the expensive intermediates (authority and
    query, host, engine, keyword) are projected columns, so the generated code
    computes each once instead of inlining it at every use.
    """
    keep = [F.col(c) for c in df.columns]
    # stage 1: authority and query (the cheap clean-up is shared by both)
    u = clean_url(col)
    df = df.withColumns(
        {"_auth": F.regexp_extract(u, _AUTHORITY, 1), "_q": F.regexp_extract(u, _QUERY, 1)}
    )
    # stage 2: host and bracket check (string slicing; the regex branches are rare)
    hp = _host_part(F.col("_auth"))
    bad = _malformed_authority(F.col("_auth"))
    h0 = _host_from_part(hp)
    host = F.when((h0 != "") & ~bad, h0)
    df = df.withColumns({"ref_malformed": bad, "ref_host": host, "_h": _drop_www(host)})
    # stage 3: engine; stage 4: keyword (only for engine hosts)
    df = df.withColumn("_eng", engine_lookup(F.col("_h"), engines, bind=False))
    df = df.withColumn(
        "_kw", F.when(F.col("_eng").isNotNull(), strip_text(query_param(F.col("_q"), F.col("_eng.param"))))
    )
    touch = F.when(
        F.col("_eng").isNotNull() & (F.coalesce(F.length("_kw"), F.lit(0)) > 0),
        F.struct(F.col("_eng.domain").alias("domain"), F.col("_kw").alias("keyword")),
    )
    return df.select(*keep, "ref_malformed", "ref_host", touch.alias("touch"))


def classify_referrer(referrer, touch, host, malformed, internal_suffixes: Sequence[str] = INTERNAL_SUFFIXES) -> Column:
    """Referrer class from already parsed parts (see :func:`referrer_class`)."""
    r, h = _col(referrer), _col(host)
    internal = F.lit(False)
    for s in internal_suffixes:
        internal = internal | h.endswith(s)
    return (
        F.when(_col(touch).isNotNull(), F.lit("search"))
        .when(r == "", F.lit("none"))
        .when(_col(malformed), F.lit("malformed"))
        .when(h.isNull(), F.lit("hostless"))
        .when(internal, F.lit("internal"))
        .otherwise(F.lit("unknown_external"))
    )


def referrer_class(referrer, touch, internal_suffixes: Sequence[str] = INTERNAL_SUFFIXES) -> Column:
    """``search`` / ``none`` / ``malformed`` / ``hostless`` / ``internal`` /
    ``unknown_external`` (P8).  ``referrer`` must already be stripped."""
    r = _col(referrer)
    host = url_hostname(r)
    internal = F.lit(False)
    for s in internal_suffixes:
        internal = internal | host.endswith(s)
    return (
        F.when(_col(touch).isNotNull(), F.lit("search"))
        .when(r == "", F.lit("none"))
        .when(url_is_malformed(r), F.lit("malformed"))
        .when(host.isNull(), F.lit("hostless"))
        .when(internal, F.lit("internal"))
        .otherwise(F.lit("unknown_external"))
    )
