"""The native functions as SQL functions: temporary functions with a SQL body,
which the analyzer puts in place of the call, so a query that uses them holds
built-in expressions only and no Python worker.

Each body is the SQL text of the ``Column`` function named beside it; patterns
and lists come from the same constants.  A lambda can't call a SQL function, so
what is needed inside one is written in place (``_decoded``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..options import PURCHASE_EVENT, SEARCH_ENGINES
from .commerce import MONEY_TYPE, REVENUE_TYPE, SUM_TYPE
from .text import _STRAY_PERCENT, PY_WHITESPACE
from .url import _AUTHORITY, _IPV6, _IPVFUTURE, _QUERY, C0_OR_SPACE, UNSAFE_URL_CHARS, delimiter_lookalikes


def _text(s: str) -> str:
    """A SQL literal: printable ASCII as it stands, other code points by number."""
    if s.isascii() and s.isprintable():
        return f"r'{s}'" if "'" not in s else f'r"{s}"'
    return "decode(unhex('" + s.encode().hex() + "'), 'UTF-8')"


def _stripped(s: str) -> str:
    return f"btrim({s}, {_text(PY_WHITESPACE)})"


def _decoded(s: str) -> str:
    return f"if(instr({s}, '%') > 0, try_url_decode(regexp_replace({s}, {_text(_STRAY_PERCENT)}, '%25')), translate({s}, '+', ' '))"


def _engines(host: str) -> str:
    cases = (
        f"WHEN {host} = {_text(suffix)} OR endswith({host}, {_text('.' + suffix)}) THEN named_struct('domain', {_text(display)}, 'param', {_text(param)})"
        for suffix, param, display in SEARCH_ENGINES
    )
    return "CASE " + " ".join(cases) + " END"


def definitions(prefix: str = "") -> dict[str, tuple[str, str, str]]:
    """name: (parameters, type, body), each after those that it calls."""
    key = "substring_index(p, '=', 1)"
    f = lambda name: prefix + name
    url = f"ltrim({_text(C0_OR_SPACE)}, translate(u, {_text(UNSAFE_URL_CHARS)}, ''))"
    literal = r"regexp_extract(a, r'\[([^\]]*)', 1)"
    malformed = (
        "coalesce(CASE WHEN instr(a, '[') > 0 OR instr(a, ']') > 0 THEN (instr(a, '[') > 0) <> (instr(a, ']') > 0) OR "
        f"if(startswith({literal}, 'v'), NOT rlike({literal}, {_text(_IPVFUTURE)}), NOT rlike({literal}, {_text(_IPV6)})) END, false) "
        f"OR coalesce(octet_length(a) > length(a) AND rlike(a, {_text(delimiter_lookalikes())}), false)"
    )
    part = "substring_index(a, '@', -1)"
    host = rf"lower(if(instr({part}, '[') > 0, regexp_extract({part}, r'\[([^\]]*)', 1), substring_index({part}, ':', 1)))"
    product = f"coalesce(CAST(try_cast({_stripped('get(split(p, ' + repr(';') + '), 3)')} AS {REVENUE_TYPE}) AS {SUM_TYPE}), CAST(0 AS {SUM_TYPE}))"
    touch = "STRUCT<domain: STRING, keyword: STRING>"
    return {
        f("strip_text"): ("s STRING", "STRING", _stripped("s")),
        f("lenient_decode"): ("s STRING", "STRING", _decoded("s")),
        f("url_authority"): ("u STRING", "STRING", f"regexp_extract({url}, {_text(_AUTHORITY)}, 1)"),
        f("url_query"): ("u STRING", "STRING", f"regexp_extract({url}, {_text(_QUERY)}, 1)"),
        f("authority_is_malformed"): ("a STRING", "BOOLEAN", malformed),
        f("authority_host"): ("a STRING", "STRING", f"if({f('authority_is_malformed')}(a), NULL, nullif({host}, ''))"),
        f("url_is_malformed"): ("u STRING", "BOOLEAN", f"{f('authority_is_malformed')}({f('url_authority')}(u))"),
        f("url_host"): ("u STRING", "STRING", f"{f('authority_host')}({f('url_authority')}(u))"),
        f("without_www"): ("h STRING", "STRING", "if(startswith(h, 'www.'), substring(h, 5), h)"),
        f("referrer_host"): ("u STRING", "STRING", f"{f('without_www')}({f('url_host')}(u))"),
        f("query_param"): (
            "q STRING, n STRING",
            "STRING",
            _decoded(
                "regexp_extract(get(filter(split(q, '&'), p -> instr(p, '=') > 0 AND instr(p, '=') < length(p) AND "
                f"({key} = n OR rlike({key}, '[%+]') AND {_decoded(key)} = n)), 0), r'(?s)^[^=]*=(.*)$', 1)"
            ),
        ),
        f("engine_lookup"): ("h STRING", "STRUCT<domain: STRING, param: STRING>", _engines("h")),
        f("touch_of"): (
            "e STRUCT<domain: STRING, param: STRING>, k STRING",
            touch,
            "if(e IS NOT NULL AND length(k) > 0, named_struct('domain', e.domain, 'keyword', k), NULL)",
        ),
        f("engine_keyword"): (
            "u STRING, e STRUCT<domain: STRING, param: STRING>",
            touch,
            f"{f('touch_of')}(e, {f('strip_text')}({f('query_param')}({f('url_query')}(u), e.param)))",
        ),
        f("search_referrer"): ("u STRING", touch, f"{f('engine_keyword')}(u, {f('engine_lookup')}({f('referrer_host')}(u)))"),
        f("is_purchase"): (
            "e STRING",
            "BOOLEAN",
            f"coalesce(array_contains(transform(split(e, ','), p -> {_stripped('p')}), {_text(PURCHASE_EVENT)}), false)",
        ),
        f("product_revenue"): (
            "s STRING",
            SUM_TYPE.upper(),
            f"coalesce(aggregate(transform(split(s, ','), p -> {product}), CAST(0 AS {SUM_TYPE}), (t, x) -> CAST(t + x AS {SUM_TYPE})), CAST(0 AS {SUM_TYPE}))",
        ),
        f("to_cents"): (f"x {SUM_TYPE.upper()}", MONEY_TYPE.upper(), f"CAST(bround(x, 2) AS {MONEY_TYPE})"),
    }


def register_sql_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create the functions in the session's temporary scope, replacing those of
    the same names; returns the names."""
    out = definitions(prefix)
    for name, (parameters, kind, body) in out.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(out)
