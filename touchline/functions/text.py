"""Text helpers as native Column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python's ``str.strip()`` removes (``str.isspace``):
# U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.  Spark's ``trim`` removes only U+0020.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A '%' not followed by two hex digits: kept literally by a lenient decoder.
_STRAY_PERCENT = "%(?![0-9A-Fa-f]{2})"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """Unicode strip with Python ``str.strip()`` semantics (F9), native ``btrim``."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def blank_to_empty(c) -> Column:
    """Missing value becomes ``''`` and the rest is stripped."""
    return F.coalesce(strip_text(c), F.lit(""))


def url_decode(c) -> Column:
    """Lenient form decoding.

    ``+`` becomes a space, ``%xx`` sequences decode as UTF-8 with U+FFFD for
    invalid bytes, and a stray ``%`` is kept as it is.  Text without ``%`` only
    needs the ``+`` replacement, so the decoder runs only where a ``%`` occurs.
    """
    s = _col(c)
    return F.when(
        F.instr(s, "%") > 0,
        F.try_url_decode(F.regexp_replace(s, _STRAY_PERCENT, "%25")),
    ).otherwise(F.translate(s, "+", " "))
