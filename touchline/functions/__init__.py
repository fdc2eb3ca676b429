"""Native Column functions: text, URL and commerce parsing."""

from .commerce import (
    MONEY_TYPE,
    REVENUE_TYPE,
    SUM_TYPE,
    event_codes,
    is_purchase,
    money_text,
    product_revenue,
    to_cents,
)
from .sql import register_sql_functions
from .text import blank_to_empty, strip_text, url_decode
from .url import (
    classify_referrer,
    engine_lookup,
    query_param,
    referrer_class,
    referrer_host,
    search_referrer,
    url_authority,
    url_hostname,
    url_is_malformed,
    url_query,
    with_referrer_parts,
)

__all__ = [
    "MONEY_TYPE", "REVENUE_TYPE", "SUM_TYPE", "event_codes", "is_purchase", "money_text",
    "product_revenue", "to_cents", "blank_to_empty", "strip_text", "url_decode",
    "engine_lookup", "query_param", "referrer_class", "referrer_host", "search_referrer",
    "url_authority", "url_hostname", "url_is_malformed", "url_query",
    "classify_referrer", "with_referrer_parts", "register_sql_functions",
]
