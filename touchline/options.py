"""Job options for an attribution run (frozen, validated once)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Optional

# Fixed values that must equal the reference's behaviour.
# Search engines, in match priority order: (host suffix, query parameter, display domain).
SEARCH_ENGINES: tuple[tuple[str, str, str], ...] = (
    ("google.com", "q", "google.com"),
    ("bing.com", "q", "bing.com"),
    ("search.yahoo.com", "p", "yahoo.com"),
    ("yahoo.com", "p", "yahoo.com"),
    ("msn.com", "q", "msn.com"),
)
# Host suffixes treated as the site's own pages (raw suffix test, no dot boundary).
INTERNAL_SUFFIXES: tuple[str, ...] = ("esshopzilla.com",)
# Columns a hit file must carry.
REQUIRED_COLUMNS: tuple[str, ...] = (
    "hit_time_gmt",
    "ip",
    "user_agent",
    "event_list",
    "product_list",
    "referrer",
)
# Event code that marks a purchase.
PURCHASE_EVENT = "1"
# Manifest schema version.
OUTPUT_SCHEMA_VERSION = "v1"
# Result column headers of the tab-separated report.
REPORT_HEADERS = ("Search Engine Domain", "Search Keyword", "Revenue")

ORDER_MODES = ("file", "time")


@dataclass(frozen=True)
class AttributionOptions:
    """Options of one attribution run.

    session_timeout: seconds of inactivity after which a visitor's touch is
        cleared (strictly greater than); ``None`` disables expiry, ``0`` is valid.
    order: ``"file"`` processes hits in arrival order, ``"time"`` in
        (hit time, arrival) order.
    strict_time: raise :class:`ParsingError` on a hit time that is neither blank
        nor a whole number; otherwise it reads as 0 and is counted.
    validate_schema: raise :class:`InputSchemaError` on missing columns.
    prefilter: with no timeout, drop rows that are neither search hits nor
        purchases before the visitor shuffle (never applied with a timeout).
    skew_threshold: a visitor with more hits than this is split into blocks of
        the order key and carried across blocks, so no single task holds it.
        ``None`` disables the check.
    block_rows: target number of hits per block of a split visitor; blocks are
        cut at quantiles of the visitor's order keys.
    block_span: fixed block width instead (arrival-sequence units in file
        order, seconds in time order); ``None`` uses ``block_rows``.
    visitor_partitions: number of partitions of the visitor shuffle; ``None``
        leaves it to ``spark.sql.shuffle.partitions`` and adaptive coalescing.
    """

    session_timeout: Optional[int] = None
    order: str = "file"
    strict_time: bool = False
    validate_schema: bool = True
    prefilter: bool = True
    skew_threshold: Optional[int] = 5_000_000
    block_rows: int = 1_000_000
    block_span: Optional[int] = None
    visitor_partitions: Optional[int] = None
    engines: tuple[tuple[str, str, str], ...] = field(default=SEARCH_ENGINES)
    internal_suffixes: tuple[str, ...] = field(default=INTERNAL_SUFFIXES)

    def __post_init__(self) -> None:
        if self.session_timeout is not None and self.session_timeout < 0:
            raise ValueError(f"a session timeout of {self.session_timeout} s is negative")
        if self.order not in ORDER_MODES:
            raise ValueError(f"order must be one of {ORDER_MODES}, got {self.order!r}")
        if self.skew_threshold is not None and self.skew_threshold < 1:
            raise ValueError(f"skew_threshold must be >= 1 or None, got {self.skew_threshold}")
        if self.block_span is not None and self.block_span < 1:
            raise ValueError(f"block_span must be >= 1 or None, got {self.block_span}")
        if self.block_rows < 1:
            raise ValueError(f"block_rows must be >= 1, got {self.block_rows}")
        if self.visitor_partitions is not None and self.visitor_partitions < 1:
            raise ValueError("visitor_partitions must be >= 1 or None")
        if not self.engines:
            raise ValueError("engines must not be empty")

    def with_(self, **changes) -> "AttributionOptions":
        return replace(self, **changes)
