"""What a set of hits should give, worked out a visitor at a time.

A visitor's hits are put in order, cut into sessions where the gap is too
long, and each purchase looks up the nearest touch before it by bisection.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from decimal import Decimal
from itertools import accumulate
from urllib.parse import parse_qsl, urlsplit

from touchline.options import PURCHASE_EVENT, SEARCH_ENGINES

NUMBER = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?")


def touch_of(referrer):
    try:
        url = urlsplit(referrer)
        labels = (url.hostname or "").split(".")
    except ValueError:
        return None
    labels = labels[labels[0] == "www" :]
    ends = {".".join(labels[i:]) for i in range(len(labels))}
    engine = next((e for e in SEARCH_ENGINES if e[0] in ends), None)
    words = [v.strip() for k, v in parse_qsl(url.query) if engine and k == engine[1]]
    return (engine[2], words[0]) if words and words[0] else None


def revenue_of(products):
    amounts = [";".join(p.split(";")[3:4]).strip() for p in (products or "").split(",")]
    return sum((Decimal(a) for a in amounts if NUMBER.fullmatch(a)), Decimal(0))


def fold(rows, timeout=None, order="file"):
    """({(domain, keyword in lower case): (as first seen, revenue)}, visitors
    that still have a touch)."""
    text = lambda r, c: (r.get(c) or "").strip()
    hits = [
        (int(text(r, "hit_time_gmt") or 0), n, touch_of(text(r, "referrer")), text(r, "event_list"), r.get("product_list"), (text(r, "ip"), text(r, "user_agent")))
        for n, r in enumerate(rows)
    ]
    if order == "time":
        hits.sort(key=lambda h: h[:2])
    visits, shown, earned, live = defaultdict(list), {}, defaultdict(Decimal), 0
    for h in hits:
        visits[h[5]].append(h)
        if h[2]:
            shown.setdefault((h[2][0], h[2][1].lower()), h[2][1])
    for mine in visits.values():
        gaps = [b[0] - a[0] for a, b in zip(mine, mine[1:])]
        session = list(accumulate([0, *(timeout is not None and g > timeout for g in gaps)]))
        touched = [i for i, h in enumerate(mine) if h[2]]

        def touch_at(i):
            k = bisect_right(touched, i) - 1
            if k >= 0 and session[touched[k]] == session[i]:
                return mine[touched[k]][2]

        live += touch_at(len(mine) - 1) is not None
        for i, h in enumerate(mine):
            bought = PURCHASE_EVENT in {c.strip() for c in h[3].split(",")}
            amount, touch = revenue_of(h[4]), touch_at(i)
            if bought and amount > 0 and touch:
                earned[touch[0], touch[1].lower()] += amount
    return {k: (shown[k], v.quantize(Decimal("0.01"))) for k, v in earned.items()}, live
