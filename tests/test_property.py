"""Property test: random hit sequences give the plain-Python fold's result."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline import AttributionOptions
from touchline.plans.attribution import attribute
from tests.fold import fold
from tests.hits import frame, hit, results

REFERRERS = st.sampled_from([
    "http://www.google.com/search?q=Alpha", "http://google.com/?q=alpha", "http://www.bing.com/search?q=Beta+x",
    "http://search.yahoo.com/search?p=g%C3%A4mma", "http://yahoo.com/?q=no&p=", "http://www.msn.com/?q=%20",
    "http://www.esshopzilla.com/x", "", "not-a-url", "http://[bad/", "http://u@www.google.com:8/?q=a&q=b",
    "http://other.org/?q=zzz", "//google.com/?q=Alpha",
])
PRODUCTS = st.sampled_from(["", "C;P;1;10;", "C;P;1;-3;", "C;P;1;;", "C;P;1;x;", "C;P;1;2.5;,C;Q;2;0.25;"])
HITS = st.lists(
    st.tuples(
        st.integers(0, 3),                                   # visitor
        st.one_of(st.just(""), st.integers(0, 20000)),       # hit time (blank allowed, unsorted)
        REFERRERS,
        st.sampled_from(["", "1", "2", "12,11", " 2 , 1 "]),  # events
        PRODUCTS,
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=HITS, timeout=st.sampled_from([None, 0, 3000]), order=st.sampled_from(["file", "time"]))
def test_matches_fold(spark, rows, timeout, order):
    hits = [hit(t, ip=f"v{v}", events=e, products=p, referrer=r) for v, t, r, e, p in rows]
    want, live = fold(hits, timeout, order)
    expect = sorted((d, disp, str(rev)) for (d, _), (disp, rev) in want.items())
    for extra in ({"skew_threshold": None}, {"skew_threshold": 5, "block_rows": 3}):
        r = attribute(frame(spark, hits), AttributionOptions(session_timeout=timeout, order=order, **extra))
        assert sorted(results(r)) == expect, extra
        assert r.run_counts.first().visitors_with_live_touch == live
