"""Streaming form: equals batch, survives a restart from its checkpoint."""

import os

import pyarrow.parquet as pq
import pytest

from touchline import AttributionOptions
from touchline.operators.aggregate import keyword_revenue
from touchline.plans.catalog import keyword_revenue as batch_keyword_revenue
from touchline.streaming.runner import events_stream, run_to_parquet
from touchline.streaming.stateful import as_attributed, stream_last_touch
from tests.conftest import SF001


def _split_events(folder, parts):
    os.makedirs(folder, exist_ok=True)
    table = pq.read_table(f"{SF001}/events.parquet").sort_by("event_id")
    n = table.num_rows
    paths = []
    for i in range(parts):
        chunk = table.slice(i * n // parts, (i + 1) * n // parts - i * n // parts)
        path = os.path.join(folder, f"events_{i}.parquet")
        pq.write_table(chunk, path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        paths.append(path)
    return paths


def _stage(src, dst_folder):
    os.makedirs(dst_folder, exist_ok=True)
    dst = os.path.join(dst_folder, os.path.basename(src))
    with open(src, "rb") as a, open(dst, "wb") as b:
        b.write(a.read())
    st = os.stat(src)
    os.utime(dst, (st.st_mtime, st.st_mtime))


def _rows(df):
    return sorted((r.search_engine_domain, r.search_keyword, str(r.revenue)) for r in df.collect())


@pytest.mark.parametrize("timeout", [None, 21600])
def test_restart_from_checkpoint_equals_batch(spark, workdir, timeout):
    parts = _split_events(os.path.join(workdir, "parts"), 4)
    inbox = os.path.join(workdir, "inbox")
    opts = AttributionOptions(session_timeout=timeout)
    root = os.path.join(workdir, "stream")
    for batch in (parts[:2], parts[2:]):
        for p in batch:
            _stage(p, inbox)
        q = run_to_parquet(stream_last_touch(events_stream(spark, inbox, max_files=1), opts), root)
        q.awaitTermination()
        assert q.exception() is None
    out = spark.read.parquet(f"{root}/out")
    got = keyword_revenue(as_attributed(out), opts).drop("keyword_lower")
    want = batch_keyword_revenue(spark, SF001, session_timeout=timeout)
    assert _rows(got) == _rows(want)
    # every purchase appears once: no double counting after the restart
    n_purchases = out.filter("is_purchase").count()
    assert n_purchases == out.filter("is_purchase").select("seq").distinct().count() == 202


def test_live_counters_observed(spark, workdir):
    inbox = os.path.join(workdir, "inbox")
    for p in _split_events(os.path.join(workdir, "parts"), 2):
        _stage(p, inbox)
    q = run_to_parquet(stream_last_touch(events_stream(spark, inbox), AttributionOptions(), metrics_name="live_q"),
                       os.path.join(workdir, "s"))
    q.awaitTermination()
    seen = [p["observedMetrics"].get("live_q") for p in q.recentProgress if p.get("observedMetrics")]
    assert seen and sum(int(m["rows_processed"]) for m in seen) == 1000


def test_continuous_intake_processes_each_file_once(spark, workdir):
    import datetime as dt

    from tests.hits import SHOP_DAY, SHOP_DAY_RESULT, hit, write_tsv
    from touchline.streaming.runner import continuous_intake

    inbox, out, chk = (os.path.join(workdir, x) for x in ("in", "out", "chk"))
    os.makedirs(inbox)
    write_tsv(SHOP_DAY, inbox, "a.tsv")
    day = dt.date(2026, 3, 5)

    def report(batch):
        q = continuous_intake(spark, inbox, out, chk, run_date=day)
        q.awaitTermination()
        assert q.exception() is None
        with open(os.path.join(out, f"batch={batch}", "2026-03-05_SearchKeywordPerformance.tab")) as fh:
            return fh.read().splitlines()[1:]

    assert report(0) == ["\t".join(r) for r in SHOP_DAY_RESULT]
    # a restart with no new file processes nothing; a new file, with its
    # columns in another order, is one new batch
    assert report(0) and sorted(os.listdir(out)) == ["batch=0"]
    more = [SHOP_DAY[1], hit(1_700_000_050, "172.16.3.3", "Phone 2", "1", "E;Z;1;9;")]
    write_tsv(more, inbox, "b.tsv", fields=["referrer", "product_list", "event_list", "user_agent", "ip", "hit_time_gmt"])
    assert report(1) == ["yahoo.com\ttent pegs\t9.00"]
    # a file written anew under its old name is run once more, over a restart,
    # and the untouched one is not
    changed = [*more, hit(1_700_000_060, "172.16.3.3", "Phone 2", "1", "E;Z;1;1;")]
    write_tsv(changed, inbox, "b.tsv")
    assert report(2) == ["yahoo.com\ttent pegs\t10.00"]
    assert report(2) and sorted(os.listdir(out)) == ["batch=0", "batch=1", "batch=2"]
    runs = spark.read.parquet(f"{chk}/ledger").groupBy("input_key").count().collect()
    assert sorted((r.input_key.rsplit("/", 1)[1], r["count"]) for r in runs) == [("a.tsv", 1), ("b.tsv", 2)]


def test_intake_runs_again_what_was_not_recorded(spark, workdir):
    """A run that failed before its ledger entry writes the same folder again."""
    from tests.hits import SHOP_DAY, SHOP_DAY_RESULT, write_tsv
    from touchline.sources import intake
    from touchline.streaming.runner import attribute_each_batch

    inbox, out, ledger = (os.path.join(workdir, x) for x in ("in", "out", "ledger"))
    os.makedirs(inbox)
    for name in ("a.tsv", "b.tsv"):
        write_tsv(SHOP_DAY, inbox, name)

    def refuse(*a):
        raise OSError("no ledger today")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(intake, "record_processed", refuse)
        with pytest.raises(OSError):
            attribute_each_batch(inbox, out, ledger)(spark.range(1), 0)
    assert os.listdir(out) == ["batch=0"]
    attribute_each_batch(inbox, out, ledger)(spark.range(1), 0)
    assert sorted(os.listdir(out)) == ["batch=0", "batch=1"]
    for n in (0, 1):
        [name] = [f for f in os.listdir(f"{out}/batch={n}") if f.endswith(".tab")]
        with open(f"{out}/batch={n}/{name}") as fh:
            assert fh.read().splitlines()[1:] == ["\t".join(r) for r in SHOP_DAY_RESULT]


@pytest.mark.parametrize("order,timeout", [("file", None), ("time", 21600)])
def test_running_totals_merge_equals_batch(spark, workdir, order, timeout):
    from touchline.errors import CheckpointError
    from touchline.streaming.runner import merge_totals, read_totals

    inbox = os.path.join(workdir, "inbox")
    for p in _split_events(os.path.join(workdir, "parts"), 4):
        _stage(p, inbox)
    totals = os.path.join(workdir, "totals")
    opts = AttributionOptions(order=order, session_timeout=timeout)
    with pytest.raises(CheckpointError):
        read_totals(spark, totals)
    q = (
        stream_last_touch(events_stream(spark, inbox, max_files=1), opts)
        .writeStream.foreachBatch(merge_totals(totals, opts))
        .option("checkpointLocation", os.path.join(workdir, "chk"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert q.exception() is None
    versions = sorted(int(v.split("=")[1]) for v in os.listdir(totals) if v.startswith("v="))
    assert versions == [2, 3]  # the ones before are removed
    got = read_totals(spark, totals).drop("keyword_lower")
    # micro-batches arrive in order, so the batch report of the stream's own
    # output is the same
    out = stream_last_touch(events_stream(spark, inbox, max_files=1), opts)
    q = run_to_parquet(out, os.path.join(workdir, "again"))
    q.awaitTermination()
    again = keyword_revenue(as_attributed(spark.read.parquet(os.path.join(workdir, "again", "out"))), opts)
    assert _rows(got) == _rows(again.drop("keyword_lower"))
    if order == "file":
        assert _rows(got) == _rows(batch_keyword_revenue(spark, SF001))
    lost = spark.read.parquet(os.path.join(workdir, "again", "out"))
    with pytest.raises(CheckpointError):
        merge_totals(os.path.join(workdir, "none"), opts)(lost, 4)


def _hits(rows):
    """Streamed rows of one visitor: (seq, time, keyword or None, revenue or None)."""
    import decimal

    import pandas as pd

    return pd.DataFrame(
        {
            "ip": "1.1.1.1",
            "user_agent": "u",
            "seq": [r[0] for r in rows],
            "hit_time": [r[1] for r in rows],
            "is_purchase": [r[3] is not None for r in rows],
            "revenue": [None if r[3] is None else decimal.Decimal(r[3]) for r in rows],
            "own_domain": [None if r[2] is None else "google.com" for r in rows],
            "own_keyword": [r[2] for r in rows],
        }
    )


class _Value:
    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


class _Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, name, schema):
        return _Value()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def _processor(**kw):
    from touchline.streaming.stateful import LastTouchProcessor

    processor, handle = LastTouchProcessor(**kw), _Handle()
    processor.init(handle)
    return processor, handle


@pytest.mark.parametrize("order", ["file", "time"])
def test_fold_over_chunks_and_batches_equals_a_plain_fold(order):
    import random

    rng = random.Random(4)
    for timeout in (None, 5):
        rows = [(i, 100 + i * 2 + rng.choice([0, 0, 3, 9, -2]), rng.choice([None, None, "a", "b"]), rng.choice([None, "1.5"])) for i in range(300)]
        processor, _ = _processor(session_timeout=timeout, order=order, emit_all=True)
        got, want, touch, before = [], [], None, None
        for a, b in ((0, 1), (1, 120), (120, 300)):
            batch = rows[a:b]
            mixed = rng.sample(batch, len(batch))
            chunks = [_hits(mixed[i : i + 7]) for i in range(0, len(mixed), 7)]
            for out in processor.handleInputRows(("1.1.1.1", "u"), iter(chunks), None):
                got += [(r.seq, r.live_keyword or None, r.new_session) for r in out.itertuples()]
            for seq, t, keyword, _ in sorted(batch, key=lambda r: (r[1], r[0]) if order == "time" else r[0]):
                fresh = timeout is not None and before is not None and t - before > timeout
                touch = keyword or (None if fresh else touch)
                before = t
                want.append((seq, touch, fresh))
        assert got == want


def test_hot_visitor_of_a_batch_is_folded_in_little_memory():
    """Two million hits of one visitor: as frames of texts they'd be some 1.5 GB."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    n, step = 2_000_000, 50_000

    def chunks():
        for at in range(0, n, step):
            seq = np.arange(at, at + step)
            keyword = np.where(seq % 1000 == 0, "tent pegs", None)
            yield pd.DataFrame({"ip": "1.1.1.1", "user_agent": "a long agent " * 20, "seq": seq, "hit_time": 1_700_000_000 + seq, "is_purchase": seq % 100_000 == 99_999, "revenue": None, "own_domain": np.where(keyword == "tent pegs", "google.com", None), "own_keyword": keyword})

    processor, _ = _processor(session_timeout=1800, order="file")
    tracemalloc.start()
    found = sum(len(out) for out in processor.handleInputRows(("1.1.1.1", "u"), chunks(), None))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 2000 + 20 and processor.touch.get() == ("google.com", "tent pegs")
    assert peak < 300 << 20


def test_idle_visitor_is_forgotten_by_its_timer():
    processor, handle = _processor(session_timeout=10, order="file", idle_limit=60)
    list(processor.handleInputRows(("1.1.1.1", "u"), iter([_hits([(1, 100, "a", None)])]), None))
    assert handle.timers == {160_000}
    list(processor.handleInputRows(("1.1.1.1", "u"), iter([_hits([(2, 105, None, None)])]), None))
    assert handle.timers == {165_000} and processor.touch.exists()
    list(processor.handleInputRows(("1.1.1.1", "u"), iter([_hits([(3, 0, None, None)])]), None))
    assert handle.timers == set()  # a last hit without a time has no timer
    assert list(processor.handleExpiredTimer("k", None, None)) == []
    assert not processor.touch.exists() and not processor.last_time.exists()


def test_state_of_idle_visitors_is_freed_and_results_stay(spark, workdir):
    """State rows in the store, and credits with and without freeing."""
    from pyspark.sql import functions as F

    from touchline.streaming.runner import known_visitors, live_touches

    inbox = os.path.join(workdir, "inbox")
    for p in _split_events(os.path.join(workdir, "parts"), 6):
        _stage(p, inbox)
    opts = AttributionOptions(session_timeout=3600)
    seen = {}
    for name, limit in (("kept", None), ("freed", 7200)):
        root = os.path.join(workdir, name)
        q = run_to_parquet(stream_last_touch(events_stream(spark, inbox, max_files=1), opts, idle_limit=limit, max_delay=0), root)
        q.awaitTermination()
        assert q.exception() is None
        seen[name] = (spark.read.parquet(f"{root}/out"), known_visitors(spark, f"{root}/chk"), live_touches(spark, f"{root}/chk"))
    (kept, all_known, _), (freed, few_known, _) = seen["kept"], seen["freed"]
    same = ["ip", "user_agent", "seq", "revenue", "live_domain", "live_keyword"]
    assert kept.count() == freed.count() and kept.select(same).exceptAll(freed.select(same)).isEmpty()
    latest = all_known.agg(F.max("last_time")).first()[0]
    assert all_known.count() > few_known.count()
    # all that is left was seen less than the limit before the last watermark
    assert few_known.agg(F.min("last_time")).first()[0] > latest - 2 * 7200 - 86400


def test_idle_limit_needs_a_timeout(spark, workdir):
    for p in _split_events(os.path.join(workdir, "parts"), 1):
        _stage(p, os.path.join(workdir, "inbox"))
    hits = events_stream(spark, os.path.join(workdir, "inbox"))
    for timeout, limit in ((None, 60), (60, 59)):
        with pytest.raises(ValueError):
            stream_last_touch(hits, AttributionOptions(session_timeout=timeout), idle_limit=limit)


def test_live_touches_of_a_stopped_stream_equal_the_batch(spark, workdir):
    from touchline.plans.attribution import attribute
    from touchline.sources.events import hits_from_events
    from touchline.streaming.runner import live_touches

    inbox = os.path.join(workdir, "inbox")
    for p in _split_events(os.path.join(workdir, "parts"), 3):
        _stage(p, inbox)
    for timeout in (None, 21600):
        opts = AttributionOptions(session_timeout=timeout)
        root = os.path.join(workdir, f"s{timeout}")
        q = run_to_parquet(stream_last_touch(events_stream(spark, inbox, max_files=1), opts), root)
        q.awaitTermination()
        want = attribute(hits_from_events(spark, SF001), opts).run_counts.first()["visitors_with_live_touch"]
        got = live_touches(spark, f"{root}/chk")
        assert got.count() == got.select("ip", "user_agent").distinct().count() == want > 0


def test_counters_outlive_the_query_and_a_restart(spark, workdir):
    import time

    from touchline.streaming.runner import CounterTable, read_counters

    parts = _split_events(os.path.join(workdir, "parts"), 4)
    inbox, root, path = (os.path.join(workdir, x) for x in ("inbox", "s", "counters"))
    table = CounterTable(spark, path, "kept")
    spark.streams.addListener(table)
    try:
        for wanted, files in ((2, parts[:2]), (4, parts[2:])):
            for p in files:
                _stage(p, inbox)
            q = run_to_parquet(stream_last_touch(events_stream(spark, inbox, max_files=1), metrics_name="kept"), root)
            q.awaitTermination()
            for _ in range(120):  # the listener hears of a batch some time after it
                time.sleep(0.5)
                if os.path.isdir(path) and [r.batches for r in read_counters(spark, path).collect()] == [wanted]:
                    break
    finally:
        spark.streams.removeListener(table)
    [row] = read_counters(spark, path).collect()
    assert (row.batches, row.rows_processed, row.total_purchase_events) == (4, 1000, 202)


@pytest.mark.parametrize("order", ["file", "time"])
def test_chained_totals_equal_batch_over_a_restart(spark, workdir, order):
    from touchline.streaming.runner import read_changes, stream_chained_totals, totals_report

    parts = _split_events(os.path.join(workdir, "parts"), 3)
    inbox, root = os.path.join(workdir, "inbox"), os.path.join(workdir, "chained")
    opts = AttributionOptions(session_timeout=21600, order=order)
    for batch in (parts[:2], parts[2:]):
        for p in batch:
            _stage(p, inbox)
        got = stream_chained_totals(spark, inbox, opts, root=root)
    assert _rows(got) == _rows(batch_keyword_revenue(spark, SF001, session_timeout=21600, order=order))
    # three batches, and update mode brings only the groups that a batch changed
    changes = spark.read.parquet(f"{root}/changes")
    assert changes.select("batch").distinct().count() == 3
    assert changes.groupBy("batch", "search_engine_domain", "keyword_lower").count().where("count > 1").isEmpty()
    assert _rows(totals_report(read_changes(spark, f"{root}/changes"))) == _rows(got)


def test_hit_file_stream_keeps_state_between_files(spark, workdir):
    from tests.hits import hit, write_tsv
    from touchline.streaming.runner import land_hit_files, stream_hit_files

    inbox, root = os.path.join(workdir, "in"), os.path.join(workdir, "root")
    os.makedirs(inbox)
    assert stream_hit_files(spark, inbox, root).count() == 0
    search = hit(1_700_000_000, "172.16.9.1", "Phone 9", "", "", "http://www.bing.com/search?q=Tent+Pegs")
    write_tsv([search], inbox, "day 1+%25.tsv")
    assert stream_hit_files(spark, inbox, root).where("is_purchase").count() == 0
    # the purchase comes in a later file, whose columns stand in another order
    buy = hit(1_700_000_090, "172.16.9.1", "Phone 9", "1", "E;Z;1;9;")
    names = ["referrer", "product_list", "event_list", "user_agent", "ip", "hit_time_gmt"]
    write_tsv([buy], inbox, "day 2.tsv", fields=names)
    rows = stream_hit_files(spark, inbox, root)
    bought = rows.where("is_purchase").collect()
    assert [(r.live_domain, r.live_keyword, r.seq_file) for r in bought] == [("bing.com", "Tent Pegs", 1)]
    # nothing new: nothing is landed, also not a landed file that is written anew
    write_tsv([buy, buy], inbox, "day 2.tsv", fields=names)
    assert land_hit_files(spark, inbox, root) == 0
    assert stream_hit_files(spark, inbox, root).count() == 2
    # what a call landed and did not get to is streamed by the next
    write_tsv([buy], inbox, "day 3.tsv")
    assert land_hit_files(spark, inbox, root) == 1
    assert stream_hit_files(spark, inbox, root).where("is_purchase").count() == 2


def test_hit_file_stream_equals_batch(spark, workdir):
    from touchline.plans.attribution import attribute_files
    from touchline.sources.events import hits_from_events
    from touchline.sources.hits import HIT_COLUMNS
    from touchline.streaming.runner import stream_hit_files

    rows = [[r[c] for c in HIT_COLUMNS] for r in hits_from_events(spark, SF001).orderBy("seq").limit(300).collect()]
    inbox = os.path.join(workdir, "in")
    os.makedirs(inbox)
    for i in range(5):
        with open(os.path.join(inbox, f"{i}.tsv"), "w") as out:
            out.write("\n".join("\t".join(r) for r in [HIT_COLUMNS, *rows[60 * i : 60 * i + 60]]) + "\n")
    opts = AttributionOptions(session_timeout=21600)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = stream_hit_files(spark, inbox, os.path.join(workdir, "root"), opts, max_files=2, by_name=True)
        want = attribute_files(spark, inbox, opts).results.drop("keyword_lower")
        assert _rows(keyword_revenue(as_attributed(got), opts).drop("keyword_lower")) == _rows(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_landed_hits_are_spread(spark, workdir, monkeypatch):
    """Landing shuffles no hits and splits a long file, so that the stream parses
    it in many tasks; the arrival order and the credits stay."""
    from tests.hits import hit, write_tsv
    from touchline.streaming import runner

    inbox = os.path.join(workdir, "in")
    os.makedirs(inbox)
    rows = [hit(1_700_000_000 + i, f"172.16.9.{i % 2}", "Phone", "", "", f"http://www.bing.com/search?q=k{i}") for i in range(20)]
    rows += [hit(1_700_000_100 + i, f"172.16.9.{i}", "Phone", "1", "E;Z;1;9;") for i in range(2)]
    write_tsv(rows, inbox, "day.tsv")
    monkeypatch.setattr(runner, "LANDED_HITS", 3)
    root = os.path.join(workdir, "root")
    got = runner.stream_hit_files(spark, inbox, root, AttributionOptions(session_timeout=1800)).where("is_purchase").collect()
    assert sorted((r.ip, r.live_keyword) for r in got) == [("172.16.9.0", "k18"), ("172.16.9.1", "k19")]
    landed = spark.read.parquet(f"{root}/hits")
    assert landed.count() == 22
    sizes = [pq.read_metadata(f.removeprefix("file:").replace("///", "/")).num_rows for f in landed.inputFiles()]
    assert max(sizes) <= 3 and len(sizes) >= 8
