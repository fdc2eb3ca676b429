"""Hit-file scans (S1-S5), report and manifest sinks (S6, S7), intake."""

import datetime as dt
import json
import os

import pytest

from touchline import AttributionOptions, InputSchemaError
from touchline.plans.attribution import attribute_files
from touchline.plans.intake_run import run_pending
from touchline.plans.sinks import manifest, write_manifest, write_report
from touchline.sources.hits import read_hits
from tests.hits import SHOP_DAY, SHOP_DAY_RESULT, hit, results, write_tsv

REPORT = ["Search Engine Domain\tSearch Keyword\tRevenue", *["\t".join(r) for r in SHOP_DAY_RESULT]]


@pytest.mark.parametrize("compress", [None, "gz", "zst"])
def test_scan_plain_and_compressed(spark, workdir, compress):
    path = write_tsv(SHOP_DAY, workdir, compress=compress)
    assert results(attribute_files(spark, path)) == SHOP_DAY_RESULT


def test_quoted_fields(spark, workdir):
    rows = [hit(1, ua='Mozilla "quoted"\tagent', referrer="http://www.google.com/search?q=a"),
            hit(2, ua='Mozilla "quoted"\tagent', events="1", products="E;N;1;3;")]
    path = write_tsv(rows, workdir)
    df = read_hits(spark, path)
    assert {r.user_agent for r in df.collect()} == {'Mozilla "quoted"\tagent'}
    assert results(attribute_files(spark, path)) == [("google.com", "a", "3.00")]


def test_multi_file_order(spark, workdir):
    first = [hit(1, referrer="http://www.google.com/search?q=first")]
    second = [hit(2, referrer="http://www.bing.com/search?q=second"), hit(3, events="1", products="E;N;1;4;")]
    write_tsv(first, workdir, "a.tsv")
    write_tsv(second, workdir, "b.tsv")
    assert results(attribute_files(spark, workdir)) == [("bing.com", "second", "4.00")]


def test_split_file_keeps_order(spark, workdir):
    rows = []
    for i in range(3000):
        rows.append(hit(i, ip=f"v{i % 3}", referrer=f"http://www.google.com/search?q=k{i}"))
    rows += [hit(5000 + i, ip=f"v{i}", events="1", products="E;N;1;1;") for i in range(3)]
    path = write_tsv(rows, workdir)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = results(attribute_files(spark, path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(k for _, k, _ in got) == ["k2997", "k2998", "k2999"]


def test_schema_contract(spark, workdir):
    short = write_tsv([{"ip": "1", "user_agent": "x"}], workdir, "short.tsv", fields=["ip", "user_agent"])
    with pytest.raises(InputSchemaError, match="short.tsv: no column hit_time_gmt, event_list"):
        read_hits(spark, short)
    assert [r.referrer for r in read_hits(spark, short, validate_schema=False).collect()] == [""]
    write_tsv(SHOP_DAY, workdir, "a.tsv")
    with pytest.raises(InputSchemaError, match="short.tsv"):
        read_hits(spark, workdir)
    empty = os.path.join(workdir, "empty.tsv")
    open(empty, "w").close()
    for path in (empty, [os.path.join(workdir, "a.tsv"), empty]):
        with pytest.raises(InputSchemaError, match="empty.tsv: no header line"):
            read_hits(spark, path)
    assert read_hits(spark, empty, validate_schema=False).count() == 0
    assert read_hits(spark, workdir, validate_schema=False).count() == len(SHOP_DAY) + 1


def test_every_file_by_its_own_header(spark, workdir):
    """Other orders, other cases, more columns; names that need escaping."""
    write_tsv(SHOP_DAY[:5], workdir, "a b[1].tsv")
    turned = [{k.upper() + " ": v for k, v in r.items()} for r in SHOP_DAY[5:9]]
    write_tsv(turned, workdir, "c+%20.tsv", fields=["more", *reversed(turned[0])])
    write_tsv(SHOP_DAY[9:], workdir, "d.tsv", compress="gz", fields=["referrer", "ip", "hit_time_gmt", "product_list", "event_list", "user_agent"])
    assert results(attribute_files(spark, workdir)) == SHOP_DAY_RESULT


def test_header_case_and_spaces(spark, workdir):
    fields = ["HIT_TIME_GMT", " IP", "User_Agent", "event_list", "product_list", "referrer"]
    rows = [{"HIT_TIME_GMT": "1", " IP": "a", "User_Agent": "u", "referrer": "http://www.google.com/search?q=z"},
            {"HIT_TIME_GMT": "2", " IP": "a", "User_Agent": "u", "event_list": "1", "product_list": "E;N;1;2;"}]
    path = write_tsv(rows, workdir, fields=fields)
    assert results(attribute_files(spark, path)) == [("google.com", "z", "2.00")]


def test_report_and_manifest(spark, workdir):
    path = write_tsv(SHOP_DAY, workdir, "in.tsv")
    out = os.path.join(workdir, "out")
    r = attribute_files(spark, path)
    day = dt.date(2026, 3, 5)
    for _ in range(2):  # a second report of the day replaces the first
        report = write_report(r, out, day)
        assert report.endswith("2026-03-05_SearchKeywordPerformance.tab")
        with open(report, "rb") as fh:
            assert fh.read().decode() == "\n".join(REPORT) + "\n"
    target = write_manifest(spark, manifest(r, path), out, day, r)
    with open(target) as fh:
        loaded = json.load(fh)
    assert loaded["schema_version"] == "v1" and loaded["rows_processed"] == 14
    assert loaded["keyword_groups"] == 3 and loaded["total_attributed_revenue"] == "97.95"
    assert loaded["data_quality"]["total_revenue_attributed"] == "97.95" and loaded["data_quality"]["bad_timestamps"] == 0
    with open(os.path.join(out, loaded["results_summary"])) as fh:
        assert [tuple(json.loads(line).values()) for line in fh] == SHOP_DAY_RESULT


def test_report_layouts_replace_each_other(spark, workdir):
    """The layout is what was asked for, whatever the number of results."""
    import glob

    g = "http://www.google.com/search?q="
    rows = []
    for i in range(60):
        rows += [hit(2 * i, ip=f"v{i}", referrer=g + f"k{i:02d}"), hit(2 * i + 1, ip=f"v{i}", events="1", products=f"E;N;1;{(i * 37) % 11 + 1};")]
    many = attribute_files(spark, write_tsv(rows, workdir, "many.tsv"))
    few = attribute_files(spark, write_tsv(SHOP_DAY, workdir, "few.tsv"))
    out, day = os.path.join(workdir, "out"), dt.date(2026, 1, 2)
    whole = []
    for result, layout in ((many, "file"), (many, "folder"), (few, "folder"), (few, "file"), (many, "file")):
        target = write_report(result, out, day, layout)
        assert os.path.isdir(target) == (layout == "folder")
        lines = []
        for part in sorted(glob.glob(f"{target}/part-*")) if layout == "folder" else [target]:
            with open(part) as fh:
                lines += [x for x in fh.read().splitlines() if not x.startswith("Search Engine")]
        if result is many:
            whole.append(lines)
        else:
            assert lines == REPORT[1:]
    assert whole[0] == whole[1] == whole[2] and len(whole[0]) == 60
    assert whole[0] == sorted(whole[0], key=lambda x: (-float(x.split("\t")[2]), x))
    assert [f for f in os.listdir(out) if not f.startswith(".")] == ["2026-01-02_SearchKeywordPerformance.tab"]
    with pytest.raises(ValueError):
        write_report(few, out, day, "heap")


def test_intake_idempotent(spark, workdir):
    inbox = os.path.join(workdir, "in")
    os.makedirs(inbox)
    write_tsv(SHOP_DAY, inbox, "day[1].tsv")
    out, ledger = os.path.join(workdir, "out"), os.path.join(workdir, "ledger")
    first = run_pending(spark, inbox, out, ledger, run_date=dt.date(2026, 3, 5))
    assert first["keyword_groups"] == 3
    assert run_pending(spark, inbox, out, ledger) is None
    # changed content: processed again
    write_tsv(SHOP_DAY[:2] + [hit(1_700_000_020, "172.16.3.3", "Phone 2", "1", "C;P;1;5;")], inbox, "day[1].tsv")
    os.utime(os.path.join(inbox, "day[1].tsv"), (1, 1))
    again = run_pending(spark, inbox, out, ledger)
    assert again is not None and again["total_attributed_revenue"] == "5.00"
    assert spark.read.parquet(ledger).count() == 2


def test_intake_tells_like_names_apart(spark, workdir):
    inbox, ledger = os.path.join(workdir, "in"), os.path.join(workdir, "ledger")
    os.makedirs(inbox)
    names = ["a+b.tsv", "a b.tsv", "c%20d.tsv", "c d.tsv"]
    for n, name in enumerate(names):
        path = write_tsv(SHOP_DAY, inbox, name)
        os.utime(path, (5, 5))  # the same size and time
        doc = run_pending(spark, inbox, os.path.join(workdir, "out"), ledger)
        assert doc is not None and doc["rows_processed"] == 14, name
        assert spark.read.parquet(ledger).count() == n + 1


@pytest.mark.parametrize("timeout,order", [(None, "file"), (2000, "file"), (2000, "time"), (None, "time")])
def test_skew_split_on_files(spark, workdir, timeout, order):
    from tests.fold import fold
    from tests.test_scale import random_hits

    rows = random_hits(11, n=600, visitors=3)
    write_tsv(rows[:250], workdir, "a.tsv")
    write_tsv(rows[250:], workdir, "b.tsv")
    want, _ = fold(rows, timeout, order)
    expect = sorted((d, disp, str(rev)) for (d, _), (disp, rev) in want.items())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        for threshold in (None, 40):
            opts = AttributionOptions(session_timeout=timeout, skew_threshold=threshold, order=order,
                                      block_rows=50)
            assert sorted(results(attribute_files(spark, workdir, opts))) == expect, threshold
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_job_entry(spark, workdir):
    from touchline.__main__ import main

    path = write_tsv(SHOP_DAY, workdir, "in.tsv")
    out = os.path.join(workdir, "out")
    assert main([path, "--output-dir", out, "--session-timeout", "9000", "--metadata", "--run-date", "2026-03-05"]) == 0
    with open(os.path.join(out, "2026-03-05_SearchKeywordPerformance.tab")) as fh:
        assert fh.read().splitlines() == REPORT
    with open(os.path.join(out, "2026-03-05_SearchKeywordPerformance_metadata.json")) as fh:
        doc = json.load(fh)
    assert doc["config"]["session_timeout"] == 9000 and doc["unique_visitors"] == 3
    assert main([os.path.join(workdir, "missing.tsv"), "--output-dir", out]) == 1
    assert main([path, "--output-dir", out, "--session-timeout", "-5"]) == 2


def test_report_quoting_matches_csv_module(spark, workdir):
    import csv
    import io

    g = "http://www.google.com/search?q="
    rows = [hit(1, ip="a", referrer=g + 'say+%22hi%22'), hit(2, ip="a", events="1", products="E;N;1;3;"),
            hit(3, ip="b", referrer=g + "tab%09in"), hit(4, ip="b", events="1", products="E;N;1;2;")]
    path = write_tsv(rows, workdir, "in.tsv")
    report = write_report(attribute_files(spark, path), os.path.join(workdir, "out"), dt.date(2026, 1, 2))
    buf = io.StringIO()
    w = csv.writer(buf, delimiter="\t", lineterminator="\n")
    w.writerow(["Search Engine Domain", "Search Keyword", "Revenue"])
    w.writerow(["google.com", 'say "hi"', "3.00"])
    w.writerow(["google.com", "tab\tin", "2.00"])
    with open(report, encoding="utf-8", newline="") as fh:
        assert fh.read() == buf.getvalue()


@pytest.mark.parametrize("compress", [None, "gz"])
def test_hot_visitor_in_files(spark, workdir, compress):
    """A visitor hot in a few files only, and within one unsplittable file."""
    from tests.fold import fold
    from touchline.operators.touch import block_number, heavy_visitors

    rows_all = []
    for i in range(6):
        rows = [hit(i * 1000 + j, ip="hot" if i in (1, 4) and j % 9 else f"v{i}-{j}", referrer=f"http://www.google.com/search?q=k{j % 4}" if j % 5 == 0 else "",
                    events="1" if j % 7 == 0 else "", products="E;N;1;2;" if j % 7 == 0 else "")
                for j in range(600)]
        write_tsv(rows, workdir, f"f{i}.tsv", compress)
        rows_all += rows
    opts = AttributionOptions(skew_threshold=300, block_rows=100)
    r = attribute_files(spark, workdir, opts)
    want, _ = fold(rows_all)
    assert sorted(results(r)) == sorted((d, disp, str(rev)) for (d, _), (disp, rev) in want.items())
    hits = r.normalized.select("seq", "ip", "user_agent", "hit_time")
    heavy = heavy_visitors(hits, opts)
    assert [x.ip for x in heavy.collect()] == ["hot"]
    blocks = hits.join(heavy, ["ip", "user_agent"]).groupBy(block_number(hits, opts, "_bounds").alias("b")).count().collect()
    assert len(blocks) > 5 and max(b["count"] for b in blocks) < 200


def test_first_seen_display_on_files(spark, workdir):
    from touchline.operators.aggregate import first_seen_display
    from touchline.operators.classify import search_hits

    g = "http://www.google.com/search?q="
    write_tsv([hit(5, ip="a", referrer=g + "IPOD"), hit(6, ip="b", referrer=g + "ipod")], workdir, "a.tsv")
    write_tsv([hit(1, ip="c", referrer=g + "Ipod"), hit(2, ip="d", referrer=g + "tv")], workdir, "b.tsv")
    r = attribute_files(spark, workdir)
    got = {(x.search_engine_domain, x.keyword_lower): x.search_keyword
           for x in first_seen_display(search_hits(r.prepared), r.options).collect()}
    assert got == {("google.com", "ipod"): "IPOD", ("google.com", "tv"): "tv"}


def test_partitioned_results_in_order(spark, workdir):
    import glob

    import pyarrow.parquet as pq

    from touchline.plans.sinks import write_results_partitioned

    g = "http://www.google.com/search?q="
    rows = []
    for i in range(40):
        rows += [hit(2 * i, ip=f"v{i}", referrer=g + f"k{i}"),
                 hit(2 * i + 1, ip=f"v{i}", events="1", products=f"E;N;1;{(i * 37) % 11 + 1};")]
    r = attribute_files(spark, write_tsv(rows, workdir, "in.tsv"))
    out = write_results_partitioned(r, os.path.join(workdir, "parts"), partitions=4)
    parts = sorted(glob.glob(os.path.join(out, "part-*.parquet")))
    assert len(parts) > 1
    got = []
    for p in parts:
        t = pq.read_table(p).to_pylist()
        got += [(x["revenue"], x["search_engine_domain"], x["keyword_lower"]) for x in t]
    assert len(got) == 40
    assert got == sorted(got, key=lambda x: (-x[0], x[1], x[2]))


def test_headers_of_files_that_share_a_task(spark, workdir, monkeypatch):
    """Where a session packs files into tasks in spite of the settings, every
    file still answers with its own header."""
    from touchline.sources import hits

    names = [["ip", f"c{i}"] for i in range(30)]
    for i, columns in enumerate(names):
        with open(os.path.join(workdir, f"{i:02}%.tsv"), "w") as out:
            out.write("\t".join(columns) + "\n" + "1\t2\n" * (i % 4))
    open(os.path.join(workdir, "99.tsv"), "w").close()
    want = [*names, []]
    assert [c for _, c in sorted(hits.file_headers(spark, [workdir]).items())] == want
    packing = hits._placed_lines
    monkeypatch.setattr(hits, "_placed_lines", lambda _, paths: packing(spark, paths).coalesce(2))
    assert [c for _, c in sorted(hits.file_headers(spark, [workdir]).items())] == want
