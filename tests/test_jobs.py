"""Listings, reference data, news, streams, readers and writers on small hand-made inputs."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from barloom.operators import dedupe, extract, listings, news, reference
from barloom.plans import snapshot
from barloom.schemas import BARS
from barloom.sources import linktable, sinks, store, tables
from barloom.streaming import jobs

D = dt.date(2026, 3, 2)


def codes(df, col="id"):
    return sorted(r[col] for r in df.collect())


def test_target_day_stops_at_the_first_older_row(spark):
    days = [3, 2, 2, 3, 1, 2, 2]  # reading order; 2 is the target
    df = spark.createDataFrame([(k, 0, k, dt.date(2026, 3, d)) for k, d in enumerate(days)], "id int, page int, row int, d date")
    target = F.lit("2026-03-02").cast("date")
    assert codes(listings.target_day(df, F.col("d"), target, ["page", "row"])) == [1, 2]
    no_older = df.filter("id <> 4")
    assert codes(listings.target_day(no_older, F.col("d"), target, ["page", "row"])) == [1, 2, 5, 6]


def test_target_day_per_listing_and_undated(spark):
    rows = [(1, "a", 0, D), (2, "a", 1, D - dt.timedelta(days=1)), (3, "a", 2, D), (4, "b", 0, D), (5, "b", 1, None), (6, "c", 0, D - dt.timedelta(days=1))]
    df = spark.createDataFrame(rows, "id int, list string, row int, d date")
    target = F.lit(str(D)).cast("date")
    assert codes(listings.target_day(df, F.col("d"), target, ["row"], ["list"])) == [1, 4]
    assert codes(listings.target_day(df, F.col("d"), target, ["row"], ["list"], keep_undated=True)) == [1, 4, 5]


def test_gate(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert listings.gated(df, F.lit("a"), F.lit("b")).count() == 0
    assert listings.gated(df, F.lit("a"), F.lit("b"), force=True).count() == 1


def test_keyword_counts_in_list_order(spark):
    df = spark.createDataFrame([("減益",), ("最高益",), ("減益",), ("ー",)], "class string")
    got = [(r["label"], r["count"]) for r in listings.keyword_counts(df).orderBy("position").collect()]
    assert got == [("最高益", 1), ("減益", 2), ("その他", 1)]


def test_keyword_hits_ignore_blanks(spark):
    df = spark.createDataFrame([(1, "清原　達郎が", "u"), (2, "清原達郎", "u"), (3, "五味大輔", ""), (4, "他", "v")], "id int, title string, url string")
    assert codes(listings.keyword_hits(df, ("清原 達郎", "五味 大輔", " "), ["id"])) == [1]


def test_labelled_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([("x", 1)], "code string, p int"), spark.createDataFrame([("y",)], "code string")
    got = listings.labelled_union({"A": a, "B": b}).orderBy("list_rank").collect()
    assert [(r["list"], r["code"], r["p"]) for r in got] == [("A", "x", 1), ("B", "y", None)]


def test_snapshot_lists(spark):
    def hist(code, closes, volume=10.0):
        return [(code, D - dt.timedelta(days=len(closes) - 1 - k), *[float(c)] * 4, volume) for k, c in enumerate(closes)]

    rows = hist("up", [100, 110, 121]) + hist("down", [100, 90, 81]) + hist("cheap", [50, 50, 50], 1e9) + hist("old", [5, 6])[:1]
    got = snapshot.snapshot(spark.createDataFrame(rows, BARS), F.lit(str(D))).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["list_rank"], r["rank"] or 0)):
        by.setdefault(r["list"], []).append(r["code"])
    assert by["出来高"] == ["up"] and by["売買代金"][0] == "cheap"
    assert by["今日の株価上昇率"] == ["up", "cheap", "down"] and by["今日の株価下落率"][0] == "down"
    assert by["本日、52週高値更新"] == ["up"] and by["本日、年初来安値更新"] == ["down"]


def test_master_rules(spark):
    df = spark.createDataFrame([(0, " a "), (1, "b"), (2, "a"), (3, " "), (4, "c"), (5, None)], "row_idx long, code string")
    assert codes(reference.until_blank(df), "row_idx") == [0, 1, 2]
    assert codes(reference.until_blank(df.filter("row_idx < 3")), "row_idx") == [0, 1, 2]
    assert codes(reference.without_blanks(df), "row_idx") == [0, 1, 2, 4]
    got = reference.distinct_in_order(reference.without_blanks(df)).orderBy("row_idx").collect()
    assert [r["code"] for r in got] == ["a", "b", "c"]


def test_wide_master_last_row_wins(spark):
    df = spark.createDataFrame([("x", "d", "1", 0), ("y", "d", "2", 1), ("x", "d", "3", 2), ("", "d", "4", 3)], ["証券コード", "更新日", "v", "row_idx"])
    got = {r["code"]: r["v"] for r in reference.wide_master(df).collect()}
    assert got == {"x": "3", "y": "2"}


def test_price_rows_today_first_and_bad_rows_dropped(spark):
    def tr(day, *cells):
        return f'<tr><th>{day}</th>' + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"

    html = (
        '<table class="stock_kabuka0 w"><tbody>' + tr('<time datetime="2026-03-02">x</time>', "1,000", "２", "1", "1.5", "a", "b", "3,000") + tr("ignored", *"1234567") + "</tbody></table>"
        '<table class="stock_kabuka_dwm"><TBODY>' + tr("26/03/01", "1", "－", "1", "1", "", "", "5") + tr("26/02/28", "1", "2") + tr("n/a", *"1234567") + "</TBODY></table>"
    )
    got = extract.price_rows(spark.createDataFrame([("c", html)], "code string, html string")).orderBy("row").collect()
    assert [(r["part"], str(r["asof_date"]), r["open"], r["high"], r["volume"]) for r in got] == [
        (0, "2026-03-02", 1000.0, 2.0, 3000.0), (1, "2026-03-01", 1.0, None, 5.0)
    ]


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("m", 5, "c")], "key string, o int, v string")
    assert codes(dedupe.first_wins(df, ["key"], ["o"]), "v") == ["a", "c"]
    assert codes(dedupe.last_wins(df, ["key"], ["o"]), "v") == ["b", "c"]


def test_news_order_history_and_age(spark):
    now = F.lit("2026-03-10 00:00:00").cast("timestamp")
    rows = [("u1", 2, "2026-03-09 00:00:00"), ("u1", 1, "2026-03-09 01:00:00"), ("u2", 1, "2026-03-01 00:00:00"), ("u3", 1, None), ("u4", 1, "2026-03-09 00:00:00"), ("u5", 1, "2026-03-02 00:00:00")]
    df = spark.createDataFrame(rows, "url string, rank int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    history = spark.createDataFrame([(" u4 ",), ("",)], "url string")
    got = news.merge_news(news.fresh_enough(df, now), history, ["rank"])
    assert sorted((r["url"], r["rank"]) for r in got.collect()) == [("u1", 1), ("u5", 1)]


def test_news_times(spark):
    run = F.lit("2026-03-10 12:34:56").cast("timestamp_ntz")
    df = spark.createDataFrame([("2026/03/01",)], "time_text string")

    def at(text, style):
        d = news.timed(df.withColumn("time_text", F.lit(text)), run, style)
        return d.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("y")).collect()[0]["y"]

    assert at("2026/03/01", "day") == "2026-03-01 12:34:56"
    assert at("", "run") == "2026-03-10 12:34:56"
    assert at("03/11 01:00", "inferred") == "2025-03-11 01:00:00"
    assert at("2026-03-09T20:00:00Z", "iso") == "2026-03-10 05:00:00"


def _write_batches(spark, path, batches):
    schema = "url string, source_rank int, title string, ts timestamp"
    for rows in batches:
        typed = [(u, k, t, dt.datetime.fromisoformat(s) if s else None) for u, k, t, s in rows]
        spark.createDataFrame(typed, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.createDataFrame([], schema).schema


def test_news_stream_equals_batches(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    first = [("a", 2, "A2", "2026-03-01T00:00:00"), ("a", 1, "A1", "2026-03-01T00:00:00"), ("b", 1, "B", "2026-03-01T00:00:00"), (" ", 1, "x", "2026-03-01T00:00:00")]
    schema = _write_batches(spark, src, [first])

    def run(ckpt=ckpt):
        jobs.news_to_table(jobs.file_stream(spark, src, schema, 1), out, ckpt, ["source_rank"]).awaitTermination()
        return sorted((r["url"], r["title"]) for r in linktable.read(spark, out).collect())

    assert run() == [("a", "A1"), ("b", "B")]
    # A month later the link is still known, because the table itself is the memory; the first batch wins, though a better source came later.
    _write_batches(spark, src, [[("a", 0, "A0", "2026-04-01T00:00:00"), (" c ", 1, "C", "2026-04-01T00:00:00"), ("d", 1, "D", None)]])
    assert run() == [("a", "A1"), ("b", "B"), ("c", "C")]
    assert run() == [("a", "A1"), ("b", "B"), ("c", "C")]
    assert run(str(tmp_path / "another")) == [("a", "A1"), ("b", "B"), ("c", "C")]


def test_link_table_reads_touched_buckets_and_does_not_grow_files(spark, tmp_path):
    path = str(tmp_path / "links")

    def rows(names):
        return spark.createDataFrame([(n, n.upper()) for n in names], "url string, title string")

    for k in range(20):
        linktable.add(spark, path, rows([f"u{k}-{x}" for x in range(30)] + [f"u{k - 1}-{x}" for x in range(30)]), buckets=4)
        assert len(linktable.read(spark, path).inputFiles()) <= 4 * linktable.FILES
    assert codes(linktable.read(spark, path), "url") == sorted(f"u{k}-{x}" for k in range(-1, 20) for x in range(30))
    plan = linktable.unseen(rows(["a"]).withColumn("bucket", linktable.bucket_of("url", 4)), linktable.read(spark, path), [2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan.replace("bucket#", "bucket") and "= 2)" in plan and "ReadSchema: struct<url:string>" in plan


def test_a_merge_that_was_cut_off_is_done_again(spark, tmp_path):
    path, copy = str(tmp_path / "links"), str(tmp_path / "copy")
    table = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "url string, bucket int")
    table.write.parquet(copy)
    # The swap had removed bucket 0 and not yet moved its new file in.
    table.filter("bucket = 1").write.partitionBy("bucket").parquet(f"{path}/rows")
    spark.createDataFrame([(copy, [0, 1])], "copy string, buckets array<int>").write.parquet(f"{path}/_merge")
    linktable.add(spark, path, spark.createDataFrame([("a",), ("d",)], "url string"), buckets=2)
    assert codes(linktable.read(spark, path), "url") == ["a", "b", "c", "d"]
    linktable.add(spark, path, spark.createDataFrame([("e",)], "url string"), buckets=2)
    assert codes(linktable.read(spark, path), "url") == ["a", "b", "c", "d", "e"]


def test_links_in_keyed_state(spark, tmp_path):
    """Files out of order, links in several files and runs; late rows apart; a link is forgotten after its time to live."""
    src, out, late, ckpt = (str(tmp_path / n) for n in ("src", "out", "late", "ckpt"))
    done = []

    def run(day, batches):
        schema = _write_batches(spark, src, batches)
        stream = jobs.file_stream(spark, src, schema, 1)
        for query in jobs.links_to_table(stream, out, late, ckpt, dt.datetime.fromisoformat(day)):
            query.awaitTermination()
            done.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]])
        return codes(spark.read.parquet(out), "url"), sorted((r["url"], r["title"]) for r in spark.read.parquet(late).collect())

    first = [[("b", 1, "", "2026-03-09T00:00:00"), ("a", 1, "", "2026-03-10T00:00:00")], [("a", 1, "", "2026-03-03T00:00:00"), ("x", 1, "old", "2026-03-01T00:00:00")], [(" b", 2, "", "2026-03-10T00:00:00"), ("c", 1, "", "2026-03-02T12:00:00"), ("n", 1, "", None)]]
    assert run("2026-03-10T12:00:00", first) == (["a", "b", "c"], [("x", "old")])
    again = [[("a", 1, "", "2026-03-10T00:00:00"), ("d", 1, "", "2026-03-12T00:00:00"), ("x", 1, "older", "2026-02-01T00:00:00")]]
    assert run("2026-03-12T12:00:00", again) == (["a", "b", "c", "d"], [("x", "old"), ("x", "older")])
    gone = [[("a", 1, "seen before", "2026-03-10T00:00:00"), ("e", 1, "", "2026-03-29T00:00:00")]]
    assert run("2026-03-30T12:00:00", gone) == (["a", "b", "c", "d", "e"], [("a", "seen before"), ("x", "old"), ("x", "older")])
    states = [x for x in done if x]
    assert max(states[1]) == 4 and states[2][-1] == 1
    assert spark.conf.get(jobs.STATE_STORE) != jobs.ROCKSDB


def test_links_need_no_table(spark, tmp_path):
    schema = _write_batches(spark, str(tmp_path), [[("a", 1, "", "2026-03-01T00:00:00")]])
    plan = jobs.unseen_links(jobs.file_stream(spark, str(tmp_path), schema), dt.datetime(2026, 3, 2))._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark" in plan and "Join" not in plan and plan.count("StreamingRelation") == 1


def _prices(spark, *items):
    """(code, days before D, close)."""
    return spark.createDataFrame([(c, D - dt.timedelta(days=k), x, x, x, x, 1.0) for c, k, x in items], BARS)


STORED = (("diff", 1, 10.0), ("diff", 2, 9.0), ("split", 1, 20.0), ("split", 100, 21.0), ("dup", 1, 3.0), ("skip", 0, 5.0))
DAILY = (("diff", 0, 11.0), ("diff", 1, 10.0), ("split", 0, 9.0), ("split", 1, 10.0), ("new", 0, 1.0), ("new", 1, 2.0), ("dup", 0, 3.0), ("dup", 0, 4.0), ("skip", 0, 6.0), ("late", 3, 7.0))
LOADED = sorted([("diff", 10.0), ("diff", 11.0), ("diff", 9.0), ("split", 9.0), ("split", 10.0), ("new", 1.0), ("new", 2.0), ("dup", 3.0), ("skip", 5.0), ("late", 7.0)])


@pytest.mark.parametrize("cut", [1, 3, len(DAILY)])
def test_a_load_in_any_cut(spark, tmp_path, cut):
    """A code may come in any number of files, in any order: split, duplicate and difference are told from all of them."""
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "prices", "ckpt"))
    store.create(_prices(spark, *STORED), path, buckets=2)
    daily = _prices(spark, *DAILY).withColumn("seq", F.monotonically_increasing_id())
    rows = daily.collect()
    for k in reversed(range(cut)):
        spark.createDataFrame(rows[k::cut], daily.schema).coalesce(1).write.mode("append").parquet(src)
    names = spark.createDataFrame([(c,) for c in ("diff", "split", "new", "dup", "skip", "late")], "code string")
    status = jobs.bars_to_store(jobs.file_stream(spark, src, daily.schema, 1), names, path, ckpt, F.lit(str(D)), daily)
    assert sorted((r["code"], r["close"]) for r in store.read(spark, path).collect()) == LOADED
    assert {r["code"]: r["action"] for r in status.collect()} == {"diff": "DIFF", "split": "REPLACE", "new": "FULL", "dup": "ERROR", "skip": "SKIP", "late": "FULL"}
    # Nothing new: the next run loads nothing. A day later the same checkpoint takes what came since.
    jobs.bars_to_store(jobs.file_stream(spark, src, daily.schema, 1), names, path, ckpt, F.lit(str(D)), daily)
    assert sorted((r["code"], r["close"]) for r in store.read(spark, path).collect()) == LOADED
    more = _prices(spark, ("diff", -1, 12.0), ("diff", 0, 11.0)).withColumn("seq", F.lit(0).cast("long"))
    more.coalesce(1).write.mode("append").parquet(src)
    jobs.bars_to_store(jobs.file_stream(spark, src, daily.schema, 1), names, path, ckpt, F.lit("2026-03-03"), daily)
    assert sorted((r["code"], r["close"]) for r in store.read(spark, path).collect()) == sorted([*LOADED, ("diff", 12.0)])


def test_a_load_that_was_cut_off(spark, tmp_path, monkeypatch):
    """Lost after the store was written and before the run was closed, with more files coming before it goes on."""
    src, path, ckpt = (str(tmp_path / n) for n in ("src", "prices", "ckpt"))
    store.create(_prices(spark, *STORED), path, buckets=2)
    daily = _prices(spark, *DAILY).withColumn("seq", F.monotonically_increasing_id())
    rows = daily.collect()
    names = spark.createDataFrame([(c,) for c in ("diff", "split", "new", "dup", "skip", "late")], "code string")
    spark.createDataFrame(rows[:5], daily.schema).coalesce(1).write.parquet(src)
    real = store.apply_load

    def lost(*a):
        real(*a)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(store, "apply_load", lost)
    with pytest.raises(RuntimeError):
        jobs.bars_to_store(jobs.file_stream(spark, src, daily.schema, 1), names, path, ckpt, F.lit(str(D)), daily)
    monkeypatch.setattr(store, "apply_load", real)
    spark.createDataFrame(rows[5:], daily.schema).coalesce(1).write.mode("append").parquet(src)
    jobs.bars_to_store(jobs.file_stream(spark, src, daily.schema, 1), names, path, ckpt, F.lit(str(D)), daily)
    assert sorted((r["code"], r["close"]) for r in store.read(spark, path).collect()) == LOADED


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("0010", 'say "x", y', None), ("13", None, 1.5)], "code string, t string, v double")
    sinks.write_csv(df.coalesce(1), path, {"code": "証券コード"}, bom=True)
    part = next(p for p in os.listdir(path) if p.endswith(".csv"))
    with open(os.path.join(path, part), encoding="utf-8") as f:
        lines = f.read().splitlines()
    assert lines == ["﻿証券コード,t,v", '0010,"say ""x"", y",', "13,,1.5"]
    back = tables.read_sheet(spark, path, required=("証券コード",))
    assert back.columns == ["証券コード", "t", "v", "row_idx"]
    assert codes(tables.first_column(back), "code") == ["0010", "13"]
    with pytest.raises(ValueError):
        tables.read_sheet(spark, path, required=("市場・商品区分",))


def test_pages_from_files(spark, tmp_path):
    (tmp_path / "a.html").write_text("<html>\n<li>1</li></html>", encoding="utf-8")
    got = tables.read_pages(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0]["html"].startswith("<html>\n") and got[0]["url"].endswith("a.html")


def test_report_headers(spark):
    df = spark.range(1).select(F.lit(1.0).alias("beta", metadata={"number": 72, "header": "(72) β"}), F.lit("x").alias("code"))
    assert sinks.report_headers(df, {"code": "証券コード"}) == {"beta": "(72) β", "code": "証券コード"}


def test_page_quality_limits(spark):
    cell = '<td class="tac"><a href="/stock/?code=13{0:02d}">13{0:02d}</a></td>'
    full = "<html>" + "".join(cell.format(k) for k in range(50)) + "</html>"
    rows = [(1, full), (2, full.replace("</html>", "")), (3, full + "アクセスが集中"), (4, "<html></html>"), (5, full.replace(">1301<", ">1399<"))]
    got = {r["page_id"]: r for r in extract.page_quality(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert [got[k]["list_ok"] for k in range(1, 6)] == [True, False, False, False, False]
    assert got[5]["basic_ok"] and got[5]["stock_rows"] == 49 and got[5]["morning_ok"]


def test_rows_behind_the_last_time_are_not_followed_to_the_end(spark):
    """Counts as by the row patterns alone, also on a page whose many rows behind the last time each made the pattern read the rest of it."""
    row, stamped = "<tr><td>a</td></tr>", '<tr><time datetime="2002-01-01">x</time></tr>'
    odd = ["", stamped, stamped + row, f"{row}\n{stamped}{row}{stamped}", "<tr><time>x</time>", "<tr><time>x</tr><tr></time></tr>" + row, '<tr><time datetime="">x</time></tr>',
           '<tr><time datetime="a></tr><time datetime="b"></tr>' + row, f"{stamped}<time>y</time></tr>{stamped[:-5]}", None]
    pages = spark.createDataFrame(list(enumerate(odd)), "page_id int, html string")
    plain = {n: F.coalesce(F.regexp_count("html", F.lit(p)), F.lit(0)).alias(n) for n, p in (("timed_rows", extract.TIMED_ROW), ("stamped_rows", extract.STAMPED_ROW))}
    assert extract.page_quality(pages).select("page_id", *plain).orderBy("page_id").collect() == pages.select("page_id", *plain.values()).orderBy("page_id").collect()
    long = spark.createDataFrame([(1, stamped)], "page_id int, html string").withColumn("html", F.concat("html", F.repeat(F.lit(row), 60_000)))
    begin = time.time()
    got = extract.page_quality(long).first()
    assert (got.timed_rows, got.stamped_rows) == (1, 1) and time.time() - begin < 20


def test_kept_rows_are_cut_once(spark):
    """No filter with the patterns of the columns stands below them, where they would run again."""
    pages = spark.createDataFrame([(1, "")], "page_id int, html string")
    news_rule = extract.news_rule("a", "(?s)<p>(.*?)</p>", extract.HREF, extract.ANCHOR, "https://s", timed=False)
    for rows in (extract.extract(pages, extract.DISCLOSURES), extract.extract(pages, news_rule), extract.extract_all(pages, (news_rule, news_rule))):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter" not in plan and rows.count() == 0
