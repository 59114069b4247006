import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from presslake.operators import audit, guards, merge
from presslake.sources import channel, feeds
from presslake.streaming import live


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_merge_candidates(spark):
    c = spark.createDataFrame([("u", 2, "B", None, "x2", ["b"]), ("u", 1, "", 7, "x1", ["a", "b"]), ("v", 3, None, None, "", None)], "k string, seq int, title string, id int, url string, labels array<string>")
    m = merge.merge_candidates(c, ["k"], "seq", ["title"], ["id"], ["url"], ["labels"])
    assert rows(m, "k", "title", "id", "url", "n_merged") == [("u", "B", 7, "x2", 2), ("v", "", None, "", 1)]
    assert {r.k: r.labels for r in m.collect()}["u"] == ["a", "b"]
    assert merge.merge_candidates(c.limit(0), ["k"], "seq", ["title"], ["id"], ["url"], ["labels"]).count() == 0


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1, "old"), ("b", 1, "b")], "k string, o int, v string")
    delta = spark.createDataFrame([("a", 2, "new"), ("a", 3, "newer"), ("c", 1, "c")], "k string, o int, v string")
    assert rows(merge.upsert(base, delta, ["k"], ["o"])) == [("a", 3, "newer", "updated"), ("b", 1, "b", "unchanged"), ("c", 1, "c", "inserted")]
    assert rows(merge.upsert(base, delta, ["k"], ["o"], ["v"]), "k", "v")[0] == ("a", "old")
    assert rows(merge.insert_missing(base, delta, ["k"]), "k") == [("c",)]


def test_streaks_and_signatures(spark):
    d = spark.createDataFrame([("s", i, f) for i, f in enumerate([False, True, False, False, True, False])], "s string, o int, f boolean")
    assert [r[1] for r in rows(merge.empty_streaks(d, "s", "o", F.col("f")), "o", "streak")] == [1, 0, 1, 2, 0, 1]
    p = spark.createDataFrame([("s", 1, "x"), ("s", 2, ""), ("s", 3, "x"), ("s", 4, "y")], "s string, p int, sig string")
    assert [r[1] for r in rows(merge.repeated_signatures(p, "s", "p", "sig"), "p", "repeated")] == [False, False, True, False]


def test_audit(spark):
    live_, stored = spark.createDataFrame([("s", "1"), ("s", "2"), ("s", "2")], "k string, i string"), spark.createDataFrame([("s", "2"), ("t", "9")], "k string, i string")
    found = audit.audit(live_, stored, ["k", "i"])
    assert rows(found) == [("s", "1", "missing_in_db"), ("t", "9", "extra_in_db")]
    src = spark.createDataFrame([("s",), ("t",), ("u",)], "k string")
    assert rows(audit.audit_status(found, src, "k"), "k", "status") == [("s", "fail"), ("t", "warning"), ("u", "pass")]


def test_feeds(spark, tmp_path):
    (tmp_path / "s.xml").write_text('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://a/1</loc><lastmod>2026-01-01</lastmod></url><url><loc>https://a/2</loc></url></urlset>')
    assert rows(feeds.read_sitemap(spark, str(tmp_path / "s.xml")), "loc", "lastmod") == [("https://a/1", "2026-01-01"), ("https://a/2", None)]
    (tmp_path / "f.xml").write_text('<rss><channel><item><link>l</link><title>t</title><enclosure url="i.jpg"/><pubDate>p</pubDate></item></channel></rss>')
    assert rows(feeds.read_feed(spark, str(tmp_path / "f.xml")), "link", "title", "pub_date", "image_url") == [("l", "t", "p", "i.jpg")]
    (tmp_path / "st.json").write_text(json.dumps({"page": 3}))
    (tmp_path / "bad.json").write_text("{nope")
    assert rows(feeds.read_state(spark, str(tmp_path / "st.json"))) == [("page", "3")]
    assert rows(feeds.read_state(spark, str(tmp_path / "bad.json"))) == []
    assert rows(feeds.id_window(spark, 5, 3)) == [(6,), (7,), (8,)]
    assert rows(feeds.id_window(spark, 3, 9, forward=False)) == [(1,), (2,)]


def line(i, **more):
    return json.dumps({"source_key": f"c{i % 2}", "message_id": i, "text": f"t{i}", **more}) + "\n"


@pytest.fixture
def archive(tmp_path):
    path = tmp_path / "history.jsonl"
    path.write_text("".join(line(i) for i in range(1, 11)) + "no json\n[]\n")
    return path


def test_channel_history(spark, archive):
    spark.dataSource.register(channel.ChannelHistory)
    read = lambda **o: [r.message_id for r in spark.read.format("channel_history").options(path=str(archive), **o).load().collect()]
    assert sorted(read()) == list(range(1, 11))
    for size in (1, 7, 50, 63, 64, 65, 200):  # ranges that begin anywhere in a line
        assert sorted(read(max_bytes=size)) == list(range(1, 11)), size
    assert sorted(read(min_id=3, max_id=9)) == [4, 5, 6, 7, 8, 9]
    assert read(limit=3) == [10, 9, 8] and read(limit=3, order="oldest") == [1, 2, 3] and read(limit=2, offset_id=5) == [4, 3]
    with archive.open("a") as f:
        f.write(line(1 << 50).rstrip("\n"))  # a large id, in a line that is not ended
    assert max(read()) == 1 << 50
    assert spark.read.format("channel_history").option("path", str(archive) + ".gone").load().count() == 0


def test_live_merge(spark, archive, tmp_path):
    spark.dataSource.register(channel.ChannelHistory)
    states = {"c0": "running", "c1": "paused"}
    sources = lambda: spark.createDataFrame(list(states.items()), "source_key string, desired_state string")
    target = live.KeyedTable(spark, str(tmp_path / "t"), channel.SCHEMA, ["source_key", "message_id"], 4)
    stream = spark.readStream.format("channel_history").options(path=str(archive), max_bytes=150).load()
    ids = lambda: sorted(r.message_id for r in target.read().collect())

    def drain():
        q = live.run_live(stream, sources, target, ["message_id"], ["text"], str(tmp_path / "cp"))
        q.awaitTermination()
        q.stop()

    for _ in range(2):  # a second drain finds nothing new
        drain()
        assert ids() == [2, 4, 6, 8, 10]
    states["c1"] = "running"
    with archive.open("a") as f:
        f.write(line(3) + line(4, text="edited", posted_at="later") + line(12)[:-5])  # late, delivered again, not ended
    drain()
    assert ids() == [2, 3, 4, 6, 8, 10]
    again = target.read().where("message_id = 4").first()
    assert (again.text, again.posted_at) == ("t4", "later")  # the body of the first delivery stays
    q = live.handoff(stream, sources, target, ["message_id"], ["text"], str(tmp_path / "cp"), "1 second")
    with archive.open("a") as f:
        f.write(line(12)[-5:])
    q.processAllAvailable()
    q.stop()
    assert ids() == [2, 3, 4, 6, 8, 10, 12]
    target.merge(spark.createDataFrame([("c0", 99, "x", "")], channel.SCHEMA), 0, ["message_id"], [])  # an old batch
    assert 99 not in ids()


def test_one_source_fails_alone(spark):
    sources = spark.createDataFrame([("a", "running"), ("b", "running"), ("c", "paused")], "source_key string, desired_state string")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4), (None, 5)], "source_key string, message_id int")
    seen = []

    def apply(df, key):
        if key == "a":
            raise ValueError("broken")
        seen.extend(r.message_id for r in df.collect())

    assert live.each_source(batch, sources, apply) == {"a": "ValueError: broken"} and seen == [2]
    assert [live.pages_to_scan(i) for i in (1, 9, 10, 20)] == [5, 5, 10, 10]


def test_checkpoints_of_a_stream(spark, tmp_path):
    spark.createDataFrame([("a", 5), ("a", 9), ("b", 2), ("a", 7), ("b", None)], "s string, i bigint").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("s string, i bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = live.checkpoints_of(stream, "s", "i").writeStream.format("memory").queryName("cps").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("cps").groupBy("s").max("checkpoint").collect()) == [("a", 9), ("b", 2)]


def test_windows_by_range_equal_whole_windows(spark):
    from pyspark.sql import Window

    rows_ = [(s, i, (i * 7919) % 101 if i % 3 else None, i % 5 > 1) for s in ("x", "y", None) for i in range(200)]
    df = spark.createDataFrame(rows_, "s string, o int, v int, f boolean").repartition(7)
    w = Window.partitionBy("s").orderBy("o")
    want = df.select("s", "o", F.max("v").over(w).alias("checkpoint"))
    got = merge.running_checkpoint(df, "s", ["o"], "v").select("s", "o", "checkpoint")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, merge.chunks(df, "s", ["o"], 30).select("s", "o", "chunk").collect())) == sorted(map(str, df.select("s", "o", F.floor((F.row_number().over(w) - 1) / 30).alias("chunk")).collect()))
    assert merge.running_checkpoint(df.limit(0), "s", ["o"], "v").count() == 0


def test_guards(spark):
    df = spark.createDataFrame([(1, "https://www.a.az/x", "3x", "30.11.-0001 00:00", ["Xəbərlər"], None), (2, "https://a.az/ru/x", "x", None, ["b"], "t"), (3, "https://b.az/", "", "", [], "t")], "i int, u string, slug string, day string, c array<string>, title string")
    why = guards.reasons(host=guards.at_host(F.col("u"), F.lit("a.az"), ["/ru/"]), slug=guards.no_leading_digit(F.col("slug")), day=guards.no_corrupt_date(F.col("day")), category=guards.in_categories(F.col("c"), ["xəbərlər", "xeberler"]), title=F.col("title") != "")
    valid, bad = guards.quarantine(df.withColumn("why", why), "why")
    assert valid.count() == 0 and {r.i: r.why for r in bad.collect()} == {1: ["slug", "day", "title"], 2: ["host", "category"], 3: ["host", "category"]}
    one = lambda e: spark.range(1).select(e.alias("x")).first().x
    assert one(guards.in_language(F.lit(None).cast("string"), "az")) and not one(guards.in_language(F.lit("ru"), "az"))
    assert not one(guards.no_error_page(F.lit("404 Not Found"), ["Not Found"])) and not one(guards.no_error_page(F.lit("t"), [], F.lit("a error404 b"))) and one(guards.no_banner(F.lit("card big"), ["banner"])) and not one(guards.no_banner(F.lit("card banner"), ["banner"]))
    assert one(guards.ignorable(F.lit(404), F.lit(None).cast("string"))) and one(guards.ignorable(F.lit(200), F.lit("Missing  title"))) and not one(guards.ignorable(F.lit(500), F.lit("boom")))
    assert one(guards.error_label(F.lit(None).cast("int"), F.lit("u"), F.lit("m"))) == "u: m"


def test_sitemap_pairs_by_position(spark):
    from presslake.functions import html

    xml = "<url><loc>a</loc><lastmod>1</lastmod></url><url><loc>b</loc></url><url><loc>c</loc><lastmod>3</lastmod></url>"
    assert [tuple(r) for r in spark.range(1).select(html.zipped_sitemap(F.lit(xml)).alias("x")).first().x] == [("a", "1"), ("b", "3"), ("c", None)]
    assert spark.range(1).select(html.first_image(F.array(F.lit("data:image/png,x"), F.lit(" ../i.jpg ")), F.lit("https://a.az/b/c")).alias("x")).first().x == "https://a.az/i.jpg"


def test_entry_and_oracles_name_the_same_queries():
    q, s = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(s) <= set(q)
    assert "p3_found" in q


def test_windows_and_stream_deduplication(spark, tmp_path):
    rows_ = [("2026-01-01 10:05:00", "a", "1"), ("2026-01-01 10:55:00", "a", "1"), ("2026-01-01 11:05:00", "b", "2"), ("2026-01-01 10:06:00", "a", "3")]
    spark.createDataFrame(rows_, "ts string, kind string, k string").selectExpr("cast(ts as timestamp) ts", "kind", "k").write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("ts timestamp, kind string, k string").parquet(str(tmp_path / "in"))
    for name, df, mode in (("w", live.windowed_counts(stream(), "ts", "kind", "1 hour", "1 day"), "complete"), ("d", live.deduplicated(stream(), ["k"], "ts", "1 day"), "append")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted((r.kind, r.n) for r in spark.table("w").collect()) == [("a", 3), ("b", 1)]
    assert sorted(r.k for r in spark.table("d").collect()) == ["1", "2", "3"]
