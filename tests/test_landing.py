import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from chorale import schemas
from chorale.operators import joins, landing
from chorale.operators.channels import channel_info
from chorale.operators.positions import running_position
from chorale.sources import landed, sinks
from frames import pages_frame, plan, thread, videos_frame


def test_flatten(spark):
    items = [thread("t1", 2, likes="7", total="5"), thread("t2", likes=None)]
    rows = landing.flatten_threads(pages_frame(spark, [("v", 1, items), ("v", 2, [])])).orderBy("page_no", "page_pos").collect()
    assert [r["comment_id"] for r in rows] == ["t1", "t1.0", "t1.1", "t2"]
    assert [r["is_reply"] for r in rows] == [False, True, True, False]
    assert [r["parent_id"] for r in rows] == [None, "t1", "t1", None]
    assert [r["like_count"] for r in rows] == [7, 0, 1, 0]
    assert [r["reply_count"] for r in rows] == [5, 0, 0, 0]
    assert [(r["item_pos"], r["reply_pos"]) for r in rows] == [(0, 0), (0, 1), (0, 2), (1, 0)]


def test_flatten_does_not_shuffle_and_stops_on_bad_json(spark):
    assert "Exchange" not in plan(landing.flatten_threads(pages_frame(spark, [("v", 1, [thread("t")])])))
    broken = spark.createDataFrame([("v", "@c", 1, "{not json", None)], schemas.THREAD_PAGE_RECORD)
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        landing.flatten_threads(broken).collect()


@pytest.mark.parametrize("limit", [0, 1, 4, 5, 37, 100, 10_000])
def test_limit_takes_the_first_rows_of_each_video(spark, limit):
    """One video holds most of the rows; slices of two pages put its cut into different slices."""
    rnd, pages, expected = random.Random(3), [], {}
    for video, n_pages in (("hot", 40), ("b", 3), ("c", 1)):
        for n in range(1, n_pages + 1):
            items = [thread(f"{video}-{n}-{i}", rnd.randrange(4)) for i in range(rnd.randrange(4))]
            pages.append((video, n, items))
            for item in items:
                expected.setdefault(video, []).append(item["id"])
                expected[video] += [r["id"] for r in item.get("replies", {}).get("comments", [])]
    rnd.shuffle(pages)
    got = {}
    for r in landing.limit_comments(pages_frame(spark, pages), limit, pages_per_slice=2).collect():
        got.setdefault(r["video_id"], []).append((r["page_no"], r["page_pos"], r["comment_id"]))
    kept = {v: [c for *_, c in sorted(rows)] for v, rows in got.items()}
    assert kept == {v: ids[:limit] if limit else ids for v, ids in expected.items()}


def test_limit_does_not_shuffle_texts(spark):
    df = landing.limit_comments(pages_frame(spark, [("v", 1, [thread("t", 3)])]), 2)
    assert "Exchange hashpartitioning" not in plan(df) and df.count() == 2


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_running_position_equals_row_number_on_skewed_groups(spark, depth):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), rnd.randrange(500), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    slices = [F.floor(F.col("t") / 100), F.floor(F.col("t") / 20), F.col("t")][:depth]
    got = running_position(df, ["k"], slices, [F.col("t"), F.col("i")], "p").collect()
    seen, expected = {}, {}
    for k, t, i in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        expected[i] = seen[k]
    assert {r["i"]: r["p"] for r in got} == expected


def test_newest_and_batches(spark):
    rows = [(f"v{i:04d}", "@hot" if i % 5 else "@x", "t", f"2024-01-{i % 28 + 1:02d}T0{i % 10}:00:00Z", "u") for i in range(700)]
    rows.append(("undated", "@hot", "t", None, "u"))
    df = videos_frame(spark, rows)
    order = {}
    for r in sorted(rows, key=lambda r: r[0]):
        order.setdefault(r[1], []).append(r)
    for rs in order.values():
        rs.sort(key=lambda r: hashlib.md5(r[0].encode()).hexdigest())
        rs.sort(key=lambda r: r[3] or "", reverse=True)
    expected = {r[0]: f"batch_{i // 50 + 1:04d}" for rs in order.values() for i, r in enumerate(rs)}
    assert {r["video_id"]: r["batch"] for r in landing.batch_videos(df).collect()} == expected
    newest = {r["video_id"] for r in landing.newest_videos(df, 3).collect()}
    assert newest == {r[0] for rs in order.values() for r in rs[:3]}
    assert landing.newest_videos(df, 0).count() == len(rows)
    assert landing.newest_videos(df, 4, per_channel=False).count() == 4


def test_batch_numbers_above_9999_are_not_cut(spark):
    df = videos_frame(spark, [(f"v{i:05d}", "@x", "t", "2024-01-01T00:00:00Z", "u") for i in range(10_001)])
    assert landing.batch_videos(df, size=1).filter("batch = 'batch_10001'").count() == 1


def test_outcomes(spark):
    rows = [
        (None, 3), (None, 0), (None, None), ("x commentsDisabled y", 0), ("x commentsdisabled y", 0),
        ("Owner DISABLED Comments", 5), ("quotaExceeded", 5),
    ]
    got = landing.ingest_outcomes(spark.createDataFrame(rows, "error string, n_comments int")).collect()
    assert {r["status"]: r["videos"] for r in got} == {"fetched": 1, "skipped": 4, "error": 2}


def test_video_list_reads_json_in_json_and_skips_other_files(spark, tmp_path):
    raw = json.dumps({"id": "v1", "snippet": {"title": "T", "publishedAt": "2024-01-01T00:00:00Z"}})
    rec = {"video_id": "v1", "channel_handle": "@c", "channel_id": "U", "channel_name": "C", "raw_json": raw, "ingested_at": "x"}
    (tmp_path / "run=1").mkdir()
    (tmp_path / "run=1" / "batch_0001.json").write_text(f"\n{json.dumps(rec)}\n\n   \n")
    (tmp_path / "notes.txt").write_text("no json")
    rows = landing.video_list(landed.read_video_records(spark, str(tmp_path))).collect()
    assert [(r["video_id"], r["title"], r["video_url"]) for r in rows] == [("v1", "T", "https://www.youtube.com/watch?v=v1")]
    assert landed.count_files(spark, str(tmp_path)).first()["files"] == 1
    assert landed.count_files(spark, str(tmp_path / "none")).first()["files"] == 0


def test_missing_landing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run the ingestion first"):
        landed.read_video_records(spark, str(tmp_path / "absent"))


def test_comment_records_roundtrip_with_nulls_and_a_hot_video(spark, tmp_path):
    pages = pages_frame(spark, [("hot", n, [thread(f"{n}")]) for n in range(1, 301)] + [("cold", 1, [thread("c")])])
    dim = videos_frame(spark, [(v, "@c", f"Title {v}", "2024", f"u/{v}") for v in ("hot", "cold")])
    comments = joins.attach_videos(landing.flatten_threads(pages), dim)
    # At this size adaptive execution would merge the tasks of the hot video into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_comment_records(comments, str(tmp_path / "run"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = landed.read_comment_records(spark, str(tmp_path / "run"))
    assert back.count() == 301 and back.filter("parent_id IS NULL AND NOT is_reply").count() == 301
    assert back.select("ingested_at").distinct().count() == 1
    files = [p for p in (tmp_path / "run" / "video_dir=hot").iterdir() if p.suffix == ".json"]
    assert len(files) > 1, "a hot video is written by several tasks"
    assert '"parent_id":null' in files[0].read_text()


def test_video_batches_are_files_of_fifty(spark, tmp_path):
    rows = [(f"v{i:03d}", "@a/b", "U", "C", "{}", "x", f"2024-01-01T00:{i % 60:02d}:00Z") for i in range(120)]
    df = spark.createDataFrame(rows, schemas.VIDEO_RECORD + ", published_at string")
    sinks.write_video_batches(df, str(tmp_path / "run"))
    sizes = {p.parent.name: len(p.read_text().splitlines()) for p in (tmp_path / "run").rglob("*.json")}
    assert sizes == {"batch=batch_0001": 50, "batch=batch_0002": 50, "batch=batch_0003": 20}
    assert (tmp_path / "run" / "channel_slug=a_b").is_dir()


def test_joins(spark):
    c = spark.createDataFrame([
        ("v", "p1", None, False, "A", "t", 1), ("v", "r1", "p1", True, "B", "t1", 2),
        ("v", "r2", "gone", True, "B", "t2", 3), ("w", "r3", "p1", True, "B", "t3", 4),
    ], "video_id string, comment_id string, parent_id string, is_reply boolean, author_name string, text string, like_count long")
    assert [r["reply_id"] for r in joins.replies_with_parents(c).collect()] == ["r1"]
    dim = videos_frame(spark, [("v", "@c", "old", "2024-01-01", "u"), ("v", "@c", "new", "2024-01-02", "u"), ("z", "@c", "z", None, "u")])
    one = joins.one_row_per_video(dim)
    assert sorted((r["video_id"], r["title"]) for r in one.collect()) == [("v", "new"), ("z", "z")]
    assert [r["video_id"] for r in joins.videos_without_comments(one, c).collect()] == ["z"]
    flags = joins.flag_present(one, c, "video_id", "has").collect()
    assert {r["video_id"]: r["has"] for r in flags} == {"v": True, "z": False}
    assert joins.attach_videos(c, one).count() == 3


def test_video_records_keep_unknown_fields(spark):
    page = json.dumps({"items": [{"id": "v1", "snippet": {"title": "T", "tags": ["a"]}, "player": {"x": 1}}, {"id": "v2"}]})
    pages = spark.createDataFrame([("@c", "U", "C", page)], "channel_handle string, channel_id string, channel_name string, raw_json string")
    rows = {r["video_id"]: json.loads(r["raw_json"]) for r in landing.video_records(pages).collect()}
    assert rows == {"v1": json.loads(page)["items"][0], "v2": {"id": "v2"}}


def test_unknown_channel_stops_the_job(spark):
    good = json.dumps({"items": [{"id": "U", "snippet": {"title": "C"}, "contentDetails": {"relatedPlaylists": {"uploads": "P"}}}]})
    kind = "channel_handle string, raw_json string"
    row = channel_info(spark.createDataFrame([("@c", good)], kind)).first()
    assert tuple(row) == ("@c", "U", "C", "P")
    for empty in ('{"items":[]}', "{}"):
        with pytest.raises(Exception, match="no channel found for handle @x"):
            channel_info(spark.createDataFrame([("@x", empty)], kind)).collect()


def test_hot_parent_is_split_by_the_adaptive_skew_join(spark):
    """A third of all replies answer one comment; with the sizes scaled down its partition is divided."""
    rows = [("v", f"p{i}", None, False) for i in range(200)]
    rows += [("v", f"r{i}", "p0" if i % 3 == 0 else f"p{i % 200}", True) for i in range(30_000)]
    c = spark.createDataFrame(rows, "video_id string, comment_id string, parent_id string, is_reply boolean").select(
        "*", F.lit("a").alias("author_name"), F.sha2("comment_id", 512).alias("text"), F.lit(1).alias("like_count"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = joins.replies_with_parents(c.repartition(8))
        assert joined.collect() and len(joined.collect()) == 30_000
        assert "skew=true" in plan(joined)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("limit", [3, 5, 9, 11])
def test_limit_holds_when_pages_are_landed_again(spark, limit):
    first = pages_frame(spark, [("v", 1, [thread("a", 2), thread("b", 2)]), ("v", 2, [thread("c", 2)])])
    second = pages_frame(spark, [("v", 1, [thread("new"), thread("a", 2), thread("b", 2)])]).withColumn(
        "ingested_at", F.lit("2024-01-02T00:00:00Z"))
    rows = landing.limit_comments(first.unionByName(first).unionByName(second), limit).orderBy("page_no", "page_pos").collect()
    assert [r["comment_id"] for r in rows] == ["new", "a", "a.0", "a.1", "b", "b.0", "b.1", "c", "c.0", "c.1"][:limit]


def test_page_errors(spark):
    texts = ['{"items": []}', "{not json", '{"error": {"errors": [{"reason": "commentsDisabled"}]}}', '{"error": {"message": "gone"}}',
             '{"items": 5}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(landing.page_error(F.col("t"))).collect()]
    assert got == [None, "malformed page", "commentsDisabled", "gone", "malformed page", "malformed page"]
