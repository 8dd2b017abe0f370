"""Pages as a stream, segments, and runs whose cost follows what is new."""

import json
import re

import pytest
from frames import pages_frame, plan, thread
from pyspark.sql import functions as F

from chorale.operators import landing
from chorale.plans.pipeline import Params, Run
from chorale.sources import segments
from chorale.sources.segments import FAN, Segments
from chorale.streaming import intake


def pruned(text):
    return re.search(r"PartitionFilters: \[[^\]]*bucket", text) is not None


class World:
    """Folders of landed videos and pages, and runs over them."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        (root / "videos").mkdir()
        (root / "pages").mkdir()

    def list_videos(self, name, *videos):
        rows = [{"video_id": v, "channel_handle": "@c", "raw_json": json.dumps(
            {"id": v, "snippet": {"title": title, "publishedAt": at}})} for v, title, at in videos]
        (self.root / f"videos/{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))

    def land(self, name, *pages):
        """pages: (video, number, items or raw text, landed at)."""
        rows = [{"video_id": v, "channel_handle": "@c", "page_no": n, "ingested_at": at,
                 "raw_json": items if isinstance(items, str) else json.dumps({"items": items})} for v, n, items, at in pages]
        (self.root / f"pages/{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))

    def run(self, run_id, until=None, **params):
        run = Run(self.spark, str(self.root / "videos"), str(self.root / "pages"), str(self.root / "out"), Params(run_id, **params))
        for name, step in run.steps():
            step()
            if name == until:
                break
        return run

    def rows(self, table, *columns):
        return sorted(tuple(r) for r in self.spark.read.parquet(str(self.root / f"out/{table}")).select(*columns).collect())

    def raw(self):
        return [c for c, in self.rows("raw", "comment_id")]


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


VIDEOS = [(f"v{i}", f"T{i}", f"2024-01-0{i + 1}T00:00:00Z") for i in range(4)]


def test_a_run_reads_new_files_and_the_videos_they_touch(world):
    world.list_videos("a", *VIDEOS)
    world.land("1", *[(v, 1, [thread(f"{v}-1", 1)], "t1") for v, *_ in VIDEOS])
    first = world.run(1)
    assert sum(p["numInputRows"] for p in first.page_progress) == 4
    world.land("2", ("v2", 2, [thread("v2-2")], "t2"))
    second = world.run(2)
    assert sum(p["numInputRows"] for p in second.page_progress) == 1
    assert world.rows("pending/run=2", "video_id") == [("v2",)]
    assert world.rows("flat/run=2", "comment_id") == [("v2-1",), ("v2-1.0",), ("v2-2",)]
    assert world.rows("comment_keys/seg=L0-000000000002-000000000002", "_key") == [("v2-2",)]
    assert len(world.raw()) == 9
    assert world.rows("outcomes/run=2", "video_id", "n_comments", "status") == [
        ("v0", 2, "fetched"), ("v1", 2, "fetched"), ("v2", 3, "fetched"), ("v3", 2, "fetched")]
    third = world.run(3)
    assert not sum(p["numInputRows"] for p in third.page_progress) and world.rows("pending/run=3", "video_id") == []
    assert len(world.raw()) == 9 and len(world.rows("outcomes/run=3", "video_id")) == 4


def test_one_anti_join_whatever_the_number_of_runs(world, monkeypatch):
    fan = 3
    monkeypatch.setattr(segments, "FAN", fan)
    world.list_videos("a", *VIDEOS)
    for i in range(1, fan + 4):
        world.land(str(i), ("v1", i, [thread(f"c{i}")], f"t{i}"))
        run = world.run(i, until="landing" if i == fan + 3 else None)
    text = plan(run.new_comments())
    assert text.count("LeftAnti") == 1 and pruned(text)
    keys = run._key_store()
    assert len(keys.live(run.exposed())) <= fan + 1 and keys.live(run.exposed())[0] == (1, 1, fan)
    assert len(run._page_store().live()) <= fan + 1
    assert sorted(r[0] for r in keys.read(valid=run.exposed()).select("_key").collect()) == sorted(f"c{i}" for i in range(1, fan + 4))
    world.run(fan + 4)
    assert world.raw() == sorted(f"c{i}" for i in range(1, fan + 4))


@pytest.mark.parametrize("last", ["pages", "landing", "documents", "gold"])
def test_what_a_broken_run_leaves_is_pending(world, last):
    world.list_videos("a", *VIDEOS)
    world.land("1", ("v0", 1, [thread("a")], "t1"))
    world.run(1, until=last)
    world.land("2", ("v1", 1, [thread("b")], "t2"))
    world.run(2)
    assert world.raw() == ["a", "b"]
    assert world.rows("outcomes/run=2", "video_id", "n_comments")[:2] == [("v0", 1), ("v1", 1)]
    assert len(list((world.root / "out/documents/c").glob("*.txt"))) == 2


def test_pages_that_land_between_two_attempts_of_a_run_wait_for_the_next(world):
    world.list_videos("a", *VIDEOS)
    world.land("1", ("v0", 1, [thread("a")], "t1"))
    world.run(1, until="landing")
    world.land("2", ("v1", 1, [thread("b")], "t2"))
    world.list_videos("b", ("v9", "late", "2024-02-01T00:00:00Z"))
    world.land("3", ("v9", 1, [thread("z")], "t2"))
    world.run(1)
    assert world.raw() == ["a"]
    world.run(2)
    assert world.raw() == ["a", "b", "z"]


def test_caps_titles_and_relanded_pages_follow_across_runs(world):
    world.list_videos("a", ("v0", "Old", "2024-01-01T00:00:00Z"), ("v1", "Other", "2024-01-02T00:00:00Z"))
    world.land("1", ("v0", 1, [thread("a"), thread("b")], "t1"), ("v0", 2, [thread("c")], "t1"), ("v1", 1, "{broken", "t1"))
    world.run(1, max_comments_per_video=2)
    assert world.raw() == ["a", "b"] and world.rows("quarantine/run=1", "video_id", "raw_json", "error") == [("v1", "{broken", "malformed page")]
    # The first page lands again, shorter: the cap now reaches the second one; the broken page comes out right.
    world.land("2", ("v0", 1, [thread("a")], "t2"), ("v1", 1, [thread("d")], "t2"), ("v1", 1, [thread("d")], "t2"))
    world.run(2, max_comments_per_video=2)
    assert world.raw() == ["a", "b", "c", "d"]
    assert world.rows("outcomes/run=2", "video_id", "status") == [("v0", "fetched"), ("v1", "fetched")]
    # Another cap makes every video pending, a new title its own.
    world.run(3, max_comments_per_video=0)
    assert world.rows("pending/run=3", "video_id") == [("v0",), ("v1",)]
    world.list_videos("b", ("v0", "Renamed", "2024-01-01T00:00:00Z"))
    world.run(4, max_comments_per_video=0)
    assert world.rows("pending/run=4", "video_id", "title") == [("v0", "Renamed")]
    assert (world.root / "out/documents/c/v0_Renamed.txt").read_text().startswith("Title: Renamed\n")


def test_parsed_pages_agree_with_the_batch_operators(spark):
    error = '{"error": {"errors": [{"reason": "commentsDisabled"}], "message": "m"}}'
    rows = [("v", "@c", 1, "{x", None), ("v", "@c", 2, error, "t"), ("v", "@c", 3, '{"error": {"message": "quota"}}', "t"),
            ("v", "@c", 4, '{"items": []}', "t"), ("v", "@c", None, "null", "t"), ("v", "@c", 6, "{}", "t")]
    pages = pages_frame(spark, [("v", 7, [thread("a", 2), thread("b")]), ("v", 7, [thread("a", 2), thread("b")])]).unionByName(
        spark.createDataFrame(rows, pages_frame(spark, []).schema))
    parsed = landing.parse_landed_pages(pages)
    want = {r["page_no"]: r["error"] for r in pages.select("page_no", landing.page_error(F.col("raw_json")).alias("error")).collect()}
    got = {r["page_no"]: (r["error"], r["n"], r["bad_json"]) for r in parsed.collect()}
    assert {k: v[0] for k, v in got.items()} == want and parsed.count() == 7
    assert got[7] == (None, 4, None) and got[1] == ("malformed page", 0, "{x") and got[6][1] == 0


def test_store_gives_the_rows_of_flatten_threads(spark, tmp_path):
    pages = pages_frame(spark, [("v", 1, [thread("a", 2), thread("b")]), ("w", 1, [thread("c", 1)])])
    store = intake.page_store(spark, str(tmp_path / "pages"))
    store.write(landing.parse_landed_pages(pages), 0)
    found = intake.comments_of_pages(store, intake.newest_pages(store, spark.createDataFrame([("v",), ("w",)], "video_id string")).select(
        "video_id", "page_no", "page_hash", "segment", "landed_at"))
    want = landing.flatten_threads(pages)
    assert sorted(map(repr, found.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_segments(spark, tmp_path):
    s = Segments(spark, str(tmp_path / "t"), "k string, v int", "k", buckets=4)
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int")
    assert s.read().count() == 0 and s.last() == -1
    for n in range(2 * FAN + 1):
        s.write(frame([(f"k{n}", n), ("hot", n)]), n)
    s.write(frame([("again", 3)]), 3)
    (tmp_path / "t" / "seg=L0-000000000099-000000000099").mkdir()  # a segment whose job has not committed
    rows = lambda df: sorted((r["k"], r["v"]) for r in df.collect())
    want = sorted([(f"k{n}", n) for n in range(2 * FAN + 1) if n != 3] + [("hot", n) for n in range(2 * FAN + 1) if n != 3] + [("again", 3)])
    assert rows(s.read()) == want and s.last() == 2 * FAN
    assert s.compact(up_to=2 * FAN) == 2
    assert s.live() == [(1, 0, FAN - 1), (1, FAN, 2 * FAN - 1), (0, 2 * FAN, 2 * FAN)] and rows(s.read()) == want
    assert rows(s.read(newer_than=2 * FAN - 2)) == [r for r in want if r[1] > 2 * FAN - 2]
    only = s.buckets_of(frame([("hot", 0)]))
    assert {b for b, in s.read(only).select("bucket").distinct().collect()} == set(only)
    assert pruned(plan(s.read(only)))
    assert rows(s.read(valid={2 * FAN})) == [r for r in want if r[1] <= 2 * FAN]
