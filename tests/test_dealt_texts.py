"""Texts move as documents or not at all, and what is made of them is the same."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import pages_frame, plan, thread, videos_frame
from pyspark.sql import functions as F

from chorale import fixtures as fx
from chorale import registry
from chorale.operators import documents, landing
from chorale.operators.joins import attach_videos
from chorale.sources import landed, sinks


def moved(df):
    """The columns that each shuffle of the plan deals rows by."""
    return [line.split("hashpartitioning(")[1] for line in plan(df).splitlines() if "Exchange hashpartitioning(" in line]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Repeated, missing and negative ids of documents and events, NULL texts, and 91 documents for 2,000 events."""
    root = tmp_path_factory.mktemp("odd")
    ids = [*range(85), 3, 3, None, -4, 90, 1000]
    texts = [None if i % 9 == 0 else f"text {i} of {d}" for i, d in enumerate(ids)]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts}), root / "documents.parquet")
    events = [*range(1980), 7, 7, None, None, -1, -4, -95, -400, 10**9, *range(5000, 5011)]
    n = len(events)
    pq.write_table(pa.table({
        "event_id": pa.array(events, pa.int64()), "ts": pa.array([10**15 + i * 10**6 for i in range(n)], pa.timestamp("us")),
        "user_id": pa.array([i % 7 for i in range(n)], pa.int64()), "event_type": ["view"] * n,
        "value": [float(i % 9) for i in range(n)], "props": ['{"k": %d}' % (i % 13) for i in range(n)]}), root / "events.parquet")
    return str(root)


def test_dealt_pages_and_comments_are_the_same(spark, odd, monkeypatch):
    def pages(together):
        return sorted(map(str, fx.thread_pages(spark, odd, 1, together=together).collect()))

    plain = pages(1)
    comments = fx.landed_comments(spark, odd).drop("lot")
    monkeypatch.setattr(fx, "DEAL_DOCS", 10)
    monkeypatch.setattr(fx, "max", lambda *v: 60 if v[-1] == 10 else max(v), raising=False)
    assert any(m.startswith("lot") for m in moved(fx.thread_pages(spark, odd, 1)))
    assert plain == pages(1)
    dealt = fx.dealt_comments(spark, odd, F.col("event_id"), 10).drop("lot")
    assert sorted(map(str, dealt.select(*comments.columns).collect())) == sorted(map(str, comments.collect()))


def test_pages_are_grouped_where_their_comments_were_dealt(spark, odd, monkeypatch):
    monkeypatch.setattr(fx, "max", lambda *v: 60 if v[-1] == fx.DEAL_DOCS else max(v), raising=False)
    assert not [m for m in moved(fx.thread_pages(spark, odd, 1)) if m.startswith("video_id")]


def test_documents_of_dealt_pages_shuffle_no_text(spark, odd, monkeypatch):
    dim = fx.videos(spark, odd)

    def build(dealt):
        pages = fx.thread_pages(spark, odd, 1, together=2, keep=["lot"])
        return documents.assemble_documents(attach_videos(landing.flatten_threads(pages, dealt), dim), dim, 2, dealt)

    plain = sorted(map(str, build([]).collect()))
    monkeypatch.setattr(fx, "max", lambda *v: 120 if v[-1] == fx.DEAL_DOCS else max(v), raising=False)
    assert not [m for m in moved(build(["lot"])) if "part#" in m and m.startswith("video_id")]
    assert [m for m in moved(build([])) if "part#" in m]
    assert sorted(map(str, build(["lot"]).collect())) == plain and len(plain) > 40


def test_a_document_whose_first_part_is_missing_has_its_header(spark):
    dim = videos_frame(spark, [("v", "@c", "T", "2024-01-01T00:00:00Z", "u"), ("w", "@c", None, None, "u")])
    pages = pages_frame(spark, [("v", 7, [thread("A", 1)]), ("w", 1, [thread("B")])])
    rows = {(r["video_id"], r["part"]): r["body"] for r in documents.assemble_documents(
        attach_videos(landing.flatten_threads(pages), dim), dim, 2).collect()}
    assert sorted(rows) == [("v", 0), ("v", 3), ("w", 0)]
    assert rows["v", 0].endswith("COMMENTS:") and rows["v", 3].startswith("[a]: text A") and rows["w", 0].startswith("Title: \n")


def test_newest_landings_are_picked_without_moving_pages(spark):
    first = pages_frame(spark, [("v", n, [thread(f"A{n}", 1)]) for n in range(4)] + [(None, None, [thread("N")])])
    second = pages_frame(spark, [("v", n, [thread(f"B{n}")]) for n in range(2)]).withColumn("ingested_at", F.lit("2024-01-02T00:00:00Z"))
    both = first.unionByName(second)
    newest = landing.newest_landing(both)
    assert not moved(newest)
    ids = lambda df: sorted(r["comment_id"] for r in landing.flatten_threads(df).collect())
    assert ids(newest) == ["A2", "A2.0", "A3", "A3.0", "B0", "B1", "N"]
    assert ids(landing.newest_landing(both.unionByName(both))) == ids(newest)


def test_limit_parses_and_keeps_only_pages_up_to_the_cut(spark):
    old = pages_frame(spark, [("v", n, [thread(f"A{n}", 1)]) for n in range(1, 9)])
    new = old.withColumn("ingested_at", F.lit("2024-01-02T00:00:00Z"))
    limited = landing.limit_comments(old.unionByName(new), 3)
    assert not moved(limited) and sorted(r["comment_id"] for r in limited.collect()) == ["A1", "A1.0", "A2"]
    broken = new.filter("page_no = 8").withColumn("raw_json", F.lit('{"items": [{'))
    stale = broken.withColumn("ingested_at", F.lit("2023-01-01T00:00:00Z"))
    assert landing.limit_comments(old.unionByName(stale), 3).count() == 3
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        landing.limit_comments(old.unionByName(broken), 3).count()


def test_one_pass_counts_pages_and_their_landings(spark):
    pages = pages_frame(spark, [("v", 1, [thread("A", 2), thread("B")])])
    row = landing.page_sizes(pages.unionByName(pages)).first()
    assert (row["n"], row["_same"], row["_n"]) == (4, 2, 2)


def test_dealt_records_are_written_by_the_tasks_that_have_them(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "TASK_ROWS", 200)
    rows = fx.dealt_comments(spark, odd, F.col("event_id"), 10)
    sinks.write_comment_records(rows, str(tmp_path / "landing"), compression="gzip", dealt=True)
    back = landed.read_comment_records(spark, str(tmp_path / "landing"))
    names = [c for c in back.columns if c != "_ingested_at"]
    assert sorted(map(str, back.select(*names).collect())) == sorted(map(str, fx.landed_comments(spark, odd).select(*names).collect()))
    of_task = {}
    for f in (tmp_path / "landing").rglob("*.json.gz"):
        of_task.setdefault(f.name.split("-")[1], set()).add(f.parent.name)
    # Dealt by video, a task would hold few of them; these tasks hold lots of documents, with comments of most videos.
    assert max(map(len, of_task.values())) >= fx.VIDEOS


def test_the_round_trip_shuffles_no_comment(spark, odd, monkeypatch):
    seen = []
    monkeypatch.setattr(sinks, "write_comment_records", lambda rows, path, *a, **k: seen.append((rows, k)) or rows.limit(1).write.json(path))
    registry.all_queries()["sink_ndjson_roundtrip"](spark, odd)
    rows, options = seen[0]
    assert options["dealt"] and not [m for m in moved(rows) if m.startswith("video_id")]
