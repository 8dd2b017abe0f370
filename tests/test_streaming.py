import json

import pytest
from pyspark.sql import functions as F

from chorale import fixtures as fx
from chorale import schemas
from chorale.operators import gold, quality, silver
from chorale.plans.pipeline import Params, run_pipeline
from chorale.sources import sinks
from chorale.streaming import layers


def record(cid, text="best", video="v", at="2024-01-01T00:00:00Z", **more):
    base = dict.fromkeys(schemas.COMMENT_FIELDS) | {
        "comment_id": cid, "video_id": video, "channel_handle": "@c", "text": text, "like_count": 1, "reply_count": 0,
        "published_at": at, "is_reply": False, "video_title": "T", "video_url": "u", "ingested_at": at}
    return base | more


def land(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


class Run:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def path(self, name):
        return str(self.root / name)

    def layers(self, run_id, **silver_options):
        layers.run_raw(self.spark, self.path("landing"), self.path("raw"), self.path("cp_raw"))
        progress = layers.run_silver(self.spark, self.path("raw"), self.path("silver"), self.path("cp_silver"), **silver_options)
        layers.run_scored(self.spark, self.path("silver"), self.path("scored"), self.path("cp_scored"), run_id)
        return progress

    def gold(self, run_id):
        return layers.merge_gold(self.spark, self.path("scored"), self.path("state"), run_id)

    def count(self, name):
        return self.spark.read.parquet(self.path(name)).count()


@pytest.fixture
def run(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    return Run(spark, tmp_path)


def test_restart_adds_nothing_and_new_files_add_their_rows(run):
    land(run.root / "landing/run=1/video_dir=v/a.json", [record("1"), record("2", "  "), record(None, "worst")])
    run.layers(1)
    assert (run.count("raw"), run.count("silver"), run.count("scored")) == (3, 2, 2)
    run.layers(2)
    assert (run.count("raw"), run.count("silver")) == (3, 2)
    land(run.root / "landing/run=3/video_dir=v/a.json", [record("3"), record("4", is_reply=True, parent_id="3")])
    (run.root / "landing/notes.txt").write_text("not a comment")
    run.layers(3)
    assert (run.count("raw"), run.count("silver"), run.count("scored")) == (5, 4, 3)
    assert run.spark.read.parquet(run.path("raw")).columns == [*schemas.COMMENT_FIELDS, "_ingested_at", "channel_bucket"]


def test_overwritten_file_is_not_read_again(run):
    land(run.root / "landing/v.json", [record("1")])
    run.layers(1)
    land(run.root / "landing/v.json", [record("1"), record("2")])
    run.layers(2)
    assert run.count("raw") == 1


def test_expectations_on_the_stream_equal_the_batch_counts(run):
    rows = [record(str(i) if i % 3 else None, " " if i % 5 == 0 else "text") for i in range(30)]
    land(run.root / "landing/a.json", rows)
    counted = layers.expectation_counts(run.layers(1))
    report = quality.expectation_report(run.spark.read.parquet(run.path("silver")), quality.SILVER_EXPECTATIONS)
    assert {r["expectation"]: r["failed_rows"] for r in report.collect()} == {
        k: v for k, v in counted.items() if k != "rows"}
    assert counted == {"rows": 24, "valid_comment_id": 8, "has_text": 0}


def test_bad_timestamp_stops_the_stream_unless_asked(run):
    land(run.root / "landing/a.json", [record("1", at="junk")])
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        run.layers(1)
    run.layers(1, on_bad_timestamp="null")
    assert run.count("silver") == 1


def test_dedup_within_time(run):
    land(run.root / "landing/a.json", [record("1"), record("1"), record("2"), record(None), record(None)])
    run.layers(1, dedup_within="1 day")
    land(run.root / "landing/b.json", [record("2"), record("3"), record(None)])
    run.layers(2, dedup_within="1 day")
    ids = [r["comment_id"] or "" for r in run.spark.read.parquet(run.path("silver")).collect()]
    assert sorted(ids) == ["", "", "", "1", "2", "3"]


def test_finished_files_are_archived(run):
    land(run.root / "landing/run=1/a.json", [record("1")])
    go = lambda: layers.run_raw(run.spark, run.path("landing"), run.path("raw"), run.path("cp"), archive=run.path("done"))
    go()
    land(run.root / "landing/run=2/b.json", [record("2")])
    go()
    go()
    assert run.count("raw") == 2
    assert not (run.root / "landing/run=1/a.json").exists()


def test_gold_merges_each_run_once_and_survives_a_lost_run(run):
    land(run.root / "landing/1.json", [record("1"), record("2", "worst")])
    run.layers(1)
    assert run.gold(1).first()["total_comments"] == 2
    assert run.gold(1).first()["total_comments"] == 2, "the same run again changes nothing"
    land(run.root / "landing/2.json", [record("3")])
    run.layers(2)  # and its merge is lost
    land(run.root / "landing/3.json", [record("4"), record("5", video="w")])
    run.layers(3)
    got = {r["video_id"]: r["total_comments"] for r in run.gold(3).collect()}
    assert got == {"v": 4, "w": 1}
    with pytest.raises(ValueError, match="older"):
        run.gold(2)
    run.layers(4)
    assert {r["video_id"]: r["total_comments"] for r in run.gold(4).collect()} == got


def test_merge_reads_only_new_runs(run):
    for i in (1, 2):
        land(run.root / f"landing/{i}.json", [record(str(i))])
        run.layers(i)
        run.gold(i)
    table = run.spark.read.parquet(run.path("scored"))
    new = table.filter((F.col("run_id") > 1) & (F.col("run_id") <= 2))
    assert len(new.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(run_id" in new._jdf.queryExecution().executedPlan().toString()


def test_gold_without_scored_table(run):
    with pytest.raises(FileNotFoundError):
        run.gold(1)


def test_pipeline_two_runs_equal_batch(spark, sf, tmp_path):
    """Pages of all videos land in two parts; documents, checks and metrics follow."""
    pages, out = fx.thread_pages(spark, sf, 2), str(tmp_path / "out")
    dim = fx.videos(spark, sf)
    item = F.to_json(F.struct(F.col("video_id").alias("id"), F.struct("title", F.col("published_at").alias("publishedAt")).alias("snippet")))
    records = dim.select("video_id", "channel_handle", F.lit("U").alias("channel_id"), F.lit("C").alias("channel_name"),
                         item.alias("raw_json"), F.col("published_at").alias("ingested_at"))
    records.write.json(str(tmp_path / "videos"))
    result = None
    for run_id, part in ((1, pages.filter("page_no <= 1")), (2, pages.filter("page_no > 1"))):
        sinks.write_thread_pages(part, str(tmp_path / f"pages{run_id}"))
        result = run_pipeline(spark, str(tmp_path / "videos"), str(tmp_path / f"pages{run_id}"), out, Params(run_id))
    raw = fx.raw_comments(spark, sf).withColumn("reply_count", F.when(F.col("is_reply"), 0).otherwise(F.col("reply_count")))
    expected = gold.comment_metrics(silver.clean_comments(raw)).drop("computed_at")
    assert sorted(map(str, result.gold.drop("computed_at").select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert result.silver.count() == silver.clean_comments(raw).count()
    assert result.checks.filter("NOT passed").count() == 0
    assert result.expectations["valid_comment_id"] == 0
    names = [f"{r['video_id']}_Video_{r['video_id'][3:]}_intro_tips.txt" for r in dim.collect()]
    assert sorted(f.name for f in (tmp_path / "out/documents").rglob("*.txt")) == sorted(names)


def test_pipeline_limits(spark, sf, tmp_path):
    dim = fx.videos(spark, sf)
    item = F.to_json(F.struct(F.struct("title", F.col("published_at").alias("publishedAt")).alias("snippet")))
    dim.select("video_id", "channel_handle", item.alias("raw_json")).write.json(str(tmp_path / "videos"))
    sinks.write_thread_pages(fx.thread_pages(spark, sf), str(tmp_path / "pages"))
    run_pipeline(spark, str(tmp_path / "videos"), str(tmp_path / "pages"), str(tmp_path / "out"),
                 Params(1, max_videos=2, max_comments_per_video=4))
    raw = spark.read.parquet(str(tmp_path / "out/raw"))
    assert {r["count"] for r in raw.groupBy("video_id").count().collect()} == {4}
    assert raw.select("video_id").distinct().count() == 8  # two per channel, four channels


def test_progress_of_many_micro_batches_is_complete(run):
    for i in range(12):
        land(run.root / f"landing/{i}.json", [record(str(i)), record(None)])
    progress = layers.run_raw(run.spark, run.path("landing"), run.path("raw"), run.path("cp_raw"), max_files=1)
    assert len([p for p in progress if p["numInputRows"]]) == 12
    silver = layers.run_silver(run.spark, run.path("raw"), run.path("silver"), run.path("cp_silver"), max_files=1)
    assert layers.expectation_counts(silver) == {"rows": 24, "valid_comment_id": 12, "has_text": 0}


def test_channel_filter_reads_the_directory_of_the_channel(run):
    from chorale.operators.channels import for_channel
    land(run.root / "landing/a.json", [record(str(i), channel_handle=f"@c{i}") for i in range(40)])
    run.layers(1)
    for name in ("raw", "silver"):
        rows = for_channel(run.spark.read.parquet(run.path(name)), "@c7")
        p = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(channel_bucket" in p and "channel_handle" in p.split("PushedFilters")[1]
        assert rows.count() == 1


def test_scored_table_holds_no_texts(run):
    land(run.root / "landing/a.json", [record("1")])
    run.layers(1)
    assert "text" not in run.spark.read.parquet(run.path("scored")).columns


def test_old_states_are_removed(run):
    for i in range(1, 7):
        land(run.root / f"landing/{i}.json", [record(str(i))])
        run.layers(i)
        run.gold(i)
    assert layers.committed_runs(run.spark, run.path("state")) == [4, 5, 6]


def test_a_broken_file_is_a_failed_row_of_the_report(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/part-0.parquet").write_bytes(b"PAR1 not a table PAR1")
    report = quality.check_tables(spark, {
        "broken": (lambda: spark.read.schema("a int").parquet(str(tmp_path / "t")), quality.TableChecks()),
        "fine": (lambda: spark.range(3), quality.TableChecks())}).collect()
    assert [(r["check_name"], r["passed"]) for r in report] == [("broken: accessible", False), ("fine: has rows", True)]
