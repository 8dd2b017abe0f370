"""How much room landed comments and pages take on their way, not only what comes out of them."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chorale import fixtures as fx
from chorale.registry import all_queries
from chorale.sources import landed, sinks
from chorale.streaming import layers


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """The smallest tables with eight times the events, so that each text is that of many comments."""
    sf, root = "/root/testdata/sf0.001", tmp_path_factory.mktemp("copies")
    events = pq.read_table(f"{sf}/events.parquet")
    n, ids = len(events), events.column("event_id").to_pylist()
    at = events.schema.get_field_index("event_id")
    more = [events.set_column(at, "event_id", pa.array([i + k * n for i in ids], pa.int64())) for k in range(8)]
    pq.write_table(pa.concat_tables(more), root / "events.parquet")
    pq.write_table(pq.read_table(f"{sf}/documents.parquet"), root / "documents.parquet")
    return str(root)


def size(path, pattern):
    return sum(p.stat().st_size for p in path.rglob(pattern))


def test_copies_of_a_text_take_little_room_in_every_layer(spark, copies, tmp_path):
    rows = fx.landed_comments(spark, copies)
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    sinks.write_comment_records(rows, str(tmp_path / "landing"), F.col("lot"), "gzip")
    assert not list((tmp_path / "landing").rglob("*.json")) and size(tmp_path / "landing", "*.json.gz") < chars / 4
    layers.run_raw(spark, str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "cp"))
    assert size(tmp_path / "raw", "*.parquet") < chars / 4
    back = landed.read_comment_records(spark, str(tmp_path / "landing"))
    assert back.count() == rows.count() == spark.read.parquet(str(tmp_path / "raw")).count()
    assert landed.count_files(spark, str(tmp_path / "landing")).first()["files"] > 0


def test_pages_are_made_with_one_shuffle_of_the_texts_and_land_compressed(spark, copies, tmp_path):
    pages = fx.thread_pages(spark, copies, 5)
    final = pages._jdf.queryExecution().executedPlan().toString()
    assert final.count("Exchange hashpartitioning(video_id") == 1
    sinks.write_thread_pages(pages, str(tmp_path / "pages"))
    plain = pages.agg(F.sum(F.octet_length("raw_json"))).first()[0]
    assert size(tmp_path / "pages", "*.json.gz") < plain / 2
    assert landed.read_thread_pages(spark, str(tmp_path / "pages")).count() == pages.count()


def test_plain_files_are_read_beside_compressed_ones(spark, sf, tmp_path):
    rows = fx.landed_comments(spark, sf)
    for part, compression in ((0, None), (1, "gzip")):
        sinks.write_comment_records(rows.filter(F.col("slot") % 2 == part), str(tmp_path / f"landing/{part}"), compression=compression)
    assert landed.read_comment_records(spark, str(tmp_path / "landing")).count() == rows.count()
    assert all_queries()["dq_not_empty"](spark, sf).filter("NOT passed").count() == 0
