"""Documents written line by line are those written part by part."""

from chorale.operators.documents import assemble_documents, document_lines
from chorale.operators.joins import attach_videos
from chorale.operators.landing import flatten_threads
from chorale.sources import named_files, sinks

PAGE = ('{"items": [{"id": "%s", "snippet": {"totalReplyCount": 0, "topLevelComment": {"snippet": {"authorDisplayName": "a",'
        ' "textOriginal": "%s", "likeCount": 1, "publishedAt": "2024-01-01T00:00:00Z"}}}}]}')
NAMES = "video_id string, channel_handle string, page_no int, raw_json string, ingested_at string"


def page(video, no, text, at):
    return (video, "@c", no, PAGE % (f"{video}-{no}-{text}", text), at)


def test_document_lines_give_the_files_of_the_parts(spark, tmp_path):
    dim = spark.createDataFrame([("v1", "@c", "One", "2024-01-01", "u1"), ("v2", "@c", "Two", "2024-01-02", "u2")],
                                "video_id string, channel_handle string, title string, published_at string, video_url string")
    pages = spark.createDataFrame([page(v, n, f"t{n}", "1") for v in ("v1", "v2") for n in range(1, 24)], NAMES)
    comments = attach_videos(flatten_threads(pages), dim)
    sinks.write_document_files(assemble_documents(comments, dim, 2), str(tmp_path / "parts"))
    sinks.write_document_lines(document_lines(comments, dim), str(tmp_path / "lines"))
    sinks.write_document_lines(document_lines(comments, dim), str(tmp_path / "packed"), packed=True)
    a, b, c = (sorted(map(tuple, named_files.read_named_text(spark, str(tmp_path / d), s).collect()))
               for d, s in (("parts", ".txt"), ("lines", ".txt"), ("packed", ".txt.gz")))
    assert len(a) == 2 and a == b == c
    assert not list((tmp_path / "packed").rglob("*.txt")) and "t23" in a[0][1]
