from __future__ import annotations

import hashlib
import io

import cases
import zstandard

from siltgate.llm import warc
from siltgate.plans.sizing import scratch_path, stored

PAGES = "page_id long, url string, html string"


def archive(spark, rows, **more):
    folder = scratch_path(spark, "warc")
    pages = cases.clashing(spark.createDataFrame(rows, PAGES), "digest", "first_id")
    index = stored(warc.write(pages, folder, **more), "index")
    return folder, index, warc.read(spark, folder)


def rows():
    same = "<p>" + "the same payload é " * 80
    small = "<p>tiny</p>"
    many = [(100 + i, f"http://h/{i}", f"<p>page number {i} " + f"w{i % 7} of it " * (50 + i)) for i in range(60)]
    return [(1, "http://a", same), (7, "http://b\r\nX: y", same), (7, "http://b2", same), (None, "http://n", same), (3, None, small), (4, "u", small), (5, "u", None), (6, "u", ""), *many]


def test_round_trip_of_every_payload(spark):
    made = rows()
    _, _, read = archive(spark, made)
    got = {r["page_id"]: r for r in read.collect() if r["page_id"] not in (7, None)}
    for page_id, _, html in made:
        if page_id in (7, None):
            continue
        payload = (html or "").encode()
        row = got[page_id]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        if row["record_type"] == "response":
            assert bytes(row["payload"]) == payload
    assert read.count() == len(made)


def test_equal_payloads_revisit_the_largest_id(spark):
    _, _, read = archive(spark, rows())
    found = cases.as_set(read.where("page_id IN (1, 3, 4, 5, 6, 7) OR page_id IS NULL"), "page_id", "record_type", "refers_to")
    assert found == sorted(
        [(1, "revisit", 7), (None, "revisit", 7), (7, "response", None), (7, "response", None), *[(i, "response", None) for i in (3, 4, 5, 6)]], key=repr
    )


def test_records_are_frames_of_their_own_with_the_leading_dictionary(spark):
    folder, index, _ = archive(spark, rows(), archive_bytes=1 << 20)
    store, root = warc._open(folder)
    checked = 0
    for path in {r["path"] for r in index.collect()}:
        with store.open_input_stream(f"{root}/{path}", compression=None) as stream:
            content = stream.read()
        known, at = warc.dictionary_of(content)
        unpack = zstandard.ZstdDecompressor(dict_data=known)
        for r in index.where(index["path"] == path).collect():
            frame = content[r["offset"] : r["offset"] + r["length"]]
            assert unpack.stream_reader(io.BytesIO(frame)).read().startswith(b"WARC/1.1\r\n")
            assert r["offset"] >= at
        checked += known is not None
    assert checked


def test_archives_are_cut_by_size_and_an_empty_table_has_none(spark):
    _, index, read = archive(spark, rows(), archive_bytes=4096)
    assert index.select("path").distinct().count() > 5 and read.count() == len(rows())
    _, index, _ = archive(spark, [])
    assert index.count() == 0


def test_a_record_larger_than_an_archive(spark):
    _, _, read = archive(spark, [(1, "u", "<p>" + "x" * 300_000), (2, "u", "b")], archive_bytes=1000)
    assert cases.as_set(read, "page_id", "payload_bytes") == [(1, 300_003), (2, 1)]
