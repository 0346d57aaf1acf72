import base64
import hashlib

import pytest
import zstandard

from tallyguard.llm import warc

PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/ü?q=1 2", "<p>two</p>"),
    (3, "http://a.example/1", "<p>one</p>"),
    (5, None, "<p>one</p>"),
    (5, "http://a.example/5", "<p>one</p>"),
    (6, "http://a.example/6", None),
    (7, "http://a.example/7", ""),
    (None, "bad\r\nurl", "<p>one</p>"),
    (None, "http://a.example/n", "only\r\n\r\nhere"),
    (10, "http://a.example/10", "é中🙂 " * 120_000),
    (11, "http://a.example/11", "WARC/1.1\r\n\r\n"),
]


def pages(spark, rows=PAGES):
    clashes = "id string, key int, payload int, row_no int, first int, size int, best int, data int, records int"
    return spark.createDataFrame([(*r, "x", *range(8)) for r in rows], f"page_id bigint, url string, html string, {clashes}")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    out, groups = [], {}
    for i, r in enumerate(rows):
        groups.setdefault(r[2] or "", []).append((r[0] is not None, r[0] or 0, i))
    for i, (id_, _, text) in enumerate(rows):
        best = max(groups[text or ""])
        size = len((text or "").encode())
        alone = best[2] == i or size < least
        out.append((id_, size, digest(text), "response" if alone else "revisit", None if alone or not best[0] else best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 11])
@pytest.mark.parametrize("frame_bytes", [1, 2000, warc.FRAME_BYTES])
def test_a_record_per_row_comes_back(spark, least, frame_bytes):
    rows = warc.round_trip(pages(spark).coalesce(1), least_bytes=least, frame_bytes=frame_bytes, bundle_bytes=5000).collect()
    assert sorted(map(tuple, rows), key=str) == expected(PAGES, least)


def test_many_partitions_and_string_ids(spark):
    rows = [(f"id {i}:%+{i % 3}é", "u", f"text {i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "name string, url string, html string").repartition(5)
    out = warc.round_trip(df, "name").collect()
    assert len(out) == 200 and {r["name"] for r in out} == {r[0] for r in rows}
    firsts = {f"text {k}": max(r[0] for r in rows if r[2] == f"text {k}") for k in range(7)}
    texts = {r[0]: r[2] for r in rows}
    for r in out:
        first = firsts[texts[r["name"]]]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["name"] == first else ("revisit", first))


def test_records_are_found_by_their_identifier(spark, tmp_path):
    folder = str(tmp_path / "bundles")
    warc.write_bundles(pages(spark).coalesce(2), folder, frame_bytes=100, bundle_bytes=300)
    every = warc.read_bundles(spark, folder).collect()
    revisits = [r for r in every if r["record_type"] == "revisit"]
    wanted = spark.createDataFrame([(r["refers_to"],) for r in revisits] + [("<urn:page:v99:1>",)], "record_id string")
    found = {r["record_id"]: r for r in warc.find_records(spark, folder, wanted).collect()}
    assert set(found) == {r["refers_to"] for r in revisits}
    for r in revisits:
        own = found[r["refers_to"]]
        assert own["record_type"] == "response"
        assert (len(own["payload"]), digest(own["payload"].decode())) == (r["payload_bytes"], r["payload_digest"])


def test_a_bundle_is_plain_zstandard_with_independent_frames(spark, tmp_path):
    folder = str(tmp_path / "bundles")
    warc.write_bundles(pages(spark).coalesce(1), folder, frame_bytes=100)
    (row,) = spark.read.parquet(folder).collect()
    data = bytes(row["data"])
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC-Record-ID: ") == len(PAGES)
    table = warc.seek_table(data)
    assert len(table) > 3 and b"".join(warc.frame(data, e) for e in table) == whole
    for at in row["records"]:
        piece = warc.frame(data, table[at["frame"]])[at["place"] : at["place"] + at["length"]]
        head, _, end = warc.parsed(piece, 0)
        assert head["WARC-Record-ID"] == at["record_id"] and end == len(piece)


def test_damage_is_noticed():
    bundle = warc.Bundle(10, 3)
    body = b"<p>text</p>"
    bundle.add("<urn:page:v1:0>", warc.record("<urn:page:v1:0>", "u", body, hashlib.sha1(b"other").digest(), None, warc.DATE))
    data = bundle.bytes()
    head, block, _ = warc.parsed(warc.frame(data, warc.seek_table(data)[0]), 0)
    with pytest.raises(ValueError, match="damaged"):
        warc.described(head, block)
    with pytest.raises(ValueError, match="seek table"):
        warc.seek_table(data[:-1] + b"x")
    with pytest.raises(ValueError, match="seek table"):
        warc.seek_table(data[1:])


def test_no_rows(spark):
    assert warc.round_trip(pages(spark, [])).collect() == []
