import base64
import glob
import hashlib
import struct

import pytest
import zstandard

from cadence.llm import warc as W


def _want(rows):
    best = {}
    for page, _, html in rows:
        p = (html or "").encode()
        if page is not None and (p not in best or page > best[p]):
            best[p] = page
    out = []
    for page, _, html in rows:
        p = (html or "").encode()
        winner = best.get(p, page)
        out.append((page, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "response" if page == winner else "revisit", None if page == winner else winner))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    rows += [(900, None, None), (901, "http://a b\r\nX: y", ""), (902, "u", "é" * 70000), (903, "u", rows[0][2]),
             (904, "u", rows[0][2]), (None, "u", rows[0][2]), (None, "u", "alone"), (905, "u", "\r\n\r\nWARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    made = W.write_archives(df, tmp_dir + "/w", archive_bytes=50_000).collect()
    assert sum(r.records for r in made) == len(rows) and len(made) > 3
    got = W.read_archives(spark, tmp_dir + "/w").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == _want(rows)
    texts = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    assert all(bytes(r.payload) == texts[r.page_id] for r in got if r.record_type == "response" and r.page_id is not None)
    # One frame per record after the dictionary, and a plain decoder agrees.
    data = open(sorted(glob.glob(tmp_dir + "/w/*.warc.zst"))[0], "rb").read()
    size = struct.unpack_from("<I", data, 4)[0]
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    o = d.decompressobj()
    assert o.decompress(data[8 + size:]).startswith(b"WARC/1.1\r\n") and (o.unused_data or len(list(W.records(data))) == 1)


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
           for r in W.op7_warc(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got, key=str) == _want(rows)


def test_damaged_archives():
    d = W.train_dictionary([])
    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), write_checksum=True)
    frame = lambda r: struct.pack("<II", W.DICTIONARY_MAGIC, len(d)) + d + c.compress(r)
    good = W.make_record(1, "u", b"hello", None, False)
    assert len(list(W.records(frame(good)))) == 1
    for bad in (frame(good)[:-3], frame(good)[8:], frame(good.replace(b"hello", b"hallo")), frame(good + b"x"), frame(good)[:20],
                frame(good.replace(b"WARC-Date", b"WARC-Type")), frame(b"WARC/0.1\r\n\r\n"), frame(good) + b"junk"):
        with pytest.raises(W.BadArchive):
            for h, block in W.records(bad):
                W.parse_payload(h, block)


def test_empty(spark, tmp_dir):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.write_archives(df, tmp_dir + "/none").count() == 0
