import base64
import hashlib
import struct
from collections import defaultdict

import duckdb
import pytest
import zstandard

from tidewatch.llm import warc
from tidewatch.session import work_folder

PAGES = "page_id long, url string, html string, digest string, response string"


def pages(spark):
    rows = [(k, f"http://x/{k}", f"<p>{k % 4}</p>" * (1 + k % 4), "d", "r") for k in range(20)]
    rows += [(30, None, None, None, None), (31, "http://a\r\nb", "", None, None), (19, "http://x/19", "<p>3</p>" * 4, "d", "r")]
    rows += [(None, "u", "alone", None, None), (None, "u", "<p>0</p>", None, None)]
    rows += [(40, "http://big", "é" * 3_000_000, None, None), (41, "x", "WARC/1.1\r\n\r\n", None, None)]
    return spark.createDataFrame(rows, PAGES).repartition(2)


def expected(rows, least=0):
    first = defaultdict(lambda: -1)
    for r in rows:
        if r.page_id is not None:
            first[r.html or ""] = max(first[r.html or ""], r.page_id)
    for r in rows:
        body = (r.html or "").encode()
        sha = base64.b32encode(hashlib.sha1(body).digest()).decode()
        response = first[r.html or ""]
        again = len(body) >= least and response >= 0 and response != r.page_id
        yield r.page_id, len(body), sha, "revisit" if again else "response", response if again else None


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    frame = pages(spark).cache()
    folder = f"file://{work_folder(spark, 'warc-test')}"
    index = warc.write_archives(frame, folder, least)
    assert sorted(map(str, warc.read_archives(index, folder).collect())) == sorted(
        str(spark.createDataFrame([e], warc.RECORD).first()) for e in expected(frame.collect(), least)
    )
    # every record is found through its frame alone
    for place in index.collect():
        with warc.Bundle(folder, place.bundle) as bundle:
            headers, block = bundle.record(place.frame, place.position, place.length)
        assert warc.interpret(headers, block)[0] == place.page_id


def test_bundles_are_plain_zstandard(spark):
    folder = f"file://{work_folder(spark, 'warc-test')}"
    index = warc.write_archives(pages(spark), folder)
    name = index.where("page_id = 40").first().bundle
    data = open(f"{folder.removeprefix('file://')}/{name}", "rb").read()
    assert struct.unpack("<I", data[-4:])[0] == warc.SEEK_MAGIC
    with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as stream:
        plain = stream.read()
    at = count = 0
    while at < len(plain):
        _, _, at = warc.parse_record(plain, at)
        count += 1
    assert count == index.where(index.bundle == name).count()
    frames = index.where(index.bundle == name).select("frame").distinct().count()
    assert frames == struct.unpack("<I", data[-9:-5])[0] > 1


def test_damage_is_noticed():
    record = warc.build_record(1, "u", b"abc", warc.base32_sha1(b"abc"), None)
    headers, block, end = warc.parse_record(record)
    assert end == len(record) and warc.interpret(headers, block)[:3] == (1, 3, warc.base32_sha1(b"abc"))
    with pytest.raises(ValueError):
        warc.interpret(headers, block.replace(b"abc", b"abd"))


def test_empty(spark):
    folder = f"file://{work_folder(spark, 'warc-test')}"
    assert warc.read_archives(warc.write_archives(pages(spark).where("false"), folder), folder).count() == 0


def test_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    columns = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    want = con.sql(f"select {', '.join(columns)} from ({warc.OP6_SQL})").fetchall()
    assert sorted(map(tuple, warc.op6_warc(spark, sf_dir).select(*columns).collect())) == sorted(want)
