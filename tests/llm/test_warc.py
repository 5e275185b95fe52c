import base64
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from meterlark.llm import queries, warc

PAGES = [
    (1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, "same"), (2, "http://a/\r\nEvil: 1 é", "other é 🙂"), (7, "u", None), (9, "u", ""),
    (4, "u", "x\r\n\r\ny" * 50000), (None, "u", "same"), (6, "u", "HTTP/1.1 404\r\n\r\nno"), (6, "u", "HTTP/1.1 404\r\n\r\nno"),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")


def expected(rows):
    out = []
    for k, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        largest = max(same, default=None)
        again = largest is not None and k != largest
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((k, len(data), digest, "revisit" if again else "response", largest if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    records = warc.with_revisits(frame(spark))
    files = warc.write(records.repartition(3))
    got = warc.read(spark, files, verify=True)
    rows = got.select(warc.page_id("record_id"), "payload_bytes", "payload_digest", "record_type", warc.page_id("refers_to")).collect()
    assert sorted(map(tuple, rows), key=repr) == expected(PAGES)
    bodies = {bytes(r["payload"]).decode() for r in got.where("record_type = 'response'").collect()}
    assert bodies == {"same", "other é 🙂", "", "x\r\n\r\ny" * 50000, "HTTP/1.1 404\r\n\r\nno"}
    assert {r.target_uri for r in got.collect()} == {"http://a/1", "http://a/5", None, "http://a/%0D%0AEvil:%201%20é", "u"}


def test_filters_are_pushed_and_skip_payloads(spark):
    files = warc.write(warc.with_revisits(frame(spark)).coalesce(1))
    assert warc.read(spark, files, record_type=["revisit"], target_uri=["http://a/1", "u"]).count() == 3
    with pytest.raises(Exception, match="can be tested"):
        warc.read(spark, files, payload_bytes=["3"]).count()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    names = json.dumps([[r["file"], r["bytes"]] for r in files.collect()])
    pushed = spark.read.format("warc").option("path", names).option("pushdown", "true").load().where("record_type = 'revisit' and payload_bytes = 4")
    assert pushed.count() == sum(t == "revisit" and n == 4 for _, n, _, t, _ in expected(PAGES))
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    reader = warc.PushingWarcReader({"path": "[]"})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert len(left) == 1 and reader.wanted == {"record_type": {"revisit"}}
    name = files.first()["file"]
    touched = []
    body = warc.WarcReader._body
    reader._body = lambda *a: touched.append(1) or body(reader, *a)
    assert len(list(reader.records(name))) == len(touched) == sum(t == "revisit" for *_, t, _ in expected(PAGES))


def test_members_are_gzip_and_foreign_archives_are_read(spark, tmp_path):
    records = [warc.record_bytes(k, "u", data, hashlib.sha1(data).hexdigest(), "response", None) for k, data in enumerate([b"one", b"", b"z" * 200000])]
    assert gzip.decompress(b"".join(map(warc.member, records))) == b"".join(records)
    (tmp_path / "own.warc.gz").write_bytes(b"".join(map(warc.member, records)))
    (tmp_path / "foreign.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    got = warc.read(spark, str(tmp_path), verify=True).select("file", warc.page_id("record_id").alias("k"), F.length("payload").alias("n")).collect()
    assert sorted((r.file.split("/")[-1], r.k, r.n) for r in got) == [(f, k, n) for f in ("foreign.warc.gz", "own.warc.gz", "plain.warc") for k, n in ((0, 3), (1, 0), (2, 200000))]
    for path in ("own.warc.gz", "foreign.warc.gz", "plain.warc"):
        assert warc.read(spark, str(tmp_path / path), record_id=["<urn:page:2>"]).count() == 1


def test_wrong_digest_is_an_error(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(warc.record_bytes(1, "u", b"one", hashlib.sha1(b"two").hexdigest(), "response", None))
    with pytest.raises(Exception, match="another digest"):
        warc.read(spark, str(tmp_path), verify=True).collect()


def test_empty_table(spark):
    assert warc.read(spark, warc.write(warc.with_revisits(frame(spark, [])))).count() == 0


def test_query_over_a_table(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op2_warc(spark, sf_dir).collect()), key=repr) == expected(rows)


def archive(n=5):
    return [warc.record_bytes(k, f"u{k}", b"x" * (k * 9000), hashlib.sha1(b"x" * (k * 9000)).hexdigest(), "response", None) for k in range(n)]


def test_members_of_many_records_and_mixed_archives_are_read_whole(spark, tmp_path):
    records = archive()
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "mixed.warc.gz").write_bytes(gzip.compress(records[0] + records[1]) + gzip.compress(b"") + warc.member(records[2]) + gzip.compress(b"".join(records[3:])) + bytes(40))
    (tmp_path / "noise.warc.gz").write_bytes(b"".join(gzip.compress(r, level) for r, level in zip(records, (0, 1, 6, 9, 0), strict=True)))
    (tmp_path / "plain.warc").write_bytes(b"".join(records) + b"\r\n\r\n")
    for payload in (True, False):
        got = warc.read(spark, str(tmp_path), payload=payload, verify=payload).select("file", "target_uri", "payload_bytes", F.length("payload").alias("n")).collect()
        want = [(f, f"u{k}", k * 9000, k * 9000 if payload else None) for f in ("mixed.warc.gz", "noise.warc.gz", "one.warc.gz", "plain.warc") for k in range(5)]
        assert sorted((r.file.split("/")[-1], r.target_uri, r.payload_bytes, r.n) for r in got) == want
    assert warc.read(spark, str(tmp_path / "one.warc.gz"), target_uri=["u3", "u4"]).count() == 2


def test_cut_and_broken_archives_are_errors(spark, tmp_path):
    records = archive()
    own, foreign = b"".join(map(warc.member, records)), b"".join(map(gzip.compress, records))
    broken = bytearray(foreign)
    broken[len(foreign) - len(gzip.compress(records[4])) + 30] ^= 255
    bad = {
        "own.warc.gz": own[:-20], "foreign.warc.gz": foreign[:-20], "single.warc.gz": gzip.compress(b"".join(records))[:-300], "plain.warc": b"".join(records)[:-20],
        "headless.warc.gz": gzip.compress(records[0]) + gzip.compress(b"WARC/1.0\r\nno blank line") + gzip.compress(records[1]), "broken.warc.gz": bytes(broken),
        "short.warc.gz": gzip.compress(records[1][:-50]), "text.warc": b"not an archive\r\n\r\nat all",
    }
    for name, data in bad.items():
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="is cut|is broken|no end of headers|no record begins"):
            warc.read(spark, str(tmp_path / name)).collect()
