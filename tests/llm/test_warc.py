import base64
import gzip
import hashlib

import pytest

from linkrank.llm import warc

PAGES = [(3, "http://a/", "<p>x</p>"), (9, "http://b/", "<p>x</p>"), (1, "http://c/ d\r\n", "<p>x</p>"), (4, None, None), (5, "http://e/", ""), (None, "http://n/", "<p>n</p>"), (6, "http://é/", "é" * 50_000), (9, "http://b/", "<p>x</p>"), (2, "u", "only")]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", 1) for i, u, h in rows], "page_id long, url string, html string, digest string, top string, shard int")


def expected(rows, least=0):
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        same = [k for k, _, x in rows if (x or "").encode() == data and k is not None]
        top = max(same, default=None)
        revisit = len(data) >= least and top is not None and i != top
        out.append((i, u, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None, None if revisit else data))
    return sorted(map(repr, out))


def read(spark, folder):
    rows = warc.read_archive(spark, folder).collect()
    return sorted(repr((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.record_type == "revisit" else bytes(r.payload))) for r in rows)


@pytest.mark.parametrize("least", [0, 9])
def test_round_trip(spark, least):
    assert read(spark, warc.write_archive(frame(spark, PAGES), least_bytes=least)) == expected(PAGES, least)


def test_empty_table(spark):
    assert read(spark, warc.write_archive(frame(spark, []))) == []


def test_files_roll_and_are_the_same_again(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>{hashlib.sha256(str(i % 150).encode()).hexdigest() * 20}</p>") for i in range(200)]
    manifests = []
    for run, parts in enumerate((3, 7)):
        folder = warc.write_archive(frame(spark, rows).repartition(parts), str(tmp_path / f"run{run}"), shard_bytes=60_000, file_bytes=4_000)
        assert read(spark, folder) == expected(rows)
        manifests.append(sorted(tuple(r) for r in spark.read.parquet(f"{folder}/manifest").collect()))
        for m in manifests[-1]:
            data = (tmp_path / f"run{run}" / m[2]).read_bytes()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (m[4], m[5])
            assert gzip.decompress(data).count(b"WARC/1.1\r\n") == m[3] + 1
        assert not list((tmp_path / f"run{run}" / "_temporary").iterdir())
    assert manifests[0] == manifests[1]
    assert len({m[0] for m in manifests[0]}) > 2 and max(m[1] for m in manifests[0]) > 0
    bounds = [(m[6], m[7]) for m in manifests[0]]
    assert bounds == sorted(bounds) and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_a_changed_payload_is_found(spark, tmp_path):
    folder = warc.write_archive(frame(spark, [(1, "u", "text")]), str(tmp_path / "run"))
    file = next((tmp_path / "run").glob("*.warc.gz"))
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).split(b"WARC/1.1")[2].join([b"WARC/1.1", b""]).replace(b"text\r\n\r\n", b"test\r\n\r\n")))
    with pytest.raises(Exception, match="differs from its headers"):
        read(spark, folder)


def test_a_hot_null_id_is_spread_over_shards(spark):
    """A third of the pages lack an id; ranges cut them by digest, and every payload has its one response."""
    rows = [(None if k % 3 == 0 else k, f"http://h/{k}", f"<p>{hashlib.sha256(str(k % 700).encode()).hexdigest() * 4}</p>") for k in range(900)]
    rows += [(5, "http://same/", f"<p>{k} of one id</p>") for k in range(300)]
    folder = warc.write_archive(frame(spark, rows), shard_bytes=16_000)
    assert read(spark, folder) == expected(rows)
    records = {}
    for m in spark.read.parquet(f"{folder}/manifest").collect():
        records[m.shard] = records.get(m.shard, 0) + m.records
    assert len(records) > 8 and max(records.values()) < 0.3 * len(rows)


def test_a_second_attempt_leaves_a_complete_file_alone(tmp_path):
    def write(payload):
        roller = warc._Roller(str(tmp_path), 0, 1 << 20, "1970-01-01T00:00:00Z", 4)
        roller.add(1, warc.page_record(1, "u", payload, hashlib.sha1(payload).digest(), None, False, "1970-01-01T00:00:00Z"))
        return roller.close()

    (tmp_path / "_temporary").mkdir()
    first = write(b"text")
    file = tmp_path / first["file"]
    node, data = file.stat().st_ino, file.read_bytes()
    assert write(b"text") == first and (file.stat().st_ino, file.read_bytes()) == (node, data)
    assert not list((tmp_path / "_temporary").iterdir())
    with pytest.raises(ValueError, match="other bytes"):
        write(b"test")
    assert file.read_bytes() == data
