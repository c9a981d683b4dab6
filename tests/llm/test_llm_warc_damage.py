"""Files that are cut off or damaged give their records up to there and say so."""

import gzip

import pytest

from corpusloom.llm import warc


def archive(n):
    one = lambda k: warc.record_bytes(
        [("WARC-Type", "response"), ("WARC-Record-ID", f"<r{k}>")], b"HTTP/1.1 200 OK\r\n\r\n" + b"text %d " % k * 50
    )
    return [one(k) + b"\r\n\r\n" for k in range(n)]


def read(spark, tmp_path, **files):
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = warc.read_warc(spark, f"file://{tmp_path}").collect()
    good = {r.record_id: bytes(r.payload) for r in rows if r.problem is None}
    return good, [r for r in rows if r.problem is not None]


@pytest.mark.parametrize("compress", [False, True])
def test_a_cut_off_file_keeps_what_came_before(spark, tmp_path, compress):
    records = archive(4)
    members = [gzip.compress(r, mtime=0) if compress else r for r in records]
    whole = b"".join(members)
    good, bad = read(spark, tmp_path, whole=whole, cut=whole[: -len(members[-1]) // 2])
    assert {f"r{k}" for k in range(4)} <= set(good) and all(good[f"r{k}"] == b"text %d " % k * 50 for k in range(4))
    (row,) = bad
    assert row.problem.startswith(f"file:{tmp_path}/cut: damaged ")
    assert (row.record_id, row.record_type, row.payload) == (None, None, None)


def test_a_file_of_something_else(spark, tmp_path):
    broken = bytearray(gzip.compress(b"".join(archive(50)), mtime=0))
    broken[len(broken) // 2] ^= 0xFF
    good, bad = read(spark, tmp_path, text=b"no archive", broken=bytes(broken), empty=b"", half=b"WARC/1.1\r\nA: b\r\n\r\n")
    assert len(bad) == 3 and all(": damaged " in r.problem for r in bad)
    assert all(payload.startswith(b"text ") for payload in good.values())
