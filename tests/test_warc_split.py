"""Byte ranges of a gzip file against the file read at once."""

import gzip
import io
import random
import zlib

from trawl.sources import warc as W


class Data:
    def __init__(self, raw):
        self.raw, self.size = raw, len(raw)

    def read_at(self, n, at):
        return self.raw[at:at + n]


def whole(raw):
    with io.TextIOWrapper(gzip.GzipFile(fileobj=io.BytesIO(raw)), encoding="utf-8", errors="ignore") as text:
        return list(W.scan_blocks(iter(lambda: text.read(1 << 20), "")))


def split(raw, size):
    data = Data(raw)
    return [p for at in range(0, len(raw), size) for p in W.range_records(data, at, min(len(raw), at + size))]


def records(rnd, n):
    out = [b"" if rnd.random() < 0.5 else b"before\r\n"]
    for i in range(n):
        body = bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 300)))
        body += rnd.choice([b"", b"\x1f\x8b\x08 no member", "ñ€😀".encode() * rnd.randint(0, 9), b" WARC/1.0 inside", b"x\rWARC/1.0\rbare"])
        out.append(b"WARC/1.0" + rnd.choice([b"\r\n", b"\n", b" \r\n", b"\r"]) + b"K: %d" % i + rnd.choice([b"\r\n", b"\n"]) + body
                   + rnd.choice([b"\r\n\r\n", b"\n", b"\r", b""]))
    return b"".join(out)


def members(rnd, text, cuts):
    at = sorted({0, len(text), *(rnd.randrange(len(text) + 1) for _ in range(cuts))})
    parts = [text[a:b] for a, b in zip(at, at[1:])]
    if rnd.random() < 0.3:
        parts.insert(rnd.randrange(len(parts) + 1), b"")
    level = rnd.choice([0, 1, 9])  # stored members hold the magic of their text as it is
    return b"".join(gzip.compress(p, level) for p in parts)


def test_ranges_give_the_rows_of_one_read():
    """Members cut anywhere: inside markers, line ends and characters; ranges of any size, some without a member start."""
    rnd = random.Random(2)
    for _ in range(150):
        raw = members(rnd, records(rnd, rnd.randint(0, 12)) or b"x", rnd.choice([0, 3, 12, 40]))
        want = whole(raw)
        for size in (rnd.randint(1, 60), rnd.randint(60, 2000), len(raw)):
            assert split(raw, size) == want


def test_a_member_inside_a_stored_member_is_not_taken():
    """A record that holds a gzip file of several members, as bytes of a stored block."""
    inner = b"".join(gzip.compress(b"WARC/1.0\nfake %d\n" % i) for i in range(5))
    text = b"WARC/1.0\none\n" + inner + b"\nWARC/1.0\ntwo\n"
    raw = gzip.compress(text, 0) + gzip.compress(b"WARC/1.0\nthree\n") + gzip.compress(inner, 0)
    assert raw.count(inner) == 2
    for size in (*range(1, 60), len(raw) // 2, len(raw)):
        assert split(raw, size) == whole(raw)


def test_not_a_member_and_broken_members():
    data = Data(b"\x1f\x8b\x08" + b"garbage" * 50)
    assert W.member_end(data, 0) is None and W.first_member(data, 0, data.size) is None
    good = gzip.compress(b"text")
    wrong = good[:-6] + b"\0\0" + good[-4:]
    assert W.member_end(Data(wrong), 0) is None and W.member_end(Data(good[:-3]), 0) is None
    assert W.member_end(Data(good + b"rest"), 0) == (len(good), b"t")


def test_large_file_by_many_tasks(spark, tmp_path):
    rnd = random.Random(5)
    text = [b"WARC/1.0\r\nWARC-TREC-ID: %d\r\n\r\n" % i + zlib.adler32(b"%d" % i).to_bytes(4, "big").hex().encode() * rnd.randint(1, 400)
            + b"\r\n\r\n" for i in range(900)]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(gzip.compress(t) for t in text))
    one = W.read_warc_exact(spark, str(path))
    many = W.read_warc_exact(spark, str(path), split_bytes=4096)
    assert one.rdd.getNumPartitions() == 1 < 10 < many.rdd.getNumPartitions()
    want = [r.payload for r in one.orderBy("rec_no").collect()]
    rows = many.orderBy("rec_no").collect()
    assert [r.payload for r in rows] == want and len({r.rec_no for r in rows}) == len(rows)
