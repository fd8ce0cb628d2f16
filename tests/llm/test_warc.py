"""Archives: round trip, magic inside payloads, blocks of any size, broken files."""

import hashlib
import random

import pytest

from parcelry.llm import warc
from parcelry.session import fresh_path

TRAP = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.fixture(scope="module")
def pages(spark):
    rnd = random.Random(3)
    rows = [(k, f"http://h/{k}", "".join(rnd.choice("<p>é\r\nx ") for _ in range(rnd.randint(0, 900)))) for k in range(60)]
    rows += [(70, "http://t", "a" + TRAP * 3 + "z"), (71, "u\r\nX-Injected: 1", TRAP), (72, None, "same " * 40), (73, "v", "same " * 40), (74, "w", "same " * 40), (75, "x", "short"), (76, "y", "short")]
    rows += [(77, "n", None), (78, "n", ""), (None, "no id", "same " * 40), (79, "big", "é" * 30_000)]
    return spark.createDataFrame([(a, b, c, "x", "y") for a, b, c in rows], "page_id long, url string, html string, payload string, digest string").repartition(3)


def expected(pages):
    first, out = {}, []
    rows = pages.select("page_id", "html").collect()
    for i, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        to = first.setdefault(digest, i) if len(data) >= 100 else i
        out.append((i, len(data), digest, None if to == i else to))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [700, 5000, warc.BLOCK])
def test_round_trip(pages, block):
    got = []
    for r in warc.round_trip(pages, block=block).collect():
        page = lambda s: int(s[10:-1]) if s and s[10:-1] else None
        data = r["payload"]
        assert (data is None) == (r["record_type"] == "revisit") == (r["refers_to"] is not None)
        digest = hashlib.sha256(data).hexdigest() if data is not None else r["stated_digest"][7:]
        assert r["stated_digest"] == f"sha256:{digest}"
        got.append((page(r["record_id"]), len(data) if data is not None else r["stated_bytes"], digest, page(r["refers_to"])))
    assert sorted(got, key=repr) == expected(pages)


def test_no_page(spark, pages):
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_cut_off_and_foreign_files(spark, pages):
    folder = fresh_path(spark, "warc")
    warc.write_archives(pages.where("page_id < 5").coalesce(1), folder)
    import glob
    import os

    path = glob.glob(f"{folder.removeprefix('file:')}/part-*")[0]
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[:-40])
    with open(os.path.join(os.path.dirname(path), "other.txt"), "wb") as f:
        f.write(b"no record here " + TRAP.encode())
    assert len(warc.read_records(spark, folder, block=300).collect()) == 4


@pytest.mark.parametrize("block", [5000, warc.BLOCK])
def test_headers_of_any_length(spark, block):
    """A url of over 64 KB in the middle of a file, and payloads full of magics without a blank line."""
    rows = [(k, f"http://h/{k}", f"page {k} " * 20) for k in range(40)]
    rows += [(40, "data:" + "u" * 70_000, "long"), (41, "data:" + "v" * 600_000, "longer " * 30), (42, "t", "WARC/1.0\r\n" * 9000), (43, "t", "WARC/1.0\r\nContent-Length: 7\r\n" * 3000), (44, "last", "end")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {int(r["record_id"][10:-1]): bytes(r["payload"]).decode() for r in warc.round_trip(pages, block=block).collect()}
    assert got == {i: html for i, _, html in rows}
