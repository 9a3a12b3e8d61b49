"""Archives that are read back, against a plain resolution of revisits."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from civicstat.llm import warc

SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def plain(rows, least=0):
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= least and last[h or ""] >= 0 and i != last[h or ""]
        out.append((str(i), len(raw), digest(h), "revisit" if revisit else "response", last[h or ""] if revisit else None))
    return sorted(out)


ROWS = [(1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c/\r\nX: y", "<p>one</p>"), (4, "u", None), (5, "u", ""), (6, "u", "line\r\n\r\nWARC/1.1\r\n\r\n"),
        (7, "u", "é日本" * 900), (8, "u", "\r\n\r\n"), (9, "u", " trailing \n"), (10, "u", "x" * 300_000), (None, "u", "<p>one</p>"), (None, "n", "alone")]


@pytest.mark.parametrize("least", [0, 5, 10_000])
def test_round_trip(frame, least):
    got = warc.archive(frame(ROWS, SCHEMA), min_bytes=least).collect()
    assert sorted((str(r.id), r.n_bytes, r.digest, r.record_type, r.refers_to) for r in got) == plain(ROWS, least)
    text = {i: h or "" for i, _, h in ROWS if i is not None}
    assert all(r.payload == text[r.id] for r in got if r.record_type == "response" and r.id is not None)
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_repeated_rows_and_ids(frame):
    rows = [(1, "u", "a"), (1, "u", "a"), (1, "u", "b"), (2, "u", "b"), (3, "u", "z"), (3, "u", "z")]
    got = warc.archive(frame(rows, SCHEMA)).collect()
    assert sorted((str(r.id), r.n_bytes, r.digest, r.record_type, r.refers_to) for r in got) == plain(rows)


def test_files_are_plain_archives(frame, tmp_path):
    path = str(tmp_path / "w")
    warc.write(frame(ROWS, SCHEMA, 1), path, "page_id", "html", "url")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path).glob("*.gz")))
    kinds = [h["WARC-Type"] for h, _, _ in warc._parse(data)]
    assert len(kinds) == len(ROWS) and kinds.count("revisit") == 4
    with pytest.raises(ValueError):
        list(warc._parse(data[3:]))


def test_empty_table_and_further_columns(spark, frame):
    schema = SCHEMA + ", digest string, value string, id int"
    assert warc.archive(spark.createDataFrame([], schema)).count() == 0
    assert warc.archive(frame([(1, "u", "h", "d", "v", 5)], schema)).first().id == 1
