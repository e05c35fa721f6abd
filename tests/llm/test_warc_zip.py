from __future__ import annotations

import hashlib
import zipfile

import pytest
from pyarrow import fs

from tillflow.llm import warc_zip as w
from tillflow.llm.scratch import new_folder

LONG = "<p>é" + "x" * 1200
ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, "http://a/3\r\n", LONG), (4, None, "<p>short"), (5, "http://a/5", "<p>short"), (6, "http://a/6", None),
    (7, "http://a/7", ""), (8, "http://a/8", "\r\n\r\n" + "y" * 2000), (None, "http://a/n", LONG), (3, "http://a/3", LONG), (9, "http://a/9", "z" * 300_000), (10, "u", "é" * 500),
    (11, "u", "é" * 500),
]


def plain(rows):
    last = {}
    for i, _, t in rows:
        t = (t or "").encode()
        if len(t) >= 1000 and i is not None:
            last[t] = max(last.get(t, i), i)
    out = []
    for i, _, t in rows:
        t = (t or "").encode()
        of = last.get(t)
        revisit = of is not None and i != of
        out.append((i, len(t), hashlib.sha1(t).hexdigest(), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(w, "PACKAGE_BYTES", 600)
    monkeypatch.setattr(w, "RANGE_BYTES", 700)
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").selectExpr("*", "1 AS key", "'x' AS digest", "2 AS last").repartition(3)
    got = w.archived(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(ROWS)


def test_payloads_are_read_back(spark):
    df = spark.createDataFrame([r for r in ROWS if r[0]], "page_id bigint, url string, html string")
    packages = w.write(df, new_folder(spark, "test"))
    got = w.read(packages).where("record_type = 'response'").collect()
    assert {(r["key"], bytes(r["payload"])) for r in got} == {(i, (t or "").encode()) for i, _, t in ROWS if i and i not in (1, 2, 10)}


def test_packages_are_zip_files_of_stored_members(spark):
    packages = w.write(spark.createDataFrame(ROWS, "page_id bigint, url string, html string").coalesce(1), new_folder(spark, "test"))
    for row in packages.collect():
        path = row["uri"].removeprefix("file://").removeprefix("file:")
        with zipfile.ZipFile(path) as z, fs.LocalFileSystem().open_input_file(path) as file:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            found = w.members(file)
            for info in z.infolist():
                _, offset, size = found[info.filename]
                assert w.read_at(file, offset, size) == z.read(info)


@pytest.mark.parametrize("comment", [b"", b"a comment with PK"])
def test_zip64_directory(tmp_path, monkeypatch, comment):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 20)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    path = str(tmp_path / "large.zip")
    with zipfile.ZipFile(path, "w") as z:
        for k in range(5):
            z.writestr(f"data-{k}-é", b"%d" % k * 40)
        z.writestr("packed", b"p" * 400, zipfile.ZIP_DEFLATED)
        z.comment = comment
    data = open(path, "rb").read()
    assert b"PK\x06\x06" in data
    with fs.LocalFileSystem().open_input_file(path) as file:
        found = w.members(file)
        assert len(found) == 6 and found["packed"][0] == zipfile.ZIP_DEFLATED
        for k in range(5):
            _, offset, size = found[f"data-{k}-é"]
            assert w.read_at(file, offset, size) == b"%d" % k * 40


def test_not_a_zip_file(tmp_path):
    (tmp_path / "x").write_bytes(b"nothing")
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as file, pytest.raises(ValueError):
        w.members(file)


def test_empty_table(spark):
    assert w.archived(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []
