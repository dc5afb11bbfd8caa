"""Digests of files that no row can hold whole."""

import hashlib

from lakeops.registry import QUERIES
from lakeops.sources import files


def test_files_longer_than_a_value_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    noise = b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(2000))
    contents = {"noise": noise, "feed": noise + b"\n", "feeds": noise + b"\n\n\n", "returns": b"a\r\nb\r\r\n" * 900,
                "mark": b"\xef\xbb\xbf" + noise, "mark_feed": b"\xef\xbb\xbfx\n" * 300, "one": b"x" * 5000,
                "blank": b"\n" * 700, "lead": b"\n" + noise, "short": b"PAR1"}
    for name, content in contents.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    monkeypatch.setattr(files, "WHOLE", 500, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = {r.file_name: (r.length, r.sha256) for r in QUERIES["binary_files"](spark, str(tmp_path)).collect()}
        pieces = files.digests_of_pieces(spark, [f"{tmp_path}/{n}.parquet" for n in contents]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {f"{n}.parquet": (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    assert found == want
    assert {r.file_name: (r.length, r.sha256) for r in pieces} == want
