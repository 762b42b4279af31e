"""Landing ledger, byte ranges and checksums."""

import os
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medallion import fs
from medallion.streaming import landing as L


def values(spark, bronze):
    return sorted(r.value for r in spark.read.parquet(bronze).select("value").collect())


def test_crash_before_and_after_the_commit(spark, tmp_ws):
    src, bronze, check = f"{tmp_ws}/s", f"{tmp_ws}/b", f"{tmp_ws}/c"
    fs.touch(spark, f"{src}/a.txt", "a\n")
    spark.createDataFrame([("junk",)], "value string").write.parquet(f"{bronze}/_staged-0")
    L.land(spark, src, bronze, check, fmt="text")
    assert values(spark, bronze) == ["a"]
    fs.rename(spark, f"{bronze}/{L.BATCH}=0", f"{bronze}/_staged-0")  # committed, not published
    fs.touch(spark, f"{src}/b.txt", "b\n")
    run = L.land(spark, src, bronze, check, fmt="text")
    assert (run.rows, run.batches) == (1, 1) and values(spark, bronze) == ["a", "b"]
    assert L.land(spark, src, bronze, check, fmt="text") == L.LandingRun(0, 0)


def test_two_runs_on_one_checkpoint_cannot_both_commit(spark, tmp_ws, monkeypatch):
    src, bronze, check = f"{tmp_ws}/s", f"{tmp_ws}/b", f"{tmp_ws}/c"
    fs.touch(spark, f"{src}/a.txt", "a\n")
    plain = L.fs.rename_new

    def beaten(spark, old, new):
        fs.touch(spark, f"{new}/part-0", "")  # the other run's batch
        return plain(spark, old, new)

    monkeypatch.setattr(L.fs, "rename_new", beaten)
    with pytest.raises(L.ConcurrentLanding):
        L.land(spark, src, bronze, check, fmt="text")
    assert not fs.exists(spark, f"{bronze}/{L.BATCH}=0")


def test_batches_follow_time_and_odd_names(spark, tmp_ws):
    src, bronze, check = f"{tmp_ws}/s", f"{tmp_ws}/b", f"{tmp_ws}/c"
    names = ["z[1].txt", "a b.txt", "m{x}.txt", "p+q%20.txt", "q*.txt"]
    os.makedirs(src.removeprefix("file:"), exist_ok=True)
    for n, name in enumerate(names):
        path = f"{src.removeprefix('file:')}/{name}"
        with open(path, "w") as f:
            f.write(f"{name}\n")
        os.utime(path, (1000 + n, 1000 + n))
    run = L.land(spark, src, bronze, check, fmt="text", max_files_per_trigger=2)
    assert (run.rows, run.batches) == (5, 3)
    by_batch = {r.value: r[L.BATCH] for r in spark.read.parquet(bronze).collect()}
    assert by_batch == {n: i // 2 for i, n in enumerate(names)}
    stems = {r.value: r.stem for r in spark.read.parquet(bronze).collect()}
    assert stems == {n: n[:-4] for n in names}


def test_empty_source_and_old_streaming_table(spark, tmp_ws):
    fs.mkdirs(spark, f"{tmp_ws}/s")
    assert L.land(spark, f"{tmp_ws}/s", f"{tmp_ws}/b", f"{tmp_ws}/c", fmt="text") == L.LandingRun(0, 0)
    fs.mkdirs(spark, f"{tmp_ws}/b/_spark_metadata")
    with pytest.raises(ValueError, match="streaming sink"):
        L.land(spark, f"{tmp_ws}/s", f"{tmp_ws}/b", f"{tmp_ws}/c", fmt="text")


def test_ranges_of_a_large_file_land_in_several_tasks(spark, tmp_ws):
    src = f"{tmp_ws}/s"
    os.makedirs(src, exist_ok=True)
    data = os.urandom(1_000_003)
    for name, content in (("big.bin", data), ("empty.bin", b""), ("small.bin", b"x")):
        with open(f"{src}/{name}", "wb") as f:
            f.write(content)
    run = L.land_ranges(spark, src, f"{tmp_ws}/b", f"{tmp_ws}/c", range_bytes=65536)
    assert run.rows == 16 + 1  # Spark's listing leaves out empty files
    bronze = spark.read.parquet(f"{tmp_ws}/b")
    files = {f for f in bronze.filter("stem = 'big'").inputFiles()}
    assert len(files) > 3  # each task writes its own file
    got = {r.source_file.split("/")[-1]: r for r in L.file_checksums(bronze).collect()}
    assert "empty.bin" not in got
    for name, content in (("big.bin", data), ("small.bin", b"x")):
        assert (got[name].n_bytes, got[name].crc32, got[name].complete) == (len(content), zlib.crc32(content), True)
    whole = {r.source_file.split("/")[-1]: r for r in L.reassembled_digests(bronze).collect()}
    import hashlib
    assert whole["big.bin"].sha256 == hashlib.sha256(data).hexdigest() and whole["big.bin"].n_bytes == len(data)
    part = L.file_checksums(bronze.filter("offset <> 65536")).filter("source_file LIKE '%big.bin'").first()
    assert not part.complete


def test_checksums_do_not_read_the_content(spark, tmp_ws):
    fs.touch(spark, f"{tmp_ws}/s/a.txt", "hello")
    L.land_ranges(spark, f"{tmp_ws}/s", f"{tmp_ws}/b", f"{tmp_ws}/c")
    from medallion.plans.sqlsurface import plan_text
    plan = plan_text(L.file_checksums(spark.read.parquet(f"{tmp_ws}/b")))
    assert "content" not in plan.split("ReadSchema")[1].splitlines()[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=6))
def test_crc_of_parts_is_the_crc_of_the_whole(parts):
    crc, total = L.Crc32(), 0
    for p in parts:
        total = crc.join(total, zlib.crc32(p), len(p))
    assert total == zlib.crc32(b"".join(parts))
