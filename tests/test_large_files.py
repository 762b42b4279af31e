"""Files larger than what one task should read: written, landed and digested in shares."""

import hashlib
import os
import random
import uuid
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medallion.sinks import text_files as T
from medallion.streaming import landing as L
from medallion.streaming import sha256 as S


def told(folder):
    return [int(open(f"{folder}/{f}").read()) for f in os.listdir(folder)]


@pytest.mark.parametrize("step", [None, S.plain])
def test_a_stored_state_goes_on_where_it_was(step):
    rnd = random.Random(7)
    for n in [*range(0, 140, 3), 55, 56, 63, 64, 65, 119, 120, 4099]:
        data = rnd.randbytes(n)
        cuts = sorted(rnd.randint(0, n) for _ in range(3))
        sha = S.Sha256(step=step)
        for a, b in zip([0, *cuts], [*cuts, n]):
            sha = S.Sha256(sha.state(), step).update(data[a:b])
        assert (sha.hexdigest(), sha.n_bytes) == (hashlib.sha256(data).hexdigest(), n)


def landed(spark, tmp_ws, files, **kw):
    src = f"{tmp_ws}/s".removeprefix("file:")
    os.makedirs(src, exist_ok=True)
    for name, content in files.items():
        with open(f"{src}/{name}", "wb") as f:
            f.write(content)
    L.land_ranges(spark, src, f"{tmp_ws}/b", f"{tmp_ws}/c", **kw)
    return spark.read.parquet(f"{tmp_ws}/b")


def test_no_task_reads_a_large_file_whole(spark, tmp_ws, monkeypatch):
    share = 1 << 17
    files = {"big.bin": os.urandom(1_000_003), "even.bin": os.urandom(4 * share), "small.bin": b"x"}
    bronze = landed(spark, tmp_ws, files, range_bytes=10_000)
    seen = f"{tmp_ws}/seen".removeprefix("file:")
    os.makedirs(seen)
    plain = L._digest

    def watched(batches):
        read = [0]

        def counted():
            for b in batches:
                read[0] += sum(len(x.as_py()) for x in b.column("content"))
                yield b
        yield from plain(counted())
        with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(read[0]))

    monkeypatch.setattr(L, "_digest", watched)
    monkeypatch.setattr(L, "TASK_BYTES", share, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it puts small shares together
    try:
        got = {r.source_file.split("/")[-1]: r for r in L.reassembled_digests(bronze).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {n: (r.n_bytes, r.sha256, r.crc32) for n, r in got.items()} == {
        n: (len(c), hashlib.sha256(c).hexdigest(), zlib.crc32(c)) for n, c in files.items()}
    assert max(told(seen)) <= len(files) * (share + 10_000 + 200)  # a round's share of every file, were they all in one task


def test_digest_of_what_is_there(spark, tmp_ws):
    data = os.urandom(300_000)
    bronze = landed(spark, tmp_ws, {"a.bin": data, "b.bin": data[:5]}, range_bytes=10_000)
    gap = bronze.filter("NOT (stem = 'a' AND offset BETWEEN 100000 AND 199999) AND NOT (stem = 'a' AND offset = 0)")
    got = {r.source_file.split("/")[-1]: r.sha256 for r in L.reassembled_digests(gap, task_bytes=30_000).collect()}
    assert got == {"a.bin": hashlib.sha256(data[10_000:100_000] + data[200_000:]).hexdigest(), "b.bin": hashlib.sha256(data[:5]).hexdigest()}
    assert L.reassembled_digests(bronze.filter("false")).collect() == []


def test_a_bronze_file_holds_ranges_that_follow_each_other(spark, tmp_ws):
    bronze = landed(spark, tmp_ws, {"a.bin": os.urandom(400_000), "b.bin": os.urandom(90_000)}, range_bytes=5000)
    runs = (bronze.groupBy(F.col("_metadata.file_path"), "source_file")
            .agg((F.max("offset") - F.min("offset")) / 5000 + 1 == F.count(F.lit(1))).collect())
    assert len(runs) > 3 and all(r[2] for r in runs)


def test_text_files_are_written_in_shares(spark, tmp_ws, monkeypatch):
    rows = spark.range(6000).select((F.col("id") * 7919 % 6000).alias("at"), F.when(F.col("id") % 10 < 8, "en").otherwise(F.concat(F.lit("x"), F.col("id") % 10)).alias("lang"))
    rows = rows.withColumn("text", F.when(F.col("at") % 50 == 0, None).otherwise(F.concat(F.lit("é "), "at", F.repeat(F.lit("z"), (F.col("at") % 90).cast("int")))))
    seen = f"{tmp_ws}/seen".removeprefix("file:")
    os.makedirs(seen)
    plain = T._append

    def watched(parts, target):
        def run(batches):
            size = [0]

            def counted():
                for b in batches:
                    size[0] += sum(b.column("length").to_pylist())
                    yield b
            yield from plain(parts, target)(counted())
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(size[0]))
        return run

    monkeypatch.setattr(T, "_append", watched)
    T.write_text_files(rows, "lang", ["at"], "text", f"{tmp_ws}/out", part_bytes=8000, round_bytes=40_000)
    want = {}
    for r in rows.orderBy("at").collect():
        want[f"{r.lang}.txt"] = want.get(f"{r.lang}.txt", "") + (r.text or "") + "\n"
    out = f"{tmp_ws}/out".removeprefix("file:")
    assert {n: open(f"{out}/{n}", newline="").read() for n in os.listdir(out)} == want
    size = len(want["en.txt"].encode())
    assert size > 4 * 40_000 and max(told(seen)) < size / 2
    with pytest.raises(FileExistsError):
        T.write_text_files(rows, "lang", ["at"], "text", f"{tmp_ws}/out")


def test_an_append_that_died_goes_on_where_the_file_ends(tmp_path):
    os.makedirs(tmp_path / "p/k=a")
    os.makedirs(tmp_path / "out")
    parts = {"k=a/part-0": b"first\n", "k=a/part-1": b"second\n"}
    for name, content in parts.items():
        (tmp_path / "p" / name).write_bytes(content)
    plan = pa.RecordBatch.from_pylist([{"name": "a.txt", "part": "k=a/part-0", "start": 0, "length": 6},
                                       {"name": "a.txt", "part": "k=a/part-1", "start": 6, "length": 7}])
    for left in (b"", b"fir", b"first\n", b"first\nsec", b"first\nsecond\n"):
        (tmp_path / "out/a.txt").write_bytes(left)
        list(T._append(f"file://{tmp_path}/p", f"file://{tmp_path}/out")(iter([plan])))
        assert (tmp_path / "out/a.txt").read_bytes() == b"first\nsecond\n"
    (tmp_path / "out/a.txt").write_bytes(b"fir")
    with pytest.raises(OSError, match="starts at 6"):
        list(T._append(f"file://{tmp_path}/p", f"file://{tmp_path}/out")(iter([plan.slice(1)])))


def test_files_of_a_query_are_whole(spark, sf):
    from medallion.plans import acceptance_storage as A
    got = {r.lang: r for r in A.q_land_ranges(spark, sf).collect()}
    texts = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "doc_id", "text").orderBy("doc_id").collect():
        texts[r.lang] = texts.get(r.lang, "") + r.text + "\n"
    assert {k: r.sha256 for k, r in got.items()} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}
    assert all(r.complete and r.crc_agrees for r in got.values())
