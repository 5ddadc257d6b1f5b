"""Files laid down by tasks, and folders listed by few of them."""

import os

import pytest
from pyspark.sql import functions as F

from vocalis.operators import split as SP
from vocalis.plans import queries as Q
from vocalis.sources import audio, sinks

ODD = ["a b.wav", "x=1%2.wav", "é.wav", "q'\"#*/:?\\{[]^}\x7f\t.wav", "twice", "twice", None, ""]


def _files(root):
    found = []
    for d, _, names in os.walk(root):
        for n in names:
            if not n.startswith(("_", ".")):
                found.append((os.path.relpath(d, root), open(os.path.join(d, n), "rb").read()))
    return sorted(found)


def test_files_are_those_of_the_text_sink(spark, tmp_path):
    rows = [(n, None if k == 2 else bytes([0, 255, 10, k])) for k, n in enumerate(ODD)]
    df = spark.createDataFrame(rows, "clip string, content binary").repartition(3)
    sinks.write_files(df, str(tmp_path / "new"), "clip", "content")
    (df.select("clip", df.content.cast("string").alias("value")).write.partitionBy("clip")
       .option("maxRecordsPerFile", 1).text(str(tmp_path / "old")))
    assert _files(tmp_path / "new") == _files(tmp_path / "old") and len(_files(tmp_path / "new")) == len(ODD)
    # no hidden files, of checksums or of the commit, beside them
    assert not [n for _, _, names in os.walk(tmp_path / "new") for n in names if n.startswith(".")]


def test_a_repeated_write_replaces_its_files(spark, tmp_path):
    df = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("a", b"3")], "clip string, content binary").coalesce(1)
    for path in (str(tmp_path / "x"), "file:" + str(tmp_path / "x")):
        sinks.write_files(df, path, "clip", "content")
        assert _files(tmp_path / "x") == [("clip=a", b"1\n"), ("clip=a", b"3\n"), ("clip=b", b"2\n")]


def test_no_rows_leave_an_empty_folder(spark, tmp_path):
    sinks.write_files(spark.createDataFrame([], "clip string, content binary"), str(tmp_path / "none"), "clip", "content")
    assert audio.scan_audio(spark, str(tmp_path / "none"), "*.txt").count() == 0


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    for k in range(300):
        os.makedirs(tmp_path / "in" / f"clip={k}")
        (tmp_path / "in" / f"clip={k}" / "f.txt").write_bytes(b"x")
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    files = audio.scan_audio(spark, str(tmp_path / "in"), "*.txt")
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing")
             for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert files.count() == 300 and max(tasks) <= max(32, 4 * spark.sparkContext.defaultParallelism) < 300


def test_ranges_come_from_few_tasks(spark):
    files = spark.range(0, 2000, 1, 300).select(F.format_string("f%05d", "id").alias("path"), F.lit(10).alias("length"))
    got = SP.byte_ranges(files, 1000)
    assert {(r["part"], r["n"]) for r in got.groupBy("part").agg(F.count("*").alias("n")).collect()} == {(k, 100) for k in range(20)}


@pytest.mark.parametrize("n, most", [(50, 200), (8000, 400)])
def test_stream_batches_do_not_grow_in_number(spark, tmp_path, monkeypatch, n, most):
    seen = {}

    def stop(session, root, glob, max_files):
        seen["max_files"] = max_files
        raise InterruptedError

    spark.range(n).select(F.col("id").alias("vec_id")).write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(Q.V, "wav_files", lambda *a: str(tmp_path))
    monkeypatch.setattr(audio, "read_stream_audio", stop)
    with pytest.raises(InterruptedError):
        Q.q_audio_stream(spark, str(tmp_path))
    assert seen["max_files"] == most


def _files_of_many_lengths(root):
    os.makedirs(root / "in" / "a b%20#")
    rows = {}
    for k, size in enumerate([1, 4, 7, 8, 9, 12, 5000]):
        rows[f"é {k}.wav"] = data = bytes((k * 31 + i) % 256 for i in range(size))
        (root / "in" / "a b%20#" / f"é {k}.wav").write_bytes(data)
    return {name: (len(d), d[:4].hex().upper(), d[-4:].hex().upper()) for name, d in rows.items()}


@pytest.mark.parametrize("store", ["mounted", "viewfs"])
def test_ends_of_long_files_are_those_of_their_content(spark, tmp_path, store):
    want, root = _files_of_many_lengths(tmp_path), str(tmp_path / "in")
    if store == "viewfs":  # nothing but Hadoop's client reaches it
        spark.sparkContext._jsc.hadoopConfiguration().set(
            "fs.viewfs.mounttable.ends.link./in", "file://" + str(tmp_path / "in"))
        root = "viewfs://ends/in"
    head, tail = audio.file_ends()
    files = audio.scan_audio(spark, root)
    got = audio.ends_of_long(files, longest=8)
    assert got.columns == files.columns
    assert {r["path"].split(":")[0] for r in got.collect()} == {"file" if store == "mounted" else "viewfs"}
    rows = {r["f"]: (r["length"], r["h"], r["t"]) for r in got.select(
        audio.file_name().alias("f"), "length", head.alias("h"), tail.alias("t")).collect()}
    assert rows == want
    assert max(len(r["content"]) for r in got.collect()) == 8
    times = {r["path"]: r["modificationTime"] for r in files.collect()}
    assert {r["path"]: r["modificationTime"] for r in got.collect()} == times
    with pytest.raises(ValueError):
        audio.ends_of_long(files, longest=7)


def test_table_files_above_2_gb(spark, tmp_path):
    """Spark refuses to read a file of that length as one value."""
    with open(tmp_path / "lineitem.parquet", "wb") as f:
        f.write(b"PAR1")
        f.seek(2**31 + 100)  # a hole, which takes no room
        f.write(b"PAR1")
    (tmp_path / "nation.parquet").mkdir()
    (tmp_path / "nation.parquet" / "part-0.parquet").write_bytes(b"PAR1xPAR2")
    got = Q.q_table_files(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("lineitem.parquet", "50415231", "50415231"), ("part-0.parquet", "50415231", "50415232")]


def test_no_files_have_no_ends(spark, tmp_path):
    assert audio.ends_of_long(audio.scan_audio(spark, str(tmp_path))).count() == 0
