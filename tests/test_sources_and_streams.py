"""Repeated, interrupted and limited runs of sinks and streams; session rules."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from larkspar import session
from larkspar.session import new_folder
from larkspar.sources import databases, folder_log, messages
from larkspar.sources.catalog_tables import setting
from larkspar.sources.files import stage, write_report
from larkspar.sources.manifests import ManifestLog, open_folder
from larkspar.streaming.row_writer import LineWriter
from larkspar.streaming.run import appended, appended_every, completed
from larkspar.streaming.transforms import camera_counts, windowed, with_gaps, with_saved_totals


def test_database_batch_written_twice_counts_once(spark):
    url, table = databases.database_url(spark), "TWICE"
    batch = spark.range(50).withColumn("batch_id", F.lit(3).cast("long"))
    for _ in range(2):
        databases.delete_batch(spark, url, table, "batch_id", 3)
        databases.write_table(batch, url, table, mode="append")
    databases.write_table(batch.withColumn("batch_id", F.lit(4).cast("long")), url, table, mode="append")
    got = {r["batch_id"]: r["count"] for r in databases.read_table(spark, url, table).groupBy("batch_id").count().collect()}
    assert got == {3: 50, 4: 50}


def test_partitioned_read_keeps_rows_outside_the_bounds(spark):
    url = databases.database_url(spark)
    databases.write_table(spark.range(200), url, "BOUNDS")
    rows = databases.read_partitioned(spark, url, "BOUNDS", "id", 50, 60, 5)
    assert rows.rdd.getNumPartitions() == 5
    assert rows.agg(F.count("*"), F.min("id"), F.max("id")).first()[:] == (200, 0, 199)


def test_cluster_needs_a_named_database_and_folder(monkeypatch):
    context = SimpleNamespace(
        master="yarn", getConf=lambda: SimpleNamespace(get=lambda key: None), getCheckpointDir=lambda: None
    )
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.larkspar.jdbc.url"):
        databases.database_url(cluster)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(cluster)


@pytest.mark.parametrize("master, in_process", [
    ("local", True), ("local[4]", True), ("local[*]", True), ("local[2,3]", True),
    ("local-cluster[3,2,3000]", False), ("spark://host:7077", False),
])
def test_in_process_database_is_for_sessions_of_one_process(master, in_process):
    """Executors of ``local-cluster`` are processes of their own, each with an empty database of that name."""
    named = {}
    conf = SimpleNamespace(get=lambda key, default=None: named.get(key, default))
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=conf)
    if in_process:
        assert databases.database_url(cluster) == databases.IN_PROCESS
    else:
        with pytest.raises(RuntimeError, match="spark.larkspar.jdbc.url"):
            databases.database_url(cluster)
    named[databases.URL_SETTING] = "jdbc:other://host/db"
    assert databases.database_url(cluster) == "jdbc:other://host/db"


def test_named_checkpoint_folder_is_used():
    chosen = []
    context = SimpleNamespace(
        master="yarn", getConf=lambda: SimpleNamespace(get=lambda key: "hdfs://name/shared/"),
        getCheckpointDir=lambda: None, setCheckpointDir=chosen.append,
    )
    assert session.shared_root(SimpleNamespace(sparkContext=context)) == "hdfs://name/shared"
    assert chosen == ["hdfs://name/shared/"]


def test_setting_is_restored(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    with pytest.raises(ValueError):
        with setting(spark, key, "static"):
            assert spark.conf.get(key) == "static"
            raise ValueError
    assert spark.conf.get(key) == before


def test_report_has_the_files_its_caller_names(spark):
    one = new_folder(spark, "report")
    write_report(spark.range(10), one)
    assert len(spark.read.json(one).inputFiles()) == 1
    path = new_folder(spark, "report")
    write_report(spark.range(10), path, files=4)
    assert len(spark.read.json(path).inputFiles()) <= 4
    rows = spark.read.json(path)
    assert rows.count() == 10 and rows.select(F.input_file_name()).distinct().count() > 1


def test_parallel_reads_ask_the_database_for_the_ends(spark):
    """Tables and subqueries in several partitions, keys without a value included, and empty tables."""
    url = databases.database_url(spark)
    rows = spark.range(100, 400).select(F.when(F.col("id") % 50 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    databases.write_table(rows, url, "ENDS")
    whole = databases.read_parallel(spark, url, "ENDS", "k", partitions=6)
    assert whole.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    per_part = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_part) == 6 and max(per_part) < 80
    part = databases.read_parallel(spark, url, '(SELECT "k" FROM ENDS WHERE "v" < 200) part', "k", partitions=3)
    assert part.rdd.getNumPartitions() == 3 and part.count() == 100
    databases.write_table(rows.where("v < 0"), url, "ENDS")
    assert databases.read_parallel(spark, url, "ENDS", "k").count() == 0


def test_distinct_pairs_are_forgotten_after_the_horizon(spark):
    """State stays bounded over many batches, and a pair that comes within the horizon is given once."""
    from larkspar.streaming.transforms import distinct_within

    drops, out, log = (new_folder(spark, name) for name in ("drops", "pairs", "stream-log"))
    start = 1_700_000_000
    for day in range(6):  # 40 pairs of its own each day, one pair every day, one with a null, and copies of all
        rows = [(f"d{day}", i % 40, start + day * 86_400 + i) for i in range(120)] + [("all", 1, start + day * 86_400)] * 3
        rows += [(None, 2, start + day * 86_400)] * 2
        frame = spark.createDataFrame(rows, "a string, b int, s long").select("a", "b", F.timestamp_seconds("s").alias("ts"))
        frame.coalesce(1).write.mode("append").parquet(drops)
        stream = spark.readStream.schema("a string, b int, ts timestamp").parquet(drops)
        pairs = distinct_within(stream, ["a", "b"], "ts", "36 hours")
        query = pairs.writeStream.format("parquet").option("path", out).option("checkpointLocation", log)
        running = query.trigger(availableNow=True).start()
        running.awaitTermination()
        held = running.lastProgress.stateOperators[0].numRowsTotal
    got = [tuple(r) for r in spark.read.schema("a string, b int").parquet(out).collect()]
    assert sorted(p for p in got if p[0] not in ("all", None)) == sorted((f"d{d}", b) for d in range(6) for b in range(40))
    assert 1 <= got.count(("all", 1)) <= 4 and 1 <= got.count((None, 2)) <= 4
    assert held < 3 * 42


def test_staged_files_follow_the_input(spark):
    wide = stage(spark.range(0, 90, 1, 9), new_folder(spark, "staged"), "json", 4)
    narrow = stage(spark.range(0, 90, 1, 1), new_folder(spark, "staged"), "json", 4)
    assert (wide.files, narrow.files, wide.per_trigger(3)) == (9, 4, 3)


def test_manifests_survive_snapshots_and_repeats(tmp_path):
    log = ManifestLog(str(tmp_path / "log"), every=3)
    assert log.last() == -1 and list(log.entries()) == []
    for number in range(11):
        log.add(number, [{"file": f"{number}-{i}"} for i in range(number % 3)])
        log.add(number, [{"file": f"{number}-{i}"} for i in range(number % 3)])  # a repeated batch
    want = [(n, f"{n}-{i}") for n in range(11) for i in range(n % 3)]
    read = lambda *span: [(e["number"], e["file"]) for e in log.entries(*span)]
    assert log.last() == 10 and read() == want
    for after in range(-1, 11):
        for until in range(after, 11):
            assert read(after, until) == [w for w in want if after < w[0] <= until]
    left = sorted(f.name for f in (tmp_path / "log").iterdir())
    assert sum(n.endswith(".snapshot") for n in left) <= 2 and sum(n.endswith(".json") for n in left) <= 2 * 3


def _put(folder, name, ids, age=0):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({"id": pa.array(ids, pa.int64())}), folder / name)
    os.utime(folder / name, (1_700_000_000 - age, 1_700_000_000 - age))


def _ids(reader, start, end):
    return sorted(i for p in reader.partitions(start, end) for b in reader.read(p) for i in b.column("id").to_pylist())


def test_source_with_late_equally_old_and_deleted_files(tmp_path):
    """No id is lost or repeated, whatever the times of the files, and a batch takes no more than its limit."""
    folder, log = tmp_path / "in", str(tmp_path / "log")
    make = lambda: folder_log.FolderReader(str(folder), log, max_files=2, every=2)
    reader = make()
    start = reader.initialOffset()
    assert reader.latestOffset() == start  # no folder yet
    for name in "cab":
        _put(folder, f"{name}.parquet", [ord(name)])
    first = reader.latestOffset()
    assert len(reader.partitions(start, first)) == 2 and _ids(reader, start, first) == [97, 98]
    _put(folder, "older.parquet", [1], age=1000)
    second = reader.latestOffset()
    assert _ids(reader, first, second) == [1, 99]
    (folder / "a.parquet").unlink()  # deleted after it was read: later batches do not move
    _put(folder, "same-time.parquet", [2])
    _put(folder, "_hidden.parquet", [3])
    reader = make()  # a restart
    third = reader.latestOffset()
    assert _ids(reader, second, third) == [2] and _ids(reader, first, second) == [1, 99]
    assert reader.latestOffset() == third and reader.partitions(third, third) == []
    with pytest.raises(FileNotFoundError):
        _ids(reader, start, first)


def test_source_with_a_limit_drains_in_several_batches(spark):
    path, out = new_folder(spark, "in"), new_folder(spark, "out")
    spark.range(0, 60, 1, 6).write.parquet(path)

    def drained():
        stream = folder_log.read_stream(spark, path, "id long", f"{out}-source", max_files=2, snapshot_every=2)
        return sorted(r["id"] for r in appended_every(stream, out, f"{out}-log").collect())

    assert drained() == list(range(60))
    spark.range(60, 70, 1, 1).write.mode("append").parquet(path)
    assert drained() == list(range(70))
    assert ManifestLog(folder_log.qualified(spark, f"{out}-source")).last() == 3
    assert spark.read.text(f"{out}-log/commits").count() >= 4


def test_source_over_sink(spark):
    """Committed batches only: partitions without rows write nothing, files of failed attempts stay unseen."""
    path = folder_log.qualified(spark, new_folder(spark, "log"))
    folder_log.register(spark)
    source = stage(spark.range(40), new_folder(spark, "ids"), "json", 4)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(source.path).where("id < 30")
    run = stream.writeStream.format("folder_log").option("path", path).option("checkpointLocation", new_folder(spark, "cp"))
    run.option("snapshot_every", 2).trigger(availableNow=True).start().awaitTermination()
    system, root = open_folder(path)
    good = [i.path for i in system.get_file_info(folder_log.fs.FileSelector(root)) if i.base_name.endswith(".parquet")]
    assert 3 <= len(good) <= 4
    system.copy_file(good[0], f"{root}/left-over.parquet")
    assert sorted(r["id"] for r in folder_log.read_committed(spark, path, stream.schema).collect()) == list(range(30))
    again = folder_log.read_stream(spark, path, "id long", new_folder(spark, "source-log"))
    assert sorted(r["id"] for r in appended(again).collect()) == list(range(30))


def test_bare_paths_follow_the_shared_folder(spark, monkeypatch):
    from larkspar import session

    for root, want in (("hdfs://name:9/cp", "hdfs://name:9/x/y"), ("s3a://b/cp", "s3a://b/x/y"), ("file:/cp", "file:/x/y"), ("file:///cp", "file:///x/y"), ("/cp", "file:/x/y")):
        monkeypatch.setattr(session, "shared_root", lambda _, root=root: root)
        assert folder_log.qualified(spark, "/x/y") == want
        assert folder_log.qualified(spark, "gs://b/x") == "gs://b/x"


def test_row_writer_replaces_a_repeated_attempt(tmp_path):
    for rows in ([1, 2], [1, 2, 3]):
        writer = LineWriter(str(tmp_path))
        assert writer.open(0, 7)
        for i in rows:
            writer.process(Row(id=i))
        writer.close(None)
    failed = LineWriter(str(tmp_path))
    failed.open(0, 7)
    failed.process(Row(id=9))
    failed.close(ValueError("lost"))
    (only,) = tmp_path.iterdir()
    assert [json.loads(line)["id"] for line in only.read_text().splitlines()] == [1, 2, 3]


def test_starting_offsets_and_topic_patterns(spark):
    rows = [("topic.a", p, o) for p in (0, 1) for o in range(5)] + [("topicXa", 0, 1), ("other", 0, 9)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long")
    assert messages.subscribe(log, pattern="topic\\..*").count() == 10
    assert messages.subscribe(log, topics=["other"]).count() == 1
    assert messages.from_offsets(log, {("topic.a", 0): 3, ("topic.a", 1): 4}).count() == 3
    ranges = {(r[0], r[1]): (r[2], r[3]) for r in messages.offset_ranges(log).collect()}
    assert ranges["topic.a", 0] == (0, 5) and ranges["other", 0] == (9, 10)


def test_saved_totals_without_new_input_stay(spark):
    # fixed values: the saved totals of the documented job
    saved = spark.createDataFrame([("hadoop", 100), ("spark", 25)], "word string, n long")
    new = spark.createDataFrame([("spark", 1), ("spark", 1), ("flink", 1)], "word string, n long")
    assert {tuple(r) for r in with_saved_totals(saved, new, "word", "n").collect()} == {("hadoop", 100), ("spark", 27), ("flink", 1)}


# Fields and layout of the camera message.
CAMERA = """{"devices": {"cameras": {"device_id": "awJo6rH", "last_event": {"has_sound": true, "has_motion": true,
"has_person": true, "start_time": "2016-12-29T00:00:00.000Z", "end_time": "2016-12-29T18:42:00.000Z"}}}}"""


def test_camera_message(spark):
    without = CAMERA.replace('"has_person": true', '"has_person": false')
    df = spark.createDataFrame([(CAMERA.encode(),), (CAMERA.encode(),), (without.encode(),)], "value binary")
    (row,) = camera_counts(df).collect()
    assert (row["has_person"], str(row["start_time"]), row["n"]) == (True, "2016-12-29", 2)


@pytest.fixture(scope="module")
def ticks(spark):
    return spark.range(120).select((F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))).alias("ts"))


def test_windows_longer_and_shorter_than_the_slide(ticks):
    n = F.count(F.lit(1))
    longer = windowed(ticks, "ts", "30 seconds", "10 seconds", [], n=n)
    assert longer.agg(F.sum("n")).first()[0] == 3 * 120
    shorter = windowed(with_gaps(ticks, "ts", 4, 10), "ts", "10 seconds", None, [], n=n)
    assert shorter.agg(F.sum("n")).first()[0] == 48


@pytest.mark.parametrize("batches", [1, 4])
def test_stream_equals_batch(spark, ticks, batches):
    staged = stage(ticks, new_folder(spark, "ticks"), "parquet", 4)
    stream = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", staged.per_trigger(batches)).parquet(staged.path)
    total = lambda df: windowed(df, "ts", "30 seconds", "10 seconds", [], n=F.count(F.lit(1)))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(completed(total(stream))) == rows(total(ticks))
    assert rows(appended(stream)) == rows(ticks)


def _words(spark, path):
    return spark.readStream.schema("word string").option("maxFilesPerTrigger", 2).json(path)


def _longest(old, rows):
    """A state of two columns that no sum could keep: the longest run of one key, and its rows so far."""
    best, n = (old.best, old.n) if old else (None, 0)
    for row in rows:
        n += row.n
        best = max(x for x in (best, row.n) if x is not None)
    return None if best == 13 else (best, n)


def test_user_given_state_update(spark):
    """Saved values, null keys, keys without input, forgotten keys and a restart."""
    from larkspar.streaming.state import PROVIDER, fold_stream

    saved = spark.createDataFrame([("hadoop", 100, 7), (None, 1, 1), ("spark", 2, 5)], "word string, best long, n long")
    drops, log = new_folder(spark, "drops"), new_folder(spark, "stream-log")
    before = spark.conf.get(PROVIDER)

    def run(rows):
        if rows:
            spark.createDataFrame(rows, "word string, n long").coalesce(1).write.mode("append").json(drops)
        stream = spark.readStream.schema("word string, n long").option("maxFilesPerTrigger", 1).json(drops)
        got = fold_stream(stream, "word", "best long, n long", _longest, saved=saved, checkpoint=log)
        assert got.columns == ["word", "best", "n"]
        return {r["word"]: (r["best"], r["n"]) for r in got.collect()}

    first = {"hadoop": (100, 7), None: (4, 6), "spark": (9, 16), "flink": (3, 3)}
    assert run([("spark", 9), ("spark", 2), (None, 4), (None, 1), ("flink", 3)]) == first
    assert run([]) == first
    assert run([("flink", 13), (None, 2)]) == {"hadoop": (100, 7), None: (4, 8), "spark": (9, 16)}
    assert run([("flink", 1)])["flink"] == (1, 1)
    assert spark.conf.get(PROVIDER) == before


def test_state_of_a_stream_without_input_is_the_saved_one(spark, tmp_path):
    from larkspar.streaming.state import fold_stream

    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("word string, n long").json(str(tmp_path / "in"))
    keep = lambda old, rows: (sum(r.n for r in rows),)
    saved = spark.createDataFrame([("a", 1), (None, 2)], "word string, n long")
    assert sorted(map(tuple, fold_stream(stream, "word", "n long", keep, saved=saved).collect()), key=str) == [("a", 1), (None, 2)]
    assert fold_stream(stream, "word", "n long", keep).collect() == []


def test_rows_of_a_frequent_key_are_combined_before_they_are_dealt_out(spark):
    import pyarrow as pa

    from larkspar.streaming.state import fold_stream, summed

    large = 2**61 + 1
    rows = pa.table({"k": ["a", None, "a", None, "b"], "n": [large, None, 5, 7, None]})
    assert {r["k"]: r["n"] for r in summed("k", "n")(rows).to_pylist()} == {"a": large + 5, None: 7, "b": 0}
    drops = new_folder(spark, "drops")
    keyed = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.lit(1).cast("long").alias("n"))
    keyed.repartition(4).write.json(drops)
    seen = lambda old, rows: tuple(a + b for a, b in zip(old or (0, 0), map(sum, zip(*((r.n, 1) for r in rows)))))
    stream = spark.readStream.schema("k string, n long").json(drops)
    got = {r["k"]: r for r in fold_stream(stream, "k", "n long, parts long", seen, combine=summed("k", "n")).collect()}
    hot = keyed.where("k = 'hot'").count()
    assert got["hot"]["n"] == hot and got["hot"]["parts"] <= 8
    assert len(got) == keyed.select("k").distinct().count() and sum(r["n"] for r in got.values()) == 40_000


FROM_ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from __spark_entry__ import queries
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for key in ("map_partitions", "src_stream_custom"):
    print(key, queries()[key](spark, "/root/testdata/sf0.001").count())
"""


def test_python_workers_find_the_package_from_any_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", FROM_ELSEWHERE, root], cwd=tmp_path, capture_output=True, text=True, timeout=240
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "map_partitions 6000" in done.stdout and "src_stream_custom 1000" in done.stdout


def test_restart_without_input_gives_the_last_result(spark, tmp_path):
    from larkspar.streaming.run import completed

    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    (tmp_path / "in").mkdir()

    def totals():
        return completed(spark.readStream.schema("k string").json(source).groupBy("k").count(), checkpoint=log)

    assert totals().count() == 0
    (tmp_path / "in" / "a.json").write_text('{"k": "x"}\n{"k": "x"}\n{"k": null}\n')
    first = sorted(map(tuple, totals().collect()), key=str)
    assert first == [("x", 2), (None, 1)] or first == [(None, 1), ("x", 2)]
    assert sorted(map(tuple, totals().collect()), key=str) == first
