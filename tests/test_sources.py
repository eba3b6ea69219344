import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from kinograph.sources import landed, sinks
from kinograph.streaming import incremental


def test_discovered(spark, rows, tmp_path):
    pages = [
        {"results": [{"id": 1, "vote_count": 5, "popularity": 30.0, "release_date": "2024-01-02"}, {"id": 2, "vote_count": 50, "popularity": 1.0, "release_date": ""}], "total_pages": 2},
        {"results": [{"id": 1, "vote_count": 6, "popularity": 30.0, "release_date": "2024-01-02"}], "total_pages": 2},
    ]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    path = str(tmp_path / "p.json")
    assert rows(landed.discovered(spark, path), "id", "vote_count") == [(1, 6), (2, 50)]
    assert rows(landed.discovered(spark, path, least_votes=20), "id") == [(2,)]
    assert rows(landed.discovered(spark, path, released_from=F.lit("2024-01-01").cast("date"), least_popularity=20), "id") == [(1,)]
    (tmp_path / "bad.json").write_text('{"results": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        landed.discovered(spark, str(tmp_path / "bad.json")).collect()


def test_embedding_replies(spark, rows):
    df = spark.createDataFrame([(1, '{"data":[{"embedding":[2.0],"index":1},{"embedding":[1.0],"index":0}]}')], "batch int, j string")
    from kinograph import schemas

    assert rows(landed.embeddings_of(landed.parsed(df, "j", schemas.EMBEDDINGS))) == [(1, 0, [1.0]), (1, 1, [2.0])]


def test_retry():
    waits, left = [], [2]

    def call(batch):
        if left[0]:
            left[0] -= 1
            raise landed.Busy
        return batch

    assert landed.with_retry(call, tries=3, wait=21, sleep=waits.append)([1]) == [1]
    assert waits == [21, 42]
    with pytest.raises(landed.Busy):
        left[0] = 9
        landed.with_retry(call, tries=2, sleep=waits.append)([1])


def test_a_call_that_hangs_is_given_up():
    with pytest.raises(TimeoutError):
        landed.within(lambda _: time.sleep(30), 0.05)([1])
    assert landed.within(lambda x: x, 5)([1]) == [1]
    with pytest.raises(landed.Busy):
        landed.within(lambda _: (_ for _ in ()).throw(landed.Busy()), 5)([1])


def test_only_the_wanted_years_are_read(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    pages = [(y, [(y * 10, 50, 1.0, f"{y}-01-01")], 1) for y in (1999, 2000, 2001)]
    kind = "release_year int, results array<struct<id:bigint,vote_count:bigint,popularity:double,release_date:string>>, total_pages int"
    spark.createDataFrame(pages, kind).write.partitionBy("release_year").json(path)
    df = landed.discovered(spark, path, where=F.col("release_year") == 2000, partition="release_year int")
    assert rows(df, "id") == [(20000,)]
    assert "PartitionFilters: [isnotnull(release_year" in df._jdf.queryExecution().toString()


def test_pulled(spark, rows):
    df = spark.createDataFrame([("a",), ("bb",), ("ccc",)], "k string")
    got = landed.pulled(df, "k", lambda xs: [[float(len(x))] for x in xs], "array<double>", batch=2, concurrency=2)
    assert rows(got) == [("a", [1.0]), ("bb", [2.0]), ("ccc", [3.0])]


def test_versioned_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read(spark, path)
    sinks.merge(spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string"), path, "id")
    before = sinks.read(spark, path)
    sinks.merge(spark.createDataFrame([(2, "B"), (3, "c")], "id int, x string"), path, "id")
    assert rows(sinks.read(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(before) == [(1, "a"), (2, "b")]  # a reader of the old version is not disturbed
    sinks.replace(sinks.read(spark, path).where("id = 3"), path)
    assert rows(sinks.read(spark, path)) == [(3, "c")]


def test_a_writer_that_dies_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    sinks.replace(old, path)
    steps = ["write the version", "write the draft", "move the draft", "remove older pointers"]
    for step in range(4):
        table = f"{path}{step}"
        shutil.copytree(path, table)
        died = RuntimeError(steps[step])
        with pytest.MonkeyPatch.context() as patch:
            real = sinks._fs

            class Dying:
                def __init__(self, fs):
                    self.fs = fs

                def __getattr__(self, name):
                    if name == ["create", "create", "rename", "delete"][step]:
                        if step == 1:
                            self.fs.create(real(spark, f"{table}/_draft-half")[1], True).close()
                        raise died
                    return getattr(self.fs, name)

            patch.setattr(sinks, "_fs", lambda s, p: (*real(s, p)[:2], Dying(real(s, p)[2])))
            if step < 3:
                with pytest.raises(RuntimeError, match=steps[step]):
                    sinks.merge(spark.createDataFrame([(3, "c")], "id int, x string"), table, "id")
            else:  # the new table stands already
                sinks.merge(spark.createDataFrame([(3, "c")], "id int, x string"), table, "id")
        want = [(1, "a"), (2, "b")] + ([(3, "c")] if step == 3 else [])
        assert rows(sinks.read(spark, table)) == want
        sinks.merge(spark.createDataFrame([(4, "d")], "id int, x string"), table, "id")
        assert rows(sinks.read(spark, table)) == [*want, (4, "d")]


def test_versions_without_a_pointer_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    sinks.replace(one, path)
    for name in os.listdir(path):
        if "_at-" in name:
            os.remove(f"{path}/{name}")
    for call in (lambda: sinks.merge(one, path, "id"), lambda: sinks.read(spark, path), lambda: sinks.replace(one, path)):
        with pytest.raises(OSError, match="no pointer"):
            call()


def test_two_writers(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    sinks.replace(one, path)
    sinks.replace(one, path)
    with pytest.raises(OSError, match="another writer"):
        sinks.replace(one.limit(0), path, expected=1)
    assert rows(sinks.read(spark, path)) == [(1, "a")]


def test_new_ids(spark, rows):
    first = sinks.with_new_ids(spark.createDataFrame([("b", 1), ("d", 2)], "k string, x int"), None, "k", "id")
    assert rows(first, "k", "id") == [("b", 1), ("d", 2)]
    then = sinks.with_new_ids(spark.createDataFrame([("a", 1), ("d", 2), ("c", 3)], "k string, x int"), first, "k", "id")
    assert rows(then, "k", "id") == [("a", 3), ("c", 4), ("d", 2)]
    assert sinks.with_new_ids(first.select("k").limit(0), first, "k", "id").count() == 0


def test_counted(spark, tmp_path):
    rows, count = sinks.counted(spark.range(10), F.col("id") > 6)
    rows.write.parquet(str(tmp_path / "x"))
    assert count() == (7, 3)


def test_rails_by_partition(spark, rows, tmp_path):
    path = str(tmp_path / "n")
    sinks.write_rails(spark.createDataFrame([("a", "r1"), ("b", "r2")], "source_movie_id string, recommendation_type string"), path)
    sinks.write_rails(spark.createDataFrame([("c", "r2")], "source_movie_id string, recommendation_type string"), path)
    assert rows(spark.read.parquet(path)) == [("a", "r1"), ("c", "r2")]


def test_audit(spark, rows, tmp_path):
    path = str(tmp_path / "runs")

    def fail():
        raise RuntimeError("no luck")

    sinks.audited(spark, "a", path, lambda: (3, 1))
    sinks.audited(spark, "a", path, lambda: (4, 0), dry_run=True)
    with pytest.raises(RuntimeError):
        sinks.audited(spark, "b", path, fail)
    assert rows(spark.read.parquet(path), "run_type", "status", "rows_processed", "error_message") == sorted([("a", "success", 3, None), ("b", "failed", 0, "no luck")], key=repr)


def test_stream_is_idempotent(spark, rows, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([("a",), ("b",), ("a",)], "id string").write.parquet(src)
    run = lambda: incremental.process_new(spark, src, "id string", out, state, lambda df: df.withColumn("n", F.length("id")), "id").awaitTermination()
    run()
    spark.createDataFrame([("b",), ("cc",)], "id string").write.mode("append").parquet(src)
    run()
    run()
    assert rows(spark.read.parquet(out), "id", "n") == [("a", 1), ("b", 1), ("cc", 2)]
