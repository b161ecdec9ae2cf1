"""Keyed tables, the index of a stream, functions in SQL."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.functions import sql, xml
from corpusloom.operators.commits import KeyedTable
from corpusloom.plans import sync
from corpusloom.streaming import incremental


def test_an_upsert_rewrites_its_buckets_only(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "k string, v int", "k", buckets=16)
    rows = lambda some, v: spark.createDataFrame([(f"k{i}", v) for i in some], "k string, v int")
    assert len(t.upsert(rows(range(200), 0))) == 16 and t.table().count() == 200
    touched = t.upsert(rows([3, 300], 1))
    assert len(touched) <= 2
    batches = sorted(p.name for p in (tmp_path / "t/rows").glob("batch=*"))
    assert sorted(int(p.name.partition("=")[2]) for p in (tmp_path / "t/rows" / batches[-1]).glob("bucket=*")) == touched
    found = {r.k: r.v for r in t.table().collect()}
    assert len(found) == 201 and (found["k3"], found["k300"], found["k4"]) == (1, 1, 0)
    for v in range(2, 6):
        t.upsert(rows(range(200), v))
    assert t.vacuum() > 0 and {r.v for r in t.table().where("k <> 'k300'").collect()} == {5} and t.table().count() == 201
    assert t.upsert(rows([], 0)) == []
    with pytest.raises(ValueError, match="1 rows without k"):
        t.upsert(spark.createDataFrame([(None, 1)], "k string, v int"))


def test_an_upsert_that_is_broken_off_is_not_seen(spark, tmp_path, monkeypatch):
    t = KeyedTable(spark, str(tmp_path / "t"), "k string, v int", "k", buckets=4)
    t.upsert(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"))
    monkeypatch.setattr(t.log, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("away")))
    with pytest.raises(OSError):
        t.upsert(spark.createDataFrame([("a", 2)], "k string, v int"))
    again = KeyedTable(spark, str(tmp_path / "t"), "k string, v int", "k", buckets=4)
    assert sorted(map(tuple, again.table().collect())) == [("a", 1), ("b", 1)]


def test_files_that_are_there_are_taken_in(spark, tmp_path):
    (tmp_path / "m/files/old").mkdir(parents=True)
    for name in ("PMC1.tar.gz", "PMC2.tar.gz", "x.tar.gz"):
        (tmp_path / "m/files/old" / name).write_bytes(b"12345")
    remote = spark.createDataFrame([(f"PMC{i}", f"oa/PMC{i}.tar.gz", "oa", "2024-01-01") for i in range(3)], "accession_id string, filename string, subset string, last_updated string")
    m = sync.Mirror(spark, str(tmp_path / "m"))
    assert sorted((r.filename, r.matched) for r in m.take_in(remote).collect()) == [("old/PMC1.tar.gz", True), ("old/PMC2.tar.gz", True), ("old/x.tar.gz", False)]
    assert sorted((r.accession_id, r.size_bytes) for r in m.manifest().collect()) == [("PMC1", 5), ("PMC2", 5)]
    assert [r.accession_id for r in m.pending(remote).collect()] == ["PMC0"]
    out = spark.createDataFrame([("PMC9", "../../etc/x", "oa", "2024-01-01")], remote.schema)
    done = m.sync(out, lambda name: b"x")
    assert done.failed == ("../../etc/x",) and "leads out" in done.reasons["../../etc/x"]


def test_an_index_stream_runs_again(spark, tmp_path):
    def put(n, values):
        spark.createDataFrame([(v,) for v in values], "doi string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")

    def run(checkpoint="checkpoint"):
        stream = spark.readStream.schema("doi string").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        incremental.index_stream(stream, f"{tmp_path}/index", f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", buckets=8).awaitTermination()
        return sorted((r.doi or "") for r in spark.read.parquet(f"{tmp_path}/out").collect())

    put(1, ["10.1/a", "10.1/A", None, "10.1/b"])
    assert [x.lower() for x in run()] == ["", "10.1/a", "10.1/b"]
    put(2, ["10.1/b", "10.1/c", None])
    expected = ["", "", "10.1/a", "10.1/b", "10.1/c"]
    assert [x.lower() for x in run()] == expected and [x.lower() for x in run()] == expected
    assert sorted(r.key for r in incremental._index(spark, f"{tmp_path}/index", 8).table("keys").collect()) == ["10.1/a", "10.1/b", "10.1/c"]


def test_an_index_stream_passes_no_known_doi_in_whatever_order_its_rows_come(spark, tmp_path, monkeypatch):
    """Executors' shuffles bring rows in any order, each time they are computed; here any row of a key may come first."""
    frame, place = type(spark.range(1)), F.udf(lambda: random.SystemRandom().random(), "double").asNondeterministic()

    def any_of_each(self, subset):
        drawn = self.withColumn("__place", place()).withColumn("__n", F.row_number().over(Window.partitionBy(*subset).orderBy("__place")))
        return drawn.where("__n = 1").drop("__place", "__n")

    monkeypatch.setattr(frame, "dropDuplicates", any_of_each)
    for n in (1, 2):
        rows = [(f"10.1/{k}", k * 100 + i) for i in range(20) for k in range(30 * n)]
        spark.createDataFrame(rows, "doi string, at long").repartition(3).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema("doi string, at long").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        incremental.index_stream(stream, f"{tmp_path}/index", f"{tmp_path}/out", f"{tmp_path}/checkpoint", buckets=4).awaitTermination()
    found = sorted(r.doi for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert found == sorted(f"10.1/{k}" for k in range(60))


def test_state_of_a_distinct_stream_has_a_horizon(spark, tmp_path):
    rows = [("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-03-01")]
    spark.createDataFrame(rows, "k string, t string").withColumn("t", F.to_timestamp("t")).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, t timestamp").parquet(f"{tmp_path}/in")
    q = incremental.distinct_stream(stream, "k", time="t", horizon="10 days").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]


def test_functions_in_sql(spark):
    sql.register(spark)
    article = "<article><front><article-meta><article-id pub-id-type='doi'>10.1/X</article-id><article-title>T</article-title></article-meta></front><body>b</body></article>"
    spark.createDataFrame([(1, article, "kept"), (2, "<a", "kept"), (3, None, "kept")], "n int, xml string, status string").createOrReplaceTempView("articles_of_test")
    found = spark.sql(f"select * from validate_with(table(articles_of_test), 'xml', '{sql.JATS}') order by n").collect()
    assert [(r.n, r.status, r.body_chars) for r in found] == [(1, "valid", 1), (2, "invalid", 0), (3, "invalid", 0)]
    assert found[0].asDict().keys() == {"n", "xml", "status", "body_chars", "errors"} and found[0].errors == xml.validate(article)["errors"]
    assert [r.doi for r in spark.sql("select jats_facts(xml).doi as doi from articles_of_test order by n").collect()] == ["10.1/X", None, None]
    for wrong in ("'no', 'corpusloom.functions.xml:facts'", "'xml', 'corpusloom.functions.xml:nothing'"):
        with pytest.raises(Exception, match="no column|not a validator"):
            spark.sql(f"select * from validate_with(table(articles_of_test), {wrong})")
