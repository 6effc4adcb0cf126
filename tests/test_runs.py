import json
import time

import pytest
from pyspark.sql import functions as F

from matchloom.config import Config
from matchloom.operators.measures import Measures
from matchloom.plans.progress import watched
from matchloom.plans.runs import RunStore
from matchloom.sources import publish, tables


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def test_measures_taken_while_writing(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("", 2), (None, 1), ("b", 3)], "t string, k int").repartition(3)
    m = Measures(["t"], {"k": ["1", "2"]})
    m.on(df.orderBy("t")).write.parquet(str(tmp_path / "x"))
    assert m.result() == {"rows": 4, "filled t": 2, "k=1": 2, "k=2": 1, "k=other": 1}
    none = Measures(["t"], {"k": ["1"]})
    none.on(df.where("false")).write.parquet(str(tmp_path / "y"))
    assert none.result() == {"rows": 0}


def test_measures_of_rows_that_stand_for_several(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 5), ("", 2, 7), (None, 1, 3_000_000_000)], "t string, k int, n long")
    m = Measures(["t"], {"k": ["1", "3"]}, weight="n")
    m.on(df).write.parquet(str(tmp_path / "x"))
    assert m.result() == {"rows": 3_000_000_012, "filled t": 5, "k=1": 3_000_000_005, "k=other": 7}
    none = Measures(weight="n")
    none.on(df.where("false")).write.parquet(str(tmp_path / "y"))
    assert none.result() == {"rows": 0}


def test_one_file_has_the_bytes_of_one_task(spark, tmp_path):
    rows = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("a key"), F.when(F.col("id") % 7 > 0, F.concat(F.lit('q "x"\t\n'), "id")).alias("b"))
    tables.write_tsv(rows.repartition(7), str(tmp_path / "out"), single=True, order=["a key"])
    rows.orderBy("a key").coalesce(1).write.options(sep="\t", quote='"', escape='"', emptyValue="", nullValue="", header=True).csv(str(tmp_path / "one"))
    bytes_of = lambda f: b"".join(p.read_bytes() for p in sorted((tmp_path / f).glob("part*.csv")))
    assert bytes_of("out") == bytes_of("one") and len(list((tmp_path / "out").glob("part*.csv"))) == 1
    assert names(tmp_path) == ["one", "out"]
    tables.write_tsv(rows.where("false"), str(tmp_path / "out"), single=True, order=["a key"])
    assert bytes_of("out") == b"a key\tb\n"


class Concatenates:
    """A store that links files behind an existing one, as HDFS does."""

    def __init__(self, files):
        self.files, self.moved = files, 0

    def getClass(self):
        return self

    def getSimpleName(self):
        return "DistributedFileSystem"

    def rename(self, a, b):
        self.files[b.toString()] = self.files.pop(a.toString())
        return True

    def concat(self, target, rest):
        for p in rest:
            self.files[target.toString()] += self.files.pop(p.toString())

    def delete(self, path, recursive):
        return self.files.pop(path.toString(), None) is not None

    def create(self, *args):
        raise AssertionError("bytes were moved")


def test_stores_that_concatenate(spark, tmp_path):
    store = Concatenates({f"hdfs:/p{k}": b"%d" % k * (k + 1) for k in range(4)})
    publish.join_files(spark, [f"hdfs:/p{k}" for k in range(4)], "hdfs:/all", store)
    assert store.files == {"hdfs:/all": b"0112223333"}


def test_parts_go_as_they_are_copied(spark, tmp_path):
    """Where bytes are moved, no more than one part of the file lies on disk twice."""
    parts = [tmp_path / f"p{k}" for k in range(3)]
    for k, p in enumerate(parts):
        p.write_text(str(k))
    with pytest.raises(Exception, match="missing"):
        publish.join_files(spark, [*map(str, parts), str(tmp_path / "missing")], str(tmp_path / "all"))
    assert not any(p.exists() for p in parts) and (tmp_path / "all").read_text() == "012"


def test_a_failing_write_leaves_what_was_there(spark, tmp_path):
    target = str(tmp_path / "out")
    tables.write_tsv(spark.range(3), target)
    for single in (False, True):
        with pytest.raises(Exception, match="boom"):
            tables.write_tsv(spark.range(9).withColumn("x", F.raise_error(F.lit("boom")).cast("string")), target, single=single)
        assert sorted(r.id for r in tables.read_tsv(spark, target).collect()) == ["0", "1", "2"] and names(tmp_path) == ["out"]
    with pytest.raises(RuntimeError), publish.published(spark, target) as side:
        tables.write_json(spark, {}, side + "/half.json")
        raise RuntimeError
    assert names(tmp_path) == ["out"]


def test_a_failing_move_brings_back_what_was_there(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "out")
    tables.write_tsv(spark.range(3), target)
    move, calls = publish.move, []

    def failing(spark, a, b):
        calls.append(b)
        if len(calls) == 2:
            raise OSError("upload failed")
        move(spark, a, b)

    monkeypatch.setattr(publish, "move", failing)
    with pytest.raises(OSError, match="upload failed"):
        tables.write_tsv(spark.range(9), target)
    assert tables.read_tsv(spark, target).count() == 3 and names(tmp_path) == ["out"]


def test_count_keys(spark, tmp_path):
    for k in range(12):
        (tmp_path / f"f{k}").write_text("x")
    assert publish.count_keys(spark, str(tmp_path)) == 12 and publish.count_keys(spark, str(tmp_path), 5) == 5
    assert publish.count_keys(spark, str(tmp_path / "none")) == 0


def test_a_killed_run_goes_on(spark, tmp_path):
    source, folder, built = tmp_path / "in.txt", str(tmp_path / "run"), []
    source.write_text("one")

    def run(kill=None, config=Config()):
        store = RunStore(spark, folder, config, [str(source)])
        df = spark.range(4)
        for stage in ("first", "second", "third", "fourth"):

            def build(df=df, stage=stage):
                built.append(stage)
                if stage == kill:
                    return df.withColumn("id", F.raise_error(F.lit("killed")).cast("long"))
                return df.withColumn("id", F.col("id") + 1)

            df = store.table(stage, build)
        return sorted(r.id for r in df.collect()), store

    with pytest.raises(Exception, match="killed"):
        run("third")
    assert built == ["first", "second", "third"]
    built.clear()
    got, store = run()
    assert got == [4, 5, 6, 7] and built == ["third", "fourth"]
    assert store.summary() == {s: {"rows": 4} for s in ("first", "second", "third", "fourth")}
    built.clear()
    assert run()[0] == got and built == []
    run(config=Config(block_cap=7))
    source.write_text("two, longer")
    run()
    assert len(built) == 8
    tables.write_json(spark, store.summary(), str(tmp_path / "summary.json"))
    assert json.loads((tmp_path / "summary.json").read_text())["first"] == {"rows": 4}


def test_slow_statements_show_signs_of_life(spark):
    slow = F.udf(lambda v: time.sleep(3) or v, "long")
    heard = []
    with watched(spark, "slow count", heard.append, every=0.4) as told:
        assert spark.range(0, 2, 1, 2).select(slow("id").alias("v")).agg(F.sum("v")).first()[0] == 1
    assert told.signs >= 2 and told.seconds > 1 and all(h.startswith("slow count: ") for h in heard)
    assert any("of 2 tasks" in h for h in heard) and "done in" in heard[-1]
    with pytest.raises(Exception, match="oops"), watched(spark, "bad", heard.append):
        spark.range(1).select(F.raise_error(F.lit("oops"))).collect()
    assert heard[-1].startswith("bad: failed")
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
