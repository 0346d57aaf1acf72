import pytest
from pyspark.sql import functions as F

from tallyguard.streaming import generations as g


def added(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def put(spark, path, batch, rows):
    g.write_generation(spark.createDataFrame(rows, "k int, n bigint").coalesce(1), path, batch, added)


def totals(spark, path):
    return {r["k"]: r["n"] for r in added(g.read_generations(spark, path, "k int, n bigint")).collect()}


def test_folders_stay_few_and_sums_right(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(g, "FAN_OUT", 3)
    path = str(tmp_path / "table")
    assert totals(spark, path) == {}
    expected = {}
    for batch in range(14):
        rows = [(batch % 2, 1), (7, batch)]
        put(spark, path, batch, rows)
        for k, n in rows:
            expected[k] = expected.get(k, 0) + n
        assert totals(spark, path) == expected
        # In base 3, the digits of the number of batches.
        digits, left = 0, batch + 1
        while left:
            digits, left = digits + left % 3, left // 3
        assert len(g.current(g.Store(spark, path))) == digits
    on_disk = [n for n in g.Store(spark, path).names(".") if n.startswith("g")]
    assert len(on_disk) < 14
    assert len(g.Store(spark, path).names(g.MANIFESTS)) <= g.MANIFESTS_KEPT + 1


def test_a_repeated_batch_changes_nothing_even_after_a_merge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(g, "FAN_OUT", 2)
    path = str(tmp_path / "table")
    for batch in range(6):
        put(spark, path, batch, [(1, 10**batch)])
        before = totals(spark, path)
        put(spark, path, batch, [(1, 10**batch)])
        assert totals(spark, path) == before == {1: int("1" * (batch + 1))}


def test_a_merge_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(g, "FAN_OUT", 2)
    path = str(tmp_path / "table")
    put(spark, path, 0, [(1, 1)])

    def broken(df):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        g.write_generation(spark.createDataFrame([(1, 5)], "k int, n bigint"), path, 1, broken)
    assert totals(spark, path) == {1: 1}
    put(spark, path, 1, [(1, 5)])
    assert totals(spark, path) == {1: 6}


def test_a_reader_that_began_earlier_still_finds_its_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(g, "FAN_OUT", 2)
    path = str(tmp_path / "table")
    put(spark, path, 0, [(1, 1)])
    early = g.read_generations(spark, path, "k int, n bigint")
    for batch in range(1, 4):
        put(spark, path, batch, [(1, 1)])
    assert early.collect()[0]["n"] == 1
