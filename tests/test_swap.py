import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import files
from shelfcast.session import scratch_path
from shelfcast.sinks import swap, tables as sink

D = dt.date
DAYS = [D(2024, 5, d) for d in (1, 2, 3)]


@pytest.fixture()
def stored(spark):
    path = scratch_path(spark, "swapped")
    df = spark.createDataFrame([(d, p, float(p)) for d in DAYS for p in range(6)], "VisitDate date, PointID long, predict_new double")
    sink.replace_slice(df, path, None)
    return df, path


def held(spark, path):
    return sorted((r["VisitDate"], r["PointID"], r["predict_new"]) for r in sink.read_table(spark, path).collect())


def test_failure_before_the_intent_changes_nothing(spark, stored, monkeypatch):
    df, path = stored
    before = held(spark, path)
    monkeypatch.setattr(files, "create_text", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
    for write in (lambda: sink.replace_slice(df.withColumn("predict_new", F.lit(9.0)), path, DAYS[1]), lambda: sink.replace_table(df.limit(1), path)):
        with pytest.raises(OSError):
            write()
        assert held(spark, path) == before


@pytest.mark.parametrize("fails_at", [0, 1, 2])
def test_failure_between_moves_is_carried_on(spark, stored, monkeypatch, fails_at):
    """The day is replaced and rows of two other days are added: whole after recovery, whichever move failed."""
    df, path = stored
    new = df.withColumn("predict_new", F.col("predict_new") + 100).where("PointID < 3")
    kept, calls = files.move, []

    def move(*a):
        if len(calls) == fails_at:
            calls.append(a)
            raise OSError("lost connection")
        calls.append(a)
        return kept(*a)

    monkeypatch.setattr(files, "move", move)
    with pytest.raises(OSError):
        sink.replace_slice(new, path, DAYS[1])
    monkeypatch.setattr(files, "move", kept)
    want = [(d, p, float(p)) for d in DAYS if d != DAYS[1] for p in range(6)] + [(d, p, p + 100.0) for d in DAYS for p in range(3)]
    assert held(spark, path) == sorted(want)
    assert not swap.recover(spark, path) and held(spark, path) == sorted(want)


def test_whole_table_is_swapped_and_may_read_itself(spark, stored):
    _, path = stored
    sink.replace_table(sink.read_table(spark, path).where("PointID = 1"), path)
    assert [r[1] for r in held(spark, path)] == [1, 1, 1]


def test_second_writer_is_told(spark, stored, monkeypatch):
    df, path = stored
    monkeypatch.setattr(swap, "recover", lambda *a: False)  # the first writer is still at its moves
    files.create_text(spark, f"{path}~intent", "[]")
    with pytest.raises(RuntimeError):
        sink.replace_slice(df, path, DAYS[0])
    files.delete(spark, f"{path}~intent")


def test_a_day_without_new_rows_is_emptied(spark, stored):
    df, path = stored
    sink.replace_slice(df.where("false"), path, DAYS[2])
    assert {r[0] for r in held(spark, path)} == set(DAYS[:2])
