"""Keyed writes: repeats, null keys, order, partial changes."""

from barloom.operators import merge


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    changes = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 3), (None, "m", 4)], "k int, v string, seq int")
    once = merge.upsert(target, changes, ["k"], order="seq")
    assert rows(once) == rows(spark.createDataFrame([(1, "y"), (2, "b"), (3, "z"), (None, "m")], "k int, v string"))
    assert rows(merge.upsert(once, changes, ["k"], order="seq")) == rows(once)


def test_upsert_preserves_and_merges_whole_rows_without_key(spark):
    target = spark.createDataFrame([(1, "a", 10)], "k int, v string, born int")
    changes = spark.createDataFrame([(1, "x", 99), (2, "y", 98)], "k int, v string, born int")
    assert rows(merge.upsert(target, changes, ["k"], preserve=["born"])) == [(1, "x", 10), (2, "y", 98)]
    keyless = target.drop("k")
    assert rows(merge.upsert(keyless, changes, ["k"]).select("v", "born")) == [("a", 10), ("x", 99), ("y", 98)]


def test_patch_leaves_unset_columns(spark):
    target = spark.createDataFrame([(1, "a", "t"), (2, "b", "u")], "k int, v string, w string")
    changes = spark.createDataFrame([(1, None, "new", ["v"])], "k int, v string, w string, cleared array<string>")
    assert rows(merge.patch(target, changes, ["k"], ["v", "w"], cleared="cleared")) == [(1, None, "new"), (2, "b", "u")]


def test_delete_and_insert(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    gone = spark.createDataFrame([(None,)], "k int")
    assert rows(merge.delete(target, gone, ["k"])) == [(1, "a")]
    new = spark.createDataFrame([(1, "z", 1), (5, "q", 2), (5, "r", 3)], "k int, v string, seq int")
    assert rows(merge.insert_new(target, new, ["k"], order="seq")) == sorted([(1, "a"), (None, "n"), (5, "q")], key=repr)


def test_rekey_moves_over_an_existing_key(spark):
    target = spark.createDataFrame([("w", "A", 1.0), ("w", "B", 2.0)], "wid string, ticker string, alloc double")
    moves = spark.createDataFrame([("w", "A", "B", 9.0, 1)], "wid string, old string, new string, alloc double, seq int")
    assert rows(merge.rekey(target, moves, ["wid", "ticker"], "old", "new")) == [("w", "B", 9.0)]
