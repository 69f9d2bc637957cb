"""Level dictionaries that never reach the driver."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskframe.operators import encode as E
from riskframe.operators import model as MD


def test_a_million_levels(spark, monkeypatch):
    """Codes of a million levels are right and no row of levels is collected."""
    from pyspark.sql.classic.dataframe import DataFrame

    def forbidden(*a, **k):
        raise AssertionError("rows were brought to the driver")

    n = 1_000_000
    df = spark.range(n).select(F.hex(F.col("id") * 7919 % n).alias("c"), "id")
    collected = []
    real = DataFrame.collect
    monkeypatch.setattr(DataFrame, "toLocalIterator", forbidden)
    monkeypatch.setattr(DataFrame, "toPandas", forbidden)
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(real(self)) or collected[-1])
    found = E.fit_dictionary(df, ["c"])
    coded = E.ordinal_encode(df, ["c"], found, suffix="_code")
    assert sum(len(x) for x in collected) == 1 and found.sizes == {"c": n}
    row = coded.agg(F.count("c_code"), F.count_distinct("c_code"), F.min("c_code"), F.max("c_code")).first()
    assert tuple(row) == (n, n, 0, n - 1)
    monkeypatch.undo()
    some = sorted(r.level for r in found.levels(spark, "c").where("code < 50").collect())
    assert some == sorted(f"{i:X}" for i in range(n))[:50]


def test_codes_follow_byte_order(spark):
    values = ["b", "B", "é", "", None, "a", "中", "z", "😀", "b", " b"]
    df = spark.createDataFrame([(i, v, i % 2 == 0 if i < 5 else None) for i, v in enumerate(values)], "id int, c string, f boolean")
    found = E.fit_dictionary(df)
    assert found.sizes == {"c": 9, "f": 2}
    want = sorted({v for v in values if v is not None}, key=lambda x: x.encode())
    assert [r.level for r in found.levels(spark, "c").orderBy("code").collect()] == want
    got = E.ordinal_encode(df, dictionary=found, null_as_level=True).orderBy("id").collect()
    assert [r.c for r in got] == [want.index(v) if v is not None else 9 for v in values]
    assert [r.f for r in got] == [1, 0, 1, 0, 1, 2, 2, 2, 2, 2, 2]
    new = spark.createDataFrame([(1, "new", True)], "id int, c string, f boolean")      # a level the dictionary lacks
    assert [r.c for r in E.ordinal_encode(new, dictionary=found).collect()] == [None]
    assert [r.c for r in E.ordinal_encode(new, dictionary=found, null_as_level=True).collect()] == [9]


def test_no_levels_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, c string")
    assert [tuple(r) for r in E.ordinal_encode(df, null_as_level=True).orderBy("id").collect()] == [(1, 0), (2, 0)]
    assert E.ordinal_encode(df.limit(0)).count() == 0
    assert E.fit_dictionary(df, []).sizes == {}
    assert [r.onehot for r in E.one_hot_positions(df).collect()] == [[], []]
    with pytest.raises(ValueError):
        E.one_hot_vector(df)


def test_positions_and_vectors_are_the_wide_view(spark):
    df = spark.createDataFrame([(i, "xyz"[i % 3] if i % 4 else None, bool(i % 2)) for i in range(24)], "id int, c string, f boolean")
    wide = E.one_hot(df, ["c", "f"]).orderBy("id").collect()
    rows = [[x for name, x in r.asDict().items() if name != "id"] for r in wide]
    assert [r.onehot for r in E.one_hot_positions(df).orderBy("id").collect()] == [[i for i, x in enumerate(r) if x] for r in rows]
    assert [list(map(int, r.onehot.toArray())) for r in E.one_hot_vector(df).orderBy("id").collect()] == rows


def test_a_saved_model_carries_its_dictionary(spark, tmp_path):
    df = spark.createDataFrame([(i, "abc"[i % 3], float(i % 7), int(i % 3 == 1)) for i in range(90)], "row_id long, c string, x double, label int")
    prep = MD.fit_prep(df, ["c", "x"])
    frame = MD.apply_prep(df, prep, keep=["row_id", "label"])
    model = MD.train_gbt(frame, MD.GBTParams(max_iter=3, max_depth=2))
    before = {r.row_id: r.score for r in MD.positive_probability(model, frame).collect()}
    MD.save_model(model, prep, str(tmp_path / "m"))
    (tmp_path / "m").rename(tmp_path / "moved")
    again, prep2, _ = MD.load_model(str(tmp_path / "moved"))
    assert prep2.levels == {"c": 3} and prep2.dictionary.startswith(str(tmp_path / "moved"))
    after = {r.row_id: r.score for r in MD.positive_probability(again, MD.apply_prep(df, prep2, keep=["row_id"])).collect()}
    assert after == before and len(after) == 90
