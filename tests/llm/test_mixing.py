"""Targets by water-filling and pivotal rounding."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import mixing

from .conftest import clashing, frame


def brute_targets(sizes, most=3.0):
    """sizes: source -> words; shares by weight, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: 1.0 + i % 3 for i, s in enumerate(names)}
    total, target, open_ = float(sum(sizes.values())), {}, set(names)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in over}
        open_ -= over
    return target


def rows_of(rng, spec):
    return [(k * 1000 + i, " ".join(["w"] * int(n)), "en", source, 1) for k, (source, sizes) in enumerate(spec.items()) for i, n in enumerate(sizes(rng))]


SPEC = {"a": lambda r: r.integers(1, 200, 600), "b": lambda r: r.integers(1, 40, 300), "Z": lambda r: r.integers(1, 9, 20), None: lambda r: r.integers(1, 90, 100),
        "é": lambda r: [0, 0], "c": lambda r: r.integers(50, 60, 400), "d": lambda r: [1]}


def test_targets_and_copies(spark, monkeypatch):
    rows = rows_of(np.random.default_rng(1), SPEC)
    df = clashing(frame(spark, rows)).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    outcomes = []
    for block, root in ((128, 2048), (16, 40)):
        monkeypatch.setattr(mixing, "BLOCK", block)
        monkeypatch.setattr(mixing, "ROOT", root)
        got = mixing.copies(df).toPandas()
        assert len(got) == len(rows) and set(got.doc_id) == {r[0] for r in rows}
        sizes = {s: int(got["size"][got.source == s].sum() if s is not None else got["size"][got.source.isna()].sum()) for s in SPEC}
        want = brute_targets(sizes)
        for s in SPEC:
            part = got[got.source == s] if s is not None else got[got.source.isna()]
            assert np.allclose(part.target, want[s], rtol=1e-9) and (part.source_size == sizes[s]).all()
            taken, largest = (part.copies * part["size"]).sum(), part["size"].max()
            assert abs(taken - want[s]) <= max(0.02 * want[s], largest)
            rate = want[s] / max(1, sizes[s])
            assert part.copies.between(np.floor(rate + 1e-9), np.ceil(rate - 1e-9)).all() and part.copies.max() <= 3
        outcomes.append(got)
    again = mixing.copies(df).toPandas()
    assert again.sort_values("doc_id").copies.tolist() == outcomes[1].sort_values("doc_id").copies.tolist()


def test_rounding_keeps_expectations(spark):
    """Over many draws, each unit is kept as often as its fraction says."""
    units = spark.range(40).select(F.lit(1).alias("source_no"), F.col("id").alias("rid"), F.lit(5).cast("long").alias("size"), (0.1 + F.col("id") % 8 / 10).alias("p"))
    many = units.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(1999))))
    got = mixing.pivotal(many).groupBy("rid").agg(F.avg(F.col("keep").cast("double")).alias("f"), F.count("*").alias("n")).toPandas()
    assert (got.n == 2000).all() and np.abs(got.f - (0.1 + got.rid % 8 / 10)).max() < 0.05
    totals = mixing.pivotal(many).groupBy("draw").agg(F.sum(F.col("keep").cast("int")).alias("k")).toPandas()
    assert totals.k.between(17, 19).all()            # the fractions sum to 18


def test_copies_keep_expectations_of_unequal_sizes(spark):
    """Over many sources of documents of 10, 6 and 1 words, a document of each size gets its fraction of a copy."""
    rows = [(3 * s + i, " ".join(["w"] * n), "en", f"s{s:04d}", 1) for s in range(900) for i, n in enumerate((10, 6, 1))]
    df = frame(spark, rows).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    got = mixing.copies(df).groupBy((F.col("target") / F.col("source_size")).alias("rate"), "size").agg(F.avg("copies").alias("f"), F.count("*").alias("n")).collect()
    assert len(got) == 9 and all(r.n == 300 for r in got)
    assert all(abs(r.f - r.rate) < 0.1 for r in got), got          # three standard deviations of 300 tosses are 0.087


def test_odd_rows(spark, odd_docs, tmp_path):
    docs = clashing(frame(spark, odd_docs))
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    sizes = {(r.doc_id, r.text): r.n for r in docs.select("doc_id", "text", mixing.word_count(F.col("text")).alias("n")).collect()}
    assert all(n == len((t or "").encode().split()) for (_, t), n in sizes.items())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert max(sum(1 for r in rows if (r.doc_id, r.text) == k) for k in {(r.doc_id, r.text) for r in rows}) <= 6
    assert mixing.mix(docs.where("doc_id = -1")).count() == 0
    assert mixing.copies(frame(spark, []).select("doc_id", "source", F.lit(0).cast("long").alias("size"))).count() == 0


def test_reruns_agree_over_partitions(spark, monkeypatch):
    """The same documents get the extra copies, into however many ranges the order is cut."""
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "ROOT", 40)
    df = frame(spark, rows_of(np.random.default_rng(1), SPEC)).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before, got = [spark.conf.get(k) for k in keys], []
    try:
        for parts in ("1", "11"):
            for k, v in zip(keys, (parts, "false"), strict=True):
                spark.conf.set(k, v)
            got.append(sorted(map(tuple, mixing.copies(df).select("doc_id", "copies").collect())))
    finally:
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
    assert got[0] == got[1]


def test_reruns_agree_over_files(spark, tmp_path):
    """The mix goes by what is in the rows, not by the files they lie in."""
    docs = frame(spark, [(i % 500, f"{i % 7} b c", "en" if i % 2 else None, "ab"[i % 3 // 2], 1) for i in range(900)])
    got = []
    for name, parts in (("one", 1), ("two", 3)):
        docs.repartition(parts).write.parquet(str(tmp_path / name))
        got.append(sorted(map(str, mixing.mix(spark.read.parquet(str(tmp_path / name))).collect())))
    assert got[0] == got[1] and len(got[0]) > 0


def test_no_python_in_the_plan(spark):
    df = frame(spark, rows_of(np.random.default_rng(1), SPEC)).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    plan = mixing.copies(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
