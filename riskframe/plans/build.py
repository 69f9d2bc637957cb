"""B1/B2: the end-to-end feature job as functions on DataFrames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from riskframe.operators import clean as C
from riskframe.operators.features import ALL_BLOCKS, build_features
from riskframe.plans.parallel import pmap
from riskframe.sources import standins

CLEANERS = {
    "bureau": C.BUREAU,
    "prev": C.PREVIOUS,
    "pos": C.POS_CASH,
    "ins": C.INSTALLMENTS,
    "cc": C.CREDIT_CARD,
}


def clean_frames(frames: dict[str, DataFrame], accuracy: int | None = None) -> dict[str, DataFrame]:
    """Clean every child table with its spec; ``bb`` is passed through.
    The per-table fits are independent and are submitted concurrently."""
    keys = [k for k in frames if k in CLEANERS]
    return {**frames, **dict(zip(keys, pmap(lambda k: C.clean(frames[k], CLEANERS[k], accuracy), keys)))}


def fit_cleaners(raw: dict[str, DataFrame], accuracy: int | None = None) -> dict[str, C.CleanModel]:
    """Fit every table's cleaner (``app`` + child tables), concurrently."""
    specs = {"app": C.APPLICATION, **CLEANERS}
    keys = [k for k in raw if k in specs]
    return dict(zip(keys, pmap(lambda k: C.fit_clean(raw[k], specs[k], accuracy), keys)))


def feature_table(spark: SparkSession, sf_dir: str, include: tuple[str, ...] = ALL_BLOCKS,
                  accuracy: int | None = None, models: dict[str, C.CleanModel] | None = None) -> DataFrame:
    """Clean application + child tables, then assemble (one row per applicant).

    By default each table is fitted on itself, as in the reference (T4); pass
    ``models`` (from ``fit_cleaners`` on a training table set) to apply the
    training caps and drops instead."""
    raw = {"app": standins.application(spark, sf_dir), **standins.frames(spark, sf_dir)}
    if models is None:
        app, raw = raw["app"], {k: df for k, df in raw.items() if k != "app"}
        done = pmap(lambda job: job(), [lambda: C.clean(app, C.APPLICATION, accuracy), lambda: clean_frames(raw, accuracy)])
        return build_features(done[0], frames=done[1], include=include)
    cleaned = {k: (models[k].transform(df) if k in models else df) for k, df in raw.items()}
    app = cleaned.pop("app")
    return build_features(app, frames=cleaned, include=include)


def bucketed_features(app_clean: DataFrame, frames: dict[str, DataFrame], out_dir: str, buckets: int | None = None,
                      include: tuple[str, ...] = ALL_BLOCKS) -> DataFrame:
    """B1 from co-located tables: the application side and each block's per-applicant aggregate are
    written by buckets of the applicant and joined from there, without a shuffle.

    A block that changes is written anew alone; the others stay as they are. ``buckets`` is
    ``spark.sql.shuffle.partitions`` by default, so that an aggregate is written as it was shuffled.
    """
    from riskframe.operators.features import CHILD_BLOCKS, KEY
    from riskframe.sources.bucketed import read_bucketed, write_bucketed

    spark = app_clean.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = {"application": build_features(app_clean, frames={}, include=tuple(b for b in include if b == "app_ratios"))}
    for block, (needs, reduce) in CHILD_BLOCKS.items():
        if block in include and all(t in frames for t in needs):
            blocks[block] = reduce(*[frames[t] for t in needs])
    base = out_dir.rstrip("/")
    pmap(lambda b: write_bucketed(blocks[b], f"{base}/{b}", KEY, buckets), list(blocks))
    out = None
    for block in blocks:
        table = read_bucketed(spark, f"{base}/{block}")
        out = table if out is None else out.join(table, KEY, "left")
    return out


def standin_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stand-ins keyed like ``sources.tables.read_raw_tables``, test applicants included."""
    return {"app": standins.application(spark, sf_dir), "app_test": standins.application_test(spark, sf_dir),
            **standins.frames(spark, sf_dir)}


def train_test_features(tables: dict[str, DataFrame], include: tuple[str, ...] = ALL_BLOCKS,
                        accuracy: int | None = None) -> dict[str, DataFrame]:
    """B1 for the training applicants (``app``) and, where given, the test applicants (``app_test``).

    Each table is cleaned on itself, as in the reference (T4). The child tables are cleaned
    and aggregated once, for all keys together, and joined to either side."""
    from riskframe.session import durable
    apps = {side: tables[t] for side, t in (("train", "app"), ("test", "app_test")) if t in tables}
    children = {k: df for k, df in tables.items() if k not in ("app", "app_test")}
    jobs = [lambda df=df: C.clean(df, C.APPLICATION, accuracy) for df in apps.values()]
    *cleaned, frames = pmap(lambda job: job(), [*jobs, lambda: clean_frames(children, accuracy)])
    keys = None
    for df in cleaned:
        ids = df.select("SK_ID_CURR")
        keys = ids if keys is None else keys.unionByName(ids)
    # an id of both sides is one applicant of the child tables
    history = durable(build_features(keys.distinct(), frames=frames, include=tuple(b for b in include if b != "app_ratios")))
    own = tuple(b for b in include if b == "app_ratios")
    return {side: build_features(df, frames={}, include=own).join(history, "SK_ID_CURR", "left") for side, df in zip(apps, cleaned)}


def run_feature_job(spark: SparkSession, source: str | dict[str, DataFrame], out_dir: str,
                    include: tuple[str, ...] = ALL_BLOCKS, n_splits: int = 5, seed: int = 42) -> dict:
    """B2: build, then write the train and test tree views, the with-folds view, the fold
    map and the aligned one-hot views.

    ``source``: the raw tables (``sources.tables.read_raw_tables``, or any frames so keyed;
    ``app_test`` may be missing) or the folder of the driver's tables, for the stand-ins.
    The feature tables are written once and every view is derived from the written copies,
    so later stages do not recompute the cleaning fits and the lineage is cut at a durable
    table; the fold map ranks ids only, and the written map is joined (J3).
    """
    from riskframe.operators.encode import align_columns, categorical_columns, one_hot
    from riskframe.operators.folds import fold_map, join_folds
    from riskframe.sources.sinks import write_manifest, write_parquet

    base = out_dir.rstrip("/")
    tables = standin_tables(spark, source) if isinstance(source, str) else source
    feats = {}
    for side, df in train_test_features(tables, include).items():
        write_parquet(df, f"{base}/{side}_features_tree.parquet")
        feats[side] = spark.read.parquet(f"{base}/{side}_features_tree.parquet")
    train = feats["train"]

    write_parquet(fold_map(train, "TARGET", n_splits, seed, "SK_ID_CURR"), f"{base}/folds_by_id.parquet")
    with_folds = join_folds(train, spark.read.parquet(f"{base}/folds_by_id.parquet"))
    # partitioned by fold: the per-fold train / validation filters prune files
    write_parquet(with_folds, f"{base}/train_with_folds_tree.parquet", partition_by=["fold"])

    # Both sides get all columns, but the target stays with the training side
    dummies = {side: one_hot(df, [c for c in categorical_columns(df) if c != "TARGET"]) for side, df in feats.items()}
    for side, df in zip(dummies, align_columns(*dummies.values())):
        out = df if side == "train" else df.drop("TARGET")
        write_parquet(out, f"{base}/{side}_features_onehot.parquet")
        cols = [c for c in out.columns if c != "TARGET"]
    write_manifest({"columns": cols}, f"{base}/onehot_columns.json")
    return {"rows": train.count(), "test_rows": feats["test"].count() if "test" in feats else 0, "tree_columns": len(train.columns),
            "onehot_columns": len(cols), "manifest": json.dumps(cols[:5])}
