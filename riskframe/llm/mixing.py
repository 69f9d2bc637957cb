"""Mixing sources to target weights by pivotal dependent rounding.

A source's target share of all words, divided by the words it has, is the number
of copies each of its documents should get. Whole copies are sure; the fractions
are rounded together: two documents' fractions meet, mass moves at random from one
to the other until one of them is 0 or 1, and the other carries the rest on. The
expected copies stay what they were, and documents meet in order of size, so the
words taken stay near the target. The meetings form a reduction tree: blocks of
neighbours in the order are reduced independently, each leaves one residual, and
the residuals are reduced the same way until the root settles the last one of
every source. DataFrame functions only.

Defined results: a null or empty text has size 0 and takes nothing; a null source
is a source, last in the order; sources without words have target 0; repeated rows
are documents of their own; an empty table gives no rows. Reruns agree, whatever the
partitions and file names: documents are numbered densely within their source, in an
order that only equal rows leave open, and blocks and random numbers follow from these
numbers and the seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, fresh, ordered

#: Documents of a block, and the most residuals of a source that the root settles together.
BLOCK, ROOT = 128, 2048
#: No document is taken more often than this.
MOST = 3
SPACE = " \t\n\x0b\x0c\r"
EPS = 1e-12


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null: 0."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[ \\t-\\r]+", -1))).cast("long")


def weights_in_order(sources: DataFrame, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """``sources`` (one row per source) with weights dealt in code-point order of the names, null last, and ``source_no``
    from 1 in that order. Sources are ranked over range partitions, so there may be any number of them."""
    placed = in_order(sources.withColumn("_all", F.lit(0)), ["_all"], F.col("source").asc_nulls_last())
    return (placed.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.col("_place") % len(cycle) + 1).cast("int")))
            .withColumn("source_no", F.col("_place") + 1).drop("_place", "_all"))


def targets(sources: DataFrame, most: float = MOST) -> DataFrame:
    """Words to take from each source (source, source_size, weight): shares by weight of all words, none above
    ``most`` times what the source has; what is cut off is shared again by weight.

    One total at a time comes back: the words left per weight once the sources above their cap at the last level are held
    at it. The level only rises, so a source once held stays held; the same level twice ends it."""
    cap = F.col("source_size") * F.lit(float(most))
    level = 0.0
    while True:
        held = cap < F.lit(level) * F.col("weight")
        row = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(held, cap)).alias("held"), F.sum(F.when(~held, F.col("weight"))).alias("weight")).first()
        if not row["weight"]:
            break
        rise = (row["all"] - (row["held"] or 0.0)) / row["weight"]
        if rise <= level:
            break
        level = rise
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def _uniform(key: Column, *seed) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(key, *[F.lit(s) for s in seed]), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _meet(carry: Column, unit: Column) -> Column:
    """One meeting: the carried fraction and the next one; the settled one is noted, the other is carried on."""
    a, b, u = carry["p"], unit["p"], unit["u"]
    total = a + b
    low = total <= 1.0
    # below one in all, the loser is settled at 0; above, the winner is settled at 1 and the loser keeps the rest
    carry_stays = F.when(low, u * total < a).otherwise(u * (2.0 - total) >= 1.0 - b)
    one = lambda name: F.when(carry_stays, carry[name]).otherwise(unit[name]).alias(name)       # noqa: E731
    other = lambda name: F.when(carry_stays, unit[name]).otherwise(carry[name]).alias(name)     # noqa: E731
    settled = F.struct(other("rid"), other("size"), (~low).alias("keep"))
    met = F.struct(one("rid"), one("size"), F.when(low, total).otherwise(total - 1.0).alias("p"),
                   F.array_append(carry["done"], settled).alias("done"))
    first = F.struct(unit["rid"].alias("rid"), unit["size"].alias("size"), unit["p"].alias("p"), carry["done"].alias("done"))
    return F.when(carry["rid"].isNull(), first).otherwise(met)


def _reduce(units: DataFrame, block: list, level: int, seed: int) -> DataFrame:
    """Each block's carried residual (rid, size, p) and the documents it settled (done)."""
    unit = F.struct("rid", "size", "p", _uniform(F.xxhash64("source_no", "rid", "draw"), seed, level).alias("u"))
    start = F.expr("named_struct('rid', CAST(NULL AS BIGINT), 'size', CAST(0 AS BIGINT), 'p', CAST(0.0 AS DOUBLE), "
                   "'done', CAST(array() AS ARRAY<STRUCT<rid: BIGINT, size: BIGINT, keep: BOOLEAN>>))")
    return (units.groupBy("source_no", "draw", *block).agg(F.sort_array(F.collect_list(unit)).alias("units"))
            .withColumn("r", F.aggregate("units", start, _meet)).select("source_no", "draw", *block, "r.rid", "r.size", "r.p", "r.done"))


def in_order(df: DataFrame, of: list, *cols) -> DataFrame:
    """The rows with their number (``_place``: 0, 1, ...) within each group ``of``, in order of ``cols``.

    The numbers don't depend on the partitions; one row per group and partition makes the offsets.
    """
    placed = ordered(df, *of, *cols)
    held = placed.groupBy(*of, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*of).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = durable(held.select(*of, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset")))
    return placed.join(held, [*of, "_part"]).withColumn("_place", F.col("_place") + F.col("_offset")).drop("_part", "_offset")


def pivotal(units: DataFrame, seed: int = 7) -> DataFrame:
    """Rounds fractions p (above 0, below 1) of units (source_no, draw, rid, size, p), in order of rid: the settled
    (source_no, draw, rid, size, keep) of all units. Every draw is a rounding of its own. ``_place``, if given, is
    the number of the unit within its source and draw in that order."""
    of = ["source_no", "draw"]
    level, settled = 0, []
    while True:
        held = units.groupBy(*of).count().agg(F.max("count").alias("worst")).first()
        if (held.worst or 0) <= ROOT:
            break
        placed = units if "_place" in units.columns else in_order(units, of, "rid")
        done = durable(_reduce(placed.withColumn("_block", F.floor(F.col("_place") / BLOCK)), ["_block"], level, seed))
        settled.append(done.select(*of, F.explode("done").alias("d")).select(*of, "d.*"))
        units = done.select(*of, "rid", "size", "p", F.col("_block").alias("_place"))     # every block leaves one
        level += 1
    root = durable(_reduce(units, [], level, seed))
    settled.append(root.select(*of, F.explode("done").alias("d")).select(*of, "d.*"))
    out = root.select(*of, "rid", "size", (_uniform(F.xxhash64("source_no", "rid", "draw"), seed, -1) < F.col("p")).alias("keep"))
    for s in settled:
        out = out.unionByName(s)
    return out


def copies(rows: DataFrame, most: int = MOST, cycle: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 7) -> DataFrame:
    """``rows`` (source, size, and key columns) with source_size, target and copies (long).

    Column names with a leading underscore, and rid and source_no, are taken by the operator. Documents of one size
    meet in the order of the key columns, as they stand.
    """
    keys = [c for c in rows.columns if c not in ("source", "size")]
    rows = durable(rows)
    sources = targets(durable(weights_in_order(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cycle)), most)
    given = durable(sources).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = (rows.join(given, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("_rate", F.least(rate, F.lit(float(most)))).withColumn("_sure", F.floor(F.col("_rate") + EPS))
             .withColumn("_fraction", F.greatest(F.lit(0.0), F.col("_rate") - F.col("_sure"))))
    placed = in_order(rated, ["source_no"], F.desc("size"), *keys).withColumnRenamed("_place", "rid")
    # one rounding: choosing among several by their totals would change the documents' chances
    units = (placed.where((F.col("_fraction") > EPS) & (F.col("_fraction") < 1.0 - EPS))
             .select("source_no", F.lit(0).alias("draw"), "rid", "size", F.col("_fraction").alias("p"), F.col("rid").alias("_place")))
    kept = pivotal(units, seed).where("keep").select("source_no", "rid", F.lit(1).alias("_more"))
    return (placed.join(kept, ["source_no", "rid"], "left")
            .withColumn("copies", (F.col("_sure") + F.coalesce("_more", F.lit(0))).cast("long"))
            .select(*keys, "source", "size", "source_size", "target", "copies"))


def mix(docs: DataFrame, seed: int = 7, text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` (a scan of files), each as often as the mix takes it.

    Rows are known by file and place in it, so that repeated and null ids are no matter; the random choice goes by
    what is in a row, and file and place only part equal rows.
    """
    file, at, often = fresh(docs, "_file", "_at", "_copies")
    row = docs.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    # maps and the like have no hash; whether a value is null counts, as hashes pass nulls over
    values = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]
    content = [*values, *[v.isNull() for v in values]]
    taken = copies(row.select(F.xxhash64(F.lit(0), *content).alias("_key"), F.xxhash64(F.lit(1), *content).alias("_key2"), F.col(file).alias("_file"), F.col(at).alias("_at"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), seed=seed)
    wanted = taken.where("copies > 0").select(F.col("_file").alias(file), F.col("_at").alias(at), F.sequence(F.lit(1).cast("long"), "copies").alias(often))
    return row.join(wanted, [file, at]).withColumn(often, F.explode(often)).select(*docs.columns)
