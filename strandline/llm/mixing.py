"""Mixing sources to target weights by capped water-filling.

Sources share a total by weight; a share may not exceed ``max_epochs`` times the source's size, and
what is cut off is shared again by weight among the others until every share is feasible.  A
document is then taken a whole number of times, the same for its source, and the fraction that is left
is met by taking some documents once more: those that come first in a seeded order, up to the
document that would overshoot by more than half its size.

Only one row per source is ever ordered by source; the seeded order is cut into 65,536 tiles by hash,
whose sums locate the one tile per source in which the fraction ends.  Rows of one id share a place in that order;
inside it they are ordered, and cut into tiles once more, by a hash of the row, so many rows with one id (or none)
neither meet in one task nor are taken all at once.

Defined cases: null sources form one source, the last; a null or empty text has size 0 and is
taken whole times only; sources without words have target 0; rows that repeat an id, or have none, are separate
documents; an empty table gives an empty result; extra columns stay, and the
operator's columns replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import saved, words

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = "mix-1"


def _source_key(source: Column) -> Column:
    """Sorts by code point with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` (key, ...) plus ``rank`` from 0 by key, without one window over all of them."""
    parts = saved(sources.orderBy("key").withColumn("part", F.spark_partition_id()), "sources")
    sizes = sorted((r["part"], r["n"]) for r in parts.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, cases = 0, None
    for part, n in sizes:  # one number per partition
        cases = (F if cases is None else cases).when(F.col("part") == part, F.lit(before))
        before += n
    inside = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    return parts.withColumn("rank", (inside + (cases if cases is not None else F.lit(0))).cast("long")).drop("part")


def water_fill(sources: DataFrame, total: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source_size, weight) plus ``target``; each round caps the shares above their cap."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        r = sources.agg(F.sum(F.when(over, cap)).alias("cut"), F.sum(F.when(~over, F.col("weight"))).alias("w"),
                        F.count(F.when(over, 1)).alias("n")).first()
        if not r["w"] or r["n"] == capped:
            break
        capped, level = r["n"], (total - (r["cut"] or 0.0)) / r["w"]
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(share > cap, cap).otherwise(share).cast("double"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE,
        max_epochs: float = MAX_EPOCHS, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) and the columns ``keep``, per document."""
    rows = saved(docs.select(
        "doc_id", *(c for c in keep if c != "doc_id"), _source_key(F.col("source")).alias("key"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("order"),
        F.md5(F.monotonically_increasing_id().cast("string")).alias("row")), "sizes")  # what the passes below read
    one, two = F.substring("order", 1, 2), F.substring("order", 3, 2)
    three = F.concat("order", F.substring("row", 1, 4))
    sources = saved(rows.groupBy("key").agg(F.sum("size").alias("source_size")), "sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    chosen = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = water_fill(ranked(sources).withColumn("weight", chosen), total, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = saved(filled.select("key", "source_size", "target", F.floor(rate).alias("whole"),
                               ((rate - F.floor(rate)) * F.col("source_size")).alias("extra")), "targets")

    def ends(tiles: DataFrame, tile: str, by: list[str]) -> DataFrame:
        """Per ``by``: the tile in which ``extra`` ends, and the words before it."""
        run = Window.partitionBy(*by).orderBy(tile)
        upto = tiles.withColumn("upto", F.sum("words").over(run))
        at = upto.where(F.col("upto") > F.col("extra")).groupBy(*by).agg(
            F.min(F.struct(tile, (F.col("upto") - F.col("words")).alias("before"))).alias("e"))
        return at.select(*by, F.col(f"e.{tile}").alias(f"end_{tile}"), F.col("e.before").alias(f"before_{tile}"))

    cut, within = plan, F.lit(True)
    spent, ended = F.lit(0), []
    for name, tile in (("one", one), ("two", two), ("three", three)):  # each level inside the tile that the one before ends in
        inner = rows.select("key", "size", "order", "row").join(cut, "key").where(within)
        tiles = inner.groupBy("key", tile.alias(name)).agg(F.sum("size").alias("words"), F.first(F.col("extra") - spent).alias("extra"))
        cut = saved(cut.join(ends(tiles, name, ["key"]), "key", "left"), "cuts")
        spent = spent + F.col(f"before_{name}")
        ended.append((tile, F.col(f"end_{name}")))
        within = F.struct(*(t for t, _ in ended)) == F.struct(*(e for _, e in ended))

    tile, end = F.struct(*(t for t, _ in ended)), F.struct(*(e for _, e in ended))
    own = F.struct("order", "row")
    in_tile = Window.partitionBy("key").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
    last = (rows.select("key", "size", "order", "row").join(cut, "key").where(tile == end)  # one tile per source
            .withColumn("prior", spent + F.coalesce(F.sum("size").over(in_tile), F.lit(0)))
            .where(2 * F.col("prior") + F.col("size") <= 2 * F.col("extra"))
            .groupBy("key").agg(F.max(own).alias("last")))
    done = saved(cut.join(last, "key", "left"), "cuts")

    # sources whose fraction never ends take none (extra 0 ends in the first tile with words)
    once_more = (F.when(F.col("end_three").isNull(), F.col("extra") > 0)
                 .otherwise((tile < end) | ((tile == end) & F.coalesce(own <= F.col("last"), F.lit(False)))))
    copies = (F.col("whole") + F.when(F.coalesce(once_more, F.lit(False)), 1).otherwise(0)).cast("long")
    return (rows.join(done, "key")
            .withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
            .select("doc_id", *(c for c in keep if c != "doc_id"), "size", "source_size", "target", "copies", "taken"))
