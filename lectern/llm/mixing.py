"""Mixing sources to target weights: hash-random order, prefix sums of sizes, an exact cut at each source's budget.

The size of a document is its number of words.  Sources stand in the order of their names by code
point, null last, and weigh WEIGHTS in turn.  Together they share SHARE per hundred of all sizes; no
target is above MOST times the size of its source, and what a source cannot take is shared out again
by weight until none is above.  The share of one unit of weight that this ends at is found by prefix
sums over sources in the order of size by weight, so any number of sources takes one pass.

Documents get keys by a hash of id and text, and are range-sorted by source and key.  Each task adds
up the sizes of its range, and the totals of the ranges before give every document its place in
its source.  A source's budget is its target without the fraction: so many words as fill whole epochs
are taken whole, and the rest is cut from the start of the order, within a document where it ends.

Defined results: null and empty texts have size 0 and are taken 0 times; rows without an id or a
source are documents like others; repeated rows follow each other in the order, and are
counted before they move, so copies of one row make no hot range; an empty table gives an empty
result.  Reruns and other partitions give the same rows.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import cut, drop_table, hot_lookup

#: Words.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources in turn, per hundred of all sizes that the mix has, and times its size that a source gives at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 150, 2
#: Rows of a range, most ranges, and copies of one row that are made by one task.
ROWS_A_RANGE, MOST_RANGES, COPIES_A_TASK = 200_000, 20_000, 10_000


def _adds(n: int):
    """Sums of the n last columns over the rows of this partition before each, and the partition."""

    def rows(batches):
        part, total = TaskContext.get().partitionId(), [0] * n
        for batch in batches:
            sums = []
            for k in range(n):
                x = batch.column(batch.num_columns - n + k).to_numpy()
                ends = np.cumsum(x) + total[k]
                sums.append(pa.array(ends - x))
                total[k] = int(ends[-1]) if len(ends) else total[k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), *sums], [*batch.schema.names, "__part", *(f"__before{k}" for k in range(n))])

    return rows


def running(table: DataFrame, order: Sequence[Column | str], values: dict[str, Column], name: str) -> DataFrame:
    """table with, for each name of values, the sum of its column over all rows that stand before in the order.

    Rows are sorted by ranges; each task sums its own, and the sums of the ranges, one row each,
    give where a range begins.  Equal rows of the order may stand in either order.
    """
    ranges = min(MOST_RANGES, table.count() // ROWS_A_RANGE + 1)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = table.withColumns({f"__value{k}": v.cast("long") for k, v in enumerate(values.values())})
    ranged = (rows.repartitionByRange(ranges, *keys) if ranges > 1 else rows.coalesce(1)).sortWithinPartitions(*keys)
    more = "".join(f", __before{k} long" for k in range(len(values)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    made = cut(ranged.mapInArrow(_adds(len(values)), f"{fields}, __part int{more}"), name)
    sums = made.groupBy("__part").agg(*(F.max(F.col(f"__before{k}") + F.col(f"__value{k}")).alias(f"t{k}") for k in range(len(values)))).collect()
    base, total = [], [0] * len(values)
    for part, *of in sorted(tuple(r) for r in sums):
        base.append((part, *total))
        total = [x + y for x, y in zip(total, of, strict=True)]
    told = F.broadcast(table.sparkSession.createDataFrame(base, "__part int" + "".join(f", __base{k} long" for k in range(len(values)))))  # a row for each range
    out = made.join(told, "__part")
    return out.select(*table.columns, *((F.col(f"__base{k}") + F.col(f"__before{k}")).alias(n) for k, n in enumerate(values)))


def rows_of(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, none, source, key, size, copies): distinct rows; none tells sources that are null, which stand last."""
    source, text = F.col(source_col).cast("string"), F.col(text_col)
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary")))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    some = docs.select(F.col(id_col).alias("id"), source.isNull().cast("int").alias("none"), F.coalesce(source, F.lit("")).alias("source"), key.alias("key"), size.alias("size"))
    return some.groupBy("id", "none", "source", "key", "size").agg(F.count("*").alias("copies"))


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST) -> DataFrame:
    """(none, source, source_size, rows, start, target) of each source: its size and rows, where it begins in the order of all, and its target."""
    sources = cut(rows.groupBy("none", "source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("rows")), "mixing-sources")
    ranked = running(sources, ["none", "source"], {"rank": F.lit(1), "start": F.col("source_size")}, "mixing-ranks")
    turn = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    placed = ranked.withColumn("weight", F.get(turn, (F.col("rank") % len(weights)).cast("int"))).withColumn("cap", F.col("source_size") * most)
    placed = cut(placed, "mixing-weights")
    for table in (sources, ranked):
        drop_table(table)
    total, all_weights = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, all_weights = total or 0, all_weights or 1
    # from the sources that are filled first on: what the others share by weight, if all before are full
    filled = running(placed, [F.col("cap") / F.col("weight")], {"full": F.col("cap"), "taken": F.col("weight")}, "mixing-shares")
    left, units = F.lit(share * total) - 100 * F.col("full"), F.lit(all_weights) - F.col("taken")
    wide = "decimal(38,0)"
    fits = left.cast(wide) * F.col("weight").cast("decimal(10,0)") <= F.col("cap").cast("decimal(18,0)") * (100 * units).cast("decimal(18,0)")
    found = filled.where(fits).agg(F.min(F.struct(F.col("taken"), left.alias("left"), units.alias("units"))).alias("at")).first()["at"]
    drop_table(filled)
    cap = F.col("cap").cast("double")
    target = F.least(cap, (F.col("weight") * F.lit(found["left"])).cast("double") / F.lit(100 * found["units"]).cast("double")) if found else cap
    return placed.select("none", "source", "source_size", "rows", "start", target.alias("target"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of each distinct row: (id, none, source, key, size, copies, source_size, target, epochs, left).

    Each copy is taken epochs times whole, and of all copies together `left` words more, one copy after the other.
    """
    rows = cut(rows_of(docs, id_col, text_col, source_col), "mixing-rows")
    told = targets(rows, weights, share, most)
    of = cut(told, "mixing-targets")
    placed = running(rows, ["none", "source", "key", "id"], {"before": F.col("size") * F.col("copies")}, "mixing-places")
    for table in (told, rows):
        drop_table(table)
    both = hot_lookup(placed, of, ["none", "source"], "rows", "inner")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    both = both.withColumn("epochs", F.least(epochs, F.lit(most))).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    left = F.least(F.greatest(F.col("rest") - (F.col("before") - F.col("start")), F.lit(0)), F.col("size") * F.col("copies"))
    return both.select("id", "none", "source", "key", "size", "copies", "source_size", "target", "epochs", left.alias("left"))


def each_copy(planned: DataFrame) -> DataFrame:
    """planned with a row for each copy and the number of it; many copies of one row are made by several tasks."""
    few = planned.where(F.col("copies") <= COPIES_A_TASK).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    many = planned.where(F.col("copies") > COPIES_A_TASK).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_A_TASK))))
    first = F.col("run") * COPIES_A_TASK
    many = many.repartition("key", "run").withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES_A_TASK, "copies") - 1))).drop("run")
    return few.unionByName(many)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: its id, size, source_size, target of its source, and words that the mix takes, repeats counted."""
    rows = each_copy(plan(docs, weights, share, most, id_col, text_col, source_col))
    more = F.least(F.greatest(F.col("left") - F.col("copy") * F.col("size"), F.lit(0)), F.col("size"))
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("epochs") * F.col("size") + more).alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """text up to the end of its n-th word."""
    words = F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: int = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: (id, source, epoch, words, text), a row for each time that a text is taken; the last may be its first words only."""
    planned = plan(docs, weights, share, most, id_col, text_col, source_col)
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text_col, F.lit(""))).cast("binary")))
    texts = docs.select(key.alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").isNull().cast("int").alias("none"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    texts = texts.where(F.col("text").isNotNull()).dropDuplicates(["key", "none", "source"]).drop("id")
    rows = each_copy(planned.where("size > 0").join(texts, ["key", "none", "source"]))
    more = F.least(F.greatest(F.col("left") - F.col("copy") * F.col("size"), F.lit(0)), F.col("size"))
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs")))).withColumn("words", F.when(F.col("epoch") < F.col("epochs"), F.col("size")).otherwise(more)).where("words > 0")
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(first_words(F.col("text"), F.col("words")))
    return rows.select(F.col("id").alias(id_col), F.when(F.col("none") == 0, F.col("source")).alias(source_col), "epoch", "words", text.alias(text_col))
