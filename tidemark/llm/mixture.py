"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in an order shuffled by hash, passed through `passes`
times. A queue entry's virtual finish time is the source's tokens up to and with it, divided by the
source's weight. All entries are sorted by finish time over the whole table, and the mix takes them
until the next would exceed the total budget. A source that has run out frees its share for the
others, so the mix meets the capped targets within one document of each source.

Every row is an entry of its own, also where rows are equal: a third of all rows under one id fills its source's
share as exactly as other rows do. Running sums come from range-sorted tasks and the totals of ranges, so
a source, or an id, with a third of all rows is spread over many tasks.

Defined cases: equal rows differ by a running number, and which of them is taken more often cannot be told from
the result; size counts words, a null text has none; null ids and sources are kept, the null
source is the last one; a table without words takes nothing; extra columns are ignored by the sizes and kept by the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ordering import running_totals
from tidemark.plans.materialize import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5  # of all sizes
PASSES = 2
SEED = 17
KEY = ("doc_id", "source", "size", "content")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size, weight, target): shares by weight, none above `passes` times the size.

    The excess of capped sources goes to the others by weight until none is above its cap. That
    fixed point is min(cap, level * weight), and the level is the largest value of (budget - caps
    of the sources before) / (weights from here on) over the sources sorted by cap / weight.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = materialize(sums.withColumns({"_last": F.col("source").isNull(), "_one": F.lit(1)}))
    ranked = running_totals(sums, ["_last", "source"], ["_one"])
    place = F.pmod("before__one", F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    scale = 1_000_000  # running sums are whole numbers
    ranked = materialize(
        ranked.withColumn("weight", weight).withColumns(
            {
                "_cap": F.col("source_size") * passes,
                "_units": F.round(F.col("weight") * scale).cast("bigint"),
                "_ratio": F.col("source_size") / F.col("weight"),
            }
        )
    )
    total, units = ranked.agg(F.sum("source_size"), F.sum("_units")).first()
    if not total:
        return ranked.select("source", "source_size", "weight", F.lit(0.0).alias("target"))
    queued = running_totals(ranked, ["_ratio", "_last", "source"], ["_cap", "_units"])
    level = (F.lit(share * total) - F.col("before__cap")) / (F.lit(units) - F.col("before__units")) * scale
    highest = queued.agg(F.max(level)).first()[0]
    target = F.least(F.col("_cap").cast("double"), F.lit(highest) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _key_columns(documents: DataFrame) -> list[Column]:
    hashed = [f.name for f in documents.schema if "map<" not in f.dataType.simpleString()]
    content = F.xxhash64(*[F.col(f"`{c}`") for c in hashed])
    return [F.col("doc_id"), F.col("source"), words(F.col("text")).alias("size"), content.alias("content")]


def sized_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, content) of every row; content is a hash of all columns that have one."""
    return documents.select(*_key_columns(documents))


def mix_plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: int = SEED) -> DataFrame:
    """The rows of `sized` (as from `sized_rows`) with source_size, weight, target and times: how often the mix
    takes the row (0 to `passes`)."""
    # Stored once, so that the running number of a row is the same for all readers.
    sized = materialize(sized.withColumn("_row", F.monotonically_increasing_id()))
    targets = materialize(source_targets(sized, weights, share, passes))
    same = F.col("source").eqNullSafe(F.col("_source"))
    entries = sized.join(targets.withColumnRenamed("source", "_source"), same).drop("_source")
    entries = materialize(
        entries.withColumns(
            {
                "_group": F.concat(F.when(F.col("source").isNull(), "1").otherwise("0"), F.coalesce("source", F.lit(""))),
                "_key": F.xxhash64(F.lit(seed), "doc_id", "size"),
            }
        )
    )
    # Rows with equal keys come one after the other, whichever number each of them has.
    queue = ["_group", "_key", "doc_id", "size", "content", "_row"]
    queued = materialize(running_totals(entries, queue, ["size"], group="_group"))

    def finish(k: Column) -> Column:
        return (F.col("before_size") + F.col("size") + F.col("source_size") * k) / F.col("weight")

    passed = queued.where("size > 0").withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    passed = passed.select(finish(F.col("_pass")).alias("_finish"), *queue)
    order = ["_finish", *queue]
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    line = running_totals(materialize(passed), order, ["size"])
    taken = line.where(F.col("before_size") + F.col("size") <= F.lit(share * total))
    last = taken.agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        times = F.lit(0)
    else:
        end = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(last, taken.select(*order).schema, strict=True)])
        here = [F.struct(finish(F.lit(k)).alias("_finish"), *queue) <= end for k in range(passes)]
        times = F.when(F.col("size") > 0, sum((h.cast("int") for h in here), F.lit(0))).otherwise(0)
    return queued.select(*KEY, "source_size", "weight", "target", times.alias("times"))


def mix_sizes(documents: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) for every document."""
    plan = mix_plan(sized_rows(documents), **settings)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mix_documents(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns.

    Equal rows are taken equally often but for one place in each source, where the mix ends among them:
    `more` of them are taken `high` times and the others `low` times. Only those rows are numbered.
    """
    plan = mix_plan(sized_rows(documents), **settings)
    groups = plan.groupBy(*KEY).agg(
        F.min("times").alias("low"),
        F.max("times").alias("high"),
        # Rows of one group are neighbours in their queue, so their times differ by one at most.
        (F.sum("times") - F.min("times") * F.count(F.lit(1))).alias("more"),
    )
    groups = materialize(groups.where("high > 0").withColumn("_edge", F.when(F.col("low") < F.col("high"), F.monotonically_increasing_id())))
    own = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_document")
    rows = documents.select(own, F.struct(*_key_columns(documents)).alias("_key"))

    def joined(part: DataFrame) -> DataFrame:
        found = part.select(*[F.col(c).alias(f"_{c}") for c in KEY], "low", "high", "more", "_edge")
        same = [F.col(f"_key.{c}").eqNullSafe(F.col(f"_{c}")) for c in KEY]
        return rows.join(found, same).select("_document", "low", "high", "more", "_edge")

    even = joined(groups.where("_edge is null")).select("_document", F.col("low").alias("times"))
    # A group for each source at most: a small table, whatever the number of its rows.
    edge = materialize(joined(groups.where("_edge is not null")).withColumns({"_id": F.monotonically_increasing_id(), "_one": F.lit(1)}))
    numbered = running_totals(edge, ["_edge", "_id"], ["_one"], group="_edge")
    times = F.when(F.col("before__one") < F.col("more"), F.col("high")).otherwise(F.col("low"))
    taken = even.unionByName(numbered.select("_document", times.alias("times"))).where("times > 0")
    return taken.select("_document", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_time")).select("_document.*")
