"""Running totals over a total order of all rows, without one task that sees them all."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.materialize import materialize


def running_totals(df: DataFrame, order: list[str], values: list[str], group: str | None = None) -> DataFrame:
    """Add `before_<value>` (bigint): the sum of the value over all rows before this one.

    `order` must be ascending and should tell all rows apart; it begins with `group` if there is
    one, and then the sums start anew in every group. The rows are range-sorted; each task adds
    up its own range, and the totals of ranges (a row for each range and group) give the offsets.
    `df` is evaluated twice, once to choose the ranges, so it should be stored. Nulls of a value
    count as 0.
    """
    schema = StructType(list(df.schema)).add("_range", "integer")
    for v in values:
        schema = schema.add(f"before_{v}", "long")

    def within(batches):
        part, last, held = TaskContext.get().partitionId(), object(), dict.fromkeys(values, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            edges, keys = [batch.num_rows], [None]
            if group:
                runs = pc.run_end_encode(batch.column(batch.schema.get_field_index(group)))
                edges, keys = runs.run_ends.to_pylist(), runs.values.to_pylist()
            columns = {v: [] for v in values}
            for lo, hi, key in zip([0, *edges], edges, keys, strict=False):
                if key != last:
                    last, held = key, dict.fromkeys(values, 0)
                for v in values:
                    own = pc.fill_null(batch.column(batch.schema.get_field_index(v)).slice(lo, hi - lo), 0).cast(pa.int64())
                    run = pc.add(pc.cumulative_sum(own), held[v])
                    columns[v].append(pc.subtract(run, own))
                    held[v] = run[-1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32())]
                + [pa.concat_arrays(columns[v]) for v in values],
                names=[*batch.schema.names, "_range", *(f"before_{v}" for v in values)],
            )

    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    stored = materialize(ranged.mapInArrow(within, schema))
    keys = ["_range"] + ([group] if group else [])
    sums = stored.groupBy(*keys).agg(*[F.sum(v).cast("bigint").alias(f"_sum_{v}") for v in values])
    earlier = (Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = stored.join(offsets, same, "left")
    return joined.withColumns({f"before_{v}": F.col(f"before_{v}") + F.col(f"_off_{v}") for v in values}).drop(
        "_range", *[f"_off_{v}" for v in values], *[f"_k_{k}" for k in keys]
    )
