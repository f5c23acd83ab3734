"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listora.session import write_out


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find within a task: links of a task become one link from each node to the least of its group.

    Groups are emitted whenever a batch ends, so that the table of parents follows the batch.
    """
    for batch in batches:
        parent: dict = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        links = [(root(x), x) for x in parent]
        links = [(a, b) for a, b in links if a != b]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in links], batch.schema.field(0).type), pa.array([b for _, b in links], batch.schema.field(0).type)],
            names=["a", "b"],
        )


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Columns node, component (the least node reachable) for every node that has a link. Links are columns a, b.

    Large-star and small-star steps (connected components in MapReduce, Kiveris et al. 2014): every node sends its
    neighbours to the least node around it, until links are stars. Each step is a grouped minimum and a join, and each
    round is written to the shared folder. A hub costs a partial minimum and a join that Spark can split. Null or equal
    ends are no links. Raises if `most_rounds` do not do; rounds grow with the logarithm of the longest path.
    """
    kind = links.schema["a"].dataType.simpleString()
    links = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = write_out(links.mapInArrow(_forest, f"a {kind}, b {kind}").distinct(), "links")
    for _ in range(most_rounds):
        either = links.union(links.select("b", "a"))
        least = either.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = (
            either.where("b > a").join(least, F.col("a") == F.col("node"))
            .select(F.col("low").alias("a"), "b").where("a != b").distinct()
        )
        low = large.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("low"))
        small = large.join(low, F.col("b") == F.col("node")).select(
            F.explode(F.array(F.struct(F.col("low").alias("a"), "b"), F.struct(F.col("low").alias("a"), F.col("a").alias("b")))).alias("link")
        )
        after = write_out(small.select("link.*").where("a != b").distinct(), "links")
        settled = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
        many = after.groupBy("b").count().where("count > 1").isEmpty()
        links = after
        if settled and many:
            stars = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
            return stars.union(links.select("a", "a").distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
