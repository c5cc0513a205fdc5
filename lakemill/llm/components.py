"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.textarrays import mixed, unmixed
from lakemill.session import cut

LINKS = "a bigint, b bigint"


def contract(pairs: np.ndarray) -> np.ndarray:
    """The links of one batch as stars: each node with the least node of its component within the batch."""
    if not len(pairs):
        return pairs
    nodes, places = np.unique(pairs.reshape(-1), return_inverse=True)
    a, b = places.reshape(-1, 2).T
    roots = np.arange(len(nodes))
    while True:
        low = roots.copy()
        np.minimum.at(low, a, roots[b])
        np.minimum.at(low, b, roots[a])
        np.minimum.at(low, roots[a], low[a])
        np.minimum.at(low, roots[b], low[b])
        low = low[low]
        if (low == roots).all():
            break
        roots = low
    own = np.arange(len(nodes)) != roots
    return np.stack([nodes[own], nodes[roots[own]]], axis=1)


def _mapped(change):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [change(c.to_numpy().view(np.uint64)).view(np.int64) for c in batch.columns]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], batch.schema.names)

    return run


def _contract_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [np.stack([c.to_numpy() for c in batch.columns], axis=1) for batch in batches if batch.num_rows]
    if parts:
        stars = contract(np.concatenate(parts))
        yield pa.RecordBatch.from_arrays([pa.array(stars[:, 0]), pa.array(stars[:, 1])], ["a", "b"])


def _number_and_contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _contract_partition(_mapped(mixed)(batches))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for every node of ``edges``.

    Nodes are numbered anew by a one-to-one mix of their bits, so that their order is
    random and leaves no long chains; that is done in the first round's contraction, as a
    step of its own would have a second Python worker beside the one that finds the links. Each round deals links out by node and contracts those
    of a partition to stars; then every node is merged into the least of itself and its
    neighbours, and links are rewritten to the merged nodes. Links and nodes fall by a
    factor from round to round. Least neighbours are taken on the map side, so a node with
    very many neighbours is no burden. A round's links and steps are written to the shared
    folder. Self loops and repeated links are harmless; an empty table gives an empty result.
    """
    shards = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def contracted(links: DataFrame, contract_partition=_contract_partition) -> DataFrame:
        return cut(links.repartition(shards, "a").mapInArrow(contract_partition, LINKS))

    apart = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).filter(F.col("a") != F.col("b"))
    links = contracted(apart, _number_and_contract)
    labels = None
    while labels is None or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        merged = cut(both.groupBy(F.col("a").alias("of")).agg(F.least(F.first("a"), F.min("b")).alias("to")))
        left = links.join(merged, F.col("a") == F.col("of")).select(F.col("to").alias("a"), "b")
        right = left.join(merged, F.col("b") == F.col("of")).select("a", F.col("to").alias("b"))
        links = contracted(right.filter(F.col("a") != F.col("b")))
        if labels is None:
            labels = merged.select(F.col("of").alias("node"), F.col("to").alias("root"))
        else:
            # Rounds are few, so their steps are put together in one plan at the end.
            labels = labels.join(merged, F.col("root") == F.col("of"), "left").select("node", F.coalesce("to", "root").alias("root"))
    named = cut(labels.mapInArrow(_mapped(unmixed), "node bigint, root bigint"))
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("node").alias("least"))
    return named.join(least, F.col("root") == F.col("r")).select("node", F.col("least").alias("root"))
