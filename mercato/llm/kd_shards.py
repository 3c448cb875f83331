"""Shards by a k-d tree over metadata: nodes are split at weighted medians along their widest dimension.

All nodes of a level are split together. One grouping finds the range of every dimension in every node; the widest one,
relative to its range in the whole table, is split. The point at which the wanted share of the bytes lies below is found
by histograms: bytes are summed by node and bin, the bin that holds the point is cut into bins again, until it is one
value or too light to matter; rows of one value are told apart by a number of their own. Every step is a grouping with
map-side sums whose result has BINS rows per node at most; rows are never sorted, collected or moved as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.store import saved

BINS = 512
SLIGHT = 0.0005
MOST_SHARDS = 4096
SLOT_ROWS = 10_000


@dataclass
class Node:
    """Heap number (children 2n, 2n + 1), shards it becomes (None: until small), and where it is split."""

    number: int
    shards: int | None
    bytes: int = 0
    rows: int = 0
    dimension: int = 0
    cut: float = 0.0
    tie: float = 0.0
    # While the cut is looked for: values or, among rows of one value, ties; bounds of the bin; bytes below it.
    on_tie: bool = False
    low: float = 0.0
    high: float = 0.0
    below: float = 0.0
    done: bool = field(default=False)

    @property
    def wanted(self) -> float:
        """Bytes that belong to the left child."""
        return self.bytes * ((self.shards // 2) / self.shards if self.shards else 0.5)


def _by_node(nodes: list[Node], value, kind: str) -> Column:
    """A value of each row's node; null for rows of other nodes."""
    return F.element_at(F.create_map(*[F.lit(x) for n in nodes for x in (n.number, value(n))]), F.col("node")).cast(kind)


def _value(nodes: list[Node], dimensions: list[str]) -> Column:
    return F.element_at(F.array(*dimensions), _by_node(nodes, lambda n: n.dimension + 1, "int"))


def _descend(rows: DataFrame, nodes: list[Node], dimensions: list[str]) -> DataFrame:
    """Rows with the number of the child they belong to; rows of nodes that are not split stay."""
    value, cut = _value(nodes, dimensions), _by_node(nodes, lambda n: n.cut, "double")
    left = (value < cut) | ((value == cut) & (F.col("tie") < _by_node(nodes, lambda n: n.tie, "double")))
    split = _by_node(nodes, lambda n: 1, "int").isNotNull()
    return rows.withColumn("node", F.when(~split, F.col("node")).otherwise(
        2 * F.col("node") + F.when(left, 0).otherwise(1)).cast("long"))


def _ranges(rows: DataFrame, dimensions: list[str]) -> dict[int, list]:
    seen = rows.groupBy("node").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"),
        *[f(d).alias(f"{d}_{k}") for d in dimensions for k, f in (("low", F.min), ("high", F.max))])
    return {r["node"]: r for r in seen.collect()}


def _find_cuts(rows: DataFrame, nodes: list[Node], dimensions: list[str], slight: float) -> None:
    """Set cut and tie of every node, by finer and finer histograms of bytes."""
    while waiting := [n for n in nodes if not n.done]:
        value = F.when(_by_node(waiting, lambda n: n.on_tie, "boolean"), F.col("tie")).otherwise(_value(waiting, dimensions))
        low, high = _by_node(waiting, lambda n: n.low, "double"), _by_node(waiting, lambda n: n.high, "double")
        inside = (value >= low) & (value <= high) & (
            ~_by_node(waiting, lambda n: n.on_tie, "boolean")
            | (_value(waiting, dimensions) == _by_node(waiting, lambda n: n.cut, "double")))
        place = F.least(F.lit(BINS - 1), F.floor(F.coalesce((value - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)) * BINS))
        bins = (rows.filter(inside).withColumn("value", value).groupBy("node", place.alias("bin"))
                .agg(F.sum("size").alias("bytes"), F.min("value").alias("low"), F.max("value").alias("high")))
        found: dict[int, list] = {}
        for r in bins.collect():
            found.setdefault(r["node"], []).append(r)
        for n in waiting:
            total = n.below
            for r in sorted(found[n.number], key=lambda r: r["bin"]):
                if total + r["bytes"] >= n.wanted or r["bin"] == max(x["bin"] for x in found[n.number]):
                    break
                total += r["bytes"]
            n.below, n.low, n.high = total, r["low"], r["high"]
            one, light = r["low"] == r["high"], r["bytes"] <= slight
            if light or (one and n.on_tie):
                # The bin goes to the nearer side whole; the cut lies at its lower or just above its upper end.
                left = n.wanted - total > r["bytes"] / 2
                edge = _above(r["high"]) if left else r["low"]
                if n.on_tie:
                    n.tie = edge
                else:
                    n.cut, n.tie = edge, float("-inf")
                n.done = True
            elif one:
                n.cut, n.on_tie, n.low, n.high = r["low"], True, 0.0, 1.0


def _above(x: float) -> float:
    import math

    return math.nextafter(x, math.inf)


def kd_shards(docs: DataFrame, dimensions: dict[str, Column], shards: int | None = None, target_bytes: int | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard (0 up, leaves from left to right), slot (0 up within a shard, no gaps).

    size is the UTF-8 bytes of the text (null: none) plus 1; text_crc32 is that of the empty text for null. With
    `shards` the tree has that many leaves of nearly equal bytes; with `target_bytes` it is split at medians until no
    leaf of two rows or more is larger. `dimensions` are numeric columns over docs, null counts as 0. Copies of
    a row and rows of equal metadata can be parted. An empty table gives no rows.
    """
    if (shards is None) == (target_bytes is None) or not 1 <= (shards or 1) <= MOST_SHARDS:
        raise ValueError(f"either shards, 1 to {MOST_SHARDS}, or target_bytes is asked for")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = [f"dimension_{i}" for i in range(len(dimensions))]
    number = F.monotonically_increasing_id()
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0)).alias(n) for n, c in zip(names, dimensions.values())],
        number.alias("row"))
    # Written once: from here on a row's own number is fixed, whatever is computed again.
    rows = saved(rows, "metadata").withColumn(
        "tie", F.shiftrightunsigned(F.xxhash64("row"), 11) / F.lit(float(1 << 53)))
    whole = list(_ranges(rows.withColumn("node", F.lit(1).cast("long")), names).values())
    rows = rows.withColumn("node", F.lit(1).cast("long"))
    level = [Node(1, shards)]
    leaves: list[int] = []
    while level and whole:
        seen = _ranges(rows, names)
        splits = []
        for n in level:
            if n.number not in seen:
                leaves.append(n.number)
                continue
            r = seen[n.number]
            n.bytes, n.rows = r["bytes"], r["rows"]
            if n.shards == 1 or n.rows < 2 or (target_bytes is not None and n.bytes <= target_bytes):
                leaves.append(n.number)
                continue
            wide = [(r[f"{d}_high"] - r[f"{d}_low"]) / ((whole[0][f"{d}_high"] - whole[0][f"{d}_low"]) or 1) for d in names]
            n.dimension = wide.index(max(wide))
            n.low, n.high = r[f"{names[n.dimension]}_low"], r[f"{names[n.dimension]}_high"]
            splits.append(n)
        if not splits:
            break
        if len(leaves) + 2 * len(splits) > MOST_SHARDS:
            raise ValueError(f"over {MOST_SHARDS} shards; ask for larger ones")
        heavy = sum(n.bytes for n in splits) / sum(n.shards or 2 for n in splits)
        _find_cuts(rows, splits, names, SLIGHT * heavy)
        rows = saved(_descend(rows, splits, names), "nodes")
        level = [Node(2 * n.number + side, n.shards and (n.shards // 2 if side == 0 else n.shards - n.shards // 2))
                 for n in splits for side in (0, 1)]
    depth = max((n.bit_length() for n in leaves), default=1)
    in_order = sorted(leaves, key=lambda n: n << (depth - n.bit_length()))
    shard = F.element_at(F.create_map(*[F.lit(x) for i, n in enumerate(in_order) for x in (n, i)]), F.col("node")) if leaves else F.lit(0)
    return slotted(rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), "row"))


def slotted(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without gaps: within parts of bounded size, from the parts' running counts."""
    most = rows.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    placed = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(1 + most // SLOT_ROWS)))
    before = (placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "row")) - 1
    return (placed.withColumn("inside", inside).join(before, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).alias("slot")))
