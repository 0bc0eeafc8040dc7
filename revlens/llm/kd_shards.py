"""K-d tree sharding: leaves of near-equal bytes in metadata space.

The tree splits a node along its widest metadata dimension (its range
there against the whole table's) at the weighted median, the place where
the bytes stand in the proportion of the leaves on either side, until
every node is one leaf of about ``target_bytes``. Each level is a few
aggregates over the written metadata: minima and maxima, then histograms
of bytes that close in on each node's cut. A dimension with few values
cannot be cut evenly by value, so rows of one value are told apart by a
hash of their row number: the cut falls within the value.

What reaches the driver is bounded by leaves x ``BUCKETS``. Each level is
written once as (row number, size, dimensions, node); the texts are read
once. The slot in a shard comes from ranks within the written parts, so
no task holds a whole shard.

Cases: a null text has 16 bytes, a null dimension sorts first; equal rows
are dealt one by one; extra columns are ignored; an empty table gives an
empty result; with more leaves than rows some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.stage import materialize, tuned, with_uid

BUCKETS = 4096
TOLERANCE = 0.0005
TIES = 1 << 36


class _Cut:
    """A node of leaves [first, first + leaves), and the search for its cut."""

    def __init__(self, first: int, leaves: int) -> None:
        self.first, self.leaves, self.left = first, leaves, leaves // 2
        self.dim, self.low, self.high, self.wanted, self.slack = 0, 0, 0, 0.0, 0.0
        self.value: int | None = None  # once the cut is known to fall within one value
        self.cut = (0, 0)  # rows below (value, tie) go left

    def children(self) -> list[_Cut]:
        return [_Cut(self.first, self.left), _Cut(self.first + self.left, self.leaves - self.left)]

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // BUCKETS))

    def narrow(self, weights: dict[int, tuple[int, int]]) -> bool:
        """Take one histogram in; true when the cut is found."""
        before, weight, rows, bucket = 0.0, 0.0, 0, max(weights, default=0) + 1
        for k in sorted(weights):
            if before + weights[k][0] > self.wanted:
                bucket, (weight, rows) = k, weights[k]
                break
            before += weights[k][0]
        start, rest = self.low + bucket * self.step, self.wanted - before
        if rest <= self.slack:
            return self._found(start)
        if weight - rest <= self.slack:
            return self._found(start + self.step)
        if rows == 1:  # a row cannot be cut: to the nearer side
            return self._found(start + self.step if 2 * rest > weight else start)
        if self.step > 1:
            self.low, self.high, self.wanted = start, start + self.step - 1, rest
        elif self.value is None:
            self.value, self.low, self.high, self.wanted = start, 0, TIES - 1, rest
        else:
            return self._found(start)
        return False

    def _found(self, at: int) -> bool:
        self.cut = (at, 0) if self.value is None else (self.value, at)
        return True


def _floor_div(a: Column, b: Column) -> Column:
    """a div b of longs; b is 0 only where a node is not asked for."""
    by = F.greatest(b, F.lit(1))
    return ((a - F.pmod(a, by)) / by).cast("long")


def _of_node(values: list[int]) -> Column:
    """The entry of a row's node; nodes are numbered by their first leaf."""
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), F.col("_node") + 1)


def grow(meta: DataFrame, dims: list[str], leaves: int) -> DataFrame:
    """``meta`` (_size, _tie, dimensions as longs) with ``_node``, the leaf of each row."""
    placed = meta.withColumn("_node", F.lit(0))
    nodes = [_Cut(0, leaves)]
    whole: list[int] = []
    while open_ := [n for n in nodes if n.leaves > 1]:
        stats = {
            r["_node"]: r for r in placed.groupBy("_node").agg(
                F.sum("_size").alias("_bytes"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))
            ).collect()
        }
        cuts = []
        for node in open_:
            if (r := stats.get(node.first)) is None:
                continue  # no rows: any cut will do
            wide = [r[f"hi_{d}"] - r[f"lo_{d}"] for d in dims]
            whole = whole or [max(w, 1) for w in wide]
            node.dim = max(range(len(dims)), key=lambda i: wide[i] / whole[i])
            node.low, node.high = r[f"lo_{dims[node.dim]}"], r[f"hi_{dims[node.dim]}"]
            node.wanted, node.slack = r["_bytes"] * node.left / node.leaves, TOLERANCE * r["_bytes"] / node.leaves
            cuts.append(node)

        def table(of: Callable[[_Cut], int], known: list[_Cut]) -> Column:
            values = [0] * leaves
            for node in known:
                values[node.first] = of(node)
            return _of_node(values)

        by_dim = F.element_at(F.array(*dims), table(lambda n: n.dim, open_).cast("int") + 1)
        valued = placed.withColumn("_value", by_dim)
        while cuts:
            tied = table(lambda n: n.value is not None, cuts) == 1
            axis = F.when(tied, F.col("_tie")).otherwise(F.col("_value"))
            found = (
                valued.filter(table(lambda n: 1, cuts) == 1).filter(~tied | (F.col("_value") == table(lambda n: n.value or 0, cuts)))
                .withColumn("_axis", axis).filter(F.col("_axis").between(table(lambda n: n.low, cuts), table(lambda n: n.high, cuts)))
                .withColumn("_bucket", _floor_div(F.col("_axis") - table(lambda n: n.low, cuts), table(lambda n: n.step, cuts)))
                .groupBy("_node", "_bucket").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows")).collect()
            )
            weights: dict[int, dict[int, tuple[int, int]]] = {n.first: {} for n in cuts}
            for r in found:
                weights[r["_node"]][r["_bucket"]] = (r["_bytes"], r["_rows"])
            cuts = [n for n in cuts if not n.narrow(weights[n.first])]
        value, tie = table(lambda n: n.cut[0], open_), table(lambda n: n.cut[1], open_)
        goes_right = (F.col("_value") > value) | ((F.col("_value") == value) & (F.col("_tie") >= tie))
        placed = materialize(
            valued.withColumn("_node", F.when(goes_right, F.col("_node") + table(lambda n: n.left, open_).cast("int")).otherwise(F.col("_node"))).drop("_value"), "level",
        )
        nodes = [c for n in nodes for c in (n.children() if n.leaves > 1 else [n])]
    return placed


def _ordinal(name: str, kind: str) -> Column:
    """A dimension as a long that keeps its order; null first. Names and
    other types have no distance: they stand in the order of a 20-bit hash."""
    c = F.col(f"`{name}`")
    if kind in ("tinyint", "smallint", "int", "bigint", "date", "boolean"):
        return F.coalesce(c.cast("int" if kind in ("date", "boolean") else "bigint").cast("bigint"), F.lit(-1))
    return F.when(c.isNull(), -1).otherwise(F.pmod(F.xxhash64(c), F.lit(1 << 20)))


def shard(
    docs: DataFrame, dims: list[str], *, shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", overhead: int = 16,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    Give the number of shards or the bytes that a shard should hold.
    """
    tuned(docs)
    kinds = dict(docs.dtypes)
    meta = materialize(
        with_uid(docs.select(
            F.col(id_col).alias("_id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + overhead).cast("bigint").alias("_size"),
            F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("_crc"), *(_ordinal(d, kinds[d]).alias(f"_d{i}") for i, d in enumerate(dims)),
        ), "_uid").withColumn("_tie", F.pmod(F.xxhash64("_uid"), F.lit(TIES))).withColumn("_part", F.shiftright("_uid", 33)),
        "metadata",
    )
    if shards is None:
        total = meta.agg(F.sum("_size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    columns = [f"_d{i}" for i in range(len(dims))]
    placed = grow(meta, columns, shards).withColumn("shard", F.col("_node").cast("int")).select("_id", "_uid", "_size", "_crc", "_part", "shard")
    # A row's slot: rows of its shard in earlier parts, and before it in its own part.
    per_part = placed.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_uid")) - 1
    return placed.withColumn("_own", own).join(before, ["shard", "_part"]).select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", (F.col("_before") + F.col("_own")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
