"""Sharding by a k-d tree over metadata, with DataFrame functions only.

A node is split at the weighted median of its widest dimension, its range
relative to the whole table's, until every leaf has the target bytes. All
nodes of a level are split together. A median is found by summing weights in
equal bins of each node's range and then of the bin that holds it, so the
driver sees a few numbers a node and no row is sorted for it. Rows alike in
all dimensions stay in one leaf.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, col
from .jaccard_join import _by

#: Bins of a search step, and the share of a node's weight at which it stops.
BINS, CLOSE = 512, 2e-4


def _numbers(spark, names: str, rows: Sequence[tuple[int, ...]]) -> DataFrame:
    """A small table of whole numbers as literals, which needs no Python on the executors."""
    wide = lambda row: ", ".join(f"cast({x} as bigint)" for x in row)
    return spark.sql(f"select * from values {', '.join(f'({wide(row)})' for row in rows)} as t({names})")


def _medians(rows: DataFrame, nodes: dict[int, dict]) -> None:
    """Put a ``cut`` into each node: rows with at most that value go left, None if no cut parts them."""
    open_ = {k: n | {"lo": n["low"], "hi": n["high"], "below": 0} for k, n in nodes.items()}
    for n in nodes.values():
        n["cut"], n["miss"] = None, n["weight"]
    while open_:
        table = _numbers(rows.sparkSession, "node, dim, lo, step", [(k, n["dim"], n["lo"], max(1, -(-(n["hi"] - n["lo"] + 1) // BINS))) for k, n in open_.items()])
        dims = F.array(*[F.col(c) for c in rows.columns if c.startswith("x")])
        steps = {k: max(1, -(-(n["hi"] - n["lo"] + 1) // BINS)) for k, n in open_.items()}
        found = rows.join(F.broadcast(table), "node").withColumn("bin", F.floor((F.get(dims, F.col("dim").cast("int")) - F.col("lo")) / F.col("step")))
        found = found.where((F.col("bin") >= 0) & (F.col("bin") < BINS)).groupBy("node", "bin").agg(F.sum("w").alias("w")).collect()
        sums: dict[int, list[tuple[int, int]]] = {}
        for r in found:
            sums.setdefault(r.node, []).append((r.bin, r.w))
        later = {}
        for k, n in open_.items():
            target, below, node, step = n["weight"] * n["left"] / n["leaves"], n["below"], nodes[k], steps[k]
            for b, w in sorted(sums.get(k, [])):
                end = min(n["lo"] + (b + 1) * step - 1, n["hi"])
                for cut, weight in ((n["lo"] + b * step - 1, below), (end, below + w)):
                    if n["low"] <= cut < n["high"] and abs(weight - target) < node["miss"]:
                        node["cut"], node["miss"] = cut, abs(weight - target)
                if below <= target <= below + w:
                    if step > 1 and node["miss"] > CLOSE * n["weight"]:
                        later[k] = n | {"lo": n["lo"] + b * step, "hi": end, "below": below}
                    break
                below += w
        open_ = later


def kd_shards(rows: DataFrame, dims: Sequence[str], weight_col: str, target_weight: float | None = None, leaves: int | None = None) -> DataFrame:
    """Add ``shard``, from 0, to each row.

    ``dims`` are integer columns; nulls count as their least value. The number
    of leaves is given, or else the total weight over ``target_weight``. Null
    weights count as 0. Rows alike in all dimensions share a shard, so a leaf
    whose rows are all alike is not split and its spare numbers stay unused.
    An empty table gives none. Columns named ``shard`` are replaced.
    """
    carry = [c for c in rows.columns if c != "shard"]
    xs = [f"x{i}" for i in range(len(dims))]
    held = rows.select(*[col(c).alias(f"k{i}") for i, c in enumerate(carry)], *[F.coalesce(col(d).cast("long"), F.lit(-(2**40))).alias(x) for d, x in zip(dims, xs)], F.coalesce(col(weight_col).cast("long"), F.lit(0)).alias("w"))
    held = checkpointed(held.withColumn("node", F.lit(0)))
    ranges = lambda df: df.groupBy("node").agg(F.sum("w").alias("w"), *[f(x).alias(f"{n}{x}") for x in xs for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    stats = ranges(held)
    if not stats:
        return held.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(carry)], F.col("node").alias("shard"))
    if leaves is None:
        leaves = max(1, round(stats[0].w / target_weight))
    whole = [max(1, stats[0][f"hi{x}"] - stats[0][f"lo{x}"]) for x in xs]
    numbers, level = {0: (0, leaves)}, 0  # node: its first shard and how many it makes
    while True:
        nodes = {}
        for r in stats:
            first, count = numbers[r.node]
            dim = max(range(len(xs)), key=lambda i: ((r[f"hi{xs[i]}"] - r[f"lo{xs[i]}"]) / whole[i], -i))
            if count > 1 and r[f"hi{xs[dim]}"] > r[f"lo{xs[dim]}"] and r.w:
                nodes[r.node] = {"dim": dim, "low": r[f"lo{xs[dim]}"], "high": r[f"hi{xs[dim]}"], "weight": r.w, "leaves": count, "left": count // 2}
        _medians(held, nodes)
        cuts = [(k, n["dim"], n["cut"], numbers[k][0] + n["left"]) for k, n in nodes.items() if n["cut"] is not None]
        if not cuts:
            break
        for k, n in nodes.items():
            if n["cut"] is not None:
                first, count = numbers[k]
                numbers[first], numbers[first + n["left"]] = (first, n["left"]), (first + n["left"], count - n["left"])
        table = _numbers(rows.sparkSession, "node, dim, cut, right", cuts)
        value = F.get(F.array(*xs), F.col("dim").cast("int"))
        held = held.join(F.broadcast(table), "node", "left").withColumn("node", F.when(value > F.col("cut"), F.col("right").cast("int")).otherwise(F.col("node"))).drop("dim", "cut", "right")
        level += 1
        held = checkpointed(held) if level % 4 == 0 else held
        stats = ranges(held)
    return held.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(carry)], F.col("node").alias("shard"))


def number_slots(rows: DataFrame, key_cols: Sequence[str], chunks: int) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard, numbered in hashed chunks side by side."""
    keyed = checkpointed(rows.withColumn("chunk", F.pmod(F.xxhash64(*[col(c) for c in key_cols]), F.lit(chunks)).cast("int")))
    counts = keyed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(_by("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(_by("shard", "chunk").orderBy(*[col(c) for c in key_cols]))
    numbered = keyed.withColumn("rank", rank).join(F.broadcast(offsets), ["shard", "chunk"])
    return numbered.withColumn("slot", F.col("before") + F.col("rank") - 1).drop("chunk", "rank", "before")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shards of near equal bytes: rows (id, size, text_crc32, law, shard, slot, grown_shard).

    A row's size is its text's bytes in UTF-8 plus 1; a null text has none.
    The dimensions, size and checksum, depend on the text alone: copies of a
    text stay together, however many, so a group over the target fills its
    shard beyond it. Ids may be null or repeat.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    sizes = docs.select(col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = kd_shards(sizes, ["size", "text_crc32"], "size", leaves=shards)
    chunks = max(4, -(-4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    out = number_slots(placed, ["id", "text_crc32", "size"], chunks)
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
