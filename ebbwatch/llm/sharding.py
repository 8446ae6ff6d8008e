"""K-d tree sharding: cells of metadata space, cut at distributed weighted medians into shards of equal bytes.

Each row has a whole number per dimension: the dimension's value in the high bits and bits of a
content hash and an id hash below, so that cuts fall between rows even where a third of them are copies. A cell that
has to become k shards is cut along its widest dimension where k // 2 of its k target sizes lie below. A
cut is found by histograms of the cells' weights; only when a histogram's bin holds few rows do
those rows, a bounded number, reach the driver to fix the cut exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import named, read_table
from ebbwatch.session import write_table

SHARDS = 40
ROW_OVERHEAD = 16
BINS = 1024
EXACT_ROWS = 2_000  # rows of a cell that the driver may see to fix a cut
BUCKET_ROWS = 2_000  # rows that one window task numbers, about


@dataclass
class Cell:
    first: int  # shard
    shards: int
    ranges: list[tuple[int, int]]  # of the dimensions, both ends included
    cut: tuple[int, int] | None = None  # dimension, smallest value on the right
    left: "Cell | None" = None
    right: "Cell | None" = None

    def leaf_of(self, keys: list[Column]) -> Column:
        """The number of the shard, or of the first one of an uncut cell."""
        if self.cut is None:
            return F.lit(self.first)
        dimension, value = self.cut
        return F.when(keys[dimension] < F.lit(value), self.left.leaf_of(keys)).otherwise(self.right.leaf_of(keys))

    def leaves(self) -> list["Cell"]:
        return [self] if self.cut is None else self.left.leaves() + self.right.leaves()


def sharding_keys(size: Column, content: Column, spread: Column) -> dict[str, Column]:
    """The two default dimensions: size on a log scale, and content; both are the same for equal texts.

    ``content`` has 32 bits. Rows that are equal in the value differ by ``spread``, a hash of the id.
    """
    logged = F.floor(F.log2(size.cast("double") + 1) * 32768).cast("long")  # below 2^21
    low = lambda c, bits: F.pmod(c, F.lit(1 << bits))
    return {
        "size": logged * (1 << 42) + F.shiftright(content, 11) * (1 << 21) + low(spread, 21),
        "content": content * (1 << 31) + low(spread, 31),
    }


def kd_tree(points: DataFrame, keys: list[str], weight: str, shards: int) -> Cell:
    """The tree over a written table of points; a level costs a few aggregates of bounded results."""
    ends = points.agg(*[f(k) for k in keys for f in (F.min, F.max)]).first()
    root = Cell(0, shards, [(ends[2 * i] or 0, ends[2 * i + 1] or 0) for i in range(len(keys))])
    extent = [max(1, hi - lo) for lo, hi in root.ranges]
    while open_cells := [c for c in root.leaves() if c.shards > 1]:
        widest = {c.first: max(range(len(keys)), key=lambda d: (c.ranges[d][1] - c.ranges[d][0]) / extent[d]) for c in open_cells}
        cuts = _cuts(points, root, open_cells, widest, keys, weight)
        for c in open_cells:
            d, value = widest[c.first], cuts[c.first]
            lo, hi = c.ranges[d]
            side = lambda part: [part if i == d else r for i, r in enumerate(c.ranges)]
            c.left = Cell(c.first, c.shards // 2, side((lo, max(lo, value - 1))))
            c.right = Cell(c.first + c.shards // 2, c.shards - c.shards // 2, side((min(hi, value), hi)))
            c.cut = (d, value)
    return root


def _cuts(
    points: DataFrame, root: Cell, cells: list[Cell], widest: dict[int, int], keys: list[str], weight: str
) -> dict[int, int]:
    """For each cell the key at which its bytes divide as its shards do, as near as rows allow."""
    spark = points.sparkSession
    columns = [F.col(k) for k in keys]
    cell = root.leaf_of(columns).alias("cell")
    along = F.lit(None).cast("long")
    for c in cells:
        along = F.when(F.col("cell") == c.first, columns[widest[c.first]]).otherwise(along)
    placed = points.select(cell, *keys, weight).select("cell", along.alias("key"), weight).where("key is not null")
    bounds = {c.first: c.ranges[widest[c.first]] for c in cells}
    below = {c.first: 0 for c in cells}  # bytes under the bounds
    goal: dict[int, float] = {}
    rows_in: dict[int, int] = {}
    cuts: dict[int, int] = {}
    while rest := [c for c in cells if c.first not in cuts]:
        fine = [c for c in rest if rows_in.get(c.first, EXACT_ROWS + 1) <= EXACT_ROWS or bounds[c.first][0] == bounds[c.first][1]]
        coarse = [c for c in rest if c not in fine]
        if coarse:
            state = [(c.first, *bounds[c.first], max(1, -(-(bounds[c.first][1] - bounds[c.first][0] + 1) // BINS))) for c in coarse]
            near = placed.join(F.broadcast(spark.createDataFrame(state, "cell int, lo long, hi long, width long")), "cell")
            bins = near.where("key between lo and hi").groupBy("cell", F.expr("(key - lo) div width").alias("bin"))
            found: dict[int, list] = {}
            for r in bins.agg(F.sum(weight).alias("bytes"), F.count("*").alias("n")).collect():
                found.setdefault(r.cell, []).append((r.bin, r.bytes, r.n))
            for c, (first, lo, hi, width) in zip(coarse, state):
                hist = sorted(found.get(first, []))
                goal.setdefault(first, sum(b for _, b, _ in hist) * (c.shards // 2) / c.shards)
                done = below[first]
                for number, size, n in hist:
                    if done + size >= goal[first]:
                        break
                    done += size
                else:
                    cuts[first] = hi
                    continue
                below[first], rows_in[first] = done, n
                bounds[first] = (lo + number * width, min(hi, lo + (number + 1) * width - 1))
        if fine:
            state = [(c.first, *bounds[c.first]) for c in fine if bounds[c.first][0] < bounds[c.first][1]]
            seen: dict[int, list] = {c.first: [] for c in fine}
            if state:
                near = placed.join(F.broadcast(spark.createDataFrame(state, "cell int, lo long, hi long")), "cell")
                few = near.where("key between lo and hi").groupBy("cell", "key").agg(F.sum(weight).alias("bytes"))
                for r in few.collect():
                    seen[r.cell].append((r.key, r.bytes))
            for c in fine:
                cuts[c.first] = _nearest(sorted(seen[c.first]), below[c.first], goal.get(c.first, 0.0), bounds[c.first])
    return cuts


def _nearest(rows: list[tuple[int, int]], below: int, goal: float, bounds: tuple[int, int]) -> int:
    """The key from which rows go to the right: the row over the goal goes where it does less harm."""
    for key, size in rows:
        if below + size >= goal:
            return key + 1 if below + size - goal < goal - below else key
        below += size
    return bounds[0] if bounds[0] == bounds[1] else bounds[1] + 1


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
    overhead: int = ROW_OVERHEAD, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (id, size, text_crc32, shard, slot), one per input row.

    The bytes of the shards are as near to equal as rows allow; copies of a text have the same coordinates
    and are only parted where a cut falls among them. Null texts count as empty; repeated rows
    are rows of their own and share a shard. ``slot`` is gapless from 0 in each shard. With no more rows
    than shards, some shards are empty. An empty input gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    points = named(docs, id_col, text_col).select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    spread = F.shiftrightunsigned(F.xxhash64("id"), 1)
    keys = {f"key_{k}": c for k, c in sharding_keys(F.col("size"), F.col("text_crc32"), spread).items()}
    points = write_table(points.withColumns(keys | {"spread": spread}), "points")
    tree = kd_tree(points, list(keys), "size", shards)
    placed = points.select(
        "id", "size", "text_crc32", "spread", tree.leaf_of([F.col(k) for k in keys]).cast("int").alias("shard")
    )
    # Slots: counts per shard and bucket give each bucket's first slot; rows are numbered inside buckets only.
    buckets = max(1, -(-points.count() // (shards * bucket_rows)))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("spread", "text_crc32"), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    firsts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("spread", "id")
    numbered = placed.withColumn("number", F.row_number().over(inside) - 1).join(firsts, ["shard", "bucket"])
    slot = (F.col("first") + F.col("number")).cast("long").alias("slot")
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", slot)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
