"""The trie of all prefixes of conversations, from padded matrices of turn ids.

A conversation is cut into blocks of ``BLOCK`` turns. Equal blocks behind equal beginnings are counted into one row; the
rows are sharded by ranges of (beginning, turn ids). A shard is a matrix of turn ids, one row per block, padded at the end: it is
sorted with ``lexsort``, a mask marks where a column changes from row to row, and the mask's running OR over the columns
marks the rows at which a node of each depth begins. ``reduceat`` then aggregates every depth from the deepest up.

Nodes at the edges of a shard may go on in the next shard, and nodes above a block that is not the conversation's last
go on in other blocks. These *open* nodes are sent with what the shard knows of them, the closed nodes below
included, and recombined by key; whatever only they know is then added to the open nodes above them, along the path
in their block, and from block to block by pointer doubling.

Ids of turns and keys of nodes are two 64-bit hashes each; equal ids are taken for equal turns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, map_batches, named, read_table
from ebbwatch.llm.digests import EMPTY, joined_digests
from ebbwatch.llm.ordering import placed
from ebbwatch.session import write_table

BLOCK = 16  # turns
SHARD_ROWS = 50_000  # rows of a matrix, about
SEGMENT = 1024  # blocks
SHARED = 5  # turns that a rebuilt conversation may take over, at most
PAD = np.iinfo(np.int64).min


def turn_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv, pos, hi, lo, chars): the turns of each conversation in order, each as an id of its role and text.

    Turns come by number (null first), those of one number by id. Null roles and texts read as empty; rows
    without a conversation are left out; equal rows are as many turns.
    """
    whole = named(rows, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text").where("conv IS NOT NULL")
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    ids = whole.select(
        F.col("conv").cast("long"), "turn", F.xxhash64(F.lit(1), role, text).alias("hi"), F.xxhash64(F.lit(2), role, text).alias("lo"),
        F.char_length(text).cast("long").alias("chars"),
    )
    counted = ids.groupBy("conv", "turn", "hi", "lo", "chars").agg(F.count("*").alias("copies"))
    every = placed(counted, "conv", ["turn", "hi", "lo"], "copies")
    return every.select("conv", F.explode(F.sequence("pos", F.col("pos") + F.col("copies") - 1)).alias("pos"), "hi", "lo", "chars")


def _lane(number: int, k, ids) -> Column:
    return F.xxhash64(F.lit(number), k, ids)


def _blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (conv, k, ka, kb, ids, chars, last): the blocks of each conversation, with the key of the turns before
    them. A conversation without turns has one empty block."""
    lengths = turns.groupBy("conv").agg(F.count("*").alias("turns"))
    cut = turns.groupBy("conv", (F.col("pos") / BLOCK).cast("long").alias("k")).agg(F.array_sort(F.collect_list(F.struct("pos", "hi", "lo", "chars"))).alias("of"))
    none = F.expr("cast(array() as array<long>)")
    rows = convs.join(lengths, "conv", "left").join(cut, "conv", "left").select(
        "conv", F.coalesce("turns", F.lit(0)).alias("turns"), F.coalesce("k", F.lit(0)).cast("long").alias("k"),
        F.coalesce(F.flatten(F.transform("of", lambda t: F.array(t["hi"], t["lo"]))), none).alias("ids"),
        F.coalesce(F.col("of.chars"), none).alias("chars"),
    )
    rows = write_table(rows.withColumn("last", F.col("turns") <= (F.col("k") + 1) * BLOCK), "blocks")
    zero = F.lit(0).cast("long")
    short = rows.where(F.col("turns") <= BLOCK).withColumns({"ka": zero, "kb": zero})
    # Keys are combined by XOR, in segments of a bounded number of blocks.
    long = rows.where(F.col("turns") > BLOCK).withColumns(
        {"segment": F.expr(f"k div {SEGMENT}"), "da": _lane(1, F.col("k"), F.col("ids")), "db": _lane(2, F.col("k"), F.col("ids"))}
    )
    before = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    xor = lambda c, window: F.coalesce(F.bit_xor(c).over(window), zero)
    totals = long.groupBy("conv", "segment").agg(F.bit_xor("da").alias("ta"), F.bit_xor("db").alias("tb"))
    over = before(["conv"], "segment")
    totals = totals.select("conv", "segment", xor("ta", over).alias("ta"), xor("tb", over).alias("tb"))
    inside = before(["conv", "segment"], "k")
    long = long.withColumns({"ia": xor("da", inside), "ib": xor("db", inside)}).join(totals, ["conv", "segment"])
    long = long.withColumns({"ka": F.col("ia").bitwiseXOR(F.col("ta")), "kb": F.col("ib").bitwiseXOR(F.col("tb"))})
    columns = ["conv", "k", "ka", "kb", "ids", "chars", "last"]
    return short.select(*columns).union(long.select(*columns))


def _matrix(column: pa.ListArray, width: int, each: int, fill: int) -> np.ndarray:
    """Lists as the rows of a padded matrix, or a stack of ``each`` interleaved ones."""
    flat, ends = np.asarray(column.flatten()).astype(np.int64), np.cumsum(np.asarray(pc.list_value_length(column)).astype(np.int64))
    sizes = np.diff(ends, prepend=0)
    out = np.full((each, len(column), width), fill, np.int64)
    at = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    out[at % each, np.repeat(np.arange(len(column)), sizes), at // each] = flat
    return out


_NODE = (
    "depth long, a long, b long, pa long, pb long, parent long, n long, least long, chars long, children long, "
    "leaves long, saved long, root long, open boolean, path array<struct<a: long, b: long>>"
)
_PATH = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def shard_nodes(table: pa.Table, block: int) -> pa.RecordBatch:
    """The nodes of a shard. ``leaves`` and ``saved`` of an open node are those of the closed nodes below it, ``children``
    its closed ones; ``parent`` is the smallest member of a closed parent. The root of a later block is counted in the block above."""
    lens = np.asarray(pc.list_value_length(table["chars"])).astype(np.int64)
    width = int(lens.max())
    ids = _matrix(table["ids"].combine_chunks(), width, 2, PAD)
    keys = [np.asarray(table[c]).astype(np.int64) for c in ("k", "ka", "kb")]
    columns = [*keys, *(ids[x, :, j] for j in range(width) for x in (0, 1)), lens]
    order = np.lexsort(columns[::-1])
    lens, ids, keys = lens[order], ids[:, order], [x[order] for x in keys]
    weight, least, ends = (np.asarray(table[c]).astype(np.int64)[order] for c in ("n", "least", "ends"))
    chars = _matrix(table["chars"].combine_chunks(), width, 1, 0)[0][order]
    a, b = (_matrix(table[c].combine_chunks(), width + 1, 1, 0)[0][order] for c in ("a", "b"))
    rows = len(lens)
    change = np.ones((rows, width + 1), bool)
    change[1:, 0] = np.any([x[1:] != x[:-1] for x in keys], 0)
    valid = lens[:, None] > np.arange(width)
    change[1:, 1:] = np.any(ids[:, 1:] != ids[:, :-1], 0) | (valid[1:] != valid[:-1])
    begins = np.logical_or.accumulate(change, axis=1)
    goes_on = (lens == block) & (weight > ends)

    made: list[dict] = []
    row_leaves, row_saved, row_children = (np.zeros(rows, np.int64) for _ in range(3))
    for depth in range(width, -1, -1):
        starts = np.flatnonzero(begins[:, depth])
        stops = np.append(starts[1:], rows)
        real = lens[starts] >= depth
        members, smallest = np.add.reduceat(weight, starts), np.minimum.reduceat(least, starts)
        opened = (depth == 0) | (starts == 0) | (stops == rows) | np.logical_or.reduceat(goes_on, starts)
        children = np.add.reduceat(row_children, starts)
        size = chars[starts, depth - 1] if depth else np.zeros(len(starts), np.int64)
        closed = real & ~opened
        row_leaves[starts] += closed & (children == 0)
        row_saved[starts] += np.where(closed, (members - 1) * size, 0)
        row_children[:] = 0
        row_children[starts[closed]] = 1
        later = (keys[0][starts] > 0) & (depth == 0)
        made.append({
            "starts": starts, "real": real, "open": opened, "depth": keys[0][starts] * block + depth, "n": np.where(later, 0, members),
            "least": smallest, "later": later, "chars": size, "children": children, "root": np.full(len(starts), int(depth == 0)),
            "leaves": np.add.reduceat(row_leaves, starts), "saved": np.add.reduceat(row_saved, starts),
        })
    made.reverse()
    out = []
    for depth, nodes in enumerate(made):
        kept = nodes["real"]
        at, opened = nodes["starts"][kept], nodes["open"][kept]
        if depth:
            above = made[depth - 1]
            up = np.searchsorted(above["starts"], at, "right") - 1
            parent = pa.array(above["least"][up], mask=above["open"][up])
            pa_, pb_ = pa.array(a[at, depth - 1]), pa.array(b[at, depth - 1])
        else:
            parent = pa_ = pb_ = pa.nulls(len(at), pa.int64())
        paths = [[{"a": x, "b": y} for x, y in zip(a[r, :depth].tolist(), b[r, :depth].tolist())] if o and depth else None for r, o in zip(at, opened)]
        out.append(pa.RecordBatch.from_arrays(
            [
                pa.array(nodes["depth"][kept]), pa.array(a[at, depth]), pa.array(b[at, depth]), pa_, pb_, parent, pa.array(nodes["n"][kept]),
                pa.array(nodes["least"][kept], mask=nodes["later"][kept]), *(pa.array(nodes[c][kept]) for c in ("chars", "children", "leaves", "saved", "root")),
                pa.array(opened), pa.array(paths, _PATH),
            ],
            ["depth", "a", "b", "pa", "pb", "parent", "n", "least", "chars", "children", "leaves", "saved", "root", "open", "path"],
        ))
    return pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def _below(roots: DataFrame) -> DataFrame:
    """Leaves and saved tokens of the whole subtree below each block's root, without the root's own.

    Rounds of pointer doubling: after ``i`` of them a block has the sums of the ``2 ** i`` levels of blocks from it on.
    """
    deepest = roots.agg(F.max("depth")).first()[0] or 0
    levels, reach = deepest // BLOCK, 1
    while reach <= levels:
        key = ["depth", "a", "b"]
        added = roots.where("ua IS NOT NULL").groupBy((F.col("depth") - reach * BLOCK).alias("depth"), F.col("ua").alias("a"), F.col("ub").alias("b"))
        added = added.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        jump = roots.select((F.col("depth") + reach * BLOCK).alias("depth"), F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("ua").alias("na"), F.col("ub").alias("nb"))
        sums = roots.join(added, key, "left").join(jump, ["depth", "ua", "ub"], "left")
        roots = write_table(
            sums.select(
                *key, F.col("na").alias("ua"), F.col("nb").alias("ub"),
                *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
            ),
            "subtrees",
        )
        reach *= 2
    return roots


def _recombined(parts: DataFrame) -> DataFrame:
    """The open nodes, each once, with the sums of their whole subtrees."""
    key = ["depth", "a", "b"]
    sums = parts.groupBy(*key).agg(
        *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")),
        *(F.max(c).alias(c) for c in ("pa", "pb", "chars", "root", "path")), F.min("least").alias("least"),
    )
    nodes = write_table(sums, "open")
    inner = nodes.where("pa IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    nodes = nodes.join(inner.agg(F.count("*").alias("inner")), key, "left")
    nodes = nodes.withColumn("children", F.col("children") + F.coalesce("inner", F.lit(0))).drop("inner").withColumns(
        {"own_leaves": F.when(F.col("children") == 0, 1).otherwise(0).cast("long"), "own_saved": (F.col("n") - 1) * F.col("chars")}
    )
    nodes = write_table(nodes, "open-own")
    in_block = nodes.where("path IS NOT NULL").groupBy((F.col("depth") - F.size("path")).alias("depth"), F.col("path")[0]["a"].alias("a"), F.col("path")[0]["b"].alias("b"))
    in_block = in_block.agg(F.sum("own_leaves").alias("open_leaves"), F.sum("own_saved").alias("open_saved"))
    roots = nodes.where("root = 1").join(in_block, key, "left").select(
        *key, F.col("path")[0]["a"].alias("ua"), F.col("path")[0]["b"].alias("ub"),
        *((F.col(c) + F.coalesce(f"open_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
    )
    below = _below(write_table(roots, "roots")).select(*key, F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
    nodes = nodes.join(below, key, "left").withColumns({f"own_{c}": F.col(f"own_{c}") + F.coalesce(f"below_{c}", F.lit(0)) for c in ("leaves", "saved")})
    # What a node has of its own goes to itself and, within its block, to all above it but the block's root.
    inside = F.coalesce(F.slice("path", 2, F.greatest(F.size("path") - 1, F.lit(0))), F.expr("cast(array() as array<struct<a: long, b: long>>)"))
    receivers = nodes.select("depth", "own_leaves", "own_saved", F.posexplode(F.reverse(F.concat(inside, F.array(F.struct("a", "b"))))).alias("up", "to"))
    received = receivers.groupBy((F.col("depth") - F.col("up")).alias("depth"), F.col("to.a").alias("a"), F.col("to.b").alias("b"))
    received = received.agg(F.sum("own_leaves").alias("all_leaves"), F.sum("own_saved").alias("all_saved"))
    # A block's root has what is closed in its block from the sums over blocks already.
    closed = lambda c: F.when(F.col("root") == 1, 0).otherwise(F.col(c))
    return nodes.join(received, key).select(
        *key, "pa", "pb", F.lit(None).cast("long").alias("parent"), "n", "least", "children",
        *((closed(c) + F.col(f"all_{c}")).alias(c) for c in ("leaves", "saved")),
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, block_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node: (conv, depth, parent_conv, n_convs, n_children, n_leaves, saved, ends_sha256).

    ``turns`` has the rows of ``turn_rows``, ``convs`` the distinct ids (``conv``), with or without turns; a
    conversation without turns is a member of the root. A node's ``conv`` is its smallest member, and its digest that of the
    ids, in order, of the members that end there. No conversations give no nodes, not even a root.
    """
    blocks = _blocks(turns, convs)
    counted = blocks.groupBy("k", "ka", "kb", "ids", "chars").agg(F.count("*").alias("n"), F.min("conv").alias("least"), F.count_if("last").alias("ends"))
    size = F.size("chars")
    keys = lambda number, key: F.concat(
        F.array(key),
        F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda j: F.col(key).bitwiseXOR(_lane(number, F.col("k"), F.slice("ids", 1, 2 * j)))))
        .otherwise(F.expr("cast(array() as array<long>)")),
    )
    counted = write_table(counted.withColumns({"a": keys(1, "ka"), "b": keys(2, "kb")}), "counted")
    shards = max(1, -(-counted.count() // block_rows))

    def work(batches: Batches) -> Batches:
        held = [b for b in batches if b.num_rows]
        if held:
            yield shard_nodes(pa.Table.from_batches(held), BLOCK)

    nodes = write_table(map_batches(counted.repartitionByRange(shards, "k", "ka", "kb", "ids"), work, _NODE), "nodes")
    opened = write_table(_recombined(nodes.where("open")), "open-sums")
    columns = ["depth", "a", "b", "pa", "pb", "parent", "n", "least", "children", "leaves", "saved"]
    closed = nodes.where("NOT open").select(*columns)
    known = closed.where("parent IS NOT NULL")
    above = opened.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("least").alias("above"))
    rest = closed.where("parent IS NULL").union(opened.select(*columns)).join(above, ["depth", "pa", "pb"], "left").withColumn("parent", F.col("above"))
    last = blocks.where("last").select(
        "conv", (F.col("k") * BLOCK + size).alias("depth"),
        *(F.when(size > 0, F.col(k).bitwiseXOR(_lane(i, F.col("k"), F.col("ids")))).otherwise(F.col(k)).alias(c) for i, k, c in ((1, "ka", "a"), (2, "kb", "b"))),
        F.col("conv").cast("string").alias("id"),
    )
    digests = joined_digests(last, ["depth", "a", "b"], ["conv"], "id", ",")
    every = known.union(rest.select(*columns)).join(digests, ["depth", "a", "b"], "left")
    return every.select(
        F.col("least").alias("conv"), "depth", F.col("parent").alias("parent_conv"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), "saved", F.coalesce("sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Each conversation with the first turns of the one at the hundred below it in place of its own; how many, a hash of its id
    tells. For ids below 0, the hundred is the one nearer to 0."""
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % (SHARED + 1)
    lengths = turns.where((F.col("conv") % 100 == 0) & (F.col("pos") < SHARED)).groupBy(F.col("conv").alias("base")).agg(F.count("*").alias("there"))
    known = convs.select("conv", (F.col("conv") - F.col("conv") % 100).alias("base"), heads.alias("heads")).join(lengths, "base", "left")
    known = write_table(known.withColumn("taken", F.least("heads", F.coalesce("there", F.lit(0)))), "rebuilt")
    ids = ("hi", "lo", "chars")
    first = turns.where((F.col("conv") % 100 == 0) & (F.col("pos") < SHARED)).select(F.col("conv").alias("base"), "pos", *ids)
    first = known.join(first, "base").where("pos < taken").select("conv", "pos", *ids)
    own = turns.join(known, "conv").where("pos >= heads").select("conv", (F.col("taken") + F.col("pos") - F.col("heads")).alias("pos"), *ids)
    return first.union(own)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    convs = named(rows, "conv_id").where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv")).distinct()
    turns = write_table(turn_rows(rows), "turn-ids")
    found = prefix_trie(write_table(rebuilt(turns, convs), "rebuilt-turns"), convs)
    return found.withColumnsRenamed({"conv": "conv_id", "parent_conv": "parent_conv_id", "saved": "saved_tokens"})
