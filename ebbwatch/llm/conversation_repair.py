"""Conversation structure repair: each conversation becomes a sequence of turns that follows the role grammar.

Turns are numbered over ranges of (conversation, turn), and cut into pieces of bounded size. A piece is
parsed from the start of the conversation or, if it is a later one, from every state of the parser; what the pieces give is
a few rows each, from which the cheapest way through all pieces of a conversation is chosen. So a conversation with a
third of all turns is parsed by many tasks. See ``role_grammar`` for the parser.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.common import Batches, map_batches, named, read_table
from ebbwatch.llm.digests import EMPTY, joined_digests
from ebbwatch.llm.ordering import placed, runs_of
from ebbwatch.llm.role_grammar import LEGAL, joined, live_states, parse
from ebbwatch.session import write_table

PIECE = 2048  # turns that are parsed at once

# Blanks and sentence ends of the contract.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")


class Repair(NamedTuple):
    turns: DataFrame  # (conversation, turn, role, text, copies, pos, fault)
    ways: DataFrame  # (conversation, cost, illegal, steps): one row per conversation with turns
    repaired: DataFrame  # (conversation, pos, k, role, text, edit)


def faults(turns: DataFrame) -> DataFrame:
    """Adds ``fault`` (blank, duplicate, truncated or null, the first that holds) of the first of a row's copies."""
    firsts = turns.groupBy("conv", "role", "text").agg(F.min("pos").alias("first"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("conv", "role", "text")]
    both = turns.alias("t").join(firsts.alias("f"), same)
    shown = F.rtrim(F.col("t.text"), F.lit(BLANKS))
    fault = (
        F.when(shown == "", "blank").when(F.col("t.pos") > F.col("f.first"), "duplicate")
        .when(~F.substring(shown, -1, 1).isin(*ENDS), "truncated")
    )
    return both.select("t.*", fault.alias("fault"))


def _entries(batches: Batches) -> Batches:
    """A row for each way through a piece: the states it leads between, and the steps for each row."""
    for (conv, piece), rows in runs_of(batches, "conv", "piece"):
        turns = [(r["initial"], r["fault"] in ("blank", "duplicate"), r["fault"] == "truncated", r["copies"] - 1) for r in rows]
        ways = {(s, e): n for s in (live_states() if piece else [0]) for e, n in parse(turns, s).items()}
        ranks = {steps: i for i, steps in enumerate(sorted({n.steps for n in ways.values()}))}
        pairs = [a["initial"] + b["initial"] for a, b in zip(rows, rows[1:])]
        illegal = sum(p not in LEGAL for p in pairs) + sum(r["copies"] - 1 for r in rows)  # no initial may follow itself
        out = []
        for (start, end), node in ways.items():
            steps = re.findall("[IJ]*[DKRS]", node.steps)
            moves, at = [], 0
            for r in rows:
                moves.append("".join(steps[at : at + r["copies"]]))
                at += r["copies"]
            out.append({
                "conv": conv, "piece": piece, "start": start, "end": end, "cost": node.cost, "rank": ranks[node.steps], "illegal": illegal,
                "first": rows[0]["initial"], "last": rows[-1]["initial"], "positions": [r["pos"] for r in rows], "moves": moves,
            })
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("conv", pa.string()), ("piece", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()),
            ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("positions", pa.list_(pa.int64())), ("moves", pa.list_(pa.string())),
        ]))


_ENTRY = (
    "conv string, piece long, start int, end int, cost long, rank int, illegal long, first string, last string, "
    "positions array<long>, moves array<string>"
)


def _ways(batches: Batches) -> Batches:
    """The way through the pieces of each conversation; holds a few numbers for each piece of one conversation."""

    def chosen(conv, pieces: list, numbers: list, illegal: int) -> pa.RecordBatch:
        cost, path, last = joined(pieces)
        rows = [{"conv": conv, "piece": p, "start": s, "end": e} for p, (s, e) in zip(numbers, path)]
        rows.append({"conv": conv, "cost": cost, "illegal": illegal, "closing": last})
        return pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([
        ("conv", pa.string()), ("piece", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
        ("cost", pa.int64()), ("illegal", pa.int64()), ("closing", pa.string()),
    ])
    now, pieces, numbers, illegal, edge = None, [], [], 0, ""
    for (conv, piece), rows in runs_of(batches, "conv", "piece"):
        if pieces and conv != now:
            yield chosen(now, pieces, numbers, illegal)
            pieces, numbers, illegal = [], [], 0
        illegal += rows[0]["illegal"] + (bool(pieces) and edge + rows[0]["first"] not in LEGAL)
        now, edge = conv, rows[0]["last"]
        pieces.append({(r["start"], r["end"]): (r["cost"], r["rank"]) for r in rows})
        numbers.append(piece)
    if pieces:
        yield chosen(now, pieces, numbers, illegal)


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", piece: int = PIECE,
) -> Repair:
    """The cheapest repair of every conversation, as tables.

    Turns are taken by (turn, role, text), nulls first; a null conversation is one too; a null role or text reads
    as one space, which is blank or of no legal role. Equal rows are copies of one turn. A conversation is known by its id as text
    (column ``conv``). Texts are never cut. An empty input gives empty tables; other columns are left out.
    """
    whole = named(rows, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text")
    whole = whole.withColumns({"conv": F.col("conv").cast("string")} | {c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")})
    counted = whole.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    turns = write_table(faults(placed(counted, "conv", ["turn", "role", "text"], "copies")), "turns")
    cut = turns.select("conv", (F.col("pos") / piece).cast("long").alias("piece"), "pos", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    cut = cut.repartition("conv", "piece").sortWithinPartitions("conv", "piece", "pos")
    entries = write_table(map_batches(cut, _entries, _ENTRY), "ways")
    few = entries.select("conv", "piece", "start", "end", "cost", "rank", "illegal", "first", "last")
    few = few.repartition("conv").sortWithinPartitions("conv", "piece")
    ways = write_table(map_batches(few, _ways, "conv string, piece long, start int, end int, cost long, illegal long, closing string"), "chosen")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("conv", "piece", "start", "end")]
    taken = entries.alias("e").join(ways.alias("w"), same).select("e.conv", "e.piece", "positions", "moves")
    last = ways.where("piece IS NULL").select("conv", F.lit(None).cast("long").alias("piece"), "closing")
    steps = taken.select("conv", "piece", F.array_join("moves", "").alias("steps")).union(last).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct(F.col("piece").isNull().alias("ends"), "piece", "steps"))).alias("all")
    )
    report = ways.where("piece IS NULL").alias("w").join(steps.alias("s"), F.col("w.conv").eqNullSafe(F.col("s.conv")))
    report = report.select("w.conv", "cost", "illegal", F.array_join("all.steps", "").alias("steps"))
    return Repair(turns, report, _repaired(turns, taken, last))


def _repaired(turns: DataFrame, taken: DataFrame, last: DataFrame) -> DataFrame:
    """The turns that stay or come in, in the order of (pos, k); what is inserted last has no pos."""
    moves = taken.select("conv", F.explode(F.arrays_zip("positions", "moves")).alias("m")).select("conv", "m.positions", "m.moves")
    same = F.col("t.conv").eqNullSafe(F.col("m.conv")) & (F.col("t.pos") == F.col("m.positions"))
    rows = turns.alias("t").join(moves.alias("m"), same).select("t.conv", "t.pos", "t.role", "t.text", "m.moves")
    ends = last.where("closing != ''").select("conv", F.lit(None).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), "closing")
    steps = rows.unionByName(ends.withColumnRenamed("closing", "moves")).select("*", F.posexplode(F.split("moves", "")).alias("k", "step"))
    is_ = lambda *letters: F.col("step").isin(*letters)
    return steps.where(is_("I", "J", "K", "R", "S")).select(
        "conv", "pos", "k",
        F.when(is_("I", "R"), "user").when(is_("J", "S"), "assistant").otherwise(F.col("role")).alias("role"),
        F.when(is_("I", "J"), "").otherwise(F.col("text")).alias("text"),
        F.when(is_("I", "J"), "insert").when(is_("K"), "keep").otherwise("rerole").alias("edit"),
    )


def line_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines."""
    lines = repaired.select("conv", F.col("pos").isNull().alias("ends"), "pos", "k", F.concat("role", F.lit(":"), "text").alias("line"))
    return joined_digests(lines, ["conv"], ["ends", "pos", "k"], "line", "\n")


def repair_report(found: Repair, conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row for each distinct id of ``conversations``, with or without turns."""
    turns = found.turns
    copies = F.when(F.col("fault") == "blank", F.col("copies"))
    extra = F.when(F.col("fault").isNull() | (F.col("fault") != "blank"), F.col("copies") - 1).otherwise(0)
    counts = turns.groupBy("conv").agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", 1).otherwise(0) + extra).alias("duplicate"),
        F.count_if(F.col("fault") == "truncated").alias("truncated"),
    )
    distinct = turns.where("turn IS NOT NULL").select("conv", "turn").distinct().groupBy("conv")
    gaps = distinct.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    digests = line_digests(found.repaired).withColumnRenamed("sha256", "repaired_sha256")
    out = named(conversations, conv_col).distinct().withColumn("of", F.col(f"`{conv_col}`").cast("string"))
    for part in (counts, gaps, found.ways, digests):
        part = part.withColumnRenamed("conv", "part_conv")
        out = out.join(part, F.col("of").eqNullSafe(F.col("part_conv")), "left").drop("part_conv")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    letters = F.translate(F.coalesce("steps", F.lit("")), "JS", "IR")
    return out.select(
        conv_col, *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), letters.alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Faults by a hash of conversation and turn: rows dropped, emptied, cut short, repeated or given to the user."""
    spoken = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(spoken("conv_id"), F.lit(":"), spoken("turn")).cast("binary")) % 20
    kept = rows.withColumn("kind", kind).where("kind != 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(spoken("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(spoken("text"), "[.!?]", "")).otherwise(spoken("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return kept.drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = named(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return repair_report(repair(damaged(rows)), rows)
