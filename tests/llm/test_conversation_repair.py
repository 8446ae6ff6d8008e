import hashlib
import itertools
import random
import re
import zlib

import pytest

from ebbwatch.llm.conversation_repair import op12_conversation_repair, repair, repair_report
from ebbwatch.llm.role_grammar import audit, closing, joined, live_states, parse

GRAMMATICAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(turns):
    """All edits of a few turns: the least (cost, audit) and the role initials with their sources."""
    best = None

    def go(i, cost, letters, made):
        nonlocal best
        if best and cost > best[0][0]:
            return
        for k in range(3):
            for extra in itertools.product("ua", repeat=k):
                here = made + [(x, None) for x in extra]
                at, so_far = cost + 5 * k, letters + "I" * k
                if i == len(turns):
                    if GRAMMATICAL.match("".join(x for x, _ in here)) and (best is None or (at, so_far) < best[0]):
                        best = (at, so_far), here
                    continue
                initial, forced, truncated = turns[i][:3]
                go(i + 1, at + 2, so_far + "D", here)
                if not forced:
                    go(i + 1, at + 5 * truncated, so_far + "K", [*here, (initial if len(initial) == 1 else "?", (i, "K"))])
                    for x in "ua":
                        if x != initial:
                            go(i + 1, at + 5 * truncated + 1, so_far + "R", [*here, (x, (i, "R"))])

    go(0, 0, "", [])
    return best


def some_turns(rng, most):
    return [(rng.choice(["u", "a", "s", "x", "", "u", "a"]), rng.random() < 0.15, rng.random() < 0.3, 0) for _ in range(rng.randint(0, most))]


def entries(part, first):
    ways = {(s, e): n for s in ([0] if first else live_states()) for e, n in parse(part, s).items()}
    ranks = sorted({n.steps for n in ways.values()})
    return ways, {k: (n.cost, ranks.index(n.steps)) for k, n in ways.items()}


def through(parts):
    made = [entries(p, not k) for k, p in enumerate(parts)]
    cost, path, last = joined([m[1] for m in made])
    return cost, "".join(m[0][x].steps for m, x in zip(made, path)) + last


def test_parser_against_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        turns = some_turns(rng, 4)
        cost, steps = through([turns] if turns else [])
        assert (cost, audit(steps)) == cheapest(turns)[0]


def test_pieces_give_the_same_way():
    rng = random.Random(2)
    for _ in range(100):
        turns = some_turns(rng, 14)
        cuts = sorted(rng.randint(0, len(turns)) for _ in range(3))
        parts = [p for p in (turns[a:b] for a, b in zip([0, *cuts], [*cuts, len(turns)])) if p]
        assert through(parts) == through([turns] if turns else [])
    assert closing(0) == (0, "")


def reading(rows):
    """The report from the definitions, with all edits tried."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = []
        for _, turn, role, text in mine:
            role, text, key = role if role is not None else " ", text if text is not None else " ", f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            turns += [(turn, role, text)] * (2 if kind == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        kinds, seen = [], set()
        for _, role, text in turns:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            kinds.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        numbers = {t[0] for t in turns} - {None}
        initials = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        (cost, letters), made = cheapest([(i, k in ("blank", "duplicate"), k == "truncated") for i, k in zip(initials, kinds)])
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names[x]}:" if of is None else f"{turns[of[0]][1] if of[1] == 'K' else names[x]}:{turns[of[0]][2]}" for x, of in made]
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why?", "cut", " \t\n", "", None, "end. \n", "a.b", "Ünï。"]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "User", "tool"]
    rows = [(c, rng.choice([*range(6), None]), rng.choice(roles), rng.choice(texts)) for c in range(60) for _ in range(rng.randint(1, 4))]
    rows += [(100 + c, t, ["user", "assistant"][t % 2], f"Turn {c} {t}.") for c in range(40) for t in range(4)]
    rows += [(None, 1, "user", "No id."), (None, 2, "assistant", "None.")]
    return rows + rows[:20]  # repeated rows


def test_query_against_reading(spark, tmp_path):
    rows = conversations()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' AS conv", "'clash' AS pos", "1 AS copies", "2 AS fault", "3 AS steps")
    frame.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == reading(rows)


@pytest.mark.parametrize("piece", [1, 3, 2048])
def test_one_long_conversation(spark, piece):
    """One conversation with most of all rows, cut over many pieces and ranges, and copies of one turn."""
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Turn {t}.", "same.", f"cut {t}"])) for t in range(300)]
    rows += [(7, 120, "user", "copied.")] * 40 + [(8, 0, "user", "Hi."), (8, 1, "assistant", "Hello.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = repair(frame, piece=piece)
    got = {r.conv_id: r for r in repair_report(found, frame).collect()}
    turns, seen = [], set()
    mine = sorted(r[1:] for r in rows if r[0] == 7)
    for _, role, text in mine:
        turns.append((role[0], (role, text) in seen, text[-1] != ".", 0))
        seen.add((role, text))
    cost, steps = through([turns])
    assert (got[7].cost, got[7].audit) == (cost, audit(steps))
    initials = [t[0] for t in turns]
    assert got[7].illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    assert got[7].duplicate == sum(t[1] for t in turns)
    assert tuple(got[8])[1:] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Hello.").hexdigest())
    kept = found.repaired.where("conv = '7'").orderBy("pos", "k").collect()
    initials = "".join(r.role[0] for r in sorted(kept, key=lambda r: (r.pos is None, r.pos or 0, r.k)))
    assert GRAMMATICAL.match(initials) and initials


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_report(repair(none), none).count() == 0
    only = spark.createDataFrame([(1, 1, "user", "Hi.")], SCHEMA)
    r = repair_report(repair(none), only).collect()[0]
    assert tuple(r) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
