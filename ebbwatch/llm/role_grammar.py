"""Weighted generalised LR repair of sequences of roles.

Conversations follow a grammar over role initials: nothing, or an optional system turn and then pairs of
user and assistant. The parser reads a sequence with a graph-structured stack: on every level, one node for
each state on top, linked to the node below it, so that stacks share what they have in common. Beside
shifting a turn as it is, it may delete it, shift it with another role, or shift an inserted turn, each at a cost.

Stacks with equal tops are merged: the one of least (cost, audit) stays. That loses nothing here, since what may
follow depends on the top of the stack alone: states of one core, such as "a pair is open", take the same
continuations whatever lies below. Two audits that meet so have taken the same rows and cost the same, so neither
begins with the other, and their order is that of whatever follows as well.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

# The grammar, costs and letters of the contract. Lower case is read, upper case is derived.
GRAMMAR = (("S", ""), ("S", "sP"), ("S", "P"), ("P", "Pua"), ("P", "ua"))
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = {"su", "ua", "au"}
# Steps: the audit's letters, with one of its own for what becomes an assistant. The order of steps is that of audits,
# since a state takes either a user or an assistant.
SHIFTS = {"u": ("I", "R"), "a": ("J", "S")}  # inserted, reroled


class Node(NamedTuple):
    state: int
    cost: int
    steps: str
    below: "Node | None"

    @property
    def rank(self) -> tuple[int, str]:
        return self.cost, self.steps


class Tables(NamedTuple):
    moves: dict  # (state, symbol) -> state
    reductions: dict  # state -> [(derived symbol, symbols taken from the stack)]
    stacks: dict  # state -> a shortest stack that it tops
    accepting: int


@lru_cache
def lr_tables() -> Tables:
    """The automaton of sets of dotted rules."""

    def closed(items: set) -> frozenset:
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            right = GRAMMAR[rule][1] if rule >= 0 else "S"
            for r, (left, _) in enumerate(GRAMMAR):
                if right[dot : dot + 1] == left and (r, 0) not in items:
                    items.add((r, 0))
                    todo.append((r, 0))
        return frozenset(items)

    begin = closed({(-1, 0)})
    numbers, todo, moves, reductions, stacks = {begin: 0}, [begin], {}, {}, {0: (0,)}
    for items in todo:
        state, nexts = numbers[items], {}
        for rule, dot in items:
            left, right = GRAMMAR[rule] if rule >= 0 else (None, "S")
            if dot < len(right):
                nexts.setdefault(right[dot], set()).add((rule, dot + 1))
            elif left:
                reductions.setdefault(state, []).append((left, len(right)))
        for symbol, goal in sorted(nexts.items()):
            goal = closed(goal)
            if goal not in numbers:
                numbers[goal] = len(numbers)
                todo.append(goal)
                stacks[numbers[goal]] = (*stacks[state], numbers[goal])
            moves[state, symbol] = numbers[goal]
    return Tables(moves, reductions, stacks, moves[0, "S"])


def _merge(tops: dict[int, Node], node: Node) -> bool:
    if node.state in tops and tops[node.state].rank <= node.rank:
        return False
    tops[node.state] = node
    return True


def _reduced(tops: dict[int, Node], todo: list[Node]) -> dict[int, Node]:
    """Adds to the tops all that reductions of ``todo`` lead to."""
    tables = lr_tables()
    while todo:
        node = todo.pop()
        for left, taken in tables.reductions.get(node.state, ()):
            below = node
            for _ in range(taken):
                below = below.below
            new = Node(tables.moves[below.state, left], node.cost, node.steps, below)
            if _merge(tops, new):
                todo.append(new)
    return tops


def _inserted(tops: dict[int, Node]) -> dict[int, Node]:
    """Adds all that inserted turns lead to; every further one costs more, so this ends."""
    tables, todo = lr_tables(), list(tops.values())
    while todo:
        node = todo.pop()
        if tops[node.state] is not node:
            continue
        for symbol, (letter, _) in SHIFTS.items():
            if (node.state, symbol) in tables.moves:
                new = Node(tables.moves[node.state, symbol], node.cost + INSERT, node.steps + letter, node)
                if _merge(tops, new):
                    before = dict(tops)
                    _reduced(tops, [new])
                    todo += [n for s, n in tops.items() if before.get(s) is not n or n is new]
    return tops


def live_states() -> list[int]:
    """The states that can read a turn."""
    return sorted({state for state, symbol in lr_tables().moves if symbol.islower()})


def parse(turns: list[tuple[str, bool, bool, int]], start: int = 0) -> dict[int, Node]:
    """The cheapest repair up to each state on top, from a state before the turns.

    A turn is (role initial, must be deleted, is truncated, further copies of it, which must be deleted).
    """
    tables, live = lr_tables(), set(live_states())
    stack = None
    for state in tables.stacks[start]:
        stack = Node(state, 0, "", stack)
    tops = {start: stack}
    for initial, forced, truncated, copies in turns:
        new: dict[int, Node] = {}
        for node in _inserted(tops).values():
            _merge(new, node._replace(cost=node.cost + DELETE, steps=node.steps + "D"))
            if forced:
                continue
            cost = node.cost + TRUNCATED * truncated
            if initial.islower() and (node.state, initial) in tables.moves:
                _merge(new, Node(tables.moves[node.state, initial], cost, node.steps + "K", node))
            for symbol, (_, letter) in SHIFTS.items():
                if symbol != initial and (node.state, symbol) in tables.moves:
                    _merge(new, Node(tables.moves[node.state, symbol], cost + REROLE, node.steps + letter, node))
        _reduced(new, list(new.values()))
        tops = {
            s: n._replace(cost=n.cost + DELETE * copies, steps=n.steps + "D" * copies) if copies else n
            for s, n in new.items() if s in live
        }
    return tops


@lru_cache
def closing(state: int) -> tuple[int, str]:
    """Cost and steps of what must be inserted to end in a state."""
    tables, stack = lr_tables(), None
    for s in tables.stacks[state]:
        stack = Node(s, 0, "", stack)
    tops = _reduced({state: stack}, [stack])
    return _inserted(tops)[tables.accepting].rank


def audit(steps: str) -> str:
    return steps.replace("J", "I").replace("S", "R")


def joined(pieces: list[dict[tuple[int, int], tuple[int, int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """The cheapest way through the pieces of a conversation: cost, (start, end) of each piece, and what is inserted last.

    A piece gives (cost, rank of the steps among the piece's) by (start, end). The steps of a piece end with a turn, so of
    two ways with the same cost, the first piece in which they differ decides.
    """
    ways, back = {0: (0, 0)}, []  # state -> (cost, order of the way so far)
    for piece in pieces:
        best: dict[int, tuple] = {}
        for (start, end), (cost, rank) in piece.items():
            if start in ways:
                new = (ways[start][0] + cost, ways[start][1], rank, start)
                if end not in best or new < best[end]:
                    best[end] = new
        order = {x: i for i, x in enumerate(sorted({b[1:3] for b in best.values()}))}
        ways = {end: (b[0], order[b[1:3]]) for end, b in best.items()}
        back.append({end: b[3] for end, b in best.items()})
    state = min(ways, key=lambda s: (ways[s][0] + closing(s)[0], ways[s][1], closing(s)[1]))
    cost, last = ways[state][0] + closing(state)[0], closing(state)[1]
    path = []
    for starts in reversed(back):
        path.append((starts[state], state))
        state = starts[state]
    return cost, path[::-1], last
