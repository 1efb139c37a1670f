"""LR tables of a small role grammar, and weighted repair of a sequence over it on a graph-structured stack.

Symbols are single characters, lower case for roles (their initials), upper case for the rest. A stack is a node: an LR
state and the node below it, shared by all stacks that grow from there. A stack whose state allows one reduction and no
shift is reduced at once, so stacks that accept the same continuations are the same node.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

#: ``(s?(ua)+)?`` : an optional system turn, then pairs of user and assistant; or nothing.
CONVERSATION = (("C", ""), ("C", "T"), ("C", "sT"), ("T", "ua"), ("T", "Tua"))

END = "$"


@dataclass(frozen=True)
class Costs:
    """``delete`` is also what a blank or duplicate row costs; a row kept though cut short costs ``truncated`` more."""

    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


#: Faults of a row, in the order in which the first one counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

#: Stacks by node, each with its least (cost, audit).
Tops = dict[int, tuple[int, str]]


def _follow(rules: Iterable[tuple[str, str]], goal: str) -> dict[str, set[str]]:
    """The terminals that may come behind each non-terminal."""
    heads = {head for head, _ in rules}
    empty: set[str] = set()
    first: dict[str, set[str]] = {head: set() for head in heads}
    follow: dict[str, set[str]] = {head: set() for head in heads}
    follow[goal].add(END)
    size = -1
    while size != (size := sum(map(len, (*first.values(), *follow.values(), empty)))):
        for head, body in rules:
            for at, symbol in enumerate(body):
                rest = follow[head] if all(s in empty for s in body[at + 1 :]) else set()
                for later in body[at + 1 :]:
                    rest = rest | first.get(later, {later})
                    if later not in empty:
                        break
                if symbol in heads:
                    follow[symbol] |= rest
            for symbol in body:
                first[head] |= first.get(symbol, {symbol})
                if symbol not in empty:
                    break
            else:
                empty.add(head)
    return follow


@dataclass
class RoleGrammar:
    """``step[node][role]`` is the node after that role, ``accepts`` the nodes at which a sequence may end.

    Grammars whose stacks are not finitely many, or that allow two of ``fillers`` (the roles that may be inserted) at the
    same place, are refused.
    """

    rules: tuple[tuple[str, str], ...] = CONVERSATION
    fillers: str = "ua"
    costs: Costs = Costs()
    most_stacks: int = 64
    step: list[dict[str, int]] = field(init=False)
    accepts: set[int] = field(init=False)

    def __post_init__(self) -> None:
        self._heads = {head for head, _ in self.rules}
        self._goal = self.rules[0][0]
        self._follow = _follow(self.rules, self._goal)
        self._states: dict[frozenset, int] = {}
        self._items: list[frozenset] = []
        self._nodes: dict[tuple[int, int], int] = {}
        self._below: list[tuple[int, int]] = []
        self._state(self._closed({(-1, 0)}))
        self._node(0, -1)
        self.step, self.accepts = [], set()
        for node in self._numbers():
            after = {role: self._after(node, role) for role in sorted({s for _, body in self.rules for s in body} - self._heads)}
            self.step.append({role: top for role, top in after.items() if top is not None})
            if self._ends(node):
                self.accepts.add(node)
            if sum(role in self.fillers for role in self.step[node]) > 1:
                raise ValueError("two roles could be inserted at the same place")

    def _numbers(self) -> Iterable[int]:
        node = 0
        while node < len(self._below):
            if node >= self.most_stacks:
                raise ValueError(f"the grammar has more than {self.most_stacks} stacks")
            yield node
            node += 1

    def _body(self, rule: int) -> str:
        return self._goal if rule < 0 else self.rules[rule][1]

    def _closed(self, items: set[tuple[int, int]]) -> frozenset:
        while True:
            wanted = {self._body(r)[at] for r, at in items if at < len(self._body(r))}
            more = items | {(i, 0) for i, (head, _) in enumerate(self.rules) if head in wanted}
            if more == items:
                return frozenset(items)
            items = more

    def _state(self, items: frozenset) -> int:
        if items not in self._states:
            self._states[items] = len(self._items)
            self._items.append(items)
        return self._states[items]

    def _node(self, state: int, below: int) -> int:
        if (state, below) not in self._nodes:
            self._nodes[state, below] = len(self._below)
            self._below.append((state, below))
        return self._nodes[state, below]

    def _shifted(self, node: int, symbol: str) -> int | None:
        moved = {(r, at + 1) for r, at in self._items[self._below[node][0]] if self._body(r)[at : at + 1] == symbol}
        return self._node(self._state(self._closed(moved)), node) if moved else None

    def _reduced(self, node: int, rule: int) -> int:
        for _ in self._body(rule):
            node = self._below[node][1]
        top = self._shifted(node, self.rules[rule][0])
        assert top is not None
        return top

    def _finished(self, node: int) -> list[int]:
        return [r for r, at in self._items[self._below[node][0]] if r >= 0 and at == len(self._body(r))]

    def _before(self, node: int, ahead: str) -> list[int]:
        """``node`` and what it reduces to when ``ahead`` comes next."""
        found = [node]
        for top in found:
            found += [self._reduced(top, r) for r in self._finished(top) if ahead in self._follow[self.rules[r][0]]]
        return found

    def _after(self, node: int, role: str) -> int | None:
        tops = {top for one in self._before(node, role) if (top := self._shifted(one, role)) is not None}
        if len(tops) > 1:
            raise ValueError("the grammar is ambiguous")
        for top in tops:
            while len(self._items[self._below[top][0]]) == 1 and (finished := self._finished(top)):
                top = self._reduced(top, finished[0])
            return top
        return None

    def _ends(self, node: int) -> bool:
        return any((-1, 1) in self._items[self._below[top][0]] for top in self._before(node, END))

    # --- repair -------------------------------------------------------------------------------------------------------

    def with_inserts(self, tops: Tops) -> Tops:
        """All stacks that inserted turns lead to as well. Equal stacks keep the least cost and, of that, audit."""
        tops, todo = dict(tops), list(tops)
        for node in todo:
            cost, audit = tops[node]
            for role in self.fillers:
                if (top := self.step[node].get(role)) is not None:
                    new = cost + self.costs.insert, audit + "I"
                    if top not in tops or new < tops[top]:
                        tops[top] = new
                        todo.append(top)
        return tops

    def after_row(self, tops: Tops, initial: str, fault: int, copies: int = 1) -> Tops:
        """The stacks behind a row that occurs ``copies`` times on end; all but its first are duplicates."""
        costs, new = self.costs, {}

        def merge(node: int, cost: int, audit: str) -> None:
            if node not in new or (cost, audit) < new[node]:
                new[node] = cost, audit

        more = costs.truncated if fault == TRUNCATED else 0
        for node, (cost, audit) in self.with_inserts(tops).items():
            merge(node, cost + costs.delete, audit + "D")
            if fault in (BLANK, DUPLICATE):
                continue
            step = self.step[node]
            if initial in step:
                merge(step[initial], cost + more, audit + "K")
            for role in self.fillers:
                if role in step:
                    merge(step[role], cost + more + costs.rerole, audit + "R")
        if copies > 1:
            lost, mark = costs.delete * (copies - 1), "D" * (copies - 1)
            new = {node: (cost + lost, audit + mark) for node, (cost, audit) in new.items()}
        return new

    def filler(self, node: int) -> tuple[str, int]:
        """The role that can be put in at ``node``, and the node behind it."""
        return next((role, self.step[node][role]) for role in self.fillers if role in self.step[node])
