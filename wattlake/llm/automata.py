"""Probabilistic automata inferred from strings by merging compatible prefix-tree states."""

from __future__ import annotations

import math
from collections import Counter


class Automaton:
    """A probabilistic automaton learned from ``strings``.

    The prefix tree of the strings is folded breadth first: a state that passes
    the Hoeffding test (ending and every next symbol, recursively) against an
    already fixed state is merged with it, else it becomes fixed itself.
    Probabilities are smoothed towards the strings' symbol classes, so any
    string has a finite likelihood.
    """

    def __init__(self, strings: list[str], alpha: float = 0.05, smoothing: float = 1.0):
        self.slack = math.sqrt(0.5 * math.log(2 / alpha))
        self.smoothing = smoothing
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        self.ends: list[int] = [0]
        self.total: list[int] = [0]
        for s in strings:
            at = 0
            for c in s:
                self.count[at][c] += 1
                self.total[at] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                    self.ends.append(0)
                    self.total.append(0)
                at = self.next[at][c]
            self.ends[at] += 1
            self.total[at] += 1
        self._fold()
        classes = Counter(symbol_class(c) for s in strings for c in s)
        n = sum(classes.values())
        self.base = {k: (classes[k] + 1) / (n + len(CLASS_SIZES)) / CLASS_SIZES[k] for k in CLASS_SIZES}
        self.mean = n / max(len(strings), 1)

    def _differs(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.slack * (n1 ** -0.5 + n2 ** -0.5)

    def _compatible(self, r: int, b: int) -> bool:
        todo = [(r, b)]
        while todo:
            r, b = todo.pop()
            n1, n2 = self.total[r], self.total[b]
            if not n1 or not n2:
                continue
            if self._differs(self.ends[r], n1, self.ends[b], n2):
                return False
            for c in self.count[r].keys() | self.count[b].keys():
                if self._differs(self.count[r][c], n1, self.count[b][c], n2):
                    return False
            # b is the root of a tree, so this ends although r may lie on a cycle
            todo.extend((self.next[r][c], self.next[b][c]) for c in self.next[b] if c in self.next[r])
        return True

    def _fold(self) -> None:
        fixed, queue = {0: None}, [(0, c) for c in sorted(self.next[0])]
        while queue:
            parent, c = queue.pop(0)
            b = self.next[parent][c]
            if b in fixed:
                continue
            into = next((r for r in fixed if self._compatible(r, b)), None)
            if into is None:
                fixed[b] = None
                queue.extend((b, x) for x in sorted(self.next[b]))
                continue
            self.next[parent][c] = into
            todo = [(into, b)]
            while todo:
                r, x = todo.pop()
                self.ends[r] += self.ends[x]
                self.total[r] += self.total[x]
                self.count[r].update(self.count[x])
                for sym, child in self.next[x].items():
                    if sym in self.next[r]:
                        todo.append((self.next[r][sym], child))
                    else:
                        self.next[r][sym] = child
                        if r in fixed:
                            queue.append((r, sym))

    def log_likelihood(self, s: str) -> float:
        """Natural logarithm of the probability of ``s`` and its end."""
        lam, at, out = self.smoothing, 0, 0.0
        for c in s:
            base = self.base[symbol_class(c)]
            if at is None:
                out += math.log(base)
                continue
            out += math.log((self.count[at][c] + lam * base) / (self.total[at] + lam))
            at = self.next[at].get(c)
        stop = 1 / (1 + self.mean)
        end, seen = (self.ends[at], self.total[at]) if at is not None else (0, 0)
        return out + math.log((end + lam * stop) / (seen + lam))


# fixed values: symbols in each class
CLASS_SIZES = {"digit": 10, "hex": 6, "lower": 20, "HEX": 6, "UPPER": 20, "other": 40}


def symbol_class(c: str) -> str:
    if "0" <= c <= "9":
        return "digit"
    if "a" <= c <= "f":
        return "hex"
    if "g" <= c <= "z":
        return "lower"
    if "A" <= c <= "F":
        return "HEX"
    if "G" <= c <= "Z":
        return "UPPER"
    return "other"
