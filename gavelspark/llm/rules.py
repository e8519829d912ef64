"""Ordered rule lists by incremental reduced-error pruning.

A rule is a conjunction of thresholds on numeric statistics.  Each rule is grown on
two thirds of the remaining examples by information gain, pruned on the other third
while that does not lower (p - n) / (p + n), and kept if it is right more often than
not there; what it covers is then removed.  The first failing rule ends the list.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Condition = tuple[str, str, float]  # statistic, '<=' or '>', threshold
Rule = list[Condition]


def _covers(rule: Rule, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for name, sign, value in rule:
        column = x[:, names.index(name)]
        hit &= (column <= value) if sign == "<=" else (column > value)
    return hit


def _best(x: np.ndarray, y: np.ndarray, names: Sequence[str]) -> Condition | None:
    """The condition of greatest information gain for the positive class."""
    p0, n0 = y.sum(), (~y).sum()
    base = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, pos = x[order, j], np.cumsum(y[order])
        cut = np.flatnonzero(np.diff(v) > 1e-9)
        if not len(cut):
            continue
        p, k = pos[cut], cut + 1
        for sign, pp, kk in (("<=", p, k), (">", p0 - p, len(v) - k)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(pp > 0, pp * (np.log2(pp / kk) - base), 0)
            i = int(np.argmax(g))
            if g[i] > gain:
                gain, best = g[i], (name, sign, float(round((v[cut[i]] + v[cut[i] + 1]) / 2, 4)))
    return best


def induce(x: np.ndarray, y: np.ndarray, names: Sequence[str], seed: int = 7, most_rules: int = 12, most_conditions: int = 4) -> list[Rule]:
    """Rules for the class ``y`` = True; an example that none covers is of the other class."""
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.arange(len(x))
    while y[left].any() and len(rules) < most_rules:
        shuffled = rng.permutation(left)
        third = max(1, len(shuffled) // 3)
        prune, grow = shuffled[:third], shuffled[third:]
        rule: Rule = []
        inside = grow
        while y[inside].any() and not y[inside].all() and len(rule) < most_conditions:
            condition = _best(x[inside], y[inside], names)
            if condition is None:
                break
            rule.append(condition)
            inside = inside[_covers([condition], x[inside], names)]
        if not rule:
            break

        def worth(r: Rule) -> float:
            hit = _covers(r, x[prune], names)
            p, n = (hit & y[prune]).sum(), (hit & ~y[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if worth(rule) <= 0:
            break
        rules.append(_merged(rule))
        left = left[~_covers(rule, x[left], names)]
    return rules


def _merged(rule: Rule) -> Rule:
    """Of several bounds of one statistic the tightest."""
    tight: dict[tuple[str, str], float] = {}
    for name, sign, value in rule:
        old = tight.get((name, sign), value)
        tight[name, sign] = min(old, value) if sign == "<=" else max(old, value)
    return [(name, sign, value) for (name, sign), value in tight.items()]


def predict(rules: list[Rule], x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(x), bool)
    for rule in rules:
        out |= _covers(rule, x, names)
    return out


def to_case(rules: list[Rule]) -> str:
    """The list as a SQL CASE expression: the number of the first rule that holds, else 0."""
    whens = " ".join(f"when {' and '.join(f'{n} {s} {v!r}' for n, s, v in rule)} then {i}" for i, rule in enumerate(rules, 1))
    return f"case {whens} else 0 end" if whens else "0"
