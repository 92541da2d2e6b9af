"""Parameter search (G01-G12): a seeded multi-objective genetic search, one evaluation call per generation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class Space:
    """Integer and float ranges and choices, by name."""

    ints: dict[str, tuple[int, int]] = field(default_factory=dict)
    floats: dict[str, tuple[float, float]] = field(default_factory=dict)
    choices: dict[str, tuple] = field(default_factory=dict)

    def sample(self, rng: np.random.Generator) -> dict:
        out: dict = {k: int(rng.integers(a, b + 1)) for k, (a, b) in self.ints.items()}
        out |= {k: float(rng.uniform(a, b)) for k, (a, b) in self.floats.items()}
        return out | {k: c[int(rng.integers(len(c)))] for k, c in self.choices.items()}

    def varied(self, base: dict, rng: np.random.Generator, share: float = 0.2) -> dict:
        """Within a share of the base, clipped to the ranges."""
        out = dict(base)
        for k, (a, b) in {**self.ints, **self.floats}.items():
            x = base[k] * (1 + rng.uniform(-share, share))
            out[k] = min(b, max(a, round(x) if k in self.ints else x))
        return out


def key(p: dict) -> tuple:
    """rounded parameters, half to even, as a memo key."""
    return tuple((k, round(v, 4) if isinstance(v, float) else v) for k, v in sorted(p.items()))


def fronts(points: np.ndarray) -> list[list[int]]:
    """Non-dominated fronts, more being better. Points go into the first front that doesn't dominate them, in descending order, in
    which none is dominated by a later one."""
    made: list[list[int]] = []
    for i in np.lexsort(-points.T[::-1]).tolist():
        p = points[i]
        k = next((k for k, f in enumerate(made) if not ((points[f] >= p).all(axis=1) & (points[f] > p).any(axis=1)).any()), len(made))
        if k == len(made):
            made.append([])
        made[k].append(i)
    return [sorted(f) for f in made]


def crowding(points: np.ndarray) -> np.ndarray:
    n = len(points)
    out = np.zeros(n)
    for m in range(points.shape[1]):
        order = np.argsort(points[:, m], kind="stable")
        span = points[order[-1], m] - points[order[0], m]
        out[order[[0, -1]]] = np.inf
        if span > 0 and n > 2:
            out[order[1:-1]] += (points[order[2:], m] - points[order[:-2], m]) / span
    return out


def search(space: Space, evaluate: Callable[[list[dict]], list[tuple[float, ...]]], baseline: dict, population: int = 28, generations: int = 60, mutation: float = 0.35, crossover: float = 0.9, seed: int = 42) -> list[dict]:
    """All trials as rows {trial, generation, params, values}. `evaluate` gets one generation at once (one Spark
    job over trials and questions) and only parameters it hasn't seen."""
    if population < 2 or generations < 1 or not 0 <= mutation <= 1 or not 0 <= crossover <= 1:
        raise ValueError("population >= 2, generations >= 1, rates within [0, 1]")
    rng = np.random.Generator(np.random.PCG64(seed))
    memo: dict[tuple, tuple[float, ...]] = {}
    trials: list[dict] = []
    parents = [baseline, *(space.varied(baseline, rng) for _ in range(population // 2))]
    parents += [space.sample(rng) for _ in range(population - len(parents))]
    kept: list[dict] = []
    for g in range(generations):
        new = {key(p): p for p in parents if key(p) not in memo}
        if new:
            memo |= dict(zip(new, evaluate(list(new.values())), strict=True))
        rows = [{"trial": g * population + k, "generation": g, "params": p, "values": memo[key(p)]} for k, p in enumerate(parents)]
        trials += rows
        pool = kept + rows
        points = np.array([r["values"] for r in pool])
        ranked: list[tuple[int, float, int]] = []
        for level, front in enumerate(fronts(points)):
            ranked += [(level, -c, i) for i, c in zip(front, crowding(points[front]), strict=True)]
        kept = [pool[i] for _, _, i in sorted(ranked)[:population]]
        parents = []
        while len(parents) < population:
            a, b = (kept[min(rng.integers(len(kept), size=2))]["params"] for _ in range(2))
            child = {k: (b if rng.random() < 0.5 else a)[k] for k in a} if rng.random() < crossover else dict(a)
            fresh = space.sample(rng)
            parents.append({k: fresh[k] if rng.random() < mutation / 2 else v for k, v in child.items()})
    return trials


def best(trials: list[dict], weights: tuple[float, ...], baseline: dict) -> dict:
    """The greatest weighted score on the Pareto front, the first trial on ties; the baseline if it is better."""
    points = np.array([t["values"] for t in trials])
    front = [trials[i] for i in sorted(fronts(points)[0])]
    weigh = lambda t: sum(w * v for w, v in zip(weights, t["values"], strict=True))
    top = max(front, key=lambda t: (weigh(t), -t["trial"]))
    start = next((t for t in trials if key(t["params"]) == key(baseline)), top)
    return start if weigh(start) > weigh(top) else top
