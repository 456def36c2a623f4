"""Adaptive search of a model's parameters on the chronological validation rows.

Trials of a batch, each a model for every target, are trained side by side: one pass over the rows serves all of them.  New
parameters are proposed from earlier trials: near the good ones, away from the rest.  At given numbers of trees (rungs)
a trial whose error is not among the best seen there stops.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from daygrain.operators.boosting import Binned, Job, Params, train

GOOD = 0.25  # share of the trials that count as good
DRAWS = 24  # candidates a proposal chooses from
RANDOM = 10  # trials before proposals look at earlier ones


@dataclass(frozen=True)
class Range:
    """Values of one parameter; ``log``: even in the logarithm."""

    low: float
    high: float
    log: bool = False
    whole: bool = False

    def inner(self, value: float) -> float:
        """The value on the scale from 0 to 1."""
        a, b, v = (math.log(x) if self.log else x for x in (self.low, self.high, value))
        return (v - a) / (b - a) if b > a else 0.0

    def outer(self, place: float) -> float:
        a, b = (math.log(x) if self.log else x for x in (self.low, self.high))
        value = a + min(1.0, max(0.0, place)) * (b - a)
        value = math.exp(value) if self.log else value
        value = min(self.high, max(self.low, value))
        return int(round(value)) if self.whole else float(value)


# The ranges in which the boosted models are searched.
SPACE = {
    "rounds": Range(100, 1000, whole=True),
    "learning_rate": Range(0.01, 0.3, log=True),
    "depth": Range(3, 15, whole=True),
    "leaves": Range(20, 200, whole=True),
    "rows": Range(0.6, 1.0),
    "columns": Range(0.6, 1.0),
    "l1": Range(1e-8, 10.0, log=True),
    "l2": Range(1e-8, 10.0, log=True),
    "least_rows": Range(5, 100, whole=True),
}


@dataclass
class Trial:
    """``trees`` were trained when ``rmse`` (over all targets of the judged rows) was measured; ``rung`` counts rungs passed."""

    number: int
    batch: int
    params: Params
    trees: int = 0
    rmse: float = math.inf
    rung: int = 0
    stopped: bool = False


def _density(places: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of normal kernels at ``places`` on the scale from 0 to 1, with one even kernel for what was never tried."""
    width = max(0.05, 1.0 / (1 + len(places)))
    bells = np.exp(-0.5 * ((at[:, None] - places[None, :]) / width) ** 2) / (width * math.sqrt(2 * math.pi))
    return (bells.sum(axis=1) + 1.0) / (len(places) + 1)


def propose(space: Mapping[str, Range], trials: Sequence[Trial], rng: np.random.Generator, random: int = RANDOM) -> dict[str, float]:
    """Parameters of the next trial: at random at first, then for each the draw near good trials that is likeliest to be one."""
    known = sorted((t for t in trials if math.isfinite(t.rmse)), key=lambda t: (t.stopped, t.rmse))
    if len(known) < random:
        return {name: r.outer(rng.random()) for name, r in space.items()}
    cut = max(1, math.ceil(GOOD * len(known)))
    out = {}
    for name, r in space.items():
        good, rest = (np.array([r.inner(getattr(t.params, name)) for t in part]) for part in (known[:cut], known[cut:]))
        centres = np.append(good, np.nan)[rng.integers(0, len(good) + 1, DRAWS)]
        width = max(0.05, 1.0 / (1 + len(good)))
        drawn = np.where(np.isnan(centres), rng.random(DRAWS), np.clip(centres + width * rng.standard_normal(DRAWS), 0, 1))
        out[name] = r.outer(float(drawn[np.argmax(_density(good, drawn) / _density(rest, drawn))]))
    return out


def search(
    data: Binned, targets: Sequence[str], space: Mapping[str, Range] = SPACE, trials: int = 100, side_by_side: int = 4,
    rungs: Sequence[int] = (10, 30, 90, 270), keep: float = 0.5, seed: int = 42, base: Params = Params(), random: int = RANDOM,
) -> list[Trial]:
    """``trials`` trials, best first: finished ones by their error on the judged rows, then those that were stopped.

    At each rung a trial goes on if its error is among the best ``keep`` of all that reached that rung so far.  The same
    seed and rows give the same trials.
    """
    if not data.judged:
        raise ValueError("no judged rows")
    import dataclasses

    rng, done, seen = np.random.default_rng(seed), [], {r: [] for r in rungs}
    while len(done) < trials:
        batch = []
        for _ in range(min(side_by_side, trials - len(done))):
            chosen = propose(space, done, rng, random)
            number = len(done) + len(batch) + 1
            params = dataclasses.replace(base, **chosen, seed=seed)
            batch.append(Trial(number, 1 + len(done) // side_by_side, params))
        jobs = [Job(f"trial{t.number}", target, t.params) for t in batch for target in targets]
        of = [t for t in batch for _ in targets]

        def after(trees: int, errors: Mapping[int, tuple[float, float | None]]) -> set[int]:
            measured = {}
            for i, (_, judged) in errors.items():
                measured.setdefault(of[i].number, []).append(judged)
            out = set()
            for t in batch:
                if len(measured.get(t.number, [])) == len(targets):
                    t.trees, t.rmse = trees, math.sqrt(sum(measured[t.number]) / len(targets))
            if trees in seen:
                here = [t for t in batch if t.number in measured and t.trees == trees]
                seen[trees] += [t.rmse for t in here]
                limit = sorted(seen[trees])[max(1, math.ceil(keep * len(seen[trees]))) - 1]
                for t in here:
                    if t.rmse > limit and trees < t.params.rounds:
                        t.stopped = True
                        out |= {i for i, other in enumerate(of) if other is t}
                    else:
                        t.rung += 1
            return out

        train(data, jobs, after)
        done += batch
    return sorted(done, key=lambda t: (t.stopped, t.rmse, t.number))


def trials_table(spark: SparkSession, trials: Sequence[Trial], space: Mapping[str, Range] = SPACE) -> DataFrame:
    """(rank, trial, batch, a column for each parameter, trees, rung, rmse, stopped) of a search, best first."""
    names = [f"{n} {'int' if r.whole else 'double'}" for n, r in space.items()]
    rows = [
        (i, t.number, t.batch, *[getattr(t.params, n) for n in space], t.trees, t.rung, float(t.rmse), t.stopped)
        for i, t in enumerate(trials, start=1)
    ]
    return spark.createDataFrame(rows, f"rank int, trial int, batch int, {', '.join(names)}, trees int, rung int, rmse double, stopped boolean")
