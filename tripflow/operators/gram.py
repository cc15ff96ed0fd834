"""Moments of a regression from one grouped pass, and penalised solutions of them.

All that a linear model needs of its rows is how its features vary together.
Numbers give sums of products, a category and a number the sums of the number
per category, two categories the rows per pair: one grouping by all single
categories and pairs of them gives every one of these at once. Any number of
penalties are then solved from the same moments without a look at the rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A solution holds when no condition of the optimum is off by more.
TOLERANCE = 1e-11
SWEEPS_BETWEEN_SOLVES, MOST_SWEEPS = 20, 20_000


@dataclass(frozen=True)
class Moments:
    """Rows, means, and population covariances of all features with each other and the label."""

    rows: int
    means: np.ndarray
    label_mean: float
    covariance: np.ndarray
    with_label: np.ndarray
    label_variance: float


def collect_moments(
    df: DataFrame,
    label: Column,
    numbers: dict[str, Column],
    categories: dict[str, Column],
    places: dict[str, dict[str, int]],
    widths: dict[str, int],
) -> Moments:
    """Moments of numbers, then of one indicator per place of each category.

    ``numbers`` are near their means already (a shift changes no covariance,
    but keeps digits) and never NULL. ``places`` gives the place of each value
    of a category below ``widths``; values without one have no indicator. What
    comes to the driver is one row per category and per pair that occurs: no
    more than the matrix holds.
    """
    x, c = list(numbers), list(categories)
    rows = df.select(
        label.cast("double").alias("_y"),
        *(numbers[n].alias(f"_x{i}") for i, n in enumerate(x)),
        *(categories[n].alias(f"_c{i}") for i, n in enumerate(c)),
    )
    values = ["_y", *(f"_x{i}" for i in range(len(x)))]
    sums = [F.count("*").alias("n")]
    sums += [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    # Products are wanted of all rows together, not of each group.
    products = [(i, j) for i in range(len(values)) for j in range(i, len(values))]
    named = [F.sum(F.col(values[i]) * F.col(values[j])).alias(f"p{i}_{j}") for i, j in products]
    if c:
        columns = [F.col(f"_c{i}") for i in range(len(c))]
        sets = [[], *([k] for k in columns), *(list(pair) for pair in combinations(columns, 2))]
        grouped = rows.groupingSets(sets, *columns)
        found = grouped.agg(F.grouping_id().alias("set"), *sums, *named).toPandas()
    else:
        found = rows.agg(*sums, *named).toPandas().assign(set=0)

    every = (1 << len(c)) - 1  # bits of a set are the columns it leaves out
    total = found[found["set"] == every].iloc[0]
    n = int(total["n"])
    first = dict(zip(c, np.cumsum([len(x), *(widths[k] for k in c)])[:-1].tolist(), strict=False))
    size = len(x) + sum(widths[k] for k in c)
    second = np.zeros((size, size))
    with_label, means = np.zeros(size), np.zeros(size)
    for i, j in products:
        value = total[f"p{i}_{j}"]
        if i:
            second[i - 1, j - 1] = second[j - 1, i - 1] = value
        elif j:
            with_label[j - 1] = value
    means[: len(x)] = [total[f"s{i + 1}"] for i in range(len(x))]
    bits = {k: 1 << (len(c) - 1 - i) for i, k in enumerate(c)}

    def at(name: str, group) -> np.ndarray:
        """Row numbers in the matrix of the categories of a group; -1 without an indicator."""
        column = group[f"_c{c.index(name)}"]
        place = column.map(places[name]).fillna(-1).to_numpy(np.int64)
        return np.where((place >= 0) & (place < widths[name]), place + first[name], -1)

    for name in c:
        group = found[found["set"] == every & ~bits[name]]
        place = at(name, group)
        group, place = group[place >= 0], place[place >= 0]
        count = group["n"].to_numpy(float)
        second[place, place] = means[place] = count
        with_label[place] = group["s0"]
        for i in range(len(x)):
            second[i, place] = second[place, i] = group[f"s{i + 1}"]
    for a, b in combinations(c, 2):
        group = found[found["set"] == every & ~bits[a] & ~bits[b]]
        place, other = at(a, group), at(b, group)
        both = (place >= 0) & (other >= 0)
        second[place[both], other[both]] = second[other[both], place[both]] = group["n"][both]

    means, label_mean = means / n, total["s0"] / n
    return Moments(
        rows=n,
        means=means,
        label_mean=float(label_mean),
        covariance=second / n - np.outer(means, means),
        with_label=with_label / n - means * label_mean,
        label_variance=float(total["p0_0"] / n - label_mean**2),
    )


def _coordinate_descent(c: np.ndarray, b: np.ndarray, l1: float) -> np.ndarray:
    """Smallest w'cw/2 - b'w + l1 |w|, c symmetric and without a negative eigenvalue.

    Every few sweeps the features in use are solved for at once, their signs
    held; that is the answer if it meets the conditions of the optimum.
    """
    w, own = np.zeros(len(b)), np.diag(c).copy()
    gradient = -b.copy()  # c @ w - b
    moving = np.flatnonzero(own > 0)

    def off(w, gradient):
        """How far the conditions of the optimum are from met."""
        used = w != 0
        inside = np.maximum(np.abs(gradient[~used]) - l1, 0).max(initial=0.0)
        return max(inside, np.abs(gradient[used] + l1 * np.sign(w[used])).max(initial=0.0))

    for sweep in range(1, MOST_SWEEPS + 1):
        for j in moving:
            rest = w[j] * own[j] - gradient[j]
            value = np.sign(rest) * max(abs(rest) - l1, 0.0) / own[j]
            if value != w[j]:
                gradient += c[:, j] * (value - w[j])
                w[j] = value
        if off(w, gradient) <= TOLERANCE:
            return w
        if sweep % SWEEPS_BETWEEN_SOLVES == 0:
            used, signs = np.flatnonzero(w), np.sign(w[w != 0])
            solved = np.zeros_like(w)
            solved[used] = np.linalg.lstsq(c[np.ix_(used, used)], b[used] - l1 * signs, rcond=None)[0]
            if (np.sign(solved[used]) == signs).all():
                exact = c @ solved - b
                if off(solved, exact) <= TOLERANCE:
                    return solved
            gradient = c @ w - b  # without the rounding of many steps
    raise ArithmeticError(f"no solution after {MOST_SWEEPS} sweeps")


def solve(moments: Moments, l1: float, l2: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept under the penalties of standardised features.

    Half the mean squared error plus l1 |w| + l2 w'w / 2, each feature and the
    label in units of its own spread, penalties in units of the label's. A
    feature that does not vary has no weight.
    """
    spread = np.sqrt(np.maximum(np.diag(moments.covariance), 0.0))
    varies = spread > 1e-9 * np.maximum(1.0, np.abs(moments.means))
    unit = float(np.sqrt(max(moments.label_variance, 0.0)))
    weights = np.zeros(len(spread))
    if unit > 0 and varies.any():
        s = spread[varies]
        c = moments.covariance[np.ix_(varies, varies)] / np.outer(s, s)
        b = moments.with_label[varies] / (s * unit)
        c[np.diag_indices_from(c)] += l2 / unit
        if l1:
            w = _coordinate_descent(c, b, l1 / unit)
        else:
            w = np.linalg.lstsq(c, b, rcond=None)[0]
        weights[varies] = w * unit / s
    return weights, float(moments.label_mean - weights @ moments.means)
