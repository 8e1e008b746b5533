"""Search for rows of a block whose vectors correlate, without all of their pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Rows searched from at once, and numbers of a slice that is looked at exactly.
STEP, SLICE = 256, 1 << 21
#: Products of unit vectors are exact to far less; who is this close counts as a candidate.
SLACK = 1e-6


class Rows:
    """Vectors of a block; ``exact`` is ``geometry.correlation`` to the last bit."""

    def __init__(self, column: pa.ChunkedArray):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        self.size = np.asarray(column.value_lengths(), dtype=np.int64)
        flat = column.flatten()
        inside = np.arange(max(int(self.size.max(initial=0)), 1)) < self.size[:, None]
        x, gap = np.zeros(inside.shape), np.zeros(inside.shape, bool)
        x[inside] = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
        gap[inside] = flat.is_null().to_numpy(zero_copy_only=False)
        self.null = gap.any(axis=1) | (self.size == 0)
        with np.errstate(all="ignore"):
            mean = x.cumsum(axis=1)[:, -1] / np.maximum(self.size, 1)  # sums go from left to right
            self.centred = np.where(inside, x - mean[:, None], 0.0)
            self.square = (self.centred * self.centred).cumsum(axis=1)[:, -1]
            #: Hardly varying, or not numbers: looked at exactly with each other row.
            self.rough = self.null | ~np.isfinite(self.square) | ~(self.square > 1e-12 * (x * x).sum(axis=1))
            self.unit = np.where(self.rough[:, None], 0.0, self.centred / np.sqrt(self.square)[:, None])

    def __len__(self) -> int:
        return len(self.size)

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Correlations of pairs; -inf where there is none."""
        out, step = np.empty(len(i)), max(SLICE // self.centred.shape[1], 1)
        flat = ~self.null & (self.square <= 0)
        with np.errstate(all="ignore"):
            for at in range(0, len(i), step):
                a, b = i[at : at + step], j[at : at + step]
                both = (self.centred[a] * self.centred[b]).cumsum(axis=1)[:, -1]
                value = both / np.sqrt(self.square[a] * self.square[b])
                value = np.where(self.null[a] | self.null[b] | (self.size[a] != self.size[b]), -np.inf, value)
                out[at : at + step] = np.where(flat[a] | flat[b], 1.0, value)
        return out

    def found(self, left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``right`` that correlate with any of ``left``, with whom, and how."""
        near = self.unit[left] @ self.unit[right].T
        near[self.rough[left]] = 2.0
        near[:, self.rough[right]] = 2.0
        best = near.argmax(axis=0)
        at = np.flatnonzero(near[best, np.arange(len(right))] >= least - SLACK)
        value = self.exact(left[best[at]], right[at])
        good = passes(value, least)
        places, whom, values = [at[good]], [left[best[at[good]]]], [value[good]]
        for place in at[~good]:  # the best isn't good enough to the last bit: any other?
            others = left[near[:, place] >= least - SLACK]
            value = self.exact(others, np.full(len(others), right[place]))
            for k in np.flatnonzero(passes(value, least))[:1]:
                places.append(np.array([place]))
                whom.append(others[k : k + 1])
                values.append(value[k : k + 1])
        return np.concatenate(places), np.concatenate(whom), np.concatenate(values)


def passes(value: np.ndarray, least: float) -> np.ndarray:
    """As Spark compares: what isn't a number is above all numbers."""
    return np.isnan(value) | (value >= least)


def forest(rows: Rows, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label of each row's group, a row that it correlates with (-1 for the first of a
    group), and their correlation."""
    label, other, value = np.full(len(rows), -1), np.full(len(rows), -1), np.full(len(rows), np.nan)
    rest, group = np.arange(len(rows)), 0
    while len(rest):
        ahead, rest = rest[:1], rest[1:]
        label[ahead] = group
        while len(ahead) and len(rest):
            now, ahead = ahead[:STEP], ahead[STEP:]
            places, whom, values = rows.found(now, rest, least)
            met = rest[places]
            label[met], other[met], value[met] = group, whom, values
            rest, ahead = np.delete(rest, places), np.concatenate((ahead, met))
        group += 1
    return label, other, value


def joining(rows: Rows, side: np.ndarray, label: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between rows of side 0 and of side 1, that join groups (``label`` on its
    side; below 0: a row by itself) which no other link joins."""
    own = np.where(label < 0, np.arange(len(rows)) + label.max(initial=0) + 1, label)
    _, group, sizes = np.unique(np.stack((side, own)), axis=1, return_inverse=True, return_counts=True)
    group = group.reshape(-1)
    order = np.argsort(group, kind="stable")
    members = np.split(order, np.cumsum(sizes)[:-1])
    met = np.zeros(len(sizes), bool)
    rest = [np.flatnonzero(side == s) for s in (0, 1)]
    links = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    for seed in np.argsort(-sizes, kind="stable"):
        if met[seed]:
            continue
        met[seed] = True
        ahead = [[], []]
        ahead[side[members[seed][0]]].append(members[seed])
        rest = [r[~met[group[r]]] for r in rest]
        while True:
            s = next((s for s in (0, 1) if ahead[s] and len(rest[1 - s])), None)
            if s is None:
                break
            now = ahead[s].pop()
            if len(now) > STEP:
                ahead[s].append(now[STEP:])
            places, whom, values = rows.found(now[:STEP], rest[1 - s], least)
            if not len(places):
                continue
            there = rest[1 - s][places]
            new, first = np.unique(group[there], return_index=True)
            links.append((whom[first], there[first], values[first]))
            met[new] = True
            ahead[1 - s].append(np.concatenate([members[g] for g in new]))
            rest[1 - s] = rest[1 - s][~met[group[rest[1 - s]]]]
    i, j, value = (np.concatenate(x) for x in zip(*links))
    return i, j, value
