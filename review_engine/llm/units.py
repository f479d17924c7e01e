"""Ids of texts by way of their units (stretches of text over whose ends no token reaches).

A batch's distinct units are looked up once, and the ids of all its units are gathered in
one step from an array. Each worker keeps the units that it has met, with a bound on their number
and on that of their ids; beyond it the table begins anew.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

MOST_UNITS = 800_000
MOST_IDS = 1 << 23

# Ids of some units, one after the other, and how many each has.
Ids = tuple[np.ndarray, np.ndarray]


class UnitIds:
    """Ids of units, for one encoder or several that cut texts into the same units."""

    def __init__(self, encode: Callable[[list], list[Ids]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.places: dict = {}
        self.kept: list[list[np.ndarray]] = []

    def _learn(self, units: list) -> None:
        for k, (ids, sizes) in enumerate(self.encode(units)):
            if k == len(self.kept):
                self.kept.append([np.empty(0, ids.dtype), np.empty(0, np.int64), np.empty(0, np.int64)])
            known, begins, lengths = self.kept[k]
            self.kept[k] = [np.concatenate([known, ids]), np.concatenate([begins, len(known) + np.cumsum(sizes) - sizes]),
                            np.concatenate([lengths, sizes])]
        self.places.update(zip(units, range(len(self.places), len(self.places) + len(units)), strict=True))

    def of(self, units: pa.Array) -> list[Ids]:
        """For each encoder the ids of all units in order, and how many each has."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [u for u in distinct if u not in self.places]
        if new or not self.kept:
            self._learn(new)
        place = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        out = []
        for known, begins, lengths in self.kept:
            sizes = lengths[place]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            out.append((known[np.repeat(begins[place] - (ends - sizes), sizes) + np.arange(total)], sizes))
        if len(self.places) > MOST_UNITS or any(len(known) > MOST_IDS for known, _, _ in self.kept):
            self._clear()
        return out
