"""Sparse matrices in compressed rows, and their product row by row."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Csr:
    """Row i holds ``data`` at the columns ``columns``, both from ``ends[i]`` to ``ends[i + 1]``."""

    ends: np.ndarray
    columns: np.ndarray
    data: np.ndarray
    width: int

    @classmethod
    def incidence(cls, starts: np.ndarray, ends: np.ndarray, width: int) -> Csr:
        """A row of ones per range of columns."""
        lengths = ends - starts
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        columns = np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])
        return cls(bounds, columns, np.ones(len(columns), np.int64), width)

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), self.rows()[order], self.data[order], len(self.ends) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: a row is the sum of the other's rows at its columns, each times its entry.

        The rows that an entry calls for are laid out side by side, and equal places of a row added up.
        """
        called = np.diff(other.ends)[self.columns]
        total = int(called.sum())
        at = np.repeat(other.ends[:-1][self.columns] - (np.cumsum(called) - called), called) + np.arange(total)
        place = np.repeat(self.rows(), called) * other.width + other.columns[at]
        value = np.repeat(self.data, called) * other.data[at]
        if np.any(place[1:] < place[:-1]):
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if total else np.zeros(0, np.int64)
        row, column = np.divmod(place[first], max(1, other.width))
        counts = np.bincount(row, minlength=len(self.ends) - 1)
        data = np.add.reduceat(value, first) if total else value
        return Csr(np.concatenate([[0], np.cumsum(counts)]), column, data, other.width)
