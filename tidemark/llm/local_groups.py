"""Connected components of a few thousand places inside one task."""

from __future__ import annotations

import numpy as np


class LocalGroups:
    """``low`` is the least place of each place's group; many pairs are joined at a time."""

    def __init__(self, n: int):
        self.low = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.low[i], self.low[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.low, np.maximum(a, b), np.minimum(a, b))
            while (self.low != self.low[self.low]).any():
                self.low = self.low[self.low]
