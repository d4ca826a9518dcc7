"""Crossover sums the bins of each parent once."""

import numpy as np

from rollcall.llm import packing


class Counted(list):
    reads = 0

    def __getitem__(self, at):
        self.reads += 1
        return super().__getitem__(at)


def test_crossover_reads_lengths_of_kept_bins_once():
    lengths = Counted(np.random.default_rng(2).integers(1, 400, 3000).tolist())
    parent: list[list[int]] = []
    packing.best_fit(np.argsort([-n for n in list(lengths)], kind="stable").tolist(), lengths, parent, [])
    lengths.reads = 0
    child = packing.crossover(parent, parent, lengths, np.random.default_rng(5))
    assert sorted(i for b in child for i in b) == list(range(3000))
    assert all(sum(list(lengths)[i] for i in b) <= packing.CAPACITY for b in child)
    assert lengths.reads < 2.75 * 3000  # the bins of both parents, and those taken from one
