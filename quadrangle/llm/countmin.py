"""Count-min sketches whose counters stop at two, merged across partitions.

A sketch has two rows of cells, two bits of meaning each: empty, one, more. Cells are
kept in blocks of 65,536. A task sends only the cells it touched, blocks are merged as a
stream of such lists, and the whole sketch is at most `MAX_CELLS / 4` bytes, so sending
it to every task is bounded whatever the input. A fuller sketch overestimates more often
and never underestimates.
"""

import numpy as np
import pyarrow as pa

from quadrangle.llm.textscan import mix

BLOCK_BITS = 16
MAX_CELLS = 1 << 27
MIN_CELLS = 1 << 20
CELLS_PER_KEY = 8
PARTIAL_KEYS = 1 << 19
PARTIAL_SCHEMA = "block int, cells binary"

_U = np.uint64


def cells_for(keys):
    """Cells for about `keys` insertions: a power of two within fixed bounds."""
    wanted = max(1, int(keys)) * CELLS_PER_KEY
    return min(MAX_CELLS, max(MIN_CELLS, 1 << (wanted - 1).bit_length()))


def places(keys, cells):
    """The two cells of each key, one in each half."""
    half = _U(cells // 2)
    return mix(keys) & (half - _U(1)), half + (mix(keys ^ _U(0xA5A5A5A5DEADBEEF)) & (half - _U(1)))


class Partial:
    """Cells touched by one task, sent on in sorted lists of bounded size."""

    def __init__(self, cells):
        self.cells, self.waiting, self.held = cells, [], 0

    def add(self, keys):
        """Insert each key once per occurrence; returns rows to send, often none."""
        if len(keys):
            self.waiting += places(keys, self.cells)
            self.held += len(keys)
        return self.flush() if self.held >= PARTIAL_KEYS else []

    def flush(self):
        """A record batch of (block, cells); a cell named twice has been hit twice."""
        if not self.held:
            return []
        touched, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.held = [], 0
        touched = np.sort(np.concatenate([touched, touched[counts > 1]]))
        blocks = (touched >> _U(BLOCK_BITS)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(blocks)) + 1
        low = (touched & _U((1 << BLOCK_BITS) - 1)).astype(np.uint16)
        lists = [x.tobytes() for x in np.split(low, cuts)]
        return [pa.record_batch([pa.array(blocks[np.r_[0, cuts]].astype(np.int32)), pa.array(lists, pa.binary())], ["block", "cells"])]


def _merge(batches):
    """Blocks of one partition as dense counters of 0, 1 or 2, packed four to a byte."""
    dense = {}
    for batch in batches:
        for block, cells in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counters = dense.setdefault(block, np.zeros(1 << BLOCK_BITS, np.uint8))
            at, times = np.unique(np.frombuffer(cells.as_buffer(), np.uint16), return_counts=True)
            counters[at] = np.minimum(2, counters[at] + times)
    for block, counters in dense.items():
        four = counters.reshape(-1, 4)
        packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
        yield pa.record_batch([pa.array([block], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["block", "cells"])


def merged(partials, cells):
    """Bytes of the whole sketch, from the tasks' lists; bounded by `MAX_CELLS / 4`."""
    out = np.zeros(cells // 4, np.uint8)
    width = 1 << (BLOCK_BITS - 2)
    for row in partials.repartition("block").mapInArrow(_merge, PARTIAL_SCHEMA).collect():
        out[row.block * width : (row.block + 1) * width] = np.frombuffer(row.cells, np.uint8)
    return out


def repeated(sketch, keys):
    """Whether each key may have been inserted twice; never false for one that was."""
    yes = np.ones(len(keys), bool)
    for at in places(keys, len(sketch) * 4):
        yes &= (sketch[(at >> _U(2)).astype(np.int64)] >> ((at & _U(3)) * _U(2)).astype(np.uint8)) & 3 >= 2
    return yes


def _twice(batches, cells):
    own = Partial(cells)
    for batch in batches:
        keys = np.asarray(batch.column(0)).view(np.uint64)
        yield from own.add(np.r_[keys, keys])
    yield from own.flush()


def membership(keys):
    """A broadcast sketch of a one-column table of longs, for `repeated`: true for each of
    them, and for few others unless there are very many."""
    cells = cells_for(2 * keys.count())
    return keys.sparkSession.sparkContext.broadcast(merged(keys.mapInArrow(lambda b: _twice(b, cells), PARTIAL_SCHEMA), cells))
