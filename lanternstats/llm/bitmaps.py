"""Tables of a fixed number of cells, filled by all tasks and sent to all tasks in packed pieces.

Their size does not depend on the data.  A bitmap of hashes keeps most rows that cannot be wanted out of a shuffle.
"""

import numpy as np
import pyarrow as pa
import zstandard

from lanternstats.llm.common import ship, slices

PIECES = 64
#: Bits of a bitmap of row ids, as a power of two.
ROW_BITS = 24


def cell_of(hashes, bits):
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def pack(part):
    """A piece in as few bytes a cell as hold it, which the first byte tells."""
    part = part.astype(np.min_scalar_type(int(part.max())))
    return bytes([part.itemsize]) + zstandard.ZstdCompressor(level=1).compress(part.tobytes())


def unpack(packed):
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), f"u{packed[0]}")


def merged_pieces(pieces, finish):
    """Pieces (piece, counts) of all tasks, combined by ``finish(so far, next)`` and ended by ``finish(all, None)``.

    They stay packed, and are bounded by the size of the table, not by the data.
    """

    def run(batches):
        place, total = None, None
        for batch in slices(batches, 16):
            for k, packed in zip(*(c.to_pylist() for c in batch.columns)):
                part = unpack(packed)
                if k != place:
                    if place is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([pack(finish(total, None))])], names=["piece", "cells"])
                    place, total = k, None
                total = finish(total, part)
        if place is not None:
            yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([pack(finish(total, None))])], names=["piece", "cells"])

    rows = pieces.repartition(PIECES, "piece").sortWithinPartitions("piece").mapInArrow(run, "piece int, cells binary").collect()
    return {r.piece: bytes(r.cells) for r in rows}


def table_of(packed, size):
    """A table of ``size`` bytes from its packed pieces; those left out are zero."""
    table = np.zeros((PIECES, size // PIECES), np.uint8)
    for k, piece in packed.items():
        table[k] = unpack(piece)
    return table.reshape(-1)


def bitmap(hashes, bits):
    """Cells in which one of the 64-bit ``hashes`` (a frame of one column) lies, a bit each."""
    width = (1 << bits) // PIECES

    def run(batches):
        at = [np.unique(cell_of(b.column(0).to_numpy().view(np.uint64), bits)) for b in batches if b.num_rows]
        at = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
        for k in range(PIECES):
            here = at[np.searchsorted(at, k * width) : np.searchsorted(at, (k + 1) * width)]
            if len(here):
                cells = np.zeros(width, np.uint8)
                cells[here - k * width] = 1
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pack(np.packbits(cells))])], names=["piece", "counts"])

    def finish(total, part):
        if part is None:
            return total
        return part if total is None else total | part

    return merged_pieces(hashes.mapInArrow(run, "piece int, counts binary"), finish)


def contains(cells, hashes, bits):
    at = cell_of(hashes, bits)
    return (cells[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


ship(__name__)
