"""Keccak-256 over a whole Arrow batch at once.

Spark has no Keccak, and SHA3 pads differently. The permutation runs on numpy arrays with one column
per row of the batch, so the Python cost is per batch and 136-byte block, not per row. Payloads are read
where Arrow put them; no value becomes a Python object.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType

RATE = 136
LANES = RATE // 8
DIGEST = 32
_PLACES = np.arange(RATE)


def _round_constants() -> np.ndarray:
    """The 24 round constants: bits of a degree-8 shift register at positions 2**j - 1."""
    register, bits = 1, []
    for _ in range(24 * 7):
        bits.append(register & 1)
        register = (register << 1) ^ (0x171 if register & 0x80 else 0)
    return np.array(
        [sum(bits[7 * r + j] << (2**j - 1) for j in range(7)) for r in range(24)], dtype=np.uint64
    )


def _lane_moves() -> list[tuple[int, int, int]]:
    """(source, target, rotation) of the combined rotate-and-move step, walking the lanes from (1, 0)."""
    moves = [(0, 0, 0)]
    x, y = 1, 0
    for step in range(24):
        target = (y, (2 * x + 3 * y) % 5)
        moves.append((x + 5 * y, target[0] + 5 * target[1], ((step + 1) * (step + 2) // 2) % 64))
        x, y = target
    return moves


_CONSTANTS = _round_constants()
_MOVES = sorted(_lane_moves(), key=lambda move: move[1])
_SOURCES = np.array([source for source, _, _ in _MOVES])
_LEFT = np.array([by for _, _, by in _MOVES], dtype=np.uint64)[:, None]
_RIGHT = np.uint64(64) - _LEFT  # numpy shifts by 64 to zero, as wanted for the lane that stays
_BEFORE, _NEXT, _SECOND = (np.arange(5) + by for by in (4, 1, 2))
_BEFORE, _NEXT, _SECOND = _BEFORE % 5, _NEXT % 5, _SECOND % 5
_ONE, _REST = np.uint64(1), np.uint64(63)

# Rows permuted together: 25 lanes of this many rows, with their temporaries, stay in the processor cache.
TILE = 512


def _permute(state: np.ndarray) -> np.ndarray:
    """Keccak-f[1600] on every column of a (25, rows) array."""
    for constant in _CONSTANTS:
        cube = state.reshape(5, 5, -1)
        parity = np.bitwise_xor.reduce(cube, axis=0)
        after = parity[_NEXT]
        cube = cube ^ (parity[_BEFORE] ^ ((after << _ONE) | (after >> _REST)))
        lanes = cube.reshape(25, -1)[_SOURCES]
        rows = ((lanes << _LEFT) | (lanes >> _RIGHT)).reshape(5, 5, -1)
        mixed = np.bitwise_not(rows[:, _NEXT])
        mixed &= rows[:, _SECOND]
        mixed ^= rows
        state = mixed.reshape(25, -1)
        state[0] ^= constant
    return state


def _tile_digests(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Digests (one row of 32 bytes each) of stretches of ``data`` that are sorted from most to fewest blocks."""
    blocks = lengths // RATE + 1
    state = np.zeros((25, len(starts)), dtype=np.uint64)
    for block in range(int(blocks[0])):
        active = int(np.searchsorted(-blocks, -block, side="left"))
        left = lengths[:active] - block * RATE
        part = data[np.minimum((starts[:active] + block * RATE)[:, None] + _PLACES, len(data) - 1)]
        last = np.flatnonzero(left < RATE)
        if len(last):
            tails = np.where(_PLACES < left[last, None], part[last], np.uint8(0))
            tails[np.arange(len(last)), left[last]] = 0x01
            tails[:, -1] ^= 0x80
            part[last] = tails
        mixed = state[:, :active].copy()
        mixed[:LANES] ^= part.view("<u8").T
        state[:, :active] = _permute(mixed)
    return np.ascontiguousarray(state[:4].T).astype("<u8").view(np.uint8)


def digest_array(payload: pa.Array) -> pa.Array:
    """Keccak-256 of each value of a binary array, read in place; NULL stays NULL.

    Payloads of similar length share a tile, so few columns ever idle, and only a tile's current blocks are copied.
    """
    payload = payload.cast(pa.large_binary())
    rows = len(payload)
    _, offsets, values = payload.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[payload.offset : payload.offset + rows + 1] if rows else np.zeros(1, dtype=np.int64)
    # a NULL may own bytes or none; it is hashed like any other value, and its digest is masked
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(1, dtype=np.uint8)
    starts, lengths = bounds[:-1], np.diff(bounds)
    order = np.argsort(-(lengths // RATE), kind="stable")
    out = np.empty((rows, DIGEST), dtype=np.uint8)
    for first in range(0, rows, TILE):
        chosen = order[first : first + TILE]
        out[chosen] = _tile_digests(data, starts[chosen], lengths[chosen])
    ends = np.arange(rows + 1, dtype=np.int32) * DIGEST
    hashed = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(out)])
    return hashed if not payload.null_count else pc.if_else(payload.is_valid(), hashed, pa.scalar(None, pa.binary()))


def digests(payloads: list[bytes]) -> list[bytes]:
    """Keccak-256 of every payload."""
    return digest_array(pa.array(payloads, pa.large_binary())).to_pylist()


@F.arrow_udf(BinaryType())
def _keccak_udf(payload: pa.Array) -> pa.Array:
    return digest_array(payload)


def keccak256(payload: Column | str) -> Column:
    """Keccak-256 of a binary column (NULL stays NULL)."""
    return _keccak_udf(payload)
