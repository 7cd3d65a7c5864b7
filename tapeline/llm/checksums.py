"""CRC-32C of many byte strings at once, and its masked form."""

from __future__ import annotations

from functools import cache

import numpy as np

# The reflected Castagnoli polynomial and the constant of the mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8
#: Strings are cut into lanes of so many bytes, which advance side by side.
LANE = 512


@cache
def step_tables() -> np.ndarray:
    """Row k: what a byte contributes k bytes later."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    rows = [table]
    for _ in range(7):
        rows.append((rows[-1] >> 8) ^ table[rows[-1] & 255])
    return np.stack(rows)


@cache
def pair_tables() -> np.ndarray:
    """Row k: what two bytes contribute 2 k bytes later."""
    rows, pair = step_tables(), np.arange(1 << 16)
    return np.stack([rows[k + 1][pair & 255] ^ rows[k][pair >> 8] for k in range(0, 8, 2)])


@cache
def lane_tables() -> np.ndarray:
    """Row k: what byte k of a checksum becomes a lane of zeros later."""
    table = step_tables()[0]
    state = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    for _ in range(LANE):
        state = (state >> 8) ^ table[state & 255]
    return state


def plain(data: bytes, state: int = 0xFFFFFFFF) -> int:
    table = step_tables()[0]
    for byte in data:
        state = (state >> 8) ^ int(table[(state ^ byte) & 255])
    return state ^ 0xFFFFFFFF


def crc32c(strings: list[bytes]) -> np.ndarray:
    """The CRC-32C of each string.

    Strings are filled up with zeros in front to whole lanes: with a state of zero these
    change nothing, and the usual first state is the same as inverting four bytes."""
    short = [len(s) < 4 for s in strings]
    if any(short):
        out = np.empty(len(strings), np.uint32)
        out[np.array(short)] = [plain(s) for s, is_short in zip(strings, short) if is_short]
        rest = [s for s, is_short in zip(strings, short) if not is_short]
        out[~np.array(short)] = crc32c(rest) if rest else []
        return out
    if not strings:
        return np.empty(0, np.uint32)
    sizes = np.array([len(s) for s in strings])
    lane = min(LANE, -(-int(sizes.max()) // 8) * 8)  # one short lane if that holds each string
    lanes = -(-sizes // lane)
    ends = np.cumsum(lanes)
    data = np.zeros(int(ends[-1]) * lane, np.uint8)
    for s, end in zip(strings, (ends * lane).tolist()):
        data[end - len(s) : end] = np.frombuffer(s, np.uint8)
    heads = (ends * lane - sizes)[:, None] + np.arange(4)
    data[heads] ^= 255
    columns = np.ascontiguousarray(data.view("<u2").reshape(-1, lane // 2).T)
    tables = pair_tables()
    state = np.zeros(int(ends[-1]), np.uint32)
    for at in range(0, lane // 2, 4):
        low, high, *others = columns[at : at + 4]
        low = low ^ (state & np.uint32(0xFFFF)).astype(np.uint16)
        high = high ^ (state >> np.uint32(16)).astype(np.uint16)
        state = tables[3][low] ^ tables[2][high]
        for k, pair in zip((1, 0), others):
            state ^= tables[k][pair]
    later = lane_tables()
    whole = np.zeros(len(strings), np.uint32)
    first = ends - lanes
    by_lanes = np.argsort(-lanes, kind="stable")
    left = np.sort(-lanes)
    for i in range(int(lanes.max())):
        some = by_lanes[: np.searchsorted(left, -i, side="left")]
        moved = whole[some]
        moved = later[0][moved & 255] ^ later[1][(moved >> 8) & 255] ^ later[2][(moved >> 16) & 255] ^ later[3][moved >> 24]
        whole[some] = moved ^ state[first[some] + i]
    return whole ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """Checksums as record files store them: turned by 15 bits, plus a constant, so that
    a checksum over data that holds checksums stays a good one."""
    crc = crc.astype(np.uint64)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA & 0xFFFFFFFF).astype(np.uint32)
