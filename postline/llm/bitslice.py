"""Comparing fingerprints by bit planes.

Fingerprints lie side by side: plane p holds bit p of every one of them, 64 to a
machine word. Moving a plane by d and taking the exclusive or compares each
fingerprint with the d-th after it, 64 at a time. The differing bits are
counted by carry-save adders whose sum bits are planes too, and a move is given
up as soon as every pair in it is beyond the radius.
"""

import numpy as np

# Planes added between two looks at whether all pairs are beyond the radius.
LOOK = 16


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(rows, words) uint64 to (64 * words, ceil(rows / 64)) uint64, with one spare word of zeros."""
    rows, words = prints.shape
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(rows, words * 8), axis=1, bitorder="little")
    across = np.zeros((words * 64, (rows + 63) // 64 * 64 + 64), np.uint8)
    across[:, :rows] = bits.T
    return np.packbits(across, axis=1, bitorder="little").view("<u8")


def _moved(planes: np.ndarray, by: int) -> np.ndarray:
    words, bits = divmod(by, 64)
    out = np.zeros_like(planes)
    keep = planes.shape[1] - words
    if keep <= 0:
        return out
    out[:, :keep] = planes[:, words:] >> np.uint64(bits)
    if bits and keep > 1:
        out[:, : keep - 1] |= planes[:, words + 1 :] << np.uint64(64 - bits)
    return out


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Where the count in the counters' planes is greater than the radius."""
    greater, equal = over.copy(), ~over
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            greater |= equal & counters[k]
            equal &= ~counters[k]
    return greater


def _far(different: np.ndarray, pairs: np.ndarray, radius: int) -> np.ndarray:
    """Per lane, whether more than `radius` of the planes are set; `pairs` are the lanes that count."""
    width = max(1, radius.bit_length())
    counters = [np.zeros_like(pairs) for _ in range(width)]
    over = ~pairs
    for p in range(0, len(different), 2):
        a, b, ones = different[p], different[p + 1], counters[0]
        half = ones ^ a
        carry = (ones & a) | (b & half)
        counters[0] = half ^ b
        for k in range(1, width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if p % LOOK == LOOK - 2 and not (~_beyond(counters, over, radius)).any():
            return ~np.zeros_like(over)
    return _beyond(counters, over, radius)


def close_pairs(prints: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows (i, j), i < j, of one group whose fingerprints differ in `radius` bits or fewer.

    `prints` is (rows, words) of uint64; rows of a group are neighbours, which
    `groups` marks by equal numbers.
    """
    firsts: list[np.ndarray] = []
    seconds: list[np.ndarray] = []
    rows = np.arange(len(groups))
    move, kept = 1, -1
    planes = np.zeros((0, 0), np.uint64)
    while len(rows) > 1:
        if kept != len(rows):
            planes, kept = planes_of(prints[rows]), len(rows)
        group = groups[rows]
        same = np.zeros(planes.shape[1] * 64, np.uint8)
        same[: len(rows) - move] = group[move:] == group[: len(rows) - move]
        pairs = np.packbits(same, bitorder="little").view("<u8")
        far = _far(planes ^ _moved(planes, move), pairs, radius)
        if (~far).any():
            near = np.flatnonzero(np.unpackbits((~far).view(np.uint8), bitorder="little"))
            firsts.append(rows[near])
            seconds.append(rows[near + move])
        move += 1
        # Only the rows of groups that are longer than the next move; looked at ever more seldom.
        if move < 16 or move % 16 == 0:
            sizes = np.bincount(groups[rows] - groups[0], minlength=1)[groups[rows] - groups[0]]
            rows = rows[sizes > move]
        elif move >= len(rows):
            break
    if not firsts:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(firsts), np.concatenate(seconds)


def stars(rows: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each row, the smallest row that the pairs connect it with, itself included."""
    root = np.arange(rows)

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(first.tolist(), second.tolist(), strict=True):
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    while not np.array_equal(root, root[root]):
        root = root[root]
    return root
