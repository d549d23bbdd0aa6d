"""Rabin-Karp hashes over the words or bytes of a batch of texts, as numpy arrays, and content-chosen cuts.

A polynomial hash modulo 2**64 of any range comes from two prefix sums: (P[b] - P[a]) * R**-a. All functions work on the
concatenation of a batch and need memory in proportion to it.
"""

import numpy as np

R, SEED = 0x9E3779B97F4A7C15, 20240607
R_INVERSE = pow(R, -1, 1 << 64)
TABLE = np.random.default_rng(SEED).integers(0, 1 << 64, 256, dtype=np.uint64)
INDEX_BITS = np.uint64(28)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(which: int, n: int) -> np.ndarray:
    """R**0 ... R**(n-1), or those of the inverse; kept and grown as needed."""
    if len(_powers[which]) < n:
        steps = np.full(max(n, 2 * len(_powers[which])), (R, R_INVERSE)[which], np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each bit of a 64-bit value over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(0, len(values)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unmixed hash of the values a[i] .. b[i]-1."""
    return (sums[b] - sums[a]) * _power(1, len(sums))[a]


def sliding(sums: np.ndarray, width: int) -> np.ndarray:
    """Unmixed hash of each `width` consecutive values."""
    n = max(0, len(sums) - width)
    return (sums[width:] - sums[:n]) * _power(1, n)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


class Units:
    """The units (bytes, or words between ASCII white space) of a batch of texts; `bounds[i]` is where text i begins."""

    def __init__(self, texts: list[bytes], words: bool):
        data = np.frombuffer(b" ".join(texts) + b" " if words else b"".join(texts), dtype=np.uint8)
        sizes = np.array([len(t) + words for t in texts], dtype=np.int64)
        byte_bounds = np.concatenate([[0], np.cumsum(sizes)])
        if words:
            gap = (data == 32) | ((data >= 9) & (data <= 13))
            edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
            starts, ends = edge[::2], edge[1::2]
            self.values = mix(range_hash(prefix_sums(TABLE[data]), starts, ends))
            self.bounds = np.searchsorted(starts, byte_bounds)
        else:
            self.values, self.bounds = TABLE[data], byte_bounds

    def inside(self, width: int) -> np.ndarray:
        """The places where `width` units begin that lie in one text."""
        counts = np.maximum(np.diff(self.bounds) - width + 1, 0)
        total = int(counts.sum())
        return np.repeat(self.bounds[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(total)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right") - 1


def cuts(units: Units, width: int, mark: int, marks: int = 1) -> dict[str, np.ndarray]:
    """Runs of consecutive windows of `width` units that share their marks: the least hashes of `mark` units inside.

    Equal windows have equal marks at equal places, whatever stands around them, so only windows of runs with the same
    `h` can be equal, and no two windows of one run are. A run has at most width - mark + 1 windows, and about half of
    its share with each further mark, of which every one is the least by a hash of its own. Gives for each run text (its
    number in the batch), start (unit within the text), n (windows), h (of the marks) and s, the hash of all its units.
    """
    places = units.inside(width)
    if not len(places):
        return {k: np.zeros(0, np.int64) for k in ("text", "start", "n", "h", "s")}
    sums = prefix_sums(units.values)
    low = np.uint64((1 << int(INDEX_BITS)) - 1)
    breaks = np.diff(places) != 1
    chosen = []
    grams = mix(sliding(sums, mark))
    index = np.arange(len(grams), dtype=np.uint64)
    for k in range(marks):
        keys = ((mix(grams + np.uint64(k)) if k else grams) & ~low) | index
        chosen.append((sliding_min(keys, width - mark + 1)[places] & low).astype(np.int64))
        breaks |= np.diff(chosen[-1]) != 0
    first = np.flatnonzero(np.concatenate([[True], breaks]))
    n = np.diff(np.concatenate([first, [len(places)]]))
    begin = places[first]
    text = units.text_of(begin)
    h = grams[chosen[0][first]]
    for more in chosen[1:]:
        h = mix(h + grams[more[first]])
    return {
        "text": text,
        "start": begin - units.bounds[text],
        "n": n,
        "h": h.view(np.int64),
        "s": mix(range_hash(sums, begin, begin + n + width - 1) + n.astype(np.uint64)).view(np.int64),
    }
