"""Word shingles of texts as weighted sets of hashes, and their consistent samples, as
arrays, for use inside tasks."""

import numpy as np

SHINGLE_WORDS = 5
# Document frequencies are counted per hash bucket, so that their table is bounded; one
# that holds this share of all documents or less counts as rare.
FREQUENCY_BUCKETS = 1 << 18
RARE_SHARE = 0.1
# Texts are worked on together up to so many bytes.
BYTES_AT_ONCE = 1 << 18

SAMPLES = 64
BAND_ROWS = 4
BANDS = SAMPLES // BAND_ROWS
TABLE_BITS = 12
ELEMENTS_AT_ONCE = 4096

_LOWER = b"abcdefghijklmnopqrstuvwxyz0123456789"
# A-Z in lower case; any other ASCII character but digits separates words.
SEPARATED = bytes(
    c if c >= 128 or c in _LOWER else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_PRIME = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def mixed(values):
    """Scrambled 64-bit hashes."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base, count):
    out = np.ones(max(count, 1), np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def word_places(raw):
    """(first places, places after the last byte) of the words between spaces."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = np.frombuffer(raw, np.uint8) != 32
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def word_hashes(raw):
    """(hashes, first places, places after the last byte) of the words between spaces."""
    first, after = word_places(raw)
    sums = np.zeros(len(raw) + 1, np.uint64)
    octets = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    np.cumsum(octets * powers(_PRIME, len(raw))[: len(raw)], out=sums[1:])
    # The word's part of the sum, moved to where a text would begin with it.
    begun = powers(_INVERSE, len(raw) + 1)[first]
    return mixed((sums[after] - sums[first]) * begun), first, after


def shingle_arrays(texts):
    """The shingle hashes of each text, repeats included. A text of fewer words is one
    shingle of all its words; a text without words has none."""
    start = 0
    while start < len(texts):
        end, size, raws = start, 0, []
        while end < len(texts) and (end == start or size < BYTES_AT_ONCE):
            raws.append((texts[end] or "").encode("utf-8", "surrogatepass").translate(SEPARATED))
            size += len(raws[-1]) + 1
            end += 1
        words, first, _ = word_hashes(b" ".join(raws))
        bounds = np.cumsum([0, *(len(r) + 1 for r in raws)])
        cut = np.searchsorted(first, bounds)
        whole = np.zeros(max(len(words) - SHINGLE_WORDS + 1, 0), np.uint64)
        for step in range(SHINGLE_WORDS):
            whole = whole * _PRIME + words[step : step + len(whole)]
        whole = mixed(whole)
        for low, high in zip(cut[:-1], cut[1:]):
            if high - low >= SHINGLE_WORDS:
                yield whole[low : high - SHINGLE_WORDS + 1]
            elif high > low:
                short = np.array([high - low], np.uint64)
                for place in range(low, high):
                    short = short * _PRIME + words[place]
                yield mixed(short)
            else:
                yield whole[:0]
        start = end


def bucket_of(hashes):
    return (hashes >> np.uint64(40)).astype(np.int64) % FREQUENCY_BUCKETS


def weighted(shingles, idf):
    """(sorted distinct hashes, weights): occurrences times the bucket's weight."""
    hashes, uses = np.unique(shingles, return_counts=True)
    return hashes, uses * idf[bucket_of(hashes)]


def similarity(left, right):
    """Weighted Jaccard similarity of two weighted sets."""
    (a, a_weights), (b, b_weights) = left, right
    if not len(a) or not len(b):
        return 0.0
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[place] == a
    common = np.minimum(a_weights[same], b_weights[place[same]]).sum()
    return float(common / (a_weights.sum() + b_weights.sum() - common))


class Sampler:
    """Improved consistent weighted sampling. The random numbers of an element come
    from three tables, each read at other bits of its hash."""

    def __init__(self, seed=7):
        random = np.random.default_rng(seed)
        shape = (1 << TABLE_BITS, SAMPLES)
        self.rate = random.gamma(2.0, 1.0, shape).astype(np.float32)
        self.log_c = np.log(random.gamma(2.0, 1.0, shape)).astype(np.float32)
        self.shift = random.random(shape).astype(np.float32)

    def samples(self, hashes, weights):
        """One hash per sample: the element that is drawn and its level."""
        best = np.full(SAMPLES, np.inf, np.float32)
        drawn = np.zeros(SAMPLES, np.uint64)
        mask = np.uint64((1 << TABLE_BITS) - 1)
        for start in range(0, len(hashes), ELEMENTS_AT_ONCE):
            part = hashes[start : start + ELEMENTS_AT_ONCE]
            rows = [(part >> np.uint64(b)) & mask for b in (0, TABLE_BITS, 2 * TABLE_BITS)]
            rate, log_c, shift = self.rate[rows[0]], self.log_c[rows[1]], self.shift[rows[2]]
            log_weight = np.log(weights[start : start + ELEMENTS_AT_ONCE]).astype(np.float32)
            level = np.floor(log_weight[:, None] / rate + shift)
            value = log_c - rate * (level - shift) - rate
            least = value.argmin(axis=0)
            every = np.arange(SAMPLES)
            better = value[least, every] < best
            best = np.where(better, value[least, every], best)
            steps = level[least, every].astype(np.int64).astype(np.uint64)
            drawn = np.where(better, mixed(part[least] ^ mixed(steps + np.uint64(1))), drawn)
        return drawn

    def bands(self, hashes, weights):
        """One key per band, each of BAND_ROWS samples; none for an empty set."""
        if not len(hashes):
            return []
        rows = self.samples(hashes, weights).reshape(BANDS, BAND_ROWS)
        keys = np.arange(BANDS, dtype=np.uint64)
        for column in rows.T:
            keys = mixed(keys * _PRIME + column)
        return keys.view(np.int64)
