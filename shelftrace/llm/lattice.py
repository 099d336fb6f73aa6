"""Segmentation lattices of words over a fixed piece vocabulary, as arrays.

A word's lattice has a node per character and an arc per vocabulary piece. Words of
like length are worked on together: one row per word, one column per node. A long word is
worked on alone: arcs are found for all its characters at once, a window at a time, and
the recursion goes over arcs instead of columns.
"""

from math import exp, inf, log1p

import numpy as np

WORD_START = "▁"
# Characters times words that are worked on at once.
CHUNK_CELLS = 1 << 19
# Words of more characters are worked on alone, by windows of so many of them.
LONG_WORD = 128
WINDOW = 1 << 16
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by the hash of their characters, with every prefix of a piece.

    `pieces` are strings; `byte_ids` gives the piece that stands for each byte value in
    characters that no piece covers.
    """

    def __init__(self, pieces, byte_ids):
        table = {}
        self.longest = 1
        for number, piece in enumerate(pieces):
            if not piece:
                continue
            code = np.uint64(0)
            self.longest = max(self.longest, len(piece))
            with np.errstate(over="ignore"):
                for end, char in enumerate(piece, 1):
                    code = _step(code, np.uint64(ord(char)))
                    table.setdefault(int(code), -1)
                    if end == len(piece):
                        table[int(code)] = number
        keys = np.array(sorted(table), dtype=np.uint64)
        self.size = len(pieces)
        self.keys = keys
        self.ids = np.array([table[int(k)] for k in keys], dtype=np.int32)
        self.byte_ids = np.asarray(byte_ids, dtype=np.int32)
        # A direct table on the top bits narrows each search to a few entries.
        bits = max(1, int(len(keys)).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(
            keys, np.arange(1 << bits, dtype=np.uint64) << self.shift
        ).astype(np.int64)

    @classmethod
    def of(cls, parts):
        """The vocabulary whose vars() these are: what broadcasts carry."""
        made = cls.__new__(cls)
        vars(made).update(parts)
        return made

    def find(self, codes):
        """(is a prefix of some piece, piece or -1) for each hash."""
        last = len(self.keys) - 1
        at = self.first[codes >> self.shift]
        found = np.zeros(len(codes), bool)
        ids = np.full(len(codes), -1, np.int32)
        open_rows = np.arange(len(codes))
        while len(open_rows):
            place = np.minimum(at[open_rows], last)
            key, code = self.keys[place], codes[open_rows]
            hit = (key == code) & (at[open_rows] <= last)
            found[open_rows[hit]] = True
            ids[open_rows[hit]] = self.ids[place[hit]]
            open_rows = open_rows[(key < code) & (at[open_rows] < last)]
            at[open_rows] += 1
        return found, ids


def _step(code, char):
    code = (code ^ char) * _MULTIPLIER
    return code ^ (code >> np.uint64(29))


def _chunks(words):
    """Row numbers of words of like length, CHUNK_CELLS characters at a time; long words
    are not among them."""
    short = [i for i, word in enumerate(words) if len(word) <= LONG_WORD]
    order = sorted(short, key=lambda i: len(words[i]))
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and (end - start + 1) * (len(words[order[end]]) + 1) <= CHUNK_CELLS:
            end += 1
        yield order[start:end]
        start = end


def _arcs(words, vocabulary):
    """Lattice of the words, each after a word start: (lengths, arcs).

    An arc is (start node, end node, rows, piece ids, byte arcs), the last for
    characters without a piece: a list of ids per row.
    """
    text = [WORD_START + w for w in words]
    lengths = np.array([len(t) for t in text])
    width = int(lengths.max())
    chars = np.zeros((len(text), width), np.uint32)
    for length in np.unique(lengths):
        same = np.flatnonzero(lengths == length)
        joined = "".join([text[i] for i in same]).encode("utf-32-le", "surrogatepass")
        chars[same, :length] = np.frombuffer(joined, np.uint32).reshape(len(same), length)
    arcs = []
    for start in range(width):
        rows = np.flatnonzero(lengths > start)
        codes = np.zeros(len(rows), np.uint64)
        for end in range(start + 1, min(width, start + vocabulary.longest) + 1):
            within = lengths[rows] >= end
            rows, codes = rows[within], codes[within]
            if not len(rows):
                break
            with np.errstate(over="ignore"):
                codes = _step(codes, chars[rows, end - 1].astype(np.uint64))
            prefix, ids = vocabulary.find(codes)
            if end == start + 1 and not (ids >= 0).all():
                bare = rows[ids < 0]
                spelled = [
                    vocabulary.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))]
                    for c in chars[bare, start]
                ]
                arcs.append((start, end, bare, None, spelled))
            whole = ids >= 0
            if whole.any():
                arcs.append((start, end, rows[whole], ids[whole], None))
            rows, codes = rows[prefix], codes[prefix]
            if not len(rows):
                break
    return lengths, arcs


def _weights(arc, scores):
    if arc[4] is None:
        return scores[arc[3]]
    return np.array([scores[ids].sum() for ids in arc[4]])


def log_likelihoods(words, vocabulary, scores):
    """Natural log of each word's probability, over all its segmentations."""
    out = np.empty(len(words))
    for chosen in _chunks(words):
        lengths, arcs = _arcs([words[i] for i in chosen], vocabulary)
        out[chosen] = _forward(lengths, arcs, scores)[np.arange(len(chosen)), lengths]
    for i, word in enumerate(words):
        if len(word) > LONG_WORD:
            out[i] = _long_forward(word, vocabulary, scores)[-1]
    return out


def _long_windows(word, vocabulary, scores, backward=False):
    """The arcs of one word as (start nodes, end nodes, weights, piece ids, byte arcs), by
    windows of start nodes, in the order of the start nodes. A byte arc has piece -1 and
    its place in a list of ids."""
    chars = np.frombuffer((WORD_START + word).encode("utf-32-le", "surrogatepass"), np.uint32)
    windows = range(0, len(chars), WINDOW)
    for begin in reversed(windows) if backward else windows:
        starts = np.arange(begin, min(begin + WINDOW, len(chars)))
        codes = np.zeros(len(starts), np.uint64)
        parts, spelled = [], []
        for size in range(1, vocabulary.longest + 1):
            within = starts + size <= len(chars)
            starts, codes = starts[within], codes[within]
            if not len(starts):
                break
            with np.errstate(over="ignore"):
                codes = _step(codes, chars[starts + size - 1].astype(np.uint64))
            prefix, ids = vocabulary.find(codes)
            if size == 1:
                bare = starts[ids < 0]
                spelled = [
                    vocabulary.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in chars[bare]
                ]
                weights = np.array([scores[own].sum() for own in spelled], float)
                parts.append((bare, bare + 1, weights, np.full(len(bare), -1), np.arange(len(bare))))
            whole = ids >= 0
            found = starts[whole]
            parts.append((found, found + size, scores[ids[whole]], ids[whole], np.full(len(found), -1)))
            starts, codes = starts[prefix], codes[prefix]
        arcs = [np.concatenate(column) for column in zip(*parts)]
        order = np.lexsort((arcs[1], arcs[0]))
        yield [column[order] for column in arcs], spelled


def _joined(here, other):
    """log(exp(here) + exp(other))."""
    if here < other:
        here, other = other, here
    return here if other == -inf else here + log1p(exp(other - here))


def _long_forward(word, vocabulary, scores):
    alpha = [-inf] * (len(word) + len(WORD_START) + 1)
    alpha[0] = 0.0
    for (starts, ends, weights, *_), _ in _long_windows(word, vocabulary, scores):
        for start, end, weight in zip(starts.tolist(), ends.tolist(), weights.tolist()):
            alpha[end] = _joined(alpha[end], alpha[start] + weight)
    return alpha


def _add_long_counts(total, word, times, vocabulary, scores):
    """Adds the expected uses of pieces in one long word."""
    alpha = np.array(_long_forward(word, vocabulary, scores))
    beta = [-inf] * len(alpha)
    beta[-1] = 0.0
    for (starts, ends, weights, ids, places), spelled in _long_windows(word, vocabulary, scores, backward=True):
        ahead = []
        for start, end, weight in zip(starts[::-1].tolist(), ends[::-1].tolist(), weights[::-1].tolist()):
            ahead.append(weight + beta[end])
            beta[start] = _joined(beta[start], ahead[-1])
        share = np.exp(alpha[starts] + np.array(ahead[::-1]) - alpha[-1]) * times
        pieces = ids >= 0
        total += np.bincount(ids[pieces], share[pieces], len(total))
        for place, part in zip(places[~pieces], share[~pieces]):
            np.add.at(total, spelled[place], part)


def _forward(lengths, arcs, scores):
    alpha = np.full((len(lengths), int(lengths.max()) + 1), -np.inf)
    alpha[:, 0] = 0.0
    for arc in arcs:  # by start node, so a node is complete before it is left
        start, end, rows = arc[:3]
        alpha[rows, end] = np.logaddexp(
            alpha[rows, end], alpha[rows, start] + _weights(arc, scores)
        )
    return alpha


def expected_counts(words, counts, vocabulary, scores):
    """Expected uses of each piece over all segmentations of the counted words."""
    total = np.zeros(vocabulary.size)
    counts = np.asarray(counts, float)
    for word, times in zip(words, counts):
        if len(word) > LONG_WORD:
            _add_long_counts(total, word, times, vocabulary, scores)
    for chosen in _chunks(words):
        lengths, arcs = _arcs([words[i] for i in chosen], vocabulary)
        times = counts[chosen]
        alpha = _forward(lengths, arcs, scores)
        beta = np.full(alpha.shape, -np.inf)
        everyone = np.arange(len(chosen))
        beta[everyone, lengths] = 0.0
        whole = alpha[everyone, lengths]
        for arc in reversed(arcs):
            start, end, rows, ids, spelled = arc
            ahead = _weights(arc, scores) + beta[rows, end]
            beta[rows, start] = np.logaddexp(beta[rows, start], ahead)
            share = np.exp(alpha[rows, start] + ahead - whole[rows]) * times[rows]
            if ids is not None:
                total += np.bincount(ids, share, vocabulary.size)
            else:
                for part, row_ids in zip(share, spelled):
                    np.add.at(total, row_ids, part)
    return total
