"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams within words, weighted by log frequency
and inverse document frequency and of length one. Document frequencies come from every
training document; the centroids come from clustering a bounded sample of each language
(SAMPLE documents are expected, chosen by hash). A text takes the language of the
centroid with the largest cosine, and is rejected if it is further from it than all but
few of the language's own texts of its length.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelftrace.llm.common import releasing

DIMENSIONS = 1 << 12
SAMPLE = 1000
CLUSTERS = 4
TURNS = 12
# A cluster holds this share of its language's sample at least.
LEAST_SIZE = 0.02
# The share of a language's texts that may lie under its cut, and the share of that cosine
# that is the cut, as texts that were not learnt from are less similar.
UNDER, SLACK = 0.005, 0.9
# Passages for a cut, as many at least, several of each text if there are fewer texts.
PASSAGES = 1000
# Least letters of the classes of length that have cuts of their own; shorter texts are of
# the first.
LENGTHS = (2, 8, 16, 32, 64, 128, 256, 512)
SEED = 5
UNKNOWN = "und"
ROWS_AT_ONCE = 256
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def letter_table():
    """Is a code point a letter, for all that Unicode has."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(texts, letters):
    """One row of hashed n-gram counts (1 to 3 letters) per text; a row of zeros for a
    text without letters. Spaces beside a word belong to its n-grams."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    shift = np.uint32(32 - int(math.log2(DIMENSIONS)))
    for row, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letters[codes]
        if not letter.any():
            continue
        codes = np.where(letter, codes, np.uint32(32))
        one = codes * _MIX[0]
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _MIX[1] + codes[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * _MIX[2] + codes[2:]
        grams = np.concatenate(
            [
                one[letter],
                two[letter[:-1] | letter[1:]] * _MIX[0],
                three[letter[1:-1]] * _MIX[1],
            ]
        )
        out[row] = np.bincount(grams >> shift, minlength=DIMENSIONS)
    return out


def unit_vectors(counts, idf):
    """By blocks of rows, so that what lies between takes little memory."""
    out = np.empty(counts.shape, np.result_type(counts, idf))
    for start in range(0, len(counts), ROWS_AT_ONCE):
        vectors = np.log1p(counts[start : start + ROWS_AT_ONCE]) * idf
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        np.divide(vectors, norms, out=vectors, where=norms > 0)
        out[start : start + ROWS_AT_ONCE] = vectors
    return out


def best_cosines(counts, idf, centres):
    """The cosine of each row with its nearest centroid."""
    found = [np.empty(0, np.float32)]
    for start in range(0, len(counts), ROWS_AT_ONCE):
        found.append((unit_vectors(counts[start : start + ROWS_AT_ONCE], idf) @ centres.T).max(axis=1))
    return np.concatenate(found)


def text_blocks(batch, name):
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(start, ROWS_AT_ONCE)
        yield part, part.column(name).to_pylist()


def document_frequencies(docs):
    """(frequency per dimension, documents) over the texts that have letters. Each task
    adds up its own and passes on one row per dimension."""

    def count(batches):
        letters, total, rows = letter_table(), np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for _, texts in text_blocks(batch, "text"):
                found = gram_counts(texts, letters) > 0
                total += found.sum(axis=0)
                rows += int(found.any(axis=1).sum())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used, -1], pa.int32()), pa.array([*total[used], rows], pa.int64())],
            names=["dimension", "documents"],
        )

    partial = docs.select("text").mapInArrow(releasing(count), "dimension int, documents long")
    frequency, rows = np.zeros(DIMENSIONS), 0
    for dimension, found in partial.groupBy("dimension").agg(F.sum("documents")).collect():
        if dimension < 0:
            rows = found
        else:
            frequency[dimension] = found
    return frequency, rows


def cluster(vectors, clusters=CLUSTERS, turns=TURNS, seed=SEED):
    """Spherical k-means from k-means++ documents; unit centroids. A cluster below the least
    size starts anew from a document of the largest, and is left out if it stays so."""
    chance = np.random.default_rng(seed)
    least = max(1, int(LEAST_SIZE * len(vectors)))
    centres = [vectors[chance.integers(len(vectors))]]
    away = 1 - vectors @ centres[0]
    for _ in range(1, min(clusters, len(vectors))):
        weights = away.clip(0).astype(float)
        weights = weights / weights.sum() if weights.sum() > 0 else None
        centres.append(vectors[chance.choice(len(vectors), p=weights)])
        away = np.minimum(away, 1 - vectors @ centres[-1])
    centres = np.array(centres)
    for turn in range(turns):
        own = (vectors @ centres.T).argmax(axis=1)
        sizes = np.bincount(own, minlength=len(centres))
        largest = np.flatnonzero(own == sizes.argmax())
        for number, size in enumerate(sizes):
            if size >= least:
                mean = vectors[own == number].mean(axis=0)
                centres[number] = mean / np.linalg.norm(mean)
            elif turn < turns // 2:
                centres[number] = vectors[chance.choice(largest)]
    sizes = np.bincount((vectors @ centres.T).argmax(axis=1), minlength=len(centres))
    return centres[sizes >= min(least, sizes.max())]


def length_class(counts):
    """Number of the class in LENGTHS of each row of n-gram counts, three to a letter."""
    return np.searchsorted(LENGTHS, counts.sum(axis=1) / 3, "right").clip(1) - 1


def passage(text, wanted, letters, chance):
    """`wanted` letters of a text from the start of a word, None if it has too few."""
    letter = letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    upto = np.cumsum(letter)
    starts = np.flatnonzero(letter & ~np.concatenate([[False], letter[:-1]]))
    starts = starts[upto[starts] + wanted - 1 <= upto[-1]] if len(letter) else starts
    if not len(starts):
        return None
    start = chance.choice(starts)
    return text[start : np.searchsorted(upto, upto[start] + wanted - 1) + 1]


def least_cosines(texts, counts, idf, centres, letters):
    """The cut of each class of length: all but few of the texts of that length and of
    as long passages of longer ones are more similar to their centroid. That of a longer
    class is not less, whatever few texts it has."""
    chance = np.random.default_rng(SEED)
    own, classes = best_cosines(counts, idf, centres), length_class(counts)
    cuts, times = [], -(-PASSAGES // len(texts))
    for number, wanted in enumerate(LENGTHS):
        parts = [passage(t, wanted, letters, chance) for t in texts for _ in range(times)]
        parts = [p for p in parts if p]
        cosines = [own[classes == number]]
        for start in range(0, len(parts), ROWS_AT_ONCE):
            some = gram_counts(parts[start : start + ROWS_AT_ONCE], letters)
            cosines.append(best_cosines(some, idf, centres))
        cosines = np.concatenate(cosines)
        least = np.quantile(cosines, UNDER, method="lower") if len(cosines) else 0.0
        cuts.append(max(SLACK * float(least), *cuts[-1:], 0.0))
    return cuts


def sampled(docs, sample):
    """(lang, text) of about `sample` of the rows (lang, text, place) of each language, by
    place. Rows of one id and text count once, for they share a place."""
    share = F.least(F.lit(float(1 << 20)), F.lit(float(sample << 20)) / F.count(F.lit(1)))
    shares = docs.groupBy(F.col("lang").alias("of")).agg(F.ceil(share).alias("upto"))
    # A number per language: the model, which goes to all tasks as well, is far larger.
    chosen = docs.join(
        F.broadcast(shares), (F.col("lang") == F.col("of")) & (F.col("place") < F.col("upto"))
    )
    return chosen.select("lang", "text", "place").distinct().select("lang", "text")


def train(docs, training, sample=SAMPLE, text="text", lang="lang", id="doc_id"):
    """The model as a dict of arrays: languages, centroids, of (language number of each
    centroid), cut (least similarity of each language by class of length) and idf.

    Learns from rows where `training` holds, `lang` is not null and the text has a
    letter. About `sample` documents of each language, chosen by a hash of id and text,
    are clustered, one language to a task; all others count towards the frequencies.
    """
    docs = docs.where(training & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
        F.pmod(F.xxhash64(F.col(id), F.col(text), F.lit(5)), F.lit(1 << 20)).alias("place"),
    )
    frequency, rows = document_frequencies(docs)
    idf = (np.log((rows + 1) / (frequency + 1)) + 1).astype(np.float32)
    chosen = sampled(docs, sample)
    shared = docs.sparkSession.sparkContext.broadcast(idf)

    def centroids(key, table):
        # In order, so that every run starts its clusters from the same texts.
        texts, letters = sorted(table.column("text").to_pylist()), letter_table()
        counts = gram_counts(texts, letters)
        known = counts.any(axis=1)
        texts, counts = [t for t, k in zip(texts, known) if k], counts[known]
        if not len(counts):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary()), "cut": pa.array([], pa.list_(pa.float64()))})
        centres = cluster(unit_vectors(counts, shared.value))
        cut = least_cosines(texts, counts, shared.value, centres, letters)
        return pa.table(
            {
                "lang": [key[0].as_py()] * len(centres),
                "centroid": [c.astype(np.float32).tobytes() for c in centres],
                "cut": [cut] * len(centres),
            }
        )

    made = (
        chosen.groupBy("lang")
        .applyInArrow(centroids, "lang string, centroid binary, cut array<double>")
        .collect()
    )
    made.sort(key=lambda r: (r[0], r[1]))
    languages = sorted({r[0] for r in made})
    cuts = {r[0]: r[2] for r in made}
    return {
        "languages": languages,
        "centroids": np.array([np.frombuffer(r[1], np.float32) for r in made]).reshape(-1, DIMENSIONS),
        "of": np.array([languages.index(r[0]) for r in made], int),
        "cut": np.array([cuts[name] for name in languages]).reshape(-1, len(LENGTHS)),
        "idf": idf,
    }


def classify(docs, model, text="text", lang_pred="lang_pred", score="score", rejected="rejected"):
    """The rows with the nearest language, its cosine (0 to 1) and whether the text is
    too far from that language for its length.

    A null text, one without letters, or any text if no language was learnt gives `und`
    with score 0 and is rejected. Of equally near languages the first by name wins.
    Columns of the names of the results are replaced.
    """
    docs = docs.drop(lang_pred, score, rejected)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)

    def nearest(batches):
        own, letters = shared.value, letter_table()
        names = np.array([*own["languages"], UNKNOWN], object)
        for batch in batches:
            for part, texts in text_blocks(batch, text):
                counts = gram_counts(texts, letters)
                known = counts.any(axis=1) & bool(len(own["of"]))
                which, best = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
                away = np.ones(len(texts), bool)
                if known.any():
                    near = unit_vectors(counts[known], own["idf"]) @ own["centroids"].T
                    place = near.argmax(axis=1)
                    which[known] = own["of"][place]
                    best[known] = near[np.arange(len(place)), place].clip(0, 1)
                    away[known] = best[known] < own["cut"][which[known], length_class(counts[known])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names[which], pa.string()), pa.array(best), pa.array(away)],
                    names=[*part.schema.names, lang_pred, score, rejected],
                )

    return docs.mapInArrow(
        releasing(nearest), f"{kinds}, {lang_pred} string, {score} double, {rejected} boolean"
    )


def identify(docs, training, sample=SAMPLE, id="doc_id", text="text", lang="lang"):
    """(id, lang_pred, score, rejected) of every document, learnt from those where
    `training` holds. Nothing but the text decides. Repeated rows and null ids come out
    as often as they occur; other columns are ignored."""
    model = train(docs, training, sample, text, lang, id)
    return classify(docs.select(id, text), model, text).drop(text)
