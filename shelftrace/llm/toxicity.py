"""Toxic passages as maximum-scoring segments of a text.

Each word scores the log-odds of its uses between toxic and clean documents, shrunk by a
Dirichlet prior of the words' overall frequency; words whose log-odds are not significant
share one negative score. A linear scan finds all maximal segments. Scores of chance segments
follow an extreme-value law whose parameters come from clean documents; it turns a
segment's score into the number of such segments expected by chance, and the logarithms
of those of the significant segments add up to a document's evidence. A logistic curve
over the evidence gives the probability of the label.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelftrace.llm.common import batch_of, highest, releasing
from shelftrace.sources.shared import stored

# Labelled documents that are learnt from are at most about so many, chosen by hash.
SAMPLE = 60_000
# A word's prior count: a constant and a share of its own count in both labels. Least
# z-score of a toxic word, and most words of a model.
PRIOR_COUNT = 0.5
PRIOR_SHARE = 0.01
LEAST_Z = 3.0
MOST_WORDS = 1 << 16
# Segments expected less often than this by chance are significant.
LEAST_EVALUE = 0.05
FLUSH_WORDS = 300_000
WORDS_PER_BATCH = 50_000

# A-Z in lower case; any other ASCII character but digits separates words.
_WORD_BYTES = b"abcdefghijklmnopqrstuvwxyz0123456789"
SEPARATED = bytes(
    c if c >= 128 or c in _WORD_BYTES else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def tokens(text):
    return text.encode("utf-8", "surrogatepass").translate(SEPARATED).split() if text else []


def maximal_segments(scores):
    """All maximal scoring segments of a sequence, as (first, last, score), in one scan.

    Segments on the stack keep their score sum before and at their end; a new one is
    merged with the nearest one that began lower, if it ends higher.
    """
    stack, total = [], 0.0
    for place, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        # (first, last, sum before, sum at the end, nearest earlier one that began lower)
        first, low = place, before
        while True:
            at = len(stack) - 1
            while at >= 0 and stack[at][2] >= low:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= total:
                stack.append((first, place, low, total, at))
                break
            first, low = stack[at][0], stack[at][2]
            del stack[at:]
    return [(first, last, end - low) for first, last, low, end, _ in stack]


def segments_of(words, table, rest):
    """Maximal segments of a text as (first word, last word, score). Only words in the
    table can start or end one; a gap between two of them is one step."""
    steps, places, last = [], [], None
    for place, word in enumerate(words):
        score = table.get(word)
        if score is not None:
            if last is not None and place > last + 1:
                steps.append((place - last - 1) * rest)
                places.append(None)
            steps.append(score)
            places.append(place)
            last = place
    return [(places[a], places[b], score) for a, b, score in maximal_segments(steps)]


def significant(words, model):
    """(passages with their expected number, evidence) of a text."""
    found, evidence = [], 0.0
    size = max(len(words), 1)
    for first, last, score in segments_of(words, model["words"], model["rest"]):
        chance = math.log(model["k"] * size) - model["lambda"] * score
        if chance < math.log(LEAST_EVALUE):
            found.append((first, last, score, math.exp(max(chance, -700.0))))
            evidence -= chance
    return found, evidence


def labelled_sample(docs, labels, training, sample, id, text, label):
    """(text, toxic) of about `sample` labelled documents at most, equal texts once: the
    label of most of them, toxic if even. The labels are cut to the sample before they
    meet the texts, so they are few enough to go to all tasks."""
    named = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull()).where(training)
    named = named.groupBy(F.col(id).alias("labelled")).agg(F.max(label).cast("int").alias("toxic"))
    rows = named.count()
    place = F.pmod(F.xxhash64("labelled", F.lit(10)), F.lit(1 << 30))
    upto = min(1 << 30, math.ceil((sample << 30) / max(rows, 1)))
    named = F.broadcast(named.where(place < upto))
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(
        named, F.col("id") == F.col("labelled")
    )
    texts = texts.where(F.col("text").isNotNull())
    alike = texts.groupBy("text").agg(F.avg("toxic").alias("share"))
    return stored(alike.select("text", (F.col("share") >= 0.5).cast("int").alias("toxic")), "labelled")


def word_counts(sample):
    """(word, toxic, clean, toxic_docs, clean_docs): uses of the word in documents of each
    label, and how many of them hold it."""
    names = ["toxic", "clean", "toxic_docs", "clean_docs"]
    schema = pa.schema([("word", pa.binary()), *((n, pa.int64()) for n in names)])

    def count(batches):
        uses, held = (Counter(), Counter()), (Counter(), Counter())

        def flush():
            words = list({**uses[0], **uses[1]})
            for start in range(0, len(words), WORDS_PER_BATCH):
                part = words[start : start + WORDS_PER_BATCH]
                tables = (uses[1], uses[0], held[1], held[0])
                yield batch_of(schema, [part, *([table[w] for w in part] for table in tables)])
            for table in uses + held:
                table.clear()

        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = Counter(tokens(text.as_py()))
                uses[toxic].update(words)
                held[toxic].update(words.keys())
                if len(uses[0]) + len(uses[1]) > FLUSH_WORDS:
                    yield from flush()
        yield from flush()

    kinds = ", ".join(f"{n} long" for n in names)
    partial = sample.mapInArrow(releasing(count), f"word binary, {kinds}")
    return partial.groupBy("word").agg(*[F.sum(n).alias(n) for n in names])


def log_odds(inside, outside, inside_all, outside_all):
    """(log-odds of a word between two bodies of text, its variance), from counts that
    hold their prior."""
    odds = F.log(inside / (F.lit(inside_all) - inside)) - F.log(outside / (F.lit(outside_all) - outside))
    return odds, 1 / inside + 1 / outside


def word_scores(counts):
    """(scores by word, score of the rest, lambda): log-odds of a word's uses with a
    Dirichlet prior of the words' overall frequency, for words that are significantly
    toxic. Significance is by the documents that hold a word, for the uses within one
    document are not independent."""
    counts = stored(counts, "words")
    names = ["toxic", "clean", "toxic_docs", "clean_docs"]
    sums = counts.agg(*[F.sum(n) for n in names], F.count(F.lit(1))).first()
    totals = [float(n or 0) for n in sums[:4]]
    if not totals[0] or not totals[1]:
        return {}, -1.0, 1.0

    def rated(inside, outside, inside_all, outside_all):
        prior = PRIOR_COUNT + PRIOR_SHARE * (F.col(inside) + F.col(outside))
        whole = PRIOR_COUNT * sums[4] + PRIOR_SHARE * (inside_all + outside_all)
        return log_odds(F.col(inside) + prior, F.col(outside) + prior, inside_all + whole, outside_all + whole)

    odds, _ = rated(*names[:2], *totals[:2])
    held_odds, variance = rated(*names[2:], *totals[2:])
    chosen = counts.withColumns({"odds": odds, "z": held_odds / F.sqrt(variance)})
    chosen = chosen.where((F.col("z") >= LEAST_Z) & (F.col("odds") > 0))
    chosen = highest(chosen, F.floor(F.col("z") * 4), MOST_WORDS)
    chosen = chosen.select("word", "odds", "toxic", "clean").collect()
    # The rest: all other words as one, with the same kind of log-odds.
    toxic, clean = totals[:2]
    held = [sum(r[2] for r in chosen), sum(r[3] for r in chosen)]
    odd = [(toxic - held[0] + 0.5) / (toxic + 1), (clean - held[1] + 0.5) / (clean + 1)]
    rest = min(math.log(odd[0] / odd[1]), -1e-3)
    shares = np.array([(clean - held[1]) / clean, *((r[3] + 0.01) / clean for r in chosen)])
    scores = np.array([rest, *(r[1] for r in chosen)])
    return {bytes(r[0]): r[1] for r in chosen}, rest, _karlin_lambda(shares / shares.sum(), scores)


def _karlin_lambda(shares, scores):
    """The positive root of sum(share * exp(lambda * score)) = 1."""
    if not (scores > 0).any():
        return 1.0

    def excess(value):
        return float((shares * np.exp(np.minimum(value * scores, 500.0))).sum()) - 1.0

    low, high = 1e-6, 1e-3
    while excess(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return (low + high) / 2


def _evidence(sample, model):
    """(toxic, evidence, words, largest segment score) of every sample document."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def weigh(batches):
        own = shared.value
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = tokens(text.as_py())
                segments = segments_of(words, own["words"], own["rest"])
                largest = max((s[2] for s in segments), default=0.0)
                rows.append((significant(words, own)[1], len(words), largest))
            columns = [list(c) for c in zip(*rows)] or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array(columns[0], pa.float64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.float64()),
                ],
                names=["toxic", "evidence", "size", "largest"],
            )

    return sample.mapInArrow(releasing(weigh), "toxic int, evidence double, size long, largest double")


def _chance_factor(sizes, largest, rate):
    """K of the extreme-value law: so many chance segments of score x are expected in
    clean documents as there are, at the score that one in a hundred reaches."""
    if not len(sizes):
        return 1.0
    level = max(float(np.quantile(largest, 0.99)), 1e-9)
    reached = (largest >= level).sum()
    return float((reached + 0.5) / (sizes.sum() + 1.0) * math.exp(min(rate * level, 500.0)))


def _logistic(evidence, toxic, turns=50):
    """(intercept, slope) of the label over log(1 + evidence), lightly held back."""
    x = np.stack([np.ones(len(evidence)), np.log1p(evidence)], axis=1)
    weights = np.array([math.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 1.5)), 0.0])
    if not toxic.any() or toxic.all():
        return weights
    weights[1] = 1.0
    ridge = np.diag([1e-3, 1e-1])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - ridge @ weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        weights = weights + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(docs, labels, training, sample=SAMPLE, id="doc_id", text="text", label="toxic"):
    """The model as a dict, learnt from labelled documents where `training` (a column
    over `labels`) holds. The driver gets the model's words and, of the sample, one
    number of evidence per document: both bounded."""
    rows = labelled_sample(docs, labels, training, sample, id, text, label)
    words, rest, rate = word_scores(word_counts(rows))
    model = {"words": words, "rest": rest, "lambda": rate, "k": 1.0}
    # toArrow: some tens of bytes for each of at most about `sample` documents.
    found = _evidence(rows, model).toArrow().to_pandas()
    clean = found[found.toxic == 0]
    model["k"] = _chance_factor(clean["size"].to_numpy(), clean.largest.to_numpy(), rate)
    found = _evidence(rows, model).select("toxic", "evidence").toArrow().to_pandas()
    model["curve"] = _logistic(found.evidence.to_numpy(), found.toxic.to_numpy().astype(float))
    return model


PASSAGE = pa.struct(
    [("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]
)


def detect(docs, model, text="text", score="score", passages="passages"):
    """The rows with a score (0 to 1) and passages: first and last word (from 0), score
    and expected number by chance of every significant segment. Columns of the names of
    the results are replaced.
    """
    docs = docs.drop(score, passages)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)

    def scan(batches):
        own = shared.value
        names = ["first", "last", "score", "expected"]
        for batch in batches:
            found, scores = [], []
            for value in batch.column(text):
                segments, evidence = significant(tokens(value.as_py()), own)
                at = own["curve"][0] + own["curve"][1] * math.log1p(evidence)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, at)))))
                found.append([dict(zip(names, s)) for s in segments])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(found, pa.list_(PASSAGE))],
                names=[*batch.schema.names, score, passages],
            )

    return docs.mapInArrow(
        releasing(scan),
        f"{kinds}, {score} double, "
        f"{passages} array<struct<first int, last int, score double, expected double>>",
    )


def score_documents(docs, labels, training, sample=SAMPLE, id="doc_id", text="text", label="toxic"):
    """(id, score, predicted, passages) of every document. `predicted` is 1 if the score
    is 0.5 or more.

    Nothing but the text decides. A null text counts as empty, has no passage and the
    base rate as score. Labels that are null or belong to no document are ignored; of
    several labels of one id the largest counts. Without labels of both kinds every
    document gets the base rate, under 0.5 if there are no labels. Repeated rows and
    null ids come out as often as they occur; other columns are ignored.
    """
    model = train(docs, labels, training, sample, id, text, label)
    scored = detect(docs.select(id, text), model, text).drop(text)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
