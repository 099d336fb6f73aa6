"""Log probability of documents under a subword lattice.

The vocabulary is an existing piece file plus the whole words of the training text. A
word's lattice has one arc for the word itself, with its discounted frequency, and the
arcs of the pieces, reached through the discounted rest of the mass; the forward
recursion in log space sums all segmentations. Piece probabilities are fitted by
expectation maximisation over the distinct training words, so the sum over all texts is
one. Words are looked up in their count table: the most frequent ones (a fixed number)
travel to the tasks, all others meet it in a join.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shelftrace.llm.common import batch_of, frequency_level, highest, words_of
from shelftrace.llm.lattice import WORD_START, Vocabulary, expected_counts, log_likelihoods
from shelftrace.sources.shared import stored

# Most words that travel to the tasks; the rest is joined.
FREQUENT_WORDS = 1 << 17
# Share of each seen word's count that goes to the pieces.
DISCOUNT = 0.75
ROUNDS = 2
# A task's partial counts are passed on beyond so many words.
FLUSH_WORDS = 300_000
WORDS_PER_BATCH = 50_000
PIECE_PRIOR = 0.01


def read_pieces(path):
    """(pieces, ids of the byte pieces) of a piece file; unusable pieces are empty."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = [], [0] * 256
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        if model.is_byte(number):
            byte_ids[int(piece[3:5], 16)] = number
        unusable = model.is_control(number) or model.is_unknown(number) or model.is_byte(number)
        pieces.append("" if unusable or WORD_START in piece[1:] else piece)
    return pieces, byte_ids


def word_counts(docs):
    """(word, trained, all_uses) over all documents; `trained` counts training rows."""
    schema = pa.schema([("word", pa.string()), ("trained", pa.int64()), ("all_uses", pa.int64())])

    def count(batches):
        tables = (Counter(), Counter())  # of other rows, of training rows

        def flush():
            words = list({**tables[0], **tables[1]})
            for start in range(0, len(words), WORDS_PER_BATCH):
                part = words[start : start + WORDS_PER_BATCH]
                learnt = [tables[1][w] for w in part]
                yield batch_of(
                    schema,
                    [
                        [w.decode("utf-8", "replace") for w in part],
                        learnt,
                        [n + tables[0][w] for n, w in zip(learnt, part)],
                    ],
                )
            for table in tables:
                table.clear()

        for batch in batches:
            for value, learn in zip(batch.column("text"), batch.column("training").to_pylist()):
                tables[bool(learn)].update(words_of(value.as_py()))
                if len(tables[0]) + len(tables[1]) > FLUSH_WORDS:
                    yield from flush()
        yield from flush()

    partial = docs.select("text", "training").mapInArrow(
        count, "word string, trained long, all_uses long"
    )
    return partial.groupBy("word").agg(
        F.sum("trained").alias("trained"), F.sum("all_uses").alias("all_uses")
    )


def fit_pieces(words, vocabulary, rounds=ROUNDS):
    """Natural log probability of each piece, from distinct words (column `word`).

    Only one number per piece of the fixed vocabulary comes to the driver.
    """
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(vars(vocabulary))
    scores = np.full(vocabulary.size, -math.log(vocabulary.size))
    for _ in range(rounds):
        current = spark.sparkContext.broadcast(scores)

        def expect(batches):
            own = Vocabulary.of(shared.value)
            total = np.zeros(own.size)
            for batch in batches:
                found = batch.column("word").to_pylist()
                total += expected_counts(found, np.ones(len(found)), own, current.value)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(total[used], pa.float64())],
                names=["piece", "uses"],
            )

        sums = words.select("word").mapInArrow(expect, "piece int, uses double")
        uses = np.full(vocabulary.size, PIECE_PRIOR)
        for piece, found in sums.groupBy("piece").agg(F.sum("uses")).collect():
            uses[piece] += found
        scores = np.log(uses / uses.sum())
    return scores


def with_piece_score(words, vocabulary, scores):
    """The words with `piece_log`: natural log probability over all segmentations."""
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast((vars(vocabulary), scores))

    def score(batches):
        own, current = Vocabulary.of(shared.value[0]), shared.value[1]
        for batch in batches:
            found = log_likelihoods(batch.column("word").to_pylist(), own, current)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())],
                names=[*batch.schema.names, "piece_log"],
            )

    kinds = ", ".join(f"{n} {t}" for n, t in words.dtypes)
    return words.mapInArrow(score, f"{kinds}, piece_log double")


def train(docs, pieces_path):
    """(word table, totals) from the columns text and training. The table has word, known, base_part and score_part, both
    log10 without the common divisors, and all_uses; the totals are in a dict."""
    counts = stored(word_counts(docs), "words")
    seen = counts.where(F.col("trained") > 0)
    sums = seen.agg(F.sum("trained"), F.count(F.lit(1))).first()
    ends = docs.where("training").count()
    tokens, kinds = (sums[0] or 0) + ends, sums[1] + (ends > 0)
    vocabulary = Vocabulary(*read_pieces(pieces_path))
    scores = fit_pieces(seen, vocabulary)
    spare = DISCOUNT * sums[1] + 1.0
    scored = with_piece_score(counts, vocabulary, scores)
    own = F.greatest(F.col("trained") - F.lit(DISCOUNT), F.lit(0.0))
    # Two arcs from start to end, added in log space; exp of the smaller one may be 0.
    through = F.col("piece_log") + F.lit(math.log(spare))
    high = F.greatest(F.when(own > 0, F.log(own)), through)
    low = F.least(F.when(own > 0, F.log(own)), through)
    both = F.when(own > 0, high + F.log1p(F.exp(low - high))).otherwise(through)
    table = scored.select(
        "word",
        (F.col("trained") > 0).cast("long").alias("known"),
        F.log10(F.col("trained") + F.lit(1.0)).alias("base_part"),
        (both / F.lit(math.log(10))).alias("score_part"),
        "all_uses",
    )
    return stored(table, "scored-words"), {
        "tokens": tokens,
        "base_divisor": math.log10(tokens + kinds + 1),
        "base_end": math.log10(ends + 1),
        "score_divisor": math.log10(tokens + 2),
        "score_end": math.log10(ends + 1),
        "ends_known": int(ends > 0),
    }


FIELDS = [
    ("row", pa.int64(), "long"),
    ("word", pa.string(), "string"),
    ("uses", pa.int64(), "long"),
    ("n_tokens", pa.int64(), "long"),
    ("known", pa.int64(), "long"),
    ("base", pa.float64(), "double"),
    ("score", pa.float64(), "double"),
]


def _looked_up(docs, words):
    """Per document its sums over frequent words (word is null), and its other words."""
    frequent = {
        row[0].encode("utf-8", "surrogatepass"): tuple(row[1:])
        for row in highest(words, frequency_level("all_uses"), FREQUENT_WORDS)
        .select("word", "known", "base_part", "score_part")
        .collect()
    }
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([(name, kind) for name, kind, _ in FIELDS])

    def look_up(batches):
        table = shared.value
        for batch in batches:
            numbers = batch.column("row").to_pylist()
            out, of = [[] for _ in FIELDS], []

            def made():
                ids = batch.column("id").take(pa.array(of, pa.int64()))
                arrays = [ids, *batch_of(schema, out).columns]
                return pa.RecordBatch.from_arrays(arrays, names=["id", *schema.names])

            for place, value in enumerate(batch.column("text")):
                tokens = words_of(value.as_py())
                known, base, score, row = 0, 0.0, 0.0, numbers[place]
                for word, uses in Counter(tokens).items():
                    parts = table.get(word)
                    if parts is None:
                        of.append(None)
                        rare = (row, word.decode("utf-8", "replace"), uses, 0, 0, 0.0, 0.0)
                        for column, cell in zip(out, rare):
                            column.append(cell)
                    else:
                        known += uses * parts[0]
                        base += uses * parts[1]
                        score += uses * parts[2]
                of.append(place)
                for column, cell in zip(out, (row, None, 1, len(tokens) + 1, known, base, score)):
                    column.append(cell)
                if len(of) >= WORDS_PER_BATCH:
                    yield made()
                    out, of = [[] for _ in FIELDS], []
            yield made()

    kinds = ", ".join(f"{name} {kind}" for name, _, kind in FIELDS)
    rows = docs.mapInArrow(look_up, f"id {dict(docs.dtypes)['id']}, {kinds}")
    return stored(rows, "looked-up")


def score_documents(docs, pieces_path, training, id="doc_id", text="text"):
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    `training` is a boolean column expression over `docs`; null means not for training.
    A null text is empty: its only token is the end. Repeated rows are scored and
    returned as often as they occur, null ids too; other columns are ignored. Without
    any training row every word is unknown and the pieces alone decide.
    """
    docs = docs.select(
        F.col(id).alias("id"),
        F.col(text).alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
        # One number per row of the scan, stored with the row before it is used.
        F.monotonically_increasing_id().alias("row"),
    )
    words, totals = train(docs, pieces_path)
    looked_up = _looked_up(docs.select("id", "text", "row"), words)
    rare = looked_up.where(F.col("word").isNotNull()).select("row", "word", "uses")
    rare = (
        rare.join(words.drop("all_uses"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("uses") * F.col("known")).alias("rare_known"),
            F.sum(F.col("uses") * F.col("base_part")).alias("rare_base"),
            F.sum(F.col("uses") * F.col("score_part")).alias("rare_score"),
        )
        .withColumnRenamed("row", "rare_row")
    )
    sums = looked_up.where(F.col("word").isNull())
    sums = sums.join(rare, F.col("row") == F.col("rare_row"), "left")

    def total(own, other, end, divisor=None):
        found = F.col(own) + F.coalesce(F.col(other), F.lit(0)) + F.lit(totals[end])
        return found - F.col("n_tokens") * F.lit(totals[divisor]) if divisor else found

    return sums.select(
        F.col("id").alias(id),
        "n_tokens",
        total("known", "rare_known", "ends_known").cast("long").alias("n_known"),
        F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
        total("base", "rare_base", "base_end", "base_divisor").alias("base_score"),
        total("score", "rare_score", "score_end", "score_divisor").alias("score"),
    )
