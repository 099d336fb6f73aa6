"""BPE encoding through a table of distinct words, and decoding through the pieces.

Texts are split at ASCII white space, which no token of the tokenizer crosses. Each
distinct word is encoded once. A document becomes a list of word numbers: frequent words
(a fixed number at most) are known to all tasks, every other word is brought together
from all its places, encoded, and its ids are joined back by document and position.
"""

import os
import zlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from shelftrace.llm.common import batch_of, frequency_level, highest, releasing
from shelftrace.llm.shingles import BYTES_AT_ONCE, mixed, word_hashes
from shelftrace.sources.shared import stored

# Most words whose numbers all tasks know; a number is three bytes at most.
FREQUENT_WORDS = (1 << 21) - 2
FLUSH_WORDS = 400_000
# Of words that a part of the documents holds once, one in so many is counted.
SPREAD = 64
WORDS_PER_BATCH = 50_000
WORDS_AT_ONCE = 2048
ROWS_AT_ONCE = 256


def load_tokenizer(path):
    """The tokenizer without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@contextmanager
def task_encoder(path):
    """(function from a list of words to their encodings, type of an id) for one task. The
    words are encoded in a thread of the task's own: the library keeps thousands of words
    per thread for every tokenizer it has had, and lets go of them only when the thread
    ends, so that a worker would grow with its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = load_tokenizer(path)
    with ThreadPoolExecutor(1) as own:

        def encode(words):
            return own.submit(tokenizer.encode_batch_fast, words, add_special_tokens=False).result()

        yield encode, id_width(tokenizer)


# A-Z in lower case and ASCII white space as spaces.
SPACED = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def spaced(text):
    """The text as bytes with its words between spaces. The tokenizer lowers case itself;
    lowering A-Z first makes fewer distinct words, but must not turn text into a special
    token."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    if b"<|" not in raw:
        return raw.translate(SPACED)
    return b" ".join(w if b"<|" in w else w.lower() for w in raw.split())


def split_words(text):
    return spaced(text).split()


def common_words(docs, part_words=FLUSH_WORDS):
    """(word, uses) of words that some part of the documents holds more than once, or that
    many parts hold. Leaving out the others halves what is shuffled. Of words that a part
    holds once, one in SPREAD is drawn, by word and part, and stands for as many: a word
    that is drawn twice at least is spread out. The uses are only estimates of how
    frequent a word is; no result depends on them."""
    schema = pa.schema([("word", pa.string()), ("uses", pa.int64()), ("drawn", pa.int64())])

    def count(batches):
        found = Counter()
        seed = zlib.crc32(str(TaskContext.get().partitionId()).encode())

        def flush():
            words = [
                w for w, uses in found.items() if uses > 1 or zlib.crc32(w, seed) % SPREAD == 0
            ]
            for start in range(0, len(words), WORDS_PER_BATCH):
                part = words[start : start + WORDS_PER_BATCH]
                drawn = [int(found[w] == 1) for w in part]
                uses = [SPREAD if d else found[w] for w, d in zip(part, drawn)]
                yield batch_of(schema, [[w.decode() for w in part], uses, drawn])
            found.clear()

        for batch in batches:
            for value in batch.column("text"):
                found.update(split_words(value.as_py()))
                if len(found) > part_words:
                    yield from flush()
                    seed = zlib.crc32(b"next", seed)
        yield from flush()

    partial = docs.select("text").mapInArrow(
        releasing(count), "word string, uses long, drawn long"
    )
    whole = partial.groupBy("word").agg(F.sum("uses").alias("uses"), F.sum("drawn").alias("drawn"))
    # A word seen by one draw alone may be held by a single part.
    lone = (F.col("drawn") == 1) & (F.col("uses") == SPREAD)
    return whole.where(~lone).select("word", "uses")


def encode_words(words, path):
    """(word, uses, ids) of distinct words, each encoded once; ids are two bytes each, or
    four if the vocabulary asks for it."""

    def encode(batches):
        with task_encoder(path) as (encoded, width):
            for batch in batches:
                for start in range(0, batch.num_rows, WORDS_AT_ONCE):
                    part = batch.slice(start, WORDS_AT_ONCE)
                    made = encoded(part.column("word").to_pylist())
                    ids = [np.array(m.ids, width).tobytes() for m in made]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(ids, pa.binary())], names=["word", "uses", "ids"]
                    )

    return words.select("word", "uses").mapInArrow(releasing(encode), "word string, uses long, ids binary")


def encode_places(rare, path):
    """(key, position, ids) of words by their places. All places of a word come together
    in one partition, in a row, so each word is encoded once and its ids go back to all
    its places. A word here is rarer than every frequent one, also one that many parts of
    the documents hold once each."""

    def encode(batches):
        last = ids = None
        with task_encoder(path) as (encoded, width):
            for batch in batches:
                for start in range(0, batch.num_rows, WORDS_AT_ONCE):
                    part = batch.slice(start, WORDS_AT_ONCE)
                    words = part.column("word").to_pylist()
                    fresh = [w for before, w in zip([last, *words], words) if w != before]
                    made = iter(encoded(fresh))
                    placed = []
                    for word in words:
                        if word != last:
                            last, ids = word, np.array(next(made).ids, width).tobytes()
                        placed.append(ids)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in [*KEY, "position"]), pa.array(placed, pa.binary())],
                        names=[*KEY, "position", "ids"],
                    )

    together = rare.repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(
        releasing(encode), "id_key string, text_key long, position int, ids binary"
    )


def id_width(tokenizer):
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def _keyed(docs):
    """Documents by a key that only repeated rows share: the id and a hash of the text, a
    short one where there is an id."""
    whole = F.xxhash64("text")
    return docs.withColumn(
        "text_key", F.when(F.col("id").isNull(), whole).otherwise(F.hash("text").cast("long"))
    ).withColumn("id_key", F.coalesce(F.col("id").cast("string"), F.lit("")))


KEY = ["id_key", "text_key"]
KEY_FIELDS = [("id_key", pa.string()), ("text_key", pa.int64())]


class WordIndex:
    """Numbers of distinct words, by two hashes of 64 bits: the first finds the word, the
    second confirms it. What is broadcast is vars() of it, some 24 bytes a word."""

    def __init__(self, parts):
        """From lists of words, which are hashed one list at a time."""
        made = [hashed_words(b" ".join(words))[:2] for words in parts]
        hashes = np.concatenate([m[0] for m in made] or [np.empty(0, np.uint64)])
        checks = np.concatenate([m[1] for m in made] or [np.empty(0, np.uint64)])
        order = np.argsort(hashes)
        self.numbers = order.astype(np.int32)
        self.hashes, self.checks = hashes[order], checks[order]
        # A table over the first bits narrows each search to a few entries.
        bits = max(1, len(hashes).bit_length())
        self.shift = np.uint64(64 - bits)
        starts = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.searchsorted(self.hashes, starts).astype(np.int32)

    @classmethod
    def of(cls, parts):
        made = cls.__new__(cls)
        vars(made).update(parts)
        return made

    def find(self, hashes, checks):
        """The number of each word; the count of words for all that are not in here."""
        size = len(self.hashes)
        out = np.full(len(hashes), size, np.int64)
        if not size or not len(hashes):
            return out
        at = self.first[hashes >> self.shift].astype(np.int64)
        rows = np.arange(len(hashes))
        while len(rows):
            place = at[rows]
            rows, place = rows[place < size], place[place < size]
            same = self.hashes[place] == hashes[rows]
            hit = same & (self.checks[place] == checks[rows])
            out[rows[hit]] = self.numbers[place[hit]]
            onward = ~hit & (self.hashes[place] <= hashes[rows])
            rows = rows[onward]
            at[rows] += 1
        return out


def hashed_words(raw):
    """(hashes, second hashes, first places, places after) of the words between spaces."""
    hashes, first, after = word_hashes(raw)
    # The second hash mixes in the sum of squares of the word's bytes.
    squares = np.arange(1, 257, dtype=np.uint64) ** np.uint64(2)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(squares[np.frombuffer(raw, np.uint8)], out=sums[1:])
    return hashes, mixed(hashes * np.uint64(3) + sums[after] - sums[first]), first, after


def number_words(texts, index):
    """For every text (it as bytes, first places of its words, places after, numbers)."""
    start = 0
    while start < len(texts):
        end, size, raws = start, 0, []
        while end < len(texts) and (end == start or size < BYTES_AT_ONCE):
            raws.append(spaced(texts[end]))
            size += len(raws[-1]) + 1
            end += 1
        hashes, checks, first, after = hashed_words(b" ".join(raws))
        numbers = index.find(hashes, checks)
        bounds = np.cumsum([0, *(len(r) + 1 for r in raws)])
        cut = np.searchsorted(first, bounds)
        for own, low, high, begin in zip(raws, cut[:-1], cut[1:], bounds):
            yield own, first[low:high] - begin, after[low:high] - begin, numbers[low:high]
        start = end


def _parts(batch):
    """A batch in slices, so that a task holds few texts in more than one form."""
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(start, ROWS_AT_ONCE)


def _rare_words(docs, index_sent):
    """(key, position, word) for words that are not frequent."""
    schema = pa.schema([*KEY_FIELDS, ("position", pa.int32()), ("word", pa.string())])

    def find(batches):
        index = WordIndex.of(index_sent.value)
        gap = len(index.hashes)
        for batch in batches:
            out = [[] for _ in schema]
            for part in _parts(batch):
                keys = zip(*(part.column(k).to_pylist() for k in KEY))
                texts = part.column("text").to_pylist()
                for key, (raw, first, after, numbers) in zip(keys, number_words(texts, index)):
                    for position in np.flatnonzero(numbers == gap).tolist():
                        word = raw[first[position] : after[position]].decode()
                        for column, cell in zip(out, (*key, position, word)):
                            column.append(cell)
                    if len(out[0]) >= WORDS_PER_BATCH:
                        yield batch_of(schema, out)
                        out = [[] for _ in schema]
            yield batch_of(schema, out)

    return docs.select(*KEY, "text").mapInArrow(
        releasing(find), "id_key string, text_key long, position int, word string"
    )


def _numbered(docs, index_sent):
    """Documents as packed word numbers; the count of frequent words marks a gap."""
    kinds = dict(docs.dtypes)

    def pack(batches):
        index = WordIndex.of(index_sent.value)
        for batch in batches:
            for part in _parts(batch):
                packed = [
                    zlib.compress(_varints(numbers.astype(np.uint32)), 1)
                    for *_, numbers in number_words(part.column("text").to_pylist(), index)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *(part.column(k) for k in KEY), pa.array(packed, pa.binary())],
                    names=["id", *KEY, "packed"],
                )

    return docs.select("id", *KEY, "text").mapInArrow(
        releasing(pack), f"id {kinds['id']}, id_key string, text_key long, packed binary"
    )


def _varints(numbers):
    """Seven bits a byte, low bits first, the high bit on all bytes but the last."""
    out = np.empty((len(numbers), 3), np.uint8)
    out[:, 0] = (numbers & 127) | ((numbers > 127) << 7)
    out[:, 1] = ((numbers >> 7) & 127) | ((numbers > 16383) << 7)
    out[:, 2] = numbers >> 14
    used = np.stack([np.ones(len(numbers), bool), numbers > 127, numbers > 16383], axis=1)
    return out[used].tobytes()


def _from_varints(data):
    octets = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(octets < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    numbers = (octets[first] & 127).astype(np.int64)
    for step in (1, 2):
        more = last - first >= step
        numbers[more] |= (octets[first[more] + step] & 127).astype(np.int64) << (7 * step)
    return numbers


def packed_lists(column, width):
    """(flat ids, first places, sizes) of a column of packed ids."""
    octets = np.dtype(width).itemsize
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // octets
    _, offsets, data = column.cast(pa.binary()).buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    used = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if len(column) and data else b""
    flat = np.frombuffer(bytes(used), width)
    return flat, (np.cumsum(sizes) - sizes).astype(np.int32), sizes.astype(np.int32)


def _filled(rows, ids_sent, width, pieces_sent=None):
    """Ids of each document: those of its word numbers, joined ids in the gaps; with
    pieces also the decoded text."""
    kinds = dict(rows.dtypes)
    decoded = ", decoded string" if pieces_sent else ""

    def fill(batches):
        common, starts, sizes = ids_sent.value
        gap = len(sizes)
        # A gap counts as an empty word here and is widened below.
        starts, sizes = np.append(starts, 0), np.append(sizes, 0)
        for batch in batches:
            for part in _parts(batch):
                rare = part.column("rare")
                found = pc.list_flatten(rare)
                positions = found.field("position").to_numpy(zero_copy_only=False)
                extra, extra_starts, extra_sizes = packed_lists(found.field("ids"), width)
                source = np.concatenate([common, extra])
                counts = pc.fill_null(pc.list_value_length(rare), 0).to_numpy(zero_copy_only=False)
                upto = np.cumsum(counts)
                made = []
                for data, low, high in zip(part.column("packed").to_pylist(), upto - counts, upto):
                    numbers = _from_varints(zlib.decompress(data))
                    lengths, begins = sizes[numbers], starts[numbers]
                    if high > low:
                        own = low + np.argsort(positions[low:high], kind="stable")
                        gaps = np.flatnonzero(numbers == gap)
                        lengths[gaps] = extra_sizes[own]
                        begins[gaps] = len(common) + extra_starts[own]
                    total = np.cumsum(lengths)
                    shift = np.repeat(begins - (total - lengths), lengths)
                    made.append(source[np.arange(len(shift)) + shift].astype(np.int32))
                offsets = np.cumsum([0, *map(len, made)]).astype(np.int32)
                arrays = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made)))
                columns, names = [part.column("id"), arrays], ["id", "ids"]
                if pieces_sent:
                    columns.append(_texts_of(arrays, pieces_sent.value))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select("id", "packed", "rare").mapInArrow(
        releasing(fill), f"id {kinds['id']}, ids array<int>{decoded}"
    )


def encode_documents(
    docs, path, id="doc_id", text="text", frequent_words=FREQUENT_WORDS, decode=False
):
    """(id, ids) of every document, as the tokenizer at `path` encodes its whole text
    without adding special tokens; with `decode` also `decoded`, as decode_documents has
    it, in the same pass. A null text is empty and has no ids. Repeated rows
    come out as often as they occur, null ids too; other columns are ignored. The file
    must lie at the same path on all executors, and its tokens must not depend on more
    than the word between white space, as with pre-tokenizers that drop white space.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    width = id_width(load_tokenizer(path))
    counted = stored(common_words(docs), "common-words")
    known = encode_words(highest(counted, frequency_level("uses"), frequent_words), path)
    # The most frequent first: their numbers take the fewest bytes.
    known = known.toArrow().sort_by([("uses", "descending"), ("word", "ascending")])
    parts = (b.column("word").cast(pa.binary()).to_pylist() for b in known.to_batches(WORDS_PER_BATCH))
    # Apart, for no worker needs both.
    index_sent = spark.sparkContext.broadcast(vars(WordIndex(parts)))
    ids_sent = spark.sparkContext.broadcast(packed_lists(known.column("ids").combine_chunks(), width))
    del known
    keyed = _keyed(docs)
    placed = encode_places(_rare_words(keyed, index_sent), path)
    placed = placed.groupBy(*KEY).agg(F.collect_set(F.struct("position", "ids")).alias("rare"))
    rows = _numbered(keyed, index_sent).join(placed, KEY, "left")
    pieces_sent = spark.sparkContext.broadcast(pieces_of(path)) if decode else None
    return _filled(rows, ids_sent, width, pieces_sent).withColumnRenamed("id", id)


def pieces_of(path):
    """Piece strings by id: the whole vocabulary, whose size is fixed."""
    tokenizer = load_tokenizer(path)
    pieces = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return pa.array(pieces, pa.string())


def _texts_of(lists, pieces):
    """The join of ids and pieces, in place: the piece of each id, those of a list with a
    space between."""
    found = pieces.take(pc.list_flatten(lists))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), found), " ")
    return pc.if_else(pc.is_valid(lists), texts, pa.scalar(None, pa.string()))


def decode_documents(encoded, path, ids="ids"):
    """The rows with `decoded`: pieces joined to their ids, special tokens kept, with a
    space between pieces, as a tokenizer without a decoder does. Null ids give null. A
    column of that name is replaced."""
    encoded = encoded.drop("decoded")
    pieces = encoded.sparkSession.sparkContext.broadcast(pieces_of(path))
    kinds = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)

    def decode(batches):
        for batch in batches:
            for part in _parts(batch):
                texts = _texts_of(part.column(ids), pieces.value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, texts], names=[*part.schema.names, "decoded"]
                )

    return encoded.mapInArrow(releasing(decode), f"{kinds}, decoded string")
