"""Helpers that several operators share."""

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import functions as F

# Words and white space as the queries define them: bytes.split() splits at exactly
# these characters and bytes.lower() lowers exactly A-Z.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column, modulus):
    """crc32 of the value as text, modulo `modulus`; a null counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(modulus))


def free_names(df, *names):
    """The names, each with underscores before it until no column of `df` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words_of(text):
    """Lower-cased words of a text as bytes; a null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def batch_of(schema, columns):
    """A record batch from lists, by the Arrow schema."""
    arrays = [pa.array(v, f.type) for v, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def releasing(work):
    """A function over Arrow batches that at its end gives free memory back to the system:
    Python workers live on between stages, beside those of the next ones."""

    def run(batches):
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


def highest(rows, level, most):
    """The rows with the highest values of `level`, a whole number of few distinct
    values: `most` at most, and all rows of a level or none. Counts per level decide, so
    no task passes on rows that do not belong to the result."""
    counts = rows.groupBy(level.cast("long").alias("level")).agg(F.count(F.lit(1))).collect()
    held, least = 0, None
    for value, count in sorted(((v, c) for v, c in counts if v is not None), reverse=True):
        held += count
        if held > most:
            break
        least = value
    return rows.where(F.lit(False) if least is None else level.cast("long") >= least)


def frequency_level(column):
    """Sixteen levels for each doubling of a count."""
    return F.floor(F.log2(F.col(column)) * 16)
