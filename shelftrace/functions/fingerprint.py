"""Row fingerprint for change detection."""

from pyspark.sql import functions as F

from shelftrace import schema


def row_hash(columns=schema.TRACKED, unambiguous=False, charset=None):
    """SHA-256 of the tracked columns as text, joined by '|', null as ''.

    The key is not part of it. With `unambiguous`, null differs from '' and a '|'
    inside a text cannot imitate a border, at the price of other hash values.
    `charset` (for example 'UTF-16LE') hashes that encoding instead of UTF-8.
    """
    if unambiguous:
        text = F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))
    else:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        text = F.concat_ws("|", *cells)
    return F.sha2(F.encode(text, charset) if charset else text, 256)
