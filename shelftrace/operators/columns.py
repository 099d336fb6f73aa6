"""Column-level checks and projections made at plan time."""

from pyspark.sql import functions as F

from shelftrace import schema
from shelftrace.functions.text import null_tokens_to_null


def clean_header(name):
    return name.strip().replace("%", "").strip()


def normalise_headers(df):
    """Header text stripped, `%` deleted, stripped again."""
    names = [clean_header(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Columns collide after header cleaning: {twice}")
    return df.toDF(*names)


def to_feed_columns(df):
    """Sheet headers, raw or cleaned, to the column names used here; others stay."""
    names = {clean_header(header): column for header, column in schema.HEADERS.items()}
    return normalise_headers(df).withColumnsRenamed(names)


def to_sheet_headers(df):
    """The nine feed columns under their sheet headers, in sheet order."""
    return df.select(*[F.col(c).alias(h) for h, c in schema.HEADERS.items()])


def require_columns(df, required):
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    return df


def project_required(df, required=schema.FEED_COLUMNS):
    return require_columns(df, required).select(*required)


def reject_empty(df, what="input"):
    """Error on zero rows; reads one row at most."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def nullify_tokens(df):
    """Texts that stand for a missing cell become null, over all string columns."""
    texts = [c for c, t in df.dtypes if t == "string"]
    return df.withColumns({c: null_tokens_to_null(c) for c in texts})


def nan_to_null(df):
    """NaN becomes null, over all floating columns."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def collate_key(df, column="sku", collation="UTF8_LCASE_RTRIM"):
    """Compare a key without regard to case and trailing spaces.

    Keys compare byte by byte unless both sides of a merge go through here.
    """
    return df.withColumn(column, F.collate(column, collation))
