"""A training corpus from `documents`, in stages that each call one operator.

Toxic documents go, then those of no known language, then all but one of each group of
near-duplicates; what is left is mixed to the sources' target weights and encoded.

Every stage takes rows with any column null, repeated rows and an empty table, which gives
an empty result. Columns beside doc_id, text, lang and source are carried along.
"""

from pyspark.sql import functions as F

from shelftrace.llm import bpe, langid, mixing, near_dedup, toxicity
from shelftrace.llm.common import free_names, remainder, table
from shelftrace.llm.queries import WORD_BPE_FILE
from shelftrace.sources.shared import stored


def without_toxicity(spark, docs, sf_dir):
    """Documents without toxic passages: those that the label is not likely for. Rows are
    judged by their text alone: a null or empty one is clean, repeated rows go or stay
    together, and ids play no part."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, remainder("doc_id", 5) != 0)
    score, passages = free_names(docs, "score", "passages")
    scored = toxicity.detect(docs, model, score=score, passages=passages)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def known_language(spark, docs, sf_dir):
    """Documents near enough to a language that is learnt from the documents. Rows are
    judged by their text alone; one without letters, null included, is in no language
    and goes."""
    model = langid.train(docs, remainder("doc_id", 4) != 2)
    lang, score, rejected = free_names(docs, "lang_pred", "score", "rejected")
    found = langid.classify(docs, model, lang_pred=lang, score=score, rejected=rejected)
    return found.where(~F.col(rejected)).select(*docs.columns)


def one_of_each(spark, docs, sf_dir):
    """One document of each class of near-duplicates, the one with the least id; one
    without an id only where no other is, and of rows with that id and the same text the
    one whose columns hash lowest. Null and empty texts are copies of one another."""
    return near_dedup.deduplicate(docs)


def mixed(spark, docs, sf_dir):
    """The mix: every document as often as it is taken, 0 to 3 times. Rows without a source
    are a source of their own; a null text has no words."""
    return mixing.mixed_documents(docs)


def encoded(spark, docs, sf_dir):
    """(doc_id, n_tokens, ids, decoded_sha256) of every document of the mix, repeated rows
    and null ids too. A null text is empty and has no ids."""
    found = bpe.encode_documents(docs, WORD_BPE_FILE, decode=True)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", without_toxicity),
    ("language", known_language),
    ("near_dedup", one_of_each),
    ("mixing", mixed),
    ("bpe", encoded),
]

# Samples of weighted sets, centroids and byte pairs are beyond SQL; tests/llm compares
# the rows with brute-force versions of the stages.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage; each stage is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
