import pytest
from llm_tables import documents, found, no_documents, rows

from shelftrace.llm import bpe
from shelftrace.llm.queries import WORD_BPE_FILE


@pytest.mark.parametrize("frequent", [3, bpe.FREQUENT_WORDS])
def test_encodes_and_decodes_like_the_tokenizer(spark, frequent):
    tokenizer = bpe.load_tokenizer(WORD_BPE_FILE)
    encoded = bpe.encode_documents(documents(spark), WORD_BPE_FILE, frequent_words=frequent)
    got = found(bpe.decode_documents(encoded, WORD_BPE_FILE))
    want = []
    for row in rows():
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids
        want.append((row[0], ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert sorted(got, key=str) == sorted(want, key=str)
    both = bpe.encode_documents(documents(spark), WORD_BPE_FILE, frequent_words=frequent, decode=True)
    assert sorted(found(both), key=str) == sorted(want, key=str)
    again = bpe.decode_documents(both, WORD_BPE_FILE)
    assert sorted(found(again), key=str) == sorted(want, key=str)


def test_no_documents(spark):
    encoded = bpe.encode_documents(no_documents(spark), WORD_BPE_FILE)
    assert found(bpe.decode_documents(encoded, WORD_BPE_FILE)) == []


def test_special_tokens_keep_their_case():
    assert bpe.split_words("A <|X|> B") == [b"A".lower(), b"<|X|>", b"b"]


def test_words_of_many_parts_are_common(spark):
    # Every text is a part of its own: a word that all hold once, and words of one text.
    texts = [(i, f"spread {' '.join(f'w{i}x{j}' for j in range(5))}") for i in range(4000)]
    docs = spark.createDataFrame([*texts, (4000, "twice twice")], "id long, text string")
    uses = dict(found(bpe.common_words(docs, part_words=1)))
    assert 2000 < uses["spread"] < 8000
    assert uses["twice"] == 2
    assert set(uses) == {"spread", "twice"}


def test_varints_round_trip():
    import numpy as np

    numbers = np.array([0, 1, 127, 128, 300, 16383, 16384, 524288, 1 << 20, bpe.FREQUENT_WORDS], np.uint32)
    assert bpe._from_varints(bpe._varints(numbers)).tolist() == numbers.tolist()
    assert bpe._from_varints(b"").tolist() == []


def test_index_knows_its_words_only():
    words = [f"w{i}".encode() for i in range(5000)]
    index = bpe.WordIndex([words[:1234], words[1234:]])
    hashes, checks, *_ = bpe.hashed_words(b" ".join([*words[::-1], b"w5000", b"w", b"0w"]))
    assert index.find(hashes, checks).tolist() == [*range(4999, -1, -1), 5000, 5000, 5000]
    assert bpe.WordIndex([]).find(hashes, checks).tolist() == [0] * 5003


def test_workers_do_not_grow_with_the_tasks_that_encode():
    # Each task loads the tokenizer anew; what the library keeps of its words must go too.
    import ctypes
    import gc
    from pathlib import Path

    def task(number):
        words = [f"{(number * 20000 + i) * 2654435761 % 2**40:x}q" for i in range(20000)]
        with bpe.task_encoder(WORD_BPE_FILE) as (encode, _):
            assert len(encode(words)) == len(words)
        del words
        gc.collect()
        ctypes.CDLL(None).malloc_trim(0)
        held = Path("/proc/self/statm").read_text().split()
        return (int(held[1]) - int(held[2])) * 4096 / 1e6

    sizes = [task(number) for number in range(12)]
    assert sizes[-1] - sizes[1] < 15
