import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vigil.llm import tokenfile

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50256), st.integers(0, 2**64 - 1)), max_size=300))
def test_round_trip(ids):
    ids = np.array(ids, np.uint64)
    assert (tokenfile.decode_words(*tokenfile.encode_words(ids)) == ids).all()


def test_words_hold_as_many_as_fit():
    assert len(tokenfile.encode_words(np.ones(120, np.uint64))[0]) == 16
    assert len(tokenfile.encode_words(np.full(8, 32767, np.uint64))[0]) == 16
    words, escapes = tokenfile.encode_words(np.array([2**60], np.uint64))
    assert len(words) == 8 and len(escapes) == 8


def expected(rows):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_back_every_document(frame, odd_rows, spark, tmp_path):
    rows = [*odd_rows, *((100 + i, f"text {i} " * (i % 50)) for i in range(300))]
    tokenfile.write_ids(frame(rows).repartition(5), str(tmp_path / "f"), PATH, block_ids=1000)
    got = [tuple(r) for r in tokenfile.read_ids(spark, str(tmp_path / "f")).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)


def test_empty_table(frame, spark, tmp_path):
    tokenfile.write_ids(frame([]), str(tmp_path / "f"), PATH)
    assert tokenfile.read_ids(spark, str(tmp_path / "f")).count() == 0
