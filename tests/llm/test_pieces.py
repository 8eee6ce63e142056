import struct

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from vigil.llm import common, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXT = st.text(st.sampled_from("   \n\tabceéß日🤗▁<s>0x41.,thing") | st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=60)


def message(*parts):
    """A protobuf message from (field, value) pairs."""
    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes(out) + bytes([n])
    raw = b""
    for field, value in parts:
        if isinstance(value, float):
            raw += varint(field << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            raw += varint(field << 3) + varint(value)
        else:
            raw += varint(field << 3 | 2) + varint(len(value)) + value
    return raw


def small_unigram(collapse=1, byte_fallback=1, prefix=1, escape=1, suffix=0):
    """A hand-written unigram model."""
    words = {"▁": -3.0, "▁the": -4.0, "▁th": -5.0, "e": -4.5, "t": -5.1, "h": -5.2, "▁there": -6.5, "re": -5.0, "r": -6.0, "a": -4.0, "▁a": -3.5, "n": -4.2, "an": -4.9, "é": -7.0}
    parts = [message((1, b"<unk>"), (2, 0.0), (3, 2)), message((1, b"<s>"), (2, 0.0), (3, 3)), message((1, b"</s>"), (2, 0.0), (3, 3))]
    if byte_fallback:
        parts += [message((1, f"<0x{b:02X}>".encode()), (2, 0.0), (3, 6)) for b in range(256)]
    parts += [message((1, w.encode()), (2, s)) for w, s in words.items()]
    return message(*[(1, p) for p in parts], (2, message((3, 1), (24, suffix), (35, byte_fallback))),
                   (3, message((1, b"identity"), (3, prefix), (4, collapse), (5, escape))))


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_bpe_parity_and_decoding(text):
    sp, coder = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.encoder(PATH)
    ids, offsets, same = coder.encode([text, "x " + text])
    for k, t in enumerate((text, "x " + text)):
        want = sp.encode(t)
        assert ids[offsets[k]:offsets[k + 1]].tolist() == want and same[k]
        assert coder.decode(want) == sp.decode(want)


def test_runs_of_spaces():
    sp, coder = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.encoder(PATH)
    texts = [" " * k + w + " " * j for k in range(45) for j in (0, 1, 2, 15, 17, 40) for w in ("x", "日", "")]
    ids, offsets, same = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == sp.encode(texts)
    assert same.all()


def test_whole_pipeline_in_the_library(spark):
    """normaliser, marker, model, byte fallback and decoder as one tokenizers object, on whole documents."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    whole = pieces.build_tokenizer(pieces.parse_model(open(PATH, "rb").read()))
    texts = [r.text for r in common.table(spark, "/root/testdata/sf0.001", "documents").collect()]
    want = sp.encode(texts)
    got = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    assert whole.decode_batch(got, skip_special_tokens=False) == sp.decode(want)


@pytest.mark.parametrize("collapse,fallback", [(1, 1), (0, 1), (1, 0), (0, 0)])
def test_unigram_parity(tmp_path, collapse, fallback):
    path = tmp_path / "u.model"
    path.write_bytes(small_unigram(collapse, fallback))
    sp, coder = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.PieceEncoder(str(path))
    assert coder.model.kind == pieces.UNIGRAM

    @settings(max_examples=200, deadline=None)
    @given(st.text(st.sampled_from("  therané.日z"), max_size=30))
    def agree(text):
        ids, offsets, same = coder.encode([text])
        assert ids.tolist() == sp.encode(text) and same.all()
    agree()


def test_parity_is_never_claimed_unseen(tmp_path):
    """Without a prefix no chunk stands alone: whole texts are compared, and wrong ids are found."""
    path = tmp_path / "u.model"
    path.write_bytes(small_unigram(prefix=0))
    sp, coder = sentencepiece.SentencePieceProcessor(model_file=str(path)), pieces.PieceEncoder(str(path))
    texts = ["the there an", "the  an", "", "é"]
    ids, offsets, same = coder.encode(texts)
    assert same.tolist() == [ids[a:b].tolist() == sp.encode(t) for a, b, t in zip(offsets, offsets[1:], texts)]
    assert same[0] and same[2]
    coder.pool[:coder.used] += 1
    assert coder.encode(texts)[2].tolist() == [False, False, True, False]


@pytest.mark.parametrize("setting", [{"escape": 0}, {"suffix": 1}])
def test_settings_not_rebuilt_are_an_error(tmp_path, setting):
    path = tmp_path / "u.model"
    path.write_bytes(small_unigram(**setting))
    with pytest.raises(ValueError, match="not rebuilt"):
        pieces.PieceEncoder(str(path))


def test_frames(frame, odd_rows):
    docs = frame(odd_rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = pieces.encode(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), sp.encode(t or "")) for i, t in odd_rows)
    back = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in odd_rows)
    done = pieces.round_trip(docs, PATH).collect()
    assert len(done) == len(odd_rows) and all(r.parity and r.text_back for r in done)
    assert pieces.round_trip(frame([]), PATH).count() == 0
