import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from vigil.llm import tokens

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


def plain(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("name,spaces", FILES)
def test_chunks_give_the_ids_of_the_text(name, spaces):
    coder, whole = tokens.ChunkEncoder(plain(name), spaces), plain(name)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(st.text(st.sampled_from(" \n\t\x1c\x01\x85  ab'sZÉéßŒ́1.,!İΣ<|>endoftx") | st.characters(exclude_categories=["Cs"])), max_size=6))
    def agree(texts):
        ids, offsets = coder.encode(texts)
        want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == want
    agree()


def test_forgetting_keeps_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHARS", 50)
    coder = tokens.ChunkEncoder(plain("byte_bpe_50k.json"), True)
    rnd = random.Random(0)
    for _ in range(20):
        texts = [" ".join(rnd.choices(["alpha", "beta", "gamma\n", "", "x" * 90], k=9)) for _ in range(3)]
        ids, offsets = coder.encode(texts)
        assert ids.tolist() == [i for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False) for i in e.ids]
        assert offsets[-1] == len(ids)


@pytest.mark.parametrize("name,spaces", FILES)
def test_words_straight_from_the_model(name, spaces):
    """Every two-letter-set word with punctuation, in and outside of the plain letters."""
    coder, whole = tokens.ChunkEncoder(plain(name), spaces), plain(name)
    rnd = random.Random(5)
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()] + list("İıſŉΣσςΩжЯ日本ﬁÅ") + ["é"]
    texts = [" ".join("".join(rnd.choices(letters, k=rnd.randrange(1, 9))) + rnd.choice(["", ".", "'", "'s", "...", "!?", ",'", "_", "1", ")\""])
                      for _ in range(30)) for _ in range(150)]
    ids, offsets = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_chunks_used_last_are_kept():
    coder = tokens.ChunkEncoder(plain("byte_bpe_50k.json"), True, 300)
    coder.encode([" ".join(f"once{i}" for i in range(25))])
    coder.encode([" ".join(f"later{i}" for i in range(25))])
    assert coder.chars > 300
    coder.encode(["more"])
    assert "more" in coder.place and not any("once" in c for c in coder.place) and 5 < len(coder.place) < 25


def test_lines_share_the_words_at_their_borders():
    """A line end is a piece of its own: pairs of words around it are not chunks, and ids stay those of the library."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = [f"{a}{b}" for a in ("Évi", "was", "Zu", "x1", "(ab)", "don't", "of") for b in ("", "ne", "\u00f1o")]
    texts = [f"{a}.\n{b},\n{a}" for a in words for b in words] + ["one\n", "\ntwo", "a\n\nb", "a \nb", "a\n b", "\n", "a\r\nb", "'s\n's", "x\n1\n'll"]
    coder = tokens.ChunkEncoder(tokens.Tokenizer.from_file(path), True)
    whole = tokens.Tokenizer.from_file(path)
    ids, offsets = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [
        e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert len(coder.place) < 10 * len(words)


def test_a_word_is_learnt_once_whatever_stands_around_it():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = ["Évine", "was", "Zumañ", "x1", "don't", "жук", "日本", "ab\xa0", "ǅabc", "can’t", "z…"]
    behind = ["", ",", ".", "!!", "'", "'s", "...)", "&&&", "_", "…,", "%;1", "’."]
    texts = [f"{a}{b} {a}{b}\n{a}{b}\n{b}{a} {b}" for a in words for b in behind]
    coder, whole = tokens.ChunkEncoder(tokens.Tokenizer.from_file(path), True), tokens.Tokenizer.from_file(path)
    ids, offsets = coder.encode([t.rstrip(" ") for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [
        e.ids for e in whole.encode_batch([t.rstrip(" ") for t in texts], add_special_tokens=False)]
    assert {" was", "was", "&&&"} <= coder.place.keys()
    assert not {c + b for c in (" was", "was", "\nwas") for b in (",", ".", "!!", "&&&")} & coder.place.keys()


def test_words_in_a_row_are_given_to_the_model_together():
    """More words than go together, some alone in their alphabet; a vocabulary that merges across their borders gets them singly."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd = random.Random(7)
    made = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randrange(1, 14))) for _ in range(3 * tokens.WORDS + 1)]
    text = " ".join(made + ["à", "éà", "à", "Ġ", "aĠb", "жà"])
    whole = tokens.Tokenizer.from_file(path)
    want = whole.encode(text, add_special_tokens=False).ids
    coder = tokens.ChunkEncoder(tokens.Tokenizer.from_file(path), True)
    assert coder.encode([text])[0].tolist() == want
    letters = sorted(tokens.LETTERS.values())
    vocab = {c: i for i, c in enumerate([*letters, "aĠ", "Ġb"])}
    crossing = tokens.Tokenizer(models.BPE(vocab, [("a", "Ġ"), ("Ġ", "b")]))
    crossing.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    want = crossing.encode("ba ba ab b", add_special_tokens=False).ids
    assert tokens.ChunkEncoder(crossing, True).encode(["ba ba ab b"])[0].tolist() == want
