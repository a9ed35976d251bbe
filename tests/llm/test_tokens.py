"""Words of letters are encoded without the steps that leave them as they are."""

import numpy as np
import pyarrow as pa
import pytest

from graphloom.llm import packing

TEXTS = ["Zorbulent quaxifying THE éTÉ naïve ßtraße", "don't we'll it's x1y2 a,b.c 'tis <|endoftext|> <|x", "İstanbul ŉ ǅ é Ångstr Ａ 中文 ½ \x1f\x85 z", "", "a" * 3000 + " " + "é" * 99, "µ ª º q" + "́" + " </w> w>"]


def test_letters_take_the_short_way(monkeypatch):
    tok, slow = packing.WordTokenizer(packing.default_tokenizer()), []
    whole = tok._encode_any
    monkeypatch.setattr(tok, "_encode_any", lambda texts: slow.extend(texts) or whole(texts))
    for text in [*TEXTS, *TEXTS]:
        want = np.array(tok.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert tok.ids(text) == want
    assert slow and not [t for t in slow if t.isascii() and t.isalpha()]


def test_other_steps_go_the_long_way():
    tok = packing.WordTokenizer(packing.default_tokenizer())
    parts = packing.json.loads(tok.model.to_str())
    assert tok._letters(parts) is not None
    for change in ({"dropout": 0.5}, {"end_of_word_suffix": None}):
        assert tok._letters(parts | {"model": parts["model"] | change}) is None
    prefixed = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": False}
    split = parts["pre_tokenizer"]["pretokenizers"][0]
    assert tok._letters(parts | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, prefixed]}}) is None


ODD = [None, "", " \t\r\n\x0b\x0c", "a", " É", "<|endoftext|>x <|ENDOFTEXT|> a<|b A<b|c", "H\u0331 Abc\u0301. \u212a É!É a,B9.c 'S x'LL", "\x00a A\x1cB. Z\x7f.", "Ж.b 中文,a a中 Ɏ,Ɏ ɐ,ɐ a×b İ.i Ÿ-ÿ"]


@pytest.mark.parametrize("size", [1, 7, 4 << 20])
def test_texts_together_have_the_ids_of_each(monkeypatch, size):
    monkeypatch.setattr(packing, "SLICE_BYTES", size)  # texts beyond it go in parts
    tok = packing.WordTokenizer(packing.default_tokenizer())
    texts = [*ODD, *TEXTS, None, *[x + y for x in "aÉ中.\x00 " for y in ("<|", "'s", "É", "\u0301", ".é")]]
    want = [np.array(tok.model.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for kind in (pa.string(), pa.large_string()):
        assert list(tok.each(pa.array(texts, kind))) == want
        assert list(tok.each(pa.array(["x", None, *texts], kind).slice(2))) == want
    assert list(tok.each(pa.array([], pa.string()))) == []
    assert list(tok.each(pa.array([None], pa.string()))) == [b""]


def test_forms_of_a_word_are_encoded_once_for_all_texts(monkeypatch):
    tok, calls = packing.WordTokenizer(packing.default_tokenizer()), []
    whole = tok._encode
    monkeypatch.setattr(tok, "_encode", lambda texts: calls.append(sorted(texts)) or whole(texts))
    texts = [f"Zorb{c}x zorb{c}x, ZORB{c.upper()}X!! Été{c}" for c in "abcdefgh"]
    assert len(list(tok.each(pa.array([*texts, *texts])))) == 16
    words = [f"zorb{c}x" for c in "abcdefgh"] + [f"été{c}" for c in "abcdefgh"]
    assert calls == [sorted([",", "!!", *words])]


@pytest.mark.parametrize("special", ["[PAD]", "<| x |>"])
def test_other_special_tokens_are_found_in_whole_texts(tmp_path, special):
    model = packing.WordTokenizer(packing.default_tokenizer()).model
    model.add_special_tokens([special])
    model.save(path := str(tmp_path / "vocabulary.json"))
    text = f"The {special}, a{special}b"
    want = model.encode(text, add_special_tokens=False).ids
    assert model.token_to_id(special) in want
    assert np.frombuffer(packing.WordTokenizer(path).ids(text), "<u4").tolist() == want
