"""Splitting and prefixes of the BPE encoder against the exact pattern and tiktoken."""

import random

import public_tokenizers
import pytest
import tiktoken

import netgroom.llm.bpe as bpe_module
from netgroom.llm.bpe import Bpe, read_ranks

RANKS = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_quick_pattern_splits_every_character_like_the_exact_one():
    bpe = Bpe(RANKS, public_tokenizers.PATTERN)
    assert bpe.quick is not None
    for code in [*range(0x10000), 0x1D7CE, 0x1F600, 0x20000, 0x10FFFF]:
        if not 0xD800 <= code < 0xE000:
            c = chr(code)
            text = f"a{c}{c}b 1{c} {c}_{c}  {c}'s{c}.{c}\n {c}"
            assert bpe.split(text) == bpe.exact.findall(text), hex(code)
    # more of one class than a stack or a nested repeat would bear
    assert bpe.quick.findall("_-" * 500_000 + "é") == ["_-" * 500_000, "é"]


def test_other_patterns_are_left_to_regex():
    bpe = Bpe(RANKS, r"\p{Lu}?\p{Ll}+|\s+|.")
    assert bpe.quick is None and bpe.split("AbcDef x²") == ["Abc", "Def", " ", "x", "²"]


def test_pieces_share_the_work_on_their_prefixes(monkeypatch, library):
    bpe, rng, done = Bpe(RANKS, public_tokenizers.PATTERN), random.Random(5), []
    short, whole = getattr(Bpe, "_last", None), Bpe.append
    monkeypatch.setattr(Bpe, "_last", lambda self, data: done.append(data) or short(self, data), raising=False)
    monkeypatch.setattr(Bpe, "append", lambda self, data, *a: done.extend(data) or whole(self, data, *a))
    stems = ["".join(rng.choice("bcdfgklmnprst") for _ in range(8)) for _ in range(30)]
    words = [stem + end for stem in stems for end in ("ing.", "ed,", "er\n", "s", "ation", "ously", "en", "q", "zz", "_")]
    text = " ".join(words)
    assert bpe.encode(text) == library.encode_ordinary(text)
    # each word has at least nine prefixes
    assert 0 < len(done) < 2 * len(words)
    count = len(done)
    assert bpe.encode(text) == library.encode_ordinary(text) and len(done) == count


@pytest.mark.parametrize("kept", [(1, 32, 40, 5), (3, 0, 40, 2), (5, 32, 4, 1_000_000), (500_000, 32, 0, 1_000_000)])
def test_bounds_of_the_tables_do_not_change_ids(monkeypatch, library, kept):
    for name, value in zip(("CACHE", "KEPT", "SHARED", "PAIRS"), kept):
        monkeypatch.setattr(bpe_module, name, value)
    bpe, rng = Bpe(RANKS, public_tokenizers.PATTERN), random.Random(6)
    odd = ["ab", "abc", "the", "ing", " ", "  ", "\n", "'re", "_", "é", "ß", "²", "的", "中文", "अ", "\x1c", "\x85", "　", "😀", "\U00020000", "12", "٣", "x" * 50]
    for _ in range(300):
        text = "".join(rng.choice(odd) for _ in range(rng.randrange(40)))
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text) and bpe.decode(ids) == text.encode()
    assert max(map(len, (bpe.pieces, bpe.older, bpe.prefixes, bpe.older_prefixes, bpe.fits))) <= max(kept[0], kept[3])
