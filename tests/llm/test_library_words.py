"""Words by way of their pieces, against the library on whole words."""

import json
import os
import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from termfold.llm.bpe_tree import Words
from termfold.llm.library_words import LibraryWords, encode_column

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "<b>", "İI", "ŉ'S", "ΑΣ", "Σ", "é", "é", "Å", "ẞ", "ſ", "ǅ",
       "a b", "a b", "x\x1cy", "x\x85y", "½", "٣4", "中文", "🙂a", "it's", "IT'S", "'RE", "--", "…x", "„q“", "×÷", "​", "Ёж", "́"]


def whole(words):
    library = Tokenizer.from_file(PATH)
    return [library.encode(w, add_special_tokens=False).ids for w in words]


def test_odd_words_equal_the_library():
    rng = random.Random(5)
    words = ODD + ["".join(rng.choice(ODD + list("abZ9'.,-")) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    words = [p.decode() for w in words for p in w.encode().split()]
    got = LibraryWords(PATH)([w.encode() for w in words])
    assert [list(x) for x in got] == whole(words)
    assert LibraryWords(PATH)([]) == []


def test_every_plain_character_alone_and_between_letters():
    words = LibraryWords(PATH)
    plain = [chr(c) for c in range(0x21, 0x2100) if words.plain(chr(c))]
    assert len(plain) > 350 and "<" not in plain
    strings = [s for c in plain for s in (c, f"a{c}b", f"{c}'s", f"{c}{c}E")]
    assert [list(x) for x in words([s.encode() for s in strings])] == whole(strings)


def test_small_caches_change_nothing():
    rng = random.Random(6)
    texts = [" ".join(rng.choice("Ab cd, ef9 gh's ÄÖ ij-kl mn").strip() + str(rng.randint(0, 40)) for _ in range(50)) for _ in range(40)]
    pieces = LibraryWords(PATH, kept=7)
    texts += ["", " \t\n", " lead", "trail\x0b", "a\x1cb  c", "x" * 1000]
    column = pa.array([None, *texts])
    for part, want in ((column, ["", *texts]), (column.slice(7, 20), texts[6:26]), (column.slice(0, 0), [])):
        got = list(encode_column(Words(pieces, 11), part, together=300))
        assert [x.tolist() for x in got] == whole(want)
    assert len(pieces.pieces) <= 7 and len(pieces.before) <= 7


def test_a_file_with_other_steps_goes_to_the_library_whole(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"]["normalizers"].pop()                                 # not lower-cased
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec), encoding="utf-8")
    words = LibraryWords(str(other))
    library = Tokenizer.from_file(str(other))
    assert words.plain is None
    assert words([b"Ab's", b"xy"]) == [library.encode(w, add_special_tokens=False).ids for w in ("Ab's", "xy")]
