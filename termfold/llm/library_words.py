"""Ids of words by the tokenizers library, by way of their pieces.

The library spends most of its time on a word's normalisation, its split and the alignment of both with the text. Words of
characters on which these steps are plain (``PLAIN``: lower-cased one to one, unchanged by composition, letters or marks in every
version of Unicode) are split by the file's own pattern for many words at once, and only pieces not seen
before go to the library's model. All other words, and all words where the file states other steps, go to the library whole.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from termfold.llm.bpe_tree import Words

#: Pieces that a worker keeps encoded, twice: those in use, and those in use before.
KEPT_PIECES = 200_000
#: Visible ASCII, Latin letters with their accents, Cyrillic letters, dashes, quotation marks, ellipsis.
PLAIN = "!-~À-ÖØ-öø-įı-ſЀ-џ–—‘-„…"
#: The steps of a file whose words are taken apart here; the pattern is the file's own.
STEPS = ["NFC", "Replace \\s+ by blank", "Lowercase", "Split, pattern kept", "ByteLevel alone"]


def _steps(spec: dict) -> list[str]:
    """What a tokenizer file does before its model, in the words of STEPS where it is one of them."""
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        return []
    out = []
    for step in [*(spec["normalizer"] or {}).get("normalizers", []), *(spec["pre_tokenizer"] or {}).get("pretokenizers", [])]:
        kind = step["type"]
        if kind == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " ":
            kind = STEPS[1]
        elif kind == "Split" and step["behavior"] == "Removed" and step["invert"] and "Regex" in step["pattern"]:
            kind = STEPS[3]
        elif kind == "ByteLevel" and not step["add_prefix_space"] and not step["use_regex"]:
            kind = STEPS[4]
        out.append(kind)
    return out


def _pattern(spec: dict) -> regex.Pattern:
    return regex.compile(next(s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")["pattern"]["Regex"] + "|\n")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level models take for each byte: visible ones themselves, the others in order from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class LibraryWords:
    """Ids of words without white space, as the library gives them."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library, self.kept = Tokenizer.from_file(path), kept
        self.model = self.library.model
        self.own = list(range(1 + max(self.library.get_vocab().values())))      # one number object for each id
        self.letters = byte_letters()
        self.pieces: dict[str, tuple] = {}
        self.before: dict[str, tuple] = {}
        self.split = self.plain = None
        if _steps(spec) == STEPS:
            first = "".join(regex.escape(t["content"][0]) for t in spec["added_tokens"])
            self.split = _pattern(spec)
            self.plain = regex.compile(f"(?V1)[[{PLAIN}\\n]--[{first}]]*+" if first else f"[{PLAIN}\\n]*+").fullmatch

    def forget(self) -> None:
        self.pieces, self.before = {}, {}

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _piece(self, piece: str) -> tuple:
        known = self.before.get(piece)
        if known is None:
            letters = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
            known = tuple([self.own[t.id] for t in self.model.tokenize(letters)])
        if len(self.pieces) >= self.kept:
            self.pieces, self.before = {}, self.pieces
        self.pieces[piece] = known
        return known

    def _plain(self, joined: str) -> list[list[int]]:
        out, own, get = [], [], self.pieces.get
        for piece in self.split.findall(joined.lower() + "\n"):
            if piece == "\n":
                out.append(own)
                own = []
            else:
                ids = get(piece)
                if ids is None:
                    ids = self._piece(piece)
                    get = self.pieces.get
                own.extend(ids)
        return out

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        joined = b"\n".join(words).decode()
        if self.plain and self.plain(joined):
            return self._plain(joined) if words else []
        words = joined.split("\n") if words else []
        if not self.plain:
            return self._whole(words)
        plain = [self.plain(w) is not None for w in words]
        easy = [w for w, p in zip(words, plain) if p]
        easy = iter(self._plain("\n".join(easy)) if easy else [])
        rest = iter(self._whole([w for w, p in zip(words, plain) if not p]))
        return [next(easy) if p else next(rest) for p in plain]


def encode_column(words: Words, texts: pa.Array, together: int = 4_000_000):
    """Ids of each text, in order; null is empty.

    Texts of about ``together`` bytes (a longer one alone) are split at ASCII white space by Arrow, and each different word of
    theirs is looked up once.
    """
    texts = texts.cast(pa.string()).fill_null("")
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + together, "right")))
        lists = pc.ascii_split_whitespace(texts.slice(i, j - i))
        coded = lists.flatten().dictionary_encode()
        own, ends = words.ids(coded.dictionary.cast(pa.binary()).to_pylist())     # white space at an end gives an empty word
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        at = coded.indices.to_numpy()
        lengths = (ends - starts)[at]
        cuts = np.concatenate([[0], np.cumsum(lengths)])
        ids = own[np.arange(cuts[-1]) + np.repeat(starts[at] - cuts[:-1], lengths)]
        offsets = lists.offsets.to_numpy()
        for a, b in zip(*(cuts[offsets - offsets[0]][k].tolist() for k in (slice(None, -1), slice(1, None)))):
            yield ids[a:b]
        i = j
