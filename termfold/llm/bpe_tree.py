"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A leaf holds the rank and place of one adjacent pair, an inner node the lowest below it: the root yields the
leftmost merge of lowest rank. A merge changes three leaves, each with logarithmic updates on its way up. Words of
like length are worked on together, one numpy row each; a long one alone. Merges never cross white space, so each
different word is encoded once in a worker and looked up after that.

Defined results: null text is empty; an empty text has no ids and decodes to an empty text; texts are encoded
whole; special strings within a text become their ids, as the library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termfold.llm.shared import give_back, ship_package, sliced, table, tidy

#: Words that a worker keeps encoded, twice: those in use, and those in use before.
KEPT = 700_000
#: Pieces with more symbols are merged one by one.
TOGETHER = 128
#: Bytes of the texts that are split into words at a time.
SPLIT = 2_000_000
NONE = np.iinfo(np.int64).max

_codecs: dict[tuple[str, int, int | None], "Codec"] = {}


class Words:
    """Ids by word, as ranges of one flat array.

    When it is full, the words become the old ones and those before are forgotten; old words that come up again
    are taken over with their ids, so that only words long unseen are encoded anew.
    """

    def __init__(self, encode_words, kept: int = KEPT, learned: int | None = None):
        self.encode_words, self.kept, self.learned = encode_words, kept, learned
        self.number = {}
        self.clear()

    def clear(self) -> None:
        self.old = (self.number, self.flat[: self.used].copy(), self.start, self.length) if self.number else ({}, None, None, None)
        self.number: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def forget(self) -> None:
        self.number = {}
        self.clear()

    def _learn(self, new: list[bytes]) -> None:
        some = self.learned or max(1, len(new))                # so many are Python objects at a time
        for i in range(0, len(new), some):
            self._learn_some(new[i : i + some])

    def _learn_some(self, new: list[bytes]) -> None:
        number, flat, start, length = self.old
        found = [number.get(w) for w in new]
        encoded = iter(self.encode_words([w for w, k in zip(new, found) if k is None]))
        ids = [next(encoded) if k is None else flat[start[k] : start[k] + length[k]].tolist() for k in found]
        n, total = len(self.number), sum(map(len, ids))
        while n + len(new) > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.length[n : n + len(new)] = lengths
        self.start[n : n + len(new)] = self.used + np.cumsum(lengths) - lengths
        if total:
            self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.used += total
        self.number.update(zip(new, range(n, n + len(new))))

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, where each word's end); new words are learned on the way."""
        at = list(map(self.number.get, words))
        if None in at:
            new = {w for w, k in zip(words, at) if k is None}
            if self.number and len(self.number) + len(new) > self.kept:
                self.clear()
                new = set(words)
            self._learn(list(new))
            at = list(map(self.number.__getitem__, words))
        at = np.array(at, np.int64)
        lengths = self.length[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.start[at] - (ends - lengths), lengths)], ends


def encode_texts(words: Words, texts: list[bytes], together: int = SPLIT):
    """Ids of each text, in order; new words are learned for several texts at once."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < together):
            size += len(texts[j])
            j += 1
        split = [t.split() for t in texts[i:j]]
        ids, ends = words.ids([w for s in split for w in s])
        ends, word, start = np.concatenate([[0], ends]), 0, 0
        for s in split:
            word += len(s)
            yield ids[start : ends[word]]
            start = ends[word]
        i = j


class Codec:
    def __init__(self, path: str, kept: int = KEPT, learned: int | None = None):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, library = spec["model"], Tokenizer.from_file(path)
        self.normalize, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.tokens = [""] * self.size
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        self.pair_rank, pairs, made = {}, [], []
        for rank, (a, b) in enumerate(model["merges"]):
            pair = self.vocab[a] * self.size + self.vocab[b]
            self.pair_rank[pair] = rank
            pairs.append(pair)
            made.append(self.vocab[a + b])
        self.made = np.array(made, np.int64)
        pairs = np.array(pairs, np.int64)
        self.by_pair = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.by_pair]
        self.words = Words(self.encode_words, kept, learned)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NONE without one."""
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.by_pair[at], NONE)

    def symbols(self, piece: str) -> list[int]:
        return [self.vocab[c] for c in piece[:-1]] + [self.vocab[piece[-1] + self.suffix]]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word (a run without white space)."""
        parts, jobs = [], []
        for w in words:
            own = []
            for s in self.at_special.split(w.decode()):
                if s in self.special:
                    own.append((None, self.special[s]))
                elif s:
                    for p, _ in self.pieces(self.normalize(s)):
                        own.append((len(jobs), 0))
                        jobs.append(self.symbols(p))
            parts.append(own)
        done = self.merge_all(jobs)
        return [[i for job, given in own for i in ([given] if job is None else done[job])] for own in parts]

    def merge_all(self, jobs: list[list[int]]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(jobs)
        groups: dict[int, list[int]] = {}
        for k, s in enumerate(jobs):
            if len(s) == 1:
                out[k] = s
            elif len(s) > TOGETHER:
                out[k] = self.merge_long(s)
            else:
                groups.setdefault((len(s) - 2).bit_length(), []).append(k)
        for level, members in groups.items():
            for i in range(0, len(members), 4096):
                some = members[i : i + 4096]
                for k, ids in zip(some, self.merge_together([jobs[k] for k in some], 1 << level)):
                    out[k] = ids
        return out

    def merge_together(self, jobs: list[list[int]], leaves: int) -> list[list[int]]:
        """Merges pieces of at most leaves + 1 symbols, one row each."""
        m, width = len(jobs), leaves + 1
        sym = np.full((m, width + 1), -1, np.int64)                 # the last column: no neighbour
        for r, s in enumerate(jobs):
            sym[r, : len(s)] = s
        after = np.tile(np.arange(1, width + 2), (m, 1))
        before = np.tile(np.arange(-1, width), (m, 1))
        after[:, width] = width
        tree = np.full((m, 2 * leaves), NONE, np.int64)
        rank = self.ranks(sym[:, :leaves], sym[:, 1 : leaves + 1])
        place = np.arange(leaves)
        tree[:, leaves:] = np.where(rank == NONE, NONE, rank * width + place)
        node = leaves >> 1
        while node:
            tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
            node >>= 1
        rows = np.arange(m)

        def put(r, at, value):
            spot = leaves + at
            tree[r, spot] = value
            spot = spot >> 1
            while len(spot) and spot[0]:
                tree[r, spot] = np.minimum(tree[r, 2 * spot], tree[r, 2 * spot + 1])
                spot = spot >> 1

        while True:
            rows = rows[tree[rows, 1] < NONE]
            if not len(rows):
                break
            rank, i = np.divmod(tree[rows, 1], width)
            j = after[rows, i]
            k = after[rows, j]
            new = self.made[rank]
            sym[rows, i], sym[rows, j] = new, -1
            after[rows, i] = k
            has = k < width
            before[rows[has], k[has]] = i[has]
            inner = j < leaves
            put(rows[inner], j[inner], NONE)
            right = self.ranks(new, sym[rows, k])
            put(rows, i, np.where(right == NONE, NONE, right * width + i))
            h = before[rows, i]
            has = h >= 0
            r, h = rows[has], h[has]
            left = self.ranks(sym[r, h], new[has])
            put(r, h, np.where(left == NONE, NONE, left * width + h))
        return [row[row >= 0].tolist() for row in sym]

    def merge_long(self, sym: list[int]) -> list[int]:
        """The same for one piece of any length."""
        n, get, sym = len(sym), self.pair_rank.get, list(sym)
        leaves = 1 << (n - 2).bit_length()
        none = (NONE, 0)
        tree = [none] * (2 * leaves)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def value(i: int):
            if i < 0 or after[i] >= n:
                return none
            rank = get(sym[i] * self.size + sym[after[i]])
            return none if rank is None else (rank, i)

        for i in range(n - 1):
            tree[leaves + i] = value(i)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, what) -> None:
            i += leaves
            tree[i] = what
            while i > 1:
                i >>= 1
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        while tree[1] is not none and tree[1] != none:
            rank, i = tree[1]
            j = after[i]
            sym[i], sym[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if j < n - 1:
                put(j, none)
            put(i, value(i))
            if before[i] >= 0:
                put(before[i], value(before[i]))
        return [s for s in sym if s >= 0]

    def encode(self, text: str) -> np.ndarray:
        return next(encode_texts(self.words, [text.encode()]))

    def decode(self, ids) -> str:
        """Token strings with a space between, as the library joins them for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def codec(path: str, kept: int = KEPT, learned: int | None = None) -> Codec:
    if (path, kept, learned) not in _codecs:
        _codecs[path, kept, learned] = Codec(path, kept, learned)
        if learned:
            give_back()                                        # what the file was read into
    return _codecs[path, kept, learned]


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


@tidy
def _encode(batches, path: str, kept: int, forget: bool, learned: int | None, split: int):
    c = codec(path, kept, learned)
    for b in sliced(batches):
        ids = list(encode_texts(c.words, _texts(b.column(1)), split))
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "ids"])
    if forget:
        c.words.forget()


def _decode(batches, path: str):
    c = codec(path)
    for b in batches:
        texts = [c.decode(x or []) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _digest(batches, path: str):
    c = codec(path)
    for b in sliced(batches):
        counts, hashes, decoded = [], [], []
        for ids in encode_texts(c.words, _texts(b.column(1))):
            counts.append(len(ids))
            hashes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            decoded.append(hashlib.sha256(c.decode(ids.tolist()).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def encode(docs: DataFrame, path: str, kept: int = KEPT, forget: bool = False, learned: int | None = None, split: int = SPLIT) -> DataFrame:
    """doc_id and ids of each document; ``kept`` words stay encoded in a worker, or until a task's end (``forget``).

    ``learned`` new words are encoded at a time (None: all of ``split`` bytes of text): fewer take less memory and more time.
    """
    ship_package(docs.sparkSession)
    work = partial(_encode, path=path, kept=kept, forget=forget, learned=learned, split=split)
    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row of ids."""
    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, path=path), "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        partial(_digest, path=path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
