"""Token counts by heap-and-linked-list byte-pair merging; no token ids are made.

A text is cut where a run of white space begins: such a place always parts two pieces of the tokenizer's own
pattern, so chunks can be counted alone and their counts kept. A chunk's pieces start as one symbol per byte. A
heap holds the rank and place of every adjacent pair that has a merge; the lowest rank, leftmost first, is popped and
its two symbols, neighbours in a linked list, become one. Tokens = initial symbols - merges.

Defined results: null text is empty and has 0 bytes and 0 tokens; texts are counted whole, however long; special
strings in a text count as one token each, as the library does by default.
"""

from __future__ import annotations

import json
import re
from functools import partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termfold.llm.shared import ship_package, sliced, table

LIMIT = 1024
#: Characters that the tokenizer's pattern takes for white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Chunks whose count a worker keeps, and their longest length; beyond, it starts anew.
KEPT, KEPT_CHARS = 400_000, 48

_counters: dict[str, "Counter"] = {}


class Counter(dict):
    """Tokens of a chunk, by chunk."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.ids = vocab
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])}
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        special = [re.escape(x["content"]) for x in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None

    def __missing__(self, chunk: str) -> int:
        n = sum(len(p) - self.merged(p) for p, _ in self.pieces(chunk))
        if len(chunk) <= KEPT_CHARS:
            if len(self) >= KEPT:
                self.clear()
            self[chunk] = n
        return n

    def merged(self, piece: str) -> int:
        """Number of merges in a piece."""
        n = len(piece)
        if n == 1:
            return 0
        get, ids = self.merges.get, self.ids
        symbols = [ids[c] for c in piece]
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = get((symbols[i], symbols[i + 1]))
            if found:
                heap.append((found[0], i))
        heapify(heap)
        merges = 0
        while heap:
            rank, i = heappop(heap)
            if symbols[i] < 0 or (j := following[i]) >= n:
                continue
            found = get((symbols[i], symbols[j]))
            if not found or found[0] != rank:       # the pair at this place has changed meanwhile
                continue
            merges += 1
            symbols[i], symbols[j] = found[1], -1
            k = following[i] = following[j]
            if k < n:
                previous[k] = i
                if found := get((symbols[i], symbols[k])):
                    heappush(heap, (found[0], i))
            if (h := previous[i]) >= 0 and (found := get((symbols[h], symbols[i]))):
                heappush(heap, (found[0], h))
        return merges

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        one = self.__getitem__
        return len(parts) - 1 + sum(sum(map(one, CHUNK.findall(p))) for p in parts)


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def _count(batches, path: str, limit: int):
    c = counter(path)
    for b in sliced(batches):
        texts = [t or "" for t in b.column(1).to_pylist()]
        counts = [c.count(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()),
             pa.array([n > limit for n in counts], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of each document; ``path`` names the vocabulary file."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        partial(_count, path=path, limit=limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
