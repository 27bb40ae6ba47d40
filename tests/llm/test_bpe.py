"""Encoding, decoding and counting against the library."""

import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from termfold.llm import bpe_count, bpe_tree
from tests.llm.messy import check_shapes

os.environ["TOKENIZERS_PARALLELISM"] = "false"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = list("abcde THEst \n\t\r&*12") + ["'s", "\x1c", "\x85", " ", "　", "é", "́", "İ", "Σς", "½", "🙂", "ﬁ", "ñ", "<|endoftext|>", "<|startoftext|>"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    made = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 50))) for _ in range(1500)]
    return made + ["", " ", "\n\n  x", "a" * 3000, "the" * 700, "don't we'll 'S", "a   b   c"]


def test_encoding_equals_the_library(texts):
    own, library = bpe_tree.Codec(WORD), Tokenizer.from_file(WORD)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text).tolist() == want.ids, text
        assert own.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)


def test_long_and_joint_merging_agree():
    own, r = bpe_tree.Codec(WORD), random.Random(2)
    jobs = [own.symbols("".join(r.choice("thesinaroe") for _ in range(r.randint(2, 60)))) for _ in range(300)]
    assert [own.merge_long(j) for j in jobs] == own.merge_all(jobs)


def test_words_that_a_worker_no_longer_keeps_are_learned_again(texts):
    own = bpe_tree.Codec(WORD)
    small = bpe_tree.Words(own.encode_words, kept=50)
    for text in texts[:200]:
        assert np.array_equal(next(bpe_tree.encode_texts(small, [text.encode()])), own.encode(text))


def test_counts_equal_the_library(texts):
    own, library = bpe_count.Counter(BYTE), Tokenizer.from_file(BYTE)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert own.count(text) == len(want.ids), text


def test_queries_on_a_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library = Tokenizer.from_file(WORD)
    for r in bpe_tree.op6_bpe(spark, sf_dir).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    library = Tokenizer.from_file(BYTE)
    for r in bpe_count.op7_token_counts(spark, sf_dir).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len(docs[r.doc_id].encode()))


def test_odd_rows(spark):
    got = check_shapes(spark, lambda d: bpe_tree.digests(d, WORD), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    assert got[2].n_tokens == got[3].n_tokens == got[7].n_tokens == 0
    assert got[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    got = check_shapes(spark, lambda d: bpe_count.count_tokens(d, BYTE), ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    assert (got[2].n_tokens, got[3].n_tokens, got[6].over_limit) == (0, 0, True)


def test_ids_are_decoded(spark):
    docs = spark.createDataFrame([(1, "The cat's hat"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in bpe_tree.decode(bpe_tree.encode(docs, WORD), WORD).collect()}
    assert got == {1: "the</w> cat</w> 's</w> hat</w>", 2: ""}
