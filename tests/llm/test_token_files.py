"""Token files: the index, the way back, lookups by key."""

import os
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from termfold.llm import token_files as T
from termfold.operators.staging import new_path
from tests.llm.messy import ROWS, clashing, documents, empty, rows

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("word_bpe_49k.json")


def test_index_is_minimal_and_perfect():
    for n in (0, 1, 2, 100, 5000):
        keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
        sizes, bits = T.build_index(keys)
        wide = T._padded(bits)
        ranks = np.concatenate([[0], np.cumsum(wide.reshape(-1, T.RANK_STEP).sum(1))[:-1]])
        assert sorted(T.slots(keys, sizes, wide, ranks).tolist()) == list(range(len(keys)))


def expected(data):
    """(doc_id, start, n_tokens, crc) with nulls first; ties by any order."""
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_on_a_table(spark, sf_dir):
    data = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, T.op8_token_files(spark, sf_dir).collect())) == expected(data)


def test_small_shards_and_lookups(spark):
    data = [(i, f"word{i} " * (i % 40)) for i in range(300)]
    out = new_path(spark)
    T.write_token_files(spark.createDataFrame(data, "doc_id long, text string").repartition(5), out, PATH, shard_ids=50)
    assert sorted(map(tuple, T.read_documents(spark, out).collect())) == expected(data)
    assert spark.read.parquet(f"{out}/shards").count() > 50
    got = {r.doc_id: len(r.ids) for r in T.lookup(spark, out, [7, 250, 999]).collect()}
    sizes = {k: n for k, _, n, _ in expected(data)}
    assert got == {7: sizes[7], 250: sizes[250]}


def test_odd_rows(spark):
    results = []
    for docs in (documents(spark), clashing(spark)):
        out = new_path(spark)
        T.write_token_files(docs, out, PATH)
        results.append(rows(T.read_documents(spark, out)))
    assert results[0] == results[1] and len(results[0]) == len(ROWS)
    want = expected([(r[0], r[1]) for r in ROWS])
    assert sorted(results[0], key=lambda r: r[1]) == want
    out = new_path(spark)
    T.write_token_files(empty(spark), out, PATH)
    assert T.read_documents(spark, out).collect() == []
