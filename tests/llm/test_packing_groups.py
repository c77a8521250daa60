"""Packing: added tokens as the library reads them, step groups over many partitions."""

import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from colloquia.llm import packing
from colloquia.llm.queries import QUERIES, tokenizer_paths


def test_added_tokens_are_the_librarys(make_docs):
    tok = Tokenizer.from_file(tokenizer_paths()[0])   # the contract's call, nothing else set
    texts = ["<|endoftext|> hi", "a<|endoftext|>", "<|endoftext|", "é<|endoftext|>ñ 中", None, "<|endoftext|>" * 3_000]
    got = packing.pack(make_docs(list(enumerate(texts))), *tokenizer_paths()).collect()
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in pieces) == len(ids) == pieces[0]["doc_tokens"]
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in pieces)
    assert 50256 in tok.encode(texts[0], add_special_tokens=False).ids


def test_step_groups_over_many_partitions(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(64)
    rows = {(r["sequence_id"], r["padded_length"], r["step_group"]) for r in packing.pack(docs, *tokenizer_paths()).collect()}
    assert len({r[0] for r in rows}) == len(rows)
    tokens = Counter()
    for _, size, group in rows:
        tokens[group] += size
    assert sorted(tokens) == list(range(packing.STEP_GROUPS))
    assert max(tokens.values()) <= 1.05 * min(tokens.values())
    for size in {s for _, s, _ in rows}:   # at most one sequence of a length more than another group
        n = Counter(g for _, s, g in rows if s == size)
        assert max(n.values()) - min(n[g] for g in range(packing.STEP_GROUPS)) <= 1
    assert {256, 512, 1_024} <= {s for _, s, _ in rows}   # shorter tiers are packed in small partitions, too


def test_registered_query_has_step_groups(spark):
    got = QUERIES["op6_packing"](spark, "/root/testdata/sf0.001")
    assert got.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.select("step_group").distinct().count() == packing.STEP_GROUPS
