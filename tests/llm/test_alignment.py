"""Cross-tokenizer alignment against a plain version, on all paths of its joins."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from colloquia.llm import alignment, queries


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def groups(text, sides):
    """Lists of (A ids, B ids); none if a side does not spell a blank and the text."""
    a, b = sides
    if not text:
        return []
    spelled = alignment.byte_level()
    left = [(i, bytes(spelled[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        byte = len(p) == 6 and p.startswith("<0x")
        right.append((i, bytes.fromhex(p[3:5]) if byte else p.replace("▁", " ").encode()))
    want = b" " + text.encode()
    if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
        return []
    out, at_a, at_b = [([], [])], 0, 0
    left, right = left[::-1], right[::-1]
    while left or right:
        if at_a <= at_b:
            i, x = left.pop()
            out[-1][0].append(i)
            at_a += len(x)
        else:
            i, x = right.pop()
            out[-1][1].append(i)
            at_b += len(x)
        if at_a == at_b:
            out.append(([], []))
    return out[:-1]


CUT = {}


def plain(rows, sides):
    for t in {t for _, t in rows} - CUT.keys():
        CUT[t] = groups(t, sides)
    cut = CUT
    links = {t: Counter((a, b) for left, right in cut[t] for a in left for b in right) for t in {t for _, t in rows}}
    docs = Counter(p for _, t in rows for p in links[t])
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for i, t in rows:
        s = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in cut[t])
        out.append((i, sum(len(x) for x, _ in cut[t]), sum(len(y) for _, y in cut[t]), len(cut[t]),
                    sum(links[t].values()), sum(m for p, m in links[t].items() if docs[p] == top[p[0]]),
                    sum(m * docs[p] for p, m in links[t].items()), hashlib.sha256(s.encode()).hexdigest() if s else ""))
    return sorted(out, key=repr), docs


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.fixture(scope="module")
def rows(odd_rows):
    r = random.Random(11)
    letters = "abcdefghij  \n\t.,'sté ñ中文字ي😀 0123İß▁"
    out = list(odd_rows) + [(9, "<|endoftext|> plain"), (10, "<0x41> </s> <unk>"), (11, "two  blanks"), (12, " lead"),
                            (13, "▁"), (14, "\x00"), (15, "x" * 5_000), (16, "ﬁ ² Å"), (17, "中文" * 400)]
    out += [(100 + i, "".join(r.choice(letters) for _ in range(r.randint(1, 300)))) for i in range(150)]
    out += [(1_000 + i, "the same words again and again") for i in range(300)]
    return out


@pytest.mark.parametrize("hot_pairs,hot_texts", [(alignment.HOT_PAIRS, alignment.HOT_TEXTS), (40, 2), (0, 1)])
def test_against_plain(make_docs, rows, sides, hot_pairs, hot_texts, monkeypatch):
    if not hot_pairs:  # wide groups by distinct ids, small slices
        monkeypatch.setattr(alignment, "WIDE_GROUP", 3)
    got = queries.aligned(make_docs(rows)).by_document(hot_pairs, hot_texts)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows, sides)[0]


def test_wide_groups(sides, rows, monkeypatch):
    """Distinct ids with their numbers give the same links as every occurrence pair."""
    import numpy as np

    a, b = alignment.Tokenizers(*queries.tokenizer_paths(), public_tokenizers.path("piece_bpe_32k.model")).sides()
    tokens = [alignment.tokens_of(t, a, b) for _, t in rows if t]
    args = [[np.array(x[i], np.uint32) for x in tokens] for i in (0, 1)]
    lens = [np.array([len(t) for t in s.tokens]) for s in (a, b)]
    whole = [x.tolist() for x in alignment.Aligned(*args, *lens).pairs(32_000)]
    monkeypatch.setattr(alignment, "WIDE_GROUP", 1)
    assert [x.tolist() for x in alignment.Aligned(*args, *lens).pairs(32_000)] == whole


def test_pairs(make_docs, rows, sides):
    got = {(r["a"], r["b"]): (r["n_docs"], r["best"]) for r in queries.aligned(make_docs(rows)).pairs.collect()}
    docs = plain(rows, sides)[1]
    assert {p: n for p, (n, _) in got.items()} == docs
    assert all(best == (n == max(m for (x, _), m in docs.items() if x == a)) for (a, _), (n, best) in got.items())


def test_no_rows(make_docs):
    assert queries.aligned(make_docs([])).by_document().collect() == []
    got = queries.aligned(make_docs([(1, None), (2, "")])).by_document().collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_whole_table(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op11_alignment"](spark, "/root/testdata/sf0.001")
    assert got.columns == [*COLUMNS[:-1], "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain([tuple(r) for r in docs], sides)[0]
