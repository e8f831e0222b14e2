from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from feedlake.llm import token_alignment as t
from feedlake.llm.queries import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    return t.Vocabularies(tokenizer_path(A), tokenizer_path(B))


def one_text(tools, text):
    """A, B, groups and links of one text by walking both rows of tokens; None without tokens."""
    if not text:
        return None
    a, b = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
    x, y = [tools.a_bytes[i] for i in a], [tools.b_bytes[i] for i in b]
    if not b"".join(x) == b"".join(y) == b" " + text.encode():
        return None
    a_ends, b_ends = np.cumsum([len(p) for p in x]).tolist(), np.cumsum([len(p) for p in y]).tolist()
    groups, links, i, j, first, second = [], [], 0, 0, 0, 0
    while i < len(a):
        links.append((a[i], b[j]))
        end_a, end_b = a_ends[i], b_ends[j]
        i, j = i + (end_a <= end_b), j + (end_b <= end_a)
        if end_a == end_b:
            groups.append(f"{','.join(map(str, a[first:i]))}|{','.join(map(str, b[second:j]))}")
            first, second = i, j
    return a, b, groups, links


def brute(tools, texts):
    found = [one_text(tools, x) for x in texts]
    counts = Counter(p for f in found if f for p in f[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = f
            high = sum(counts[p] == best[p[1]] for p in links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((len(a), len(b), len(groups), len(links), high, sum(counts[p] for p in links), digest))
    return out


def fuzzed(n):
    pick = random.Random(n)
    parts = "a the é ß я 中 😀 ▁ <s> <|endoftext|> 's ; ﬁ x 123 . ,b ;\r \x00 \u0085   　  ".split(" ")
    parts += [" ", "  ", "\n", "\t", "\r", " b", "  ", "　 x"]
    return ["".join(pick.choices(parts, k=pick.randint(0, 14))) for _ in range(n)]


def aligned(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = rows.selectExpr("*", "'x' as a", "1 as n", "2 as row", "3 as pair").repartition(3)
    found = t.align_tokens(rows, tokenizer_path(A), tokenizer_path(B), **options)
    assert found.columns == COLUMNS
    return [tuple(r)[1:] for r in sorted(found.collect())]


def test_equals_walking_both_rows_of_tokens(spark, tools):
    texts = [None, "", " ", "a ", "x" * 5000, "ab " * 3000, "▁", "same text", "same text", *fuzzed(1500)]
    assert aligned(spark, texts) == brute(tools, texts)


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not here")
def test_given_texts_in_blocks_of_pairs(spark, tools):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    assert aligned(spark, texts, block=500) == brute(tools, texts)


def test_small_cache_changes_nothing(tools, monkeypatch):
    import pyarrow as pa

    texts = fuzzed(300)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(300)), "text": texts})
    run = t._aligned(tokenizer_path(A), tokenizer_path(B))
    whole = [b.to_pydict() for b in run(iter([batch, batch]))]
    monkeypatch.setattr(t, "CHUNKS", 1)
    assert [b.to_pydict() for b in t._aligned(tokenizer_path(A), tokenizer_path(B))(iter([batch, batch]))] == whole


def test_no_rows_and_no_tokens(spark):
    assert aligned(spark, []) == []
    assert aligned(spark, [None, "", "▁"]) == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_ids_of_any_type_and_repeated_rows(spark):
    rows = spark.createDataFrame([("k", "a b"), ("k", "a b"), (None, "c")], "doc_id string, text string")
    found = t.align_tokens(rows, tokenizer_path(A), tokenizer_path(B)).collect()
    assert Counter(r.doc_id for r in found) == {"k": 2, None: 1}


def test_cuts_by_division_equal_the_intersection():
    random_ = np.random.default_rng(4)
    for _ in range(200):
        stops_a, stops_b, a, b, at = [], [], [], [], 0
        for _ in range(random_.integers(1, 6)):
            size = int(random_.integers(1, 60))
            for ends, stops in ((a, stops_a), (b, stops_b)):
                inner = np.flatnonzero(random_.random(size - 1) < random_.random()) + 1
                ends += [at + int(i) for i in inner] + [at + size]
                stops.append(len(ends))
            at += size
        a, b = np.array(a), np.array(b)
        cuts = t.shared_cuts(a, b, np.array(stops_a), np.array(stops_b))
        assert a[cuts].tolist() == np.intersect1d(a, b).tolist()
