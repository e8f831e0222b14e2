"""What the Python side of a task holds, and which Python workers are started."""

from __future__ import annotations

import random
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from test_operators import prose

from feedlake.llm import bytesnp, decontaminate, near_dedup, packing
from feedlake.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def batch():
    """4 MB of text in one batch."""
    rng = random.Random(4)
    words = [prose(rng, 1) + rng.choice("klmnop") for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(2000)]
    assert sum(map(len, texts)) > 4e6
    return pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts})


def held(work) -> float:
    """MB of Python and numpy that the work takes at most, and what stays of the hash tables."""
    bytesnp._powers.clear()
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def signer():
    fields = [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]
    return near_dedup._signer(["doc_id"], "text", 5, near_dedup.SLOTS, near_dedup.ROWS, pa.schema(fields))


def finder(only_clean):
    return decontaminate._finder(SimpleNamespace(value=([1], ["some words of a benchmark that no text holds " * 4], pa.int64())), only_clean)


@pytest.mark.parametrize(
    "make",
    [signer, lambda: near_dedup._set_maker("doc_id", "text", 5), lambda: finder(True), lambda: finder(False), lambda: packing._tokens(tokenizer_path(), 1, 4096, ["doc_id"])],
    ids=["signer", "set_maker", "clean", "rows", "tokens"],
)
def test_a_task_holds_little_beside_its_batch(batch, make):
    rows = []
    run = make()
    assert held(lambda: rows.extend(part.num_rows for part in run(iter([batch])))) < 32
    assert sum(rows) in (0, batch.num_rows)  # no text matches an item; all others give a row


def test_the_vocabulary_is_not_taken_apart():
    assert held(lambda: packing._Encoder(tokenizer_path())) < 2


def test_packing_sends_its_tables_as_arrow(spark, monkeypatch):
    sent, plain = [], type(spark).createDataFrame
    docs = plain(spark, [(1, "some words"), (2, None), (2, None), (None, "other words here")], "doc_id long, text string")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: sent.append(type(data)) or plain(self, data, *a, **k))
    found = packing.pack(docs, tokenizer_path()).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "2", "2", "None"]
    assert sorted(r["offset"] for r in found)[0] == 0 and {r["sequence_id"] for r in found} == {0}
    assert packing.pack(docs.limit(0), tokenizer_path()).collect() == []
    assert set(sent) == {pa.Table}
