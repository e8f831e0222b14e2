"""Language-model scores: prediction by partial matching over byte contexts, pretrained.

The trie holds, for every context of up to ``ORDER`` bytes, how often each byte followed it in the
learning texts. A byte is coded from the longest context on: with count / (n + q) where the context
has seen it, else the escape q / (n + q) leads to the next shorter context, in which the symbols of
the longer one are excluded; n counts followers and q distinct ones, both after exclusion. Below the
empty context all symbols not yet excluded are alike. The end of a text is a symbol of its own
(0xFF, which UTF-8 never holds); a text begins after ``ORDER`` newlines.

The trie is a table of n-grams that Spark counts. Its probabilities are worked out per last two
context bytes, where all longer contexts lie together; the two shortest orders have 65,792 entries
at most. Texts then look their bytes up. The most frequent keys are broadcast, a fixed number of them;
the rest go out as rows and are joined, so nothing that is broadcast grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.scale import materialise

ORDER = 5
HEAD = 1 << 20
GROUPS = 256
#: Distinct keys that a task sums before it hands them over.
HELD = 2_000_000
END = 0xFF
_LOW = [np.int64((1 << 8 * (k + 1)) - 1) for k in range(ORDER + 1)]
WORD, GRAM = 0, 1


def ngrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every symbol with its context, and its text: the context above, the symbol lowest."""
    n_texts = len(bounds) - 1
    size = np.diff(bounds)
    text = np.repeat(np.arange(n_texts), size)
    first = bounds[:-1] + np.arange(n_texts) * (ORDER + 1) + ORDER
    out = np.full(len(data) + n_texts * (ORDER + 1), 0x0A, np.uint8)
    at = np.arange(len(data)) + (first - bounds[:-1])[text]
    out[at] = bytesnp.LOWER[data]
    out[first + size] = END
    code = np.zeros(len(out) - ORDER, np.int64)
    for k in range(ORDER + 1):
        code = code << 8 | out[k : len(out) - ORDER + k]
    coded = np.ones(len(out), bool)
    coded[(first[:, None] - np.arange(1, ORDER + 1)).ravel()] = False
    return code[np.flatnonzero(coded) - ORDER], np.repeat(np.arange(n_texts), size + 1)


def word_keys(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words, text = bytesnp.word_hashes(data, bounds)
    return (words >> np.uint64(1)).view(np.int64), text


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], np.concatenate([t for _, t in parts])[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _counter(learns: str, text: str):
    """(kind, key, n, learnt) of words and n-grams, summed over some portions at a time."""

    def rows(kind: int, parts: list) -> pa.RecordBatch:
        both, times = _summed(parts)
        keys = (both.view(np.uint64) >> np.uint64(1)).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys), pa.array(times), pa.array(times * (both & 1))],
            ["kind", "key", "n", "learnt"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {WORD: [], GRAM: []}
        for part, data, bounds in bytesnp.portions(batches, text):
            learnt = np.array(part.column(learns).to_pylist(), np.int64)
            for kind, keys_of in ((WORD, word_keys), (GRAM, ngrams)):
                keys, own = keys_of(data, bounds)
                held[kind].append(np.unique(keys << 1 | learnt[own], return_counts=True))
                if sum(len(k) for k, _ in held[kind]) > HELD:
                    yield rows(kind, held[kind])
                    held[kind] = []
        for kind, parts in held.items():
            if parts:
                yield rows(kind, parts)

    return run


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in the sorted keys, or their number where it is missing."""
    at = np.searchsorted(keys, wanted)
    hit = np.append(keys, 0)[at] == wanted
    return np.where(hit & (at < len(keys)), at, len(keys))


def _padded(values: np.ndarray) -> np.ndarray:
    return np.append(values, 0.0)


def log_probabilities(codes: np.ndarray, counts: np.ndarray, short: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each n-gram's symbol in its context.

    ``codes`` are distinct and hold every n-gram whose context ends with the same two bytes as one of
    them; ``counts`` how often the learning texts have each. ``short`` are codes of one context byte
    and a symbol, with their counts over the whole corpus.
    """
    total, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
    longer = None
    q = np.zeros(len(codes))
    for k in range(ORDER, -1, -1):
        source, weight = (codes, counts) if k >= 2 else short
        some = weight > 0
        grams, which = np.unique(source[some] & _LOW[k], return_inverse=True)
        count = np.bincount(which, weights=weight[some], minlength=len(grams))
        contexts, context = np.unique(grams >> 8, return_inverse=True)
        here = _find(contexts, (codes & _LOW[k]) >> 8)
        n = _padded(np.bincount(context, weights=count, minlength=len(contexts)))[here]
        all_q = _padded(np.bincount(context, minlength=len(contexts)))
        q = all_q[here]
        q_left = q
        if longer is not None:
            # the symbols that the longer context has seen are excluded, with their counts here
            long_grams, long_context, long_here, long_q = longer
            twice = _padded(count)[_find(grams, long_grams & _LOW[k])]
            n = n - _padded(np.bincount(long_context, weights=twice, minlength=len(long_q) - 1))[long_here]
            q_left = q - long_q[long_here]
        own = _padded(count)[_find(grams, codes & _LOW[k])]
        hit = open_ & (own > 0)
        total[hit] += np.log10(own[hit] / (n + q_left)[hit])
        escape = open_ & (own == 0) & (q_left > 0)
        total[escape] += np.log10(q_left[escape] / (n + q_left)[escape])
        open_ &= ~hit
        longer = grams, context, here, all_q
    total[open_] -= np.log10(256 - q[open_])
    return total


def _prober(short: tuple[np.ndarray, np.ndarray]):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key")
        value = log_probabilities(frame["key"].to_numpy(), frame["learnt"].to_numpy(float), short)
        return frame.assign(value=value)[["kind", "key", "n", "learnt", "value"]]

    return run


class Lookup:
    """Places of 64-bit keys, found by a table of the keys' scrambled low bits."""

    def __init__(self, keys: np.ndarray):
        self.none = len(keys)
        self.mask = np.uint64((1 << max(int(len(keys) * 3).bit_length(), 4)) - 1)
        self.keys = np.append(keys, -1)
        self.slots = np.full(int(self.mask) + 1, self.none, np.int32)
        left = np.arange(len(keys))
        slot = bytesnp.mix(keys.view(np.uint64)) & self.mask
        while len(left):
            free = self.slots[slot] == self.none
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + np.uint64(1)) & self.mask

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted key, or the number of keys where it is missing."""
        slot = bytesnp.mix(wanted.view(np.uint64)) & self.mask
        at = self.slots[slot].astype(np.int64)
        left = np.flatnonzero((self.keys[at] != wanted) & (at < self.none))
        while len(left):
            slot[left] = (slot[left] + np.uint64(1)) & self.mask
            at[left] = self.slots[slot[left]]
            left = left[(self.keys[at[left]] != wanted[left]) & (at[left] < self.none)]
        return at


def _by_text(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring limits."""
    sums = np.add.reduceat(np.append(values, 0.0), limits[:-1]) if len(limits) > 1 else np.zeros(0)
    return np.where(np.diff(limits) > 0, sums, 0.0)


def _scorer(tables, text: str, names: list[str]):
    """Per text: what the head gives, and the keys that it lacks."""
    built = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.extend((Lookup(keys), *map(_padded, values)) for keys, *values in tables.value)
        for part, data, bounds in bytesnp.portions(batches, text):
            n = part.num_rows
            columns = [part.column(c) for c in names]
            for (lookup, *tables_), keys_of in zip(built, (word_keys, ngrams), strict=True):
                keys, own = keys_of(data, bounds)
                at = lookup(keys)
                limits = np.searchsorted(own, np.arange(n + 1))
                columns += [pa.array(np.diff(limits)), *(pa.array(_by_text(t[at], limits)) for t in tables_)]
                missed = np.flatnonzero(at == lookup.none)
                offsets = np.searchsorted(missed, limits).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(keys[missed])))
            yield pa.RecordBatch.from_arrays(
                columns, [*names, "words", "w_score", "w_known", "w_rest", "symbols", "g_score", "g_rest"]
            )

    return run


def _frequent(values: DataFrame, most: int) -> Column:
    """Condition for the most frequent keys, ``most`` at most, from a histogram of 256 classes."""
    level = F.floor(F.log2("n") * 4)
    steps = sorted(((r.level, r.keys) for r in values.groupBy(level.alias("level")).agg(F.count("*").alias("keys")).collect()), reverse=True)
    total, least = 0, 1 << 20
    for step, keys in steps:
        total += keys
        if total > most:
            break
        least = step
    return level >= least


def model_scores(
    docs: DataFrame,
    learns: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    smoothing: float = 0.1,
    head: int = HEAD,
) -> DataFrame:
    """One row per input row: (doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score).

    ``learns`` is a condition on the columns of ``docs``; where it is null the row is not learnt from.
    A null text is empty: one token, the end. Texts are lower-cased (A-Z). ``base_score`` is the
    unigram score over words and one end, with additive smoothing over the distinct tokens and one
    more; ``score`` the model's log10 probability of the text's bytes and its end. With nothing to
    learn from, all tokens have count 0 and all symbols the same probability. Repeated rows count as
    often as they stand and get a row each. Other columns are not read, except by ``learns``. The
    ``head`` most frequent words and n-grams are broadcast, the rest is joined: the result does not
    depend on it.
    """
    docs = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(learns, F.lit(False)).alias("learnt"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    counts = materialise(
        docs.select("learnt", "text")
        .mapInArrow(_counter("learnt", "text"), "kind byte, key long, n long, learnt long")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"), F.sum("learnt").alias("learnt"))
    )
    texts = docs.where("learnt").count()
    words, grams = counts.where(f"kind = {WORD}"), counts.where(f"kind = {GRAM}")
    tokens = words.agg(F.coalesce(F.sum("learnt"), F.lit(0)).alias("n"), F.count_if(F.col("learnt") > 0).alias("v")).first()
    train_tokens, distinct = tokens.n + texts, tokens.v + (texts > 0)
    below = float(train_tokens + smoothing * (distinct + 1))
    words = words.withColumn("value", F.log10((F.col("learnt") + smoothing) / below))

    short = grams.groupBy(F.expr("key & 65535").alias("key")).agg(F.sum("learnt").alias("n")).orderBy("key").toArrow()
    short = short["key"].to_numpy().astype(np.int64), short["n"].to_numpy().astype(float)
    grams = materialise(
        grams.withColumn("group", F.expr(f"pmod(xxhash64(shiftright(key, 8) & 65535), {GROUPS})"))
        .groupBy("group")
        .applyInPandas(_prober(short), "kind byte, key long, n long, learnt long, value double")
    )

    tables = []
    rest = []
    for values in (words, grams):
        often = _frequent(values, head)
        top = values.where(often).select("key", "value", (F.col("learnt") > 0).cast("double").alias("known")).toArrow()
        # whether a symbol is known is asked of words alone
        tables.append([top[c].to_numpy().copy() for c in ("key", "value", "known")[: 3 if values is words else 2]])
        rest.append(values.where(~often).select("key", "value", (F.col("learnt") > 0).cast("long").alias("known")))
    head_tables = spark.sparkContext.broadcast(tables)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = materialise(
        docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "learnt", "text").mapInArrow(
            _scorer(head_tables, "text", ["row", "doc_id", "learnt"]),
            f"row long, doc_id {kind}, learnt boolean, words long, w_score double, w_known double, w_rest array<long>, "
            "symbols long, g_score double, g_rest array<long>",
        )
    )
    parts = []
    for name, values in zip(("w", "g"), rest, strict=True):
        keys = found.select("row", F.explode(f"{name}_rest").alias("key")).join(values, "key")
        zero, double = F.lit(0).cast("long"), F.lit(0.0)
        score, known = (F.col("value"), F.col("known"))
        parts.append(keys.select("row", *((score, known, double) if name == "w" else (double, zero, score))).toDF("row", "w", "k", "g"))
    more = parts[0].unionByName(parts[1]).groupBy("row").agg(F.sum("w").alias("w"), F.sum("k").alias("k"), F.sum("g").alias("g"))
    end = float(np.log10((texts + smoothing) / below))
    zero = F.lit(0)
    return found.join(more, "row", "left").select(
        "doc_id",
        "learnt",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("w_known").cast("long") + F.coalesce("k", zero) + int(texts > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("w_score") + F.coalesce("w", zero) + end).alias("base_score"),
        (F.col("g_score") + F.coalesce("g", zero)).alias("score"),
    )
