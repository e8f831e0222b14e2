"""Repeated byte strings across a corpus: a common-prefix interval tree over suffix arrays.

A string of ``length`` bytes that stands twice has the same least k-gram hash at both places. Each
text is therefore cut into blocks, runs of string starts with the same least hash; equal strings
lie in blocks with equal keys, so blocks with a key of their own are done with. Blocks that are
equal as a whole are repeated throughout and are settled by counting. For the others, one copy of
each distinct block is brought together by key, and an enhanced suffix array is built over them:
sorted suffixes, common prefixes with the neighbour, and a stack scan for the intervals of the
common-prefix tree. An interval whose occurrences have different left neighbours is a maximal
repeat; it is reported with all its occurrences.

Keys with more distinct blocks than one task should hold go another exact way: their strings are
counted by hash, which Spark spreads over all tasks.

Passages of fewer bytes than that are told the same way, with words in place of bytes: strings of
``passage`` words that also stand in another document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.llm.common import small
from feedlake.scale import materialise

LENGTH, GRAM = 400, 32
PASSAGE, PASSAGE_GRAM = 50, 12
HOT_BLOCKS = 4000
CHUNK = 1 << 20


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def words_of(data: np.ndarray, bounds: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each text's first word (one more entry for the end)."""
    starts, ends = bytesnp.spans_of(~bytesnp.SPACE[data], bounds)
    return bytesnp.span_hashes(prefix, starts, ends), np.searchsorted(starts, bounds)


def blocks_of(prefix: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """(text, key, hash, first, last, again) of every block; starts count from the text's start.

    ``again`` says that the key's k-gram stands in the block more than once, so that the block may
    hold one string twice.
    """
    none = [np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, bool)]
    if len(prefix) <= length:
        return none
    at = np.arange(len(prefix) - gram)
    grams = bytesnp.span_hashes(prefix, at, at + gram)
    least = sliding_least(grams, length - gram + 1)
    text = bytesnp.owner(bounds, np.arange(len(least)))
    valid = bounds[1:][text] >= np.arange(len(least)) + length
    new = valid.copy()
    new[1:] &= ~(valid[:-1] & (least[1:] == least[:-1]) & (text[1:] == text[:-1]))
    first = np.flatnonzero(new)
    if not len(first):
        return none
    end = np.ones(len(valid), bool)
    end[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(end & valid)
    key = least[first]
    # places of the keys' k-grams, to see which stand twice in their block
    keys = np.unique(key)
    table = np.zeros(1 << 20, bool)
    table[keys >> np.uint64(44)] = True
    place = np.flatnonzero(table[grams >> np.uint64(44)])
    which = np.searchsorted(keys, grams[place])
    which[which == len(keys)] = 0
    exact = keys[which] == grams[place]
    spots = np.sort(which[exact] << 40 | place[exact])
    number = np.searchsorted(keys, key) << 40
    again = np.searchsorted(spots, number | (last + length - gram), "right") - np.searchsorted(spots, number | first) > 1
    hashes = bytesnp.span_hashes(prefix, first, last + length)
    of = text[first]
    return of, key, hashes, first - bounds[of], last - bounds[of], again


_BLOCKS = "array<struct<key:long,hash:long,first:long,last:long,again:boolean>>"


def _lists(blocks, n: int) -> pa.ListArray:
    """The blocks of n texts as one list each."""
    of, key, hashes, first, last, again = blocks
    columns = [key.view(np.int64), hashes.view(np.int64), first, last, again]
    rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["key", "hash", "first", "last", "again"])
    return pa.ListArray.from_arrays(np.searchsorted(of, np.arange(n + 1)).astype(np.int32), rows)


def _blocker(length: int, gram: int, passage: int, passage_gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, "text"):
            prefix = bytesnp.prefix_hashes(data)
            words, word_bounds = words_of(data, bounds, prefix)
            word_prefix = bytesnp.sequence_hashes(words)
            body = data.tobytes()
            whole = [hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("doc_id", "t1", "t2")),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(whole),
                    _lists(blocks_of(prefix, bounds, length, gram), part.num_rows),
                    _lists(blocks_of(word_prefix, word_bounds, passage, passage_gram), part.num_rows),
                ],
                ["doc_id", "t1", "t2", "n_bytes", "sha256", "blocks", "passages"],
            )

    return run


def suffix_array(symbols: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and each one's common prefix with the one before it; prefixes shorter than
    ``least`` may be given too short.

    Prefix doubling from as many symbols as fit into one number; a rank is the first place of its
    group, so that only groups of several suffixes are sorted again. The ranks of all sizes are kept
    for the prefixes. The last symbol is unique, so suffixes of one group never end inside it.
    """
    n = len(symbols)
    bits = int(symbols.max()).bit_length()
    start = size = 62 // bits
    padded = np.r_[symbols, np.zeros(size, np.int64)]
    key = np.zeros(n, np.int64)
    for j in range(size):
        key = key << bits | padded[j : j + n]
    order, at, rank, ranks = np.arange(n), np.arange(n), np.zeros(n, np.int32), []
    common = np.zeros(n, np.int64)  # at first the last size at which the two were of one group
    while True:
        by = np.argsort(key)
        order[at], key = order[at][by], key[by]
        new = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        ranks.append((size, rank))
        common[at[~new]] = size
        at = at[~(new & np.r_[new[1:], True])]
        if not len(at):
            break
        key = rank[order[at]].astype(np.int64) * n + rank[order[at] + size]
        size *= 2
    far = np.flatnonzero(2 * np.maximum(common, start) > least)
    far = far[far > 0]
    same = common[far]
    left, right, stop = order[far - 1] + same, order[far] + same, same.copy()
    for size, rank in reversed(ranks):
        inside = (stop > size) & (np.maximum(left, right) < n)
        at = np.flatnonzero(inside)
        at = at[rank[left[at]] == rank[right[at]]]
        for places in (same, left, right):
            places[at] += size
    at = np.arange(len(far))
    for _ in range(start - 1):  # what is left is shorter than the first size
        at = at[padded[left[at]] == padded[right[at]]]
        for places in (same, left, right):
            places[at] += 1
    common[far] = same
    return order, common


def maximal_repeats(order: np.ndarray, common: np.ndarray, before: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(size, occurrences) of every interval of the common-prefix tree of at least ``length`` symbols
    whose occurrences have different left neighbours.

    ``before`` holds each position's left neighbour; negative ones differ from all others.
    """
    high = np.flatnonzero(common >= length)
    if not len(high):
        return
    breaks = np.flatnonzero(np.diff(high) > 1)
    left = before[order]
    differs = np.ones(len(order), np.int64)
    differs[1:] = (left[1:] != left[:-1]) | (left[1:] < 0)
    changes = np.cumsum(differs)  # changes[j] - changes[i] > 0: not all alike from i to j
    for lo, hi in zip(high[np.r_[0, breaks + 1]], high[np.r_[breaks, len(high) - 1]], strict=True):
        stack = []  # (size, first place in the suffix array)
        for i in range(lo, hi + 2):
            size = int(common[i]) if i <= hi else 0
            start = i - 1
            while stack and stack[-1][0] > size:
                depth, start = stack.pop()
                if changes[i - 1] > changes[start]:
                    yield depth, order[start:i]
            if size >= length and (not stack or stack[-1][0] < size):
                stack.append((size, start))


def repeats_in(segments: list, length: int, base: int = 256, documents: np.ndarray | None = None) -> list[np.ndarray]:
    """For each segment the (start, end) spans of maximal repeats of at least ``length`` symbols that
    stand in it and anywhere else in the segments, or twice in it.

    Segments are bytes, or arrays of symbols below ``base``. With ``documents``, the number of each
    segment's document, only repeats that several documents hold count; -1 stands for several.
    """
    sizes = np.array([len(s) for s in segments])
    starts = np.r_[0, np.cumsum(sizes + 1)]
    symbols = np.empty(starts[-1], np.int64)
    for k, (at, s) in enumerate(zip(starts, segments, strict=False)):
        symbols[at : at + len(s)] = np.frombuffer(s, np.uint8) if isinstance(s, bytes) else s
        symbols[at + len(s)] = base + k
    order, common = suffix_array(symbols, length)
    before = np.r_[-1, symbols[:-1]]
    before[starts[:-1]] = -1
    holder = None if documents is None else np.repeat(documents, sizes + 1)
    cover = np.zeros(len(symbols) + 1, np.int64)
    for size, places in maximal_repeats(order, common, before, length):
        if holder is not None:
            held = holder[places]
            if held.min() >= 0 and (held == held[0]).all():
                continue
        np.add.at(cover, places, 1)
        np.add.at(cover, places + size, -1)
    inside = np.cumsum(cover[:-1]) > 0
    inside[starts[1:] - 1] = False
    first, last = bytesnp.spans_of(inside, starts)
    of = bytesnp.owner(starts, first)
    out = np.stack([first - starts[of], last - starts[of]], axis=1)
    return np.split(out, np.searchsorted(of, np.arange(1, len(segments))))


_SEGMENT = "words boolean, key long, n long, hot boolean, t1 long, t2 long, first long, segment binary"
_SPAN = "t1 long, t2 long, start long, end long"


def _cutter(length: int, passage: int):
    """The bytes of the wanted blocks of each text, or the hashes of their words."""
    names = ["words", "key", "n", "hot", "t1", "t2", "first", "segment"]
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 3, pa.binary()]

    def cut(part, column: str, body: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
        wanted = part.column(column)
        of = np.repeat(np.arange(part.num_rows), np.asarray(wanted.value_lengths()))
        flat = wanted.flatten()
        keys, place = np.asarray(flat.field("key")), np.asarray(flat.field("place"))
        first = (place.view(np.uint64) >> np.uint64(33)).astype(np.int64)
        size = (place >> 2 & (1 << 31) - 1) + length
        sizes = np.r_[0, np.cumsum(size * body.itemsize)]
        t1, t2 = (np.asarray(part.column(c)) for c in ("t1", "t2"))
        lo = 0
        while lo < len(of):
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + 4 * CHUNK, "right")) - 1)
            at = bounds[of[lo:hi]] + first[lo:hi]
            segments = [body[a : a + n].tobytes() for a, n in zip(at, size[lo:hi], strict=True)]
            flags = place[lo:hi]
            rows = [np.full(hi - lo, column == "passages"), keys[lo:hi], 1 + (flags & 1), flags & 2 > 0, t1[of[lo:hi]], t2[of[lo:hi]], first[lo:hi], segments]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], names)
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, "text"):
            yield from cut(part, "strings", data, bounds, length)
            if part.column("passages").flatten():
                yield from cut(part, "passages", *words_of(data, bounds, bytesnp.prefix_hashes(data)), passage)

    return run


def _by_bytes(rows: list[dict], length: int) -> list[np.ndarray]:
    return repeats_in([r["segment"] for r in rows], length)


def _by_words(rows: list[dict], length: int) -> list[np.ndarray]:
    segments = [np.frombuffer(r["segment"], np.int64) for r in rows]
    kinds, numbers = np.unique(np.concatenate(segments), return_inverse=True)
    segments = np.split(numbers, np.cumsum([len(s) for s in segments])[:-1])
    documents = np.unique([r["t1"] for r in rows], return_inverse=True)[1]
    documents[[r["n"] > 1 for r in rows]] = -1
    return repeats_in(segments, length, len(kinds), documents)


def _scanner(length: int, repeats):
    """Maximal repeats among the segments of each key; whole keys, about ``CHUNK`` bytes at a time."""

    def scan(rows: list[dict]) -> pa.RecordBatch:
        t1, t2, start, end = [], [], [], []
        for row, spans in zip(rows, repeats(rows, length), strict=True):
            if row["n"] == 1:
                for a, b in spans:
                    t1.append(row["t1"])
                    t2.append(row["t2"])
                    start.append(row["first"] + int(a))
                    end.append(row["first"] + int(b))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (t1, t2, start, end)], ["t1", "t2", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > CHUNK and row["key"] != rows[-1]["key"]:
                    yield scan(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row["segment"])
        if rows:
            yield scan(rows)

    return run


def _windows(length: int, prefix_of):
    """Every string of a hot key's segments as its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                prefix = prefix_of(r["segment"])
                at = np.arange(len(prefix) - length)
                hashes = bytesnp.span_hashes(prefix, at, at + length).view(np.int64)
                same = lambda v: pa.array(np.full(len(at), v), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [same(r["key"]), same(r["n"]), same(r["t1"]), same(r["t2"]), pa.array(at + r["first"], pa.int64()), pa.array(hashes)],
                    ["key", "n", "t1", "t2", "start", "hash"],
                )

    return run


def _merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(t1, t2, n_removed, n_spans, spans) of spans in the order of their texts and starts, joined where they
    touch. A text's spans may go on in the next batch."""

    def told(t1, t2, start, end) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])])
        of = np.searchsorted(first, np.arange(len(start)), "right") - 1
        rows = pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"])
        columns = [t1[first], t2[first], np.bincount(of, end - start).astype(np.int64), np.bincount(of)]
        lists = pa.ListArray.from_arrays(np.r_[first, len(start)].astype(np.int32), rows)
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), lists], ["t1", "t2", "n_removed", "n_spans", "spans"])

    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.asarray(batch.column(c)) for c in ("t1", "t2", "start", "end")]
        t1, t2, start, end = rows if kept is None else map(np.concatenate, zip(kept, rows, strict=True))
        new = np.r_[True, (t1[1:] != t1[:-1]) | (t2[1:] != t2[:-1])]
        text = np.cumsum(new) << 40  # a span of the next text starts beyond all ends of this one
        reach = np.maximum.accumulate(end + text)
        first = np.flatnonzero(np.r_[True, (start + text)[1:] > reach[:-1]])
        end = (reach - text)[np.r_[first[1:] - 1, len(reach) - 1]]
        t1, t2, start = t1[first], t2[first], start[first]
        open_at = np.flatnonzero(new[first])[-1]  # the last text's spans
        kept = [c[open_at:] for c in (t1, t2, start, end)]
        if open_at:
            yield told(*(c[:open_at] for c in (t1, t2, start, end)))
    if kept is not None:
        yield told(*kept)


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of what stays of each text."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            out = []
            for text, spans in zip(part.column("text"), part.column("spans").to_pylist(), strict=True):
                body, at, digest = (text.as_py() or "").encode(), 0, hashlib.sha256()
                for s in spans:
                    digest.update(body[at : s["start"]])
                    at = s["end"]
                digest.update(body[at:])
                out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("t1"), part.column("t2"), pa.array(out)], ["t1", "t2", "rest"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.withColumns({"t1": F.xxhash64("doc_id", "text"), "t2": F.xxhash64("text", F.lit(1), "doc_id")})


def _joined(spans: DataFrame) -> DataFrame:
    """Spans of each text, joined where they touch."""
    ordered = spans.repartition("t1", "t2").sortWithinPartitions("t1", "t2", "start")
    return ordered.mapInArrow(_merger, "t1 long, t2 long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>")


_STRING = "key long, n long, t1 long, t2 long, start long, hash long"


def _wanted(blocks: DataFrame, several: Column) -> DataFrame:
    """(t1, t2, w): the one copy to look into of each block, its place and flags in one number (texts are
    shorter than 2**31 bytes)."""
    flags = F.shiftleft(F.col("hot").cast("long"), 1).bitwiseOR(several.cast("long"))
    place = F.shiftleft("first", 33).bitwiseOR(F.shiftleft("size", 2)).bitwiseOR(flags)
    return blocks.select("t1", "t2", F.struct("key", place.alias("place")).alias("w"))


def _string_blocks(cut: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Spans of blocks that stand twice as a whole, and one copy of each block still to look into."""
    rows = cut.select("t1", "t2", F.inline("blocks"))
    distinct = materialise(
        rows.groupBy("key", "hash").agg(
            F.count("*").alias("n"),
            F.max(F.col("again").cast("int")).alias("again"),
            F.min("t1").alias("t1"),
            F.min_by("t2", "t1").alias("t2"),
            F.min_by("first", "t1").alias("first"),
            F.max(F.col("last") - F.col("first")).alias("size"),
        )
    )
    counted = rows.join(distinct.where("n > 1").select("key", "hash"), ["key", "hash"]).select(
        "t1", "t2", F.col("first").alias("start"), (F.col("last") + length).alias("end")
    )
    keys = distinct.groupBy("key").agg(F.count("*").alias("d"), F.count_if(F.col("n") == 1).alias("single"), F.max("again").alias("again"))
    keys = keys.where("single > 0 and (d > 1 or again > 0)").select("key", (F.col("d") > HOT_BLOCKS).alias("hot"))
    return counted, _wanted(distinct.join(keys, "key"), F.col("n") > 1)


def _passage_blocks(cut: DataFrame, passage: int) -> tuple[DataFrame, DataFrame]:
    """The same of blocks of words, which count where several documents hold them."""
    rows = cut.select("t1", "t2", F.inline("passages")).drop("again")
    distinct = materialise(
        rows.groupBy("key", "hash").agg(
            F.min("t1").alias("t1"),
            F.max("t1").alias("other"),
            F.min_by("t2", "t1").alias("t2"),
            F.min_by("first", "t1").alias("first"),
            F.max(F.col("last") - F.col("first")).alias("size"),
        )
    )
    counted = rows.join(distinct.where("t1 < other").select("key", "hash"), ["key", "hash"]).select(
        "t1", "t2", F.col("first").alias("start"), (F.col("last") + passage).alias("end")
    )
    keys = distinct.groupBy("key").agg(
        F.count("*").alias("d"),
        F.min("t1").alias("least"),
        F.max("other").alias("most"),
        F.count_if(F.col("t1") == F.col("other")).alias("single"),
    )
    keys = keys.where("single > 0 and d > 1 and least < most").select("key", (F.col("d") > HOT_BLOCKS).alias("hot"))
    return counted, _wanted(distinct.join(keys, "key"), F.col("t1") < F.col("other"))


def _byte_prefix(segment: bytes) -> np.ndarray:
    return bytesnp.prefix_hashes(np.frombuffer(segment, np.uint8))


def _word_prefix(segment: bytes) -> np.ndarray:
    return bytesnp.sequence_hashes(np.frombuffer(segment, np.uint64))


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, passage: int = PASSAGE, passage_gram: int = PASSAGE_GRAM
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of keyed documents: (doc_id, t1, t2, n_bytes, sha256) per row, and per t1, t2 the merged spans
    of repeated bytes and those, in words, of passages that another document holds too."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, t1 long, t2 long, n_bytes long, sha256 string, blocks {_BLOCKS}, passages {_BLOCKS}"
    cut = materialise(docs.mapInArrow(_blocker(length, gram, passage, passage_gram), schema))
    counted, wanted = _string_blocks(cut, length)
    counted_words, wanted_words = _passage_blocks(cut, passage)
    both = wanted.withColumn("words", F.lit(False)).unionByName(wanted_words.withColumn("words", F.lit(True)))
    wanted = both.groupBy("t1", "t2").agg(
        F.collect_list(F.when(~F.col("words"), F.col("w"))).alias("strings"),
        F.collect_list(F.when(F.col("words"), F.col("w"))).alias("passages"),
    )
    texts = docs.select("t1", "t2", "text").join(small(materialise(wanted)), ["t1", "t2"])
    segments = materialise(texts.mapInArrow(_cutter(length, passage), _SEGMENT))

    def scanned(words: bool, size: int, repeats) -> DataFrame:
        some = segments.where(~F.col("hot") & (F.col("words") == words))
        return some.repartition("key").sortWithinPartitions("key").mapInArrow(_scanner(size, repeats), _SPAN)

    def hot(words: bool, size: int, prefix_of, often: Column) -> DataFrame:
        some = segments.where(F.col("hot") & (F.col("words") == words))
        strings = some.mapInArrow(_windows(size, prefix_of), _STRING)
        kept = strings.groupBy("key", "hash").agg(often.alias("often")).where("often").select("key", "hash")
        return strings.where("n = 1").join(kept, ["key", "hash"]).select("t1", "t2", "start", (F.col("start") + size).alias("end"))

    spans = counted.unionByName(scanned(False, length, _by_bytes)).unionByName(hot(False, length, _byte_prefix, F.sum("n") > 1))
    several = (F.max("n") > 1) | (F.min("t1") < F.max("t1"))
    shared = counted_words.unionByName(scanned(True, passage, _by_words)).unionByName(hot(True, passage, _word_prefix, several))
    return cut.drop("blocks", "passages"), materialise(_joined(spans)), _joined(shared)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    passage: int = PASSAGE,
    passage_gram: int = PASSAGE_GRAM,
) -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared_words).

    Every byte of a text that lies in a string of ``length`` UTF-8 bytes which also starts anywhere
    else, in the same text or another, is removed; n_spans counts the maximal removed runs. A null
    text is empty. Texts shorter than ``length`` lose nothing. Repeated rows are repeats of each
    other, so both are removed whole if long enough. Ids may be null. Other columns are not read.

    n_shared_words counts the words, split at the six ASCII blanks, in strings of ``passage`` words
    that also stand in a document of another id or text; nothing is removed for it.
    """
    docs = _keyed(docs, id_col, text_col)
    rows, spans, shared = repeated_spans(docs, length, gram, passage, passage_gram)
    shared = shared.select("t1", "t2", F.col("n_removed").alias("n_shared_words"))
    told = rows.join(spans.select("t1", "t2", "n_removed", "n_spans"), ["t1", "t2"], "left").join(shared, ["t1", "t2"], "left")
    told = materialise(told.fillna(0, ["n_removed", "n_spans", "n_shared_words"]))
    partly = told.where("n_removed > 0 and n_removed < n_bytes").select("t1", "t2").distinct()
    partly = spans.join(partly, ["t1", "t2"], "left_semi").select("t1", "t2", "spans")
    rest = (
        docs.select("t1", "t2", "text")
        .join(small(partly), ["t1", "t2"])
        .mapInArrow(_rest, "t1 long, t2 long, rest string")
        .dropDuplicates(["t1", "t2"])
    )
    empty = hashlib.sha256(b"").hexdigest()
    return told.join(rest, ["t1", "t2"], "left").select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.when(F.col("n_removed") == 0, F.col("sha256"))
        .when(F.col("n_removed") == F.col("n_bytes"), F.lit(empty))
        .otherwise(F.col("rest"))
        .alias("kept_sha256"),
        "n_shared_words",
    )
