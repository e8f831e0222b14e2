"""Benchmark decontamination: q-gram lemma filter in diagonal bands, banded alignment to verify.

Every window of an item is looked for, whatever byte it starts at. A place that matches a window of
m bytes with at most e edits shares at least m - q + 1 - q * e of its q-grams, and these lie on at
most e + 1 neighbouring diagonals. Diagonals of an item are dealt into overlapping bands of
2 * (e + 1), so that one band holds them all; a window slides over the shared q-grams of a band, and
where it holds enough of them it is aligned within the band, and kept if the edits fit.

Texts and items are compared with ASCII and Latin-1 letters lower-cased and everything that is not
a letter, a digit or outside ASCII taken as one blank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.scale import measured_bytes

#: Items below SHORTEST bytes are compared without edits, those below Q only with whole texts.
Q, WINDOW, SHORTEST = 8, 96, 24
EDIT_PERCENT = 10
BLOCK_BYTES = 8 << 20
#: Bytes of text that a task takes at once; their q-grams take some 40 times as much.
PORTION = 1 << 18
_BITS = 20
_SALT = np.uint64(0x9E3779B97F4A7C15)

PLAIN = np.full(256, 0x20, np.uint8)
PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
PLAIN[0x80:] = np.arange(0x80, 0x100)


def plain(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compared bytes, their bounds, and the original place of each."""
    out = PLAIN[data]
    if len(out):
        after = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[after] += 0x20
    blank = out == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[bounds[:-1][bounds[:-1] < len(out)]] = True
    place = np.flatnonzero(keep)
    return out[place], np.searchsorted(place, bounds), place


def codes_of(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q-gram of at most 8 bytes that starts at each byte as one number, by doubling."""
    code = np.r_[data, np.zeros(8 - q, np.uint8)].astype(np.uint64)
    for half in (1, 2, 4):
        code = code[:-half] << np.uint64(8 * half) | code[half:] if len(code) > half else code[:0]
    return code >> np.uint64(8 * (8 - q))


def _edits(size: int) -> int:
    return size * EDIT_PERCENT // 100 if size >= SHORTEST else 0


def _needed(size: int, q: int) -> int:
    """q-grams that a place must share with a window of this size."""
    return size - q + 1 - q * _edits(size)


def indexes(ids: list, texts: list[str]) -> list[Index]:
    """Items by the longest q-gram that the lemma vouches for, at most Q bytes; tiny ones apart."""
    data, bounds = bytesnp.raw(pa.array(texts, pa.string()))
    data, bounds, _ = plain(data, bounds)
    groups: dict[int, list] = {}
    for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        body = data[lo:hi].tobytes()
        if len(body.strip()) < SHORTEST:
            body = body.strip()
        if body:
            size = min(len(body), WINDOW)
            q = next((q for q in range(Q, 1, -1) if _needed(size, q) > 0), Q) if size >= Q else 0
            groups.setdefault(q, []).append((ids[k], body))
    return [Index(q, *zip(*items, strict=True)) for q, items in sorted(groups.items())]


class Index:
    """The q-grams of items; with q = 0 the items are only compared with whole texts."""

    def __init__(self, q: int, ids: tuple, bodies: tuple[bytes, ...]):
        self.q, self.item = q, list(ids)
        self.length = np.array([len(b) for b in bodies], np.int64)
        self.base = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(bodies), np.uint8)
        self.size = np.minimum(self.length, WINDOW)
        self.edits = np.array([_edits(n) for n in self.size.tolist()], np.int64)
        if not q:
            self.whole: dict[bytes, list[int]] = {}
            for k, body in enumerate(bodies):
                self.whole.setdefault(body, []).append(k)
            return
        self.need = self.size - q + 1 - q * self.edits
        code = codes_of(self.data, q)
        item = np.repeat(np.arange(len(bodies)), self.length)[: len(code)]
        offset = np.arange(len(code)) - self.base[item]
        inner = np.flatnonzero(offset + q <= self.length[item])
        order = inner[np.argsort(code[inner], kind="stable")]
        self.code, self.first, self.times = np.unique(code[order], return_index=True, return_counts=True)
        self.of, self.offset = item[order].astype(np.int32), offset[order].astype(np.int32)
        self.marked = np.zeros(1 << _BITS, bool)
        self.marked[self.code * _SALT >> np.uint64(64 - _BITS)] = True

    def hits(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, item, offset) of every shared q-gram that has enough others around it."""
        code = codes_of(data, self.q)
        none = np.zeros(0, np.int64)
        if not len(self.code) or not len(code):
            return none, none, none
        place = np.flatnonzero(self.marked[code * _SALT >> np.uint64(64 - _BITS)])
        at = np.searchsorted(self.code, code[place])
        at[at == len(self.code)] = 0
        same = self.code[at] == code[place]
        place, at = place[same], at[same]
        reach = int((self.size + self.edits).max())
        shared = np.zeros(len(code) + 2 * reach + 1, np.int32)
        shared[place + reach + 1] = 1
        shared = np.cumsum(shared, dtype=np.int32)  # shared q-grams before each place, padded by the reach
        around = shared[place + 2 * reach + 1] - shared[place]
        near = around >= self.need.min()
        place, at, around = place[near], at[near], around[near]
        times = self.times[at]
        entry = np.repeat(self.first[at] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum()) if len(at) else none
        place, item, offset = np.repeat(place.astype(np.int32), times), self.of[entry], self.offset[entry]
        enough = np.repeat(around, times) >= self.need[item]
        return place[enough], item[enough], offset[enough]


def matches(index: Index, data: np.ndarray, bounds: np.ndarray):
    """(text, item, first, end, edits) of verified windows; first and end are places in ``data``."""
    if not index.q:
        return _whole_texts(index, data, bounds)
    place, item, offset = index.hits(data)
    none = np.zeros(0, np.int64)
    if not len(place):
        return none, none, none, none, none
    step = (index.edits + 1).astype(np.int32)[item]
    band = (place - offset) // step
    # each diagonal lies in two overlapping bands; a table of hashed bands drops most of those that
    # cannot reach their count, before anything is sorted
    need = index.need[item]
    kept = []
    for shift in (0, 1):
        slot = ((item.astype(np.int64) << 32) + (band - shift)).view(np.uint64) * _SALT >> np.uint64(64 - _BITS)
        slot = slot.view(np.int64)
        full = np.flatnonzero(np.bincount(slot, minlength=1 << _BITS)[slot] >= need)
        kept.append((band[full] - shift, item[full], offset[full], place[full]))
    band, item, offset, place = (np.concatenate(x).astype(np.int64) for x in zip(*kept, strict=True))
    text = bytesnp.owner(bounds, place)
    whole = place + index.q <= bounds[text + 1]
    band, item, offset, text = band[whole], item[whole], offset[whole], text[whole]
    order = np.lexsort((offset, band, item, text))
    band, item, offset, text = band[order], item[order], offset[order], text[order]
    new = np.ones(len(band), bool)
    new[1:] = (band[1:] != band[:-1]) | (item[1:] != item[:-1]) | (text[1:] != text[:-1])
    fresh = new.copy()
    fresh[1:] |= offset[1:] != offset[:-1]
    group = np.cumsum(new)[fresh]
    band, item, offset, text = band[fresh], item[fresh], offset[fresh], text[fresh]
    some, start = _starts(index, group, item, offset)
    if not len(some):
        return none, none, none, none, none
    text, item, band = text[some], item[some], band[some]
    order = list(_by_size(index, item))
    ends, edits = (np.concatenate(x) for x in zip(*(align(index, data, bounds, text[s], item[s], start[s], band[s]) for s in order), strict=True))
    order = np.concatenate(order)
    fits = edits <= index.edits[item[order]]
    order, ends, edits = order[fits], ends[fits], edits[fits]
    # the two bands of a diagonal find the same place
    text, item, start, ends, edits = np.unique(np.stack([text[order], item[order], start[order], ends, edits]), axis=1)
    first = np.maximum(ends - index.size[item], bounds[text])
    ends = np.minimum(ends, bounds[text + 1])
    short = index.size[item] < SHORTEST
    stands = ~short | ~(_joined(data, bounds, text, first) | _joined(data, bounds, text, ends))
    return text[stands], item[stands], first[stands], ends[stands], edits[stands]


def _starts(index: Index, group: np.ndarray, item: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that hold enough shared q-grams of their band: an entry of the band, and the first byte.

    Entries are ascending by band (``group``) and offset. The windows that hold the needed q-grams from
    one entry on are a range of starts; a range begins after the one before it in the band.
    """
    last = np.arange(len(offset)) + index.need[item] - 1
    span = index.size[item] - index.q
    at = np.flatnonzero(last < len(offset))
    at = at[group[last[at]] == group[at]]
    at = at[offset[last[at]] - offset[at] <= span[at]]
    low = np.maximum(offset[last[at]] - span[at], 0)
    high = np.minimum(offset[at], (index.length - index.size)[item[at]])
    after = group[at[1:]] == group[at[:-1]]
    low[1:] = np.where(after, np.maximum(low[1:], high[:-1] + 1), low[1:])
    times = np.maximum(high - low + 1, 0)
    return np.repeat(at, times), np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())


def _joined(data: np.ndarray, bounds: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Does an ASCII word of the text go on over the place?"""
    inner = (at > bounds[text]) & (at < bounds[text + 1])
    word = (data != 0x20) & (data < 0x80)
    at = np.where(inner, at, 1)
    return inner & word[at - 1] & word[np.minimum(at, len(data) - 1)]


def _whole_texts(index: Index, data: np.ndarray, bounds: np.ndarray):
    """The texts that are nothing but an item, blanks around it aside."""
    found = []
    for k in np.flatnonzero(np.diff(bounds) < Q + 2).tolist():
        body = data[bounds[k] : bounds[k + 1]].tobytes()
        first = bounds[k] + len(body) - len(body.lstrip())
        found += [(k, i, first, first + len(body.strip()), 0) for i in index.whole.get(body.strip(), [])]
    return tuple(np.array(found, np.int64).reshape(-1, 5).T)


def _by_size(index: Index, item: np.ndarray) -> Iterator[np.ndarray]:
    """Candidates of one window size together, some thousands at a time."""
    for size in np.unique(index.size[item]):
        some = np.flatnonzero(index.size[item] == size)
        for lo in range(0, len(some), 4096):
            yield some[lo : lo + 4096]


def align(index: Index, data: np.ndarray, bounds: np.ndarray, text: np.ndarray, item: np.ndarray, start: np.ndarray, band: np.ndarray):
    """Least edits of whole windows against the text within each band, and where the best one ends."""
    size, edits = int(index.size[item[0]]), int(index.edits[item[0]])
    step = edits + 1
    width = 2 * step
    low = band * step + start  # where the window starts on the band's first diagonal
    column = np.arange(width)
    body = index.base[item] + start
    lower, upper = bounds[text][:, None], bounds[text + 1][:, None]
    cost = np.zeros((len(band), width), np.int32)
    for i in range(size):
        at = low[:, None] + i + column
        inside = (at >= lower) & (at < upper)
        letter = data[np.clip(at, 0, len(data) - 1)]
        wrong = (letter != index.data[body + i][:, None]) | ~inside
        new = cost + wrong
        new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(new - column, axis=1) + column
    best = cost.argmin(axis=1)
    return low + size + best, cost[np.arange(len(band)), best]


def _finder(tables, only_clean: bool):
    built: list[list[Index]] = []

    def found(data, bounds):
        """Original places of the compared bytes, and the matches of each index."""
        if not built:
            built.append(indexes(*tables.value[:2]))
        body, limits, place = plain(data, bounds)
        return place, [(index, *matches(index, body, limits)) for index in built[0]]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, "text", PORTION):
            keep = np.ones(part.num_rows, bool)
            for _, text, *_ in found(data, bounds)[1]:
                keep[text] = False
            yield part.filter(pa.array(keep))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, "text", PORTION):
            place, some = found(data, bounds)
            if not any(len(text) for _, text, *_ in some):
                continue
            points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # code points before each byte
            text, first, end, edits = (np.concatenate([x[k] for x in some]) for k in (1, 3, 4, 5))
            start = points[place[np.minimum(first, len(place) - 1)]] - points[bounds[text]]
            stop = points[place[end - 1] + 1] - points[bounds[text]]
            table = pa.table(
                {
                    "row": pa.array(text),
                    "item_id": pa.array([x[0].item[k] for x in some for k in x[2]], tables.value[2]),
                    "start": pa.array(start, pa.int64()),
                    "end": pa.array(stop, pa.int64()),
                    "edits": pa.array(edits, pa.int64()),
                }
            )
            table = table.group_by(["row", "item_id"]).aggregate(
                [("start", "min"), ("end", "max"), ("edits", "min"), ("edits", "count")]
            )
            table = table.append_column("doc_id", pc.take(part.column("doc_id"), table["row"].combine_chunks()))
            table = table.select(["doc_id", "item_id", "start_min", "end_max", "edits_min", "edits_count"])
            yield from table.rename_columns(["doc_id", "item_id", "start", "end", "edits", "n_places"]).combine_chunks().to_batches()

    return clean if only_clean else rows


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """The items as broadcast tables of a checked size; a larger benchmark goes in several blocks."""
    items = benchmark.select(F.col(item_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    items = items.select("text", "id").distinct()
    count = max(1, math.ceil(measured_bytes(items) / BLOCK_BYTES))
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k).orderBy("id", "text").toArrow()
        yield benchmark.sparkSession.sparkContext.broadcast((block["id"].to_pylist(), block["text"].to_pylist(), block["id"].type))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start, end, edits, n_places) for every row and item that match.

    A row matches an item if any 96 bytes of the item, from whatever byte on (all of it if shorter),
    stand in the text with at most one edit in ten bytes. ``start`` and ``end`` (code points, as far
    as the edit budget is exact) hold the first and last place, ``edits`` the least edits of a window,
    ``n_places`` how many windows and ends were found. Items below 24 compared bytes must stand in the
    text as they are, as words of their own; those below 8, single words mostly, must be the whole
    text. Null and empty texts match nothing; null ids are kept as they are. A repeated row gives its own rows; repeated
    items count once. No rows on either side give none. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {benchmark.schema[item_col].dataType.simpleString()}, start long, end long, edits long, n_places long"
    parts = [docs.mapInArrow(_finder(t, False), schema) for t in _blocks(benchmark, item_col, item_text_col)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns; the text in ``text``) that match no item of the benchmark."""
    for t in _blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(_finder(t, True), docs.schema)
    return docs
