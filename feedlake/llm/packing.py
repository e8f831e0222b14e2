"""Best-fit packing: a grouping genetic algorithm over lengths, on islands with migrating elites.

Documents of one length are interchangeable, so a packing is a list of bin patterns (the lengths in
a bin) and how often each is used. There are at most ``capacity`` lengths, which bounds an
individual whatever the number of documents. Bins that best fit fills to the brim are set aside; what
is left open is evolved, as long as it takes more bins than its lengths need. Crossover injects another parent's well-filled bins,
takes out what is then packed twice, and best-fits the displaced lengths into what is left. Each
island is a Spark task with its own population, which it keeps; after every epoch its elites migrate to
the next island. Epochs go on until several of them bring no gain.
Documents then take their places by rank within their length, counted per slice and offset, so no
length, however common, is gathered.
"""

from __future__ import annotations

import json
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.scale import materialise

CAPACITY = 4096
ISLANDS, GENERATIONS, POPULATION, ELITES = 4, 8, 8, 2
#: Epochs without a gain after which the search ends, and the least part of the bins that is a gain.
PATIENCE, GAIN = 3, 0.0005
#: Pieces of one length that are numbered together, and the most such slices besides one a length.
SLICE, SLICES = 500, 50_000
#: Words whose ids a task keeps (some 30 bytes each), parts of words that it keeps, and bytes of text that
#: it takes at once. Beyond its limit a table starts anew.
WORDS, PARTS, PORTION = 500_000, 20_000, 1 << 18

Packing = Counter  # pattern (lengths, descending) -> how many bins


def best_fit(demand: dict[int, int], bins: Packing, capacity: int, noise: np.random.Generator | None = None) -> Packing:
    """Place all lengths, longest first, each into the fullest bin that takes it; open bins as needed.

    Equal bins and equal lengths move together. With ``noise`` the order is disturbed a little.
    """
    room: dict[int, list[list]] = {}  # free space -> [pattern, how many]
    for pattern, times in bins.items():
        room.setdefault(capacity - sum(pattern), []).append([pattern, times])
    free = np.zeros(capacity + 1, np.int64)
    for space, groups in room.items():
        free[space] = sum(g[1] for g in groups)
    order = sorted(demand, reverse=True)
    if noise is not None and order:
        order = [order[i] for i in np.argsort(-np.array(order) * noise.uniform(0.9, 1.0, len(order)))]
    for length in order:
        left = demand[length]
        space = length
        while left:
            spaces = np.flatnonzero(free[space:])
            if not len(spaces):
                each = capacity // length
                full, over = divmod(left, each)
                for pattern, times in (((length,) * each, full), ((length,) * over, 1 if over else 0)):
                    if times:
                        rest = capacity - sum(pattern)
                        room.setdefault(rest, []).append([pattern, times])
                        free[rest] += times
                break
            space += int(spaces[0])
            groups = room[space]
            pattern, times = groups[-1]
            each = min(space // length, left)
            use = min(times, left // each)
            if use == times:
                groups.pop()
            else:
                groups[-1][1] -= use
            free[space] -= use
            left -= use * each
            rest = space - each * length
            room.setdefault(rest, []).append([tuple(sorted(pattern + (length,) * each, reverse=True)), use])
            free[rest] += use
    packed = Packing()
    for groups in room.values():
        for pattern, times in groups:
            packed[pattern] += times
    return packed


def cost(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewest bins first; among equals, the more uneven filling, which leaves room to improve."""
    filled = sum(times * (sum(p) / capacity) ** 2 for p, times in packing.items())
    return sum(packing.values()), -filled


def crossover(one: Packing, two: Packing, demand: dict[int, int], capacity: int, random: np.random.Generator) -> Packing:
    """A child of ``one`` with well-filled bins of ``two`` put in whole."""
    full = sorted(two, key=lambda p: (-sum(p), p))
    full = full[: max(1, int(len(full) * random.uniform(0.1, 0.6)))]
    left = dict(demand)
    child = Packing()
    kept = sorted(one, key=lambda p: (-sum(p), p))
    for source, patterns in ((two, full), (one, kept)):
        for pattern in patterns:
            need = Counter(pattern)
            times = min(source[pattern], *(left[n] // k for n, k in need.items()))
            if times:
                child[pattern] += times
                for n, k in need.items():
                    left[n] -= k * times
    return best_fit({n: k for n, k in left.items() if k}, child, capacity, random)


def evolve(population: list[Packing], demand: dict[int, int], capacity: int, seed: int) -> list[Packing]:
    """Some generations on one island, each with as many children as parents; the best come first."""
    random = np.random.default_rng(seed)
    least = -(-sum(n * k for n, k in demand.items()) // capacity)
    while len(population) < POPULATION and sum(population[0].values()) > least:
        population.append(best_fit(demand, Packing(), capacity, random))
    for _ in range(GENERATIONS):
        population.sort(key=lambda p: cost(p, capacity))
        if sum(population[0].values()) <= least:
            break
        for _ in range(len(population)):
            # the better of two, twice
            i, j = (min(random.integers(0, POPULATION, 2)) % len(population) for _ in range(2))
            population.append(crossover(population[i], population[j], demand, capacity, random))
        population = sorted(population, key=lambda p: cost(p, capacity))[:POPULATION]
    return sorted(population, key=lambda p: cost(p, capacity))


def _least(demand: dict[int, int], capacity: int) -> int:
    return -(-sum(n * k for n, k in demand.items()) // capacity)


def _island(demand: dict[int, int], capacity: int, epoch: int, populations):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for island in batch.column("id").to_pylist():
                population = evolve(pickle.loads(populations.value[island]), demand, capacity, 1000 * epoch + island)
                yield pa.RecordBatch.from_arrays([pa.array([island]), pa.array([pickle.dumps(population)])], ["island", "population"])

    return run


def pack_lengths(spark, demand: dict[int, int], capacity: int = CAPACITY) -> Packing:
    """The best packing of all islands; ``demand`` says how many pieces there are of each length."""
    start = best_fit(demand, Packing(), capacity)
    full = Packing({p: n for p, n in start.items() if sum(p) == capacity})
    best, rest = start - full, Counter()
    for pattern, times in best.items():
        for length in pattern:
            rest[length] += times
    least, bins = _least(rest, capacity), sum(best.values())
    populations: list[list[Packing]] = [[best] for _ in range(ISLANDS)]
    epoch = idle = 0
    while idle < PATIENCE and bins > least:  # as few as the open lengths allow
        shipped = spark.sparkContext.broadcast([pickle.dumps(p) for p in populations])
        found = spark.range(0, ISLANDS, 1, ISLANDS).mapInArrow(_island(rest, capacity, epoch, shipped), "island long, population binary").collect()
        shipped.unpersist()
        populations = [pickle.loads(r.population) for r in sorted(found, key=lambda r: r.island)]
        best = min((p[0] for p in populations), key=lambda p: cost(p, capacity))
        now = sum(best.values())
        idle = 0 if now <= bins - max(1, GAIN * now) else idle + 1
        bins = min(bins, now)
        elites = [p[:ELITES] for p in populations]
        populations = [[*p[: POPULATION - ELITES], *elites[k - 1]] for k, p in enumerate(populations)]
        epoch += 1
    return full + best


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Encoder(dict):
    """Ids of each word between blanks as little-endian bytes; parts of words stay for a while.

    A word of ASCII and Latin-1 letters is taken apart here, and each part goes to the vocabulary's
    merges alone; any other word goes through the whole tokenizer. That takes a vocabulary that lower-cases,
    drops white space and cuts words as ``STEPS`` says; with any other one ``plain`` is false.
    """

    #: Normalizer and pre-tokenizer that the short cut stands for.
    STEPS = (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    )

    LETTERS = re.compile("[a-zß-öø-ÿ]+")
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the steps alone: the whole tokenizer as JSON takes many times the vocabulary's memory
        steps = tuple(s and json.loads(s.__getstate__()) for s in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer))
        special = all(t.content.startswith("<|") for t in self.tokenizer.get_added_tokens_decoder().values())
        self.plain = steps == self.STEPS and special
        self.merge = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        bytesnp.release()  # what reading the vocabulary took

    def _merged(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.merge(letters)])

    def ids(self, word: str) -> bytes:
        lower = word.lower()
        if self.LETTERS.fullmatch(lower):
            return self._merged(lower)
        if self.PLAIN.fullmatch(word) and "<|" not in word:
            parts = self.SPLIT.findall(lower)
            return self._merged(lower) if len(parts) == 1 else b"".join([self[p] for p in parts])
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        if len(self) >= PARTS:
            self.clear()
        found = self[part] = self.ids(part)
        return found


class _Words:
    """Ids of the words seen so far, by hash: ascending hashes, where the ids of each start, how many."""

    def __init__(self):
        self.hashes, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, "<u4")

    def learn(self, hashes: np.ndarray, spell) -> None:
        """Add those of the ascending hashes that are new; ``spell`` gives the ids of the words at some places."""
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inner = place < len(self.hashes)
        new[inner] = self.hashes[place[inner]] != hashes[inner]
        if len(self.hashes) + np.count_nonzero(new) > WORDS:
            self.__init__()
            new[:], place = True, np.zeros(len(hashes), np.int64)
        found = spell(np.flatnonzero(new))
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4
        at = len(self.flat) + np.cumsum(size, dtype=np.int32) - size
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), "<u4")])
        self.hashes, self.at, self.size = (
            np.insert(old, place[new], add) for old, add in ((self.hashes, hashes[new]), (self.at, at), (self.size, size))
        )

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(self.hashes, hashes)
        return self.at[place].astype(np.int64), self.size[place].astype(np.int64)


def _ids(encoder: _Encoder, words: _Words, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and where each text's begin; every distinct word is looked up once."""
    body = data.tobytes()
    if not encoder.plain:
        texts = [body[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        found = [np.array(e.ids, "<u4") for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *found]), np.cumsum([0, *map(len, found)])
    if b"<|" not in body:  # special tokens are told by case
        data = bytesnp.LOWER[data]
        body = data.tobytes()
    starts, ends = bytesnp.spans_of(~bytesnp.SPACE[data], bounds)
    # a stop or comma that ends a word stands alone if a letter is before it, so that fewer words differ
    last = ends - 1
    stop = last[(last > starts) & ((data[last] == 0x2E) | (data[last] == 0x2C))]
    before = data[stop - 1]
    latin = (before >= 0x9F) & (before <= 0xBF) & (before != 0xB7) & (data[stop - 2] == 0xC3)
    stop = stop[((before >= 0x61) & (before <= 0x7A)) | latin]
    starts, ends = np.sort(np.concatenate([starts, stop])), np.sort(np.concatenate([ends, stop]))
    hashes = bytesnp.span_hashes(bytesnp.prefix_hashes(data), starts, ends)
    distinct, first, word = np.unique(hashes, return_index=True, return_inverse=True)

    def spelt(new: np.ndarray) -> list[bytes]:
        spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
        return [encoder.ids(body[a:b].decode()) for a, b in spans]

    words.learn(distinct, spelt)
    at, size = words.of(distinct)
    times = size[word]
    end = np.cumsum(times)
    ids = words.flat[np.repeat(at[word] - end + times, times) + np.arange(end[-1] if len(end) else 0)]
    return ids, np.r_[0, end][np.searchsorted(starts, bounds)]


def _tokens(path: str, end: int, capacity: int, others: list[str]):
    """Pieces of each text: ids, cut at the capacity."""
    closing = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = _Encoder(path), _Words()  # given back at the end of the task
        for part, data, bounds in bytesnp.portions(batches, "text", PORTION):
            all_ids, limits = _ids(encoder, words, data, bounds)
            row, piece, start, length, crc = [], [], [], [], []
            for i, (a, b) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
                ids = all_ids[a:b].tobytes() + closing
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).take(pa.array(row, pa.int64())) for c in others),
                    *(pa.array(x, t) for x, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()))),
                ],
                [*others, "piece", "start", "length", "ids_crc32"],
            )
        del encoder, words
        bytesnp.release()

    return run


def _places(packing: Packing) -> dict[str, np.ndarray]:
    """Runs of places: ranks ``low`` to ``low + bins - 1`` of a length go to consecutive sequences."""
    rows, used, first = [], Counter(), 0
    for pattern in sorted(packing, reverse=True):
        times, offset = packing[pattern], 0
        for length in pattern:
            rows.append((length, used[length], first, offset))
            used[length] += times
            offset += length
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("length", "low", "first", "offset"), table.T, strict=True))


def _placer(runs, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        key = table["length"] << 44 | table["low"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, length.astype(np.int64) << 44 | rank, "right") - 1
            sequence = table["first"][at] + rank - table["low"][at] if len(at) else at
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence, pa.int64()), pa.array(table["offset"][at] if len(at) else at, pa.int64())],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = 1,
) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A text's ids are those of ``tokenizer`` (a file that all executors see) and ``end``; a null or
    empty text is ``end`` alone. Only texts longer than ``capacity`` are cut, into pieces of it and a
    shorter last one. Sequences are numbered from 0 without gaps, and hold their pieces from offset 0
    without gaps. Repeated rows and null ids are packed like others. No rows give no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = materialise(
        docs.mapInArrow(
            _tokens(tokenizer, end, capacity, ["doc_id"]),
            f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
        )
    )
    demand = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(_places(pack_lengths(spark, demand, capacity)))
    each = max(SLICE, -(-sum(demand.values()) // SLICES))
    slices = _longs(spark, ["length", "slices"], [(k, -(-n // each)) for k, n in demand.items()])
    pieces = pieces.join(F.broadcast(slices), "length").withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "slices"))
    before, used = [], Counter()
    for r in sorted(pieces.groupBy("length", "slice").agg(F.count("*").alias("n")).collect()):
        before.append((r.length, r.slice, used[r.length]))
        used[r.length] += r.n
    before = _longs(spark, ["length", "slice", "before"], before)
    return _ranked(pieces, before).mapInArrow(
        _placer(runs, names),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def _longs(spark, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small table, sent as Arrow: tuples would start Python workers of another kind beside those of the operators."""
    table = np.array(rows, np.int64).reshape(-1, len(names))
    return spark.createDataFrame(pa.table(dict(zip(names, map(pa.array, table.T), strict=True))))


def _ranked(pieces: DataFrame, before: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0: within a slice by a window, across slices by offset."""
    own: Column = F.row_number().over(Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32"))
    return pieces.join(F.broadcast(before), ["length", "slice"]).withColumn("rank", F.col("before") + own - 1)
