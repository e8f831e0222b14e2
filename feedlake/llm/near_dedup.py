"""Near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find.

A signature slot takes the least (rank, fraction) that any shingle gives it. A shingle's ranks are
one random permutation of the slots, so they are correlated and the estimate varies less than with
independent minima; a text stops as soon as no shingle's next rank could lower a slot.

Texts with equal shingle sets are one class; only classes go on. Within a band a bucket is a star
around its best connected class, never all pairs. Links count only after the full sets are compared.
In buckets that still hold several components, members of different ones are compared: pair by pair
in small buckets; in large ones those outside the main component are a query set, taken in blocks
against the rest, so that only links become rows and no centre hides one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from feedlake.llm import bytesnp
from feedlake.llm.common import small
from feedlake.llm.graph import components
from feedlake.scale import materialise

SLOTS, ROWS = 128, 4
#: Members above which a band's leftovers are searched in blocks, and the sizes of slice and block.
HOT, SLICE, BLOCK = 16, 2000, 256
#: Bytes of text that a task takes at once: a shingle takes some 250 bytes while its text is signed.
PORTION = 1 << 18


def superminhash(values: np.ndarray, text: np.ndarray, n_texts: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures [n_texts, slots] of 64-bit shingles; 32 bits of rank above 32 bits of fraction."""
    sign = np.full(n_texts * slots, np.iinfo(np.uint64).max, np.uint64)
    kind = np.uint8 if slots <= 256 else np.uint16
    ranks = np.tile(np.arange(slots, dtype=kind), (len(values), 1))
    active = np.arange(len(values))
    for j in range(slots):
        if not len(active):
            break
        r = bytesnp.mix(values[active] + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)))
        k = j + ((r >> np.uint64(40)) * np.uint64(slots - j) >> np.uint64(24)).astype(np.int64)
        slot = ranks[active, k]
        ranks[active, k] = ranks[active, j]
        owner = text[active]
        np.minimum.at(sign, owner * slots + slot, (r & np.uint64(0xFFFFFFFF)) | np.uint64(j << 32))
        open_ = sign.reshape(n_texts, slots).max(axis=1) >= np.uint64((j + 1) << 32)
        active = active[open_[owner]]
    return sign.reshape(n_texts, slots)


def _sets(data: np.ndarray, bounds: np.ndarray, words: int):
    """Distinct shingles of each text, their text, and a 16-byte key that equal sets share."""
    values, text = bytesnp.distinct(*bytesnp.shingles(*bytesnp.word_hashes(data, bounds), words))
    n = len(bounds) - 1
    size = np.bincount(text, minlength=n)
    key = np.zeros((n, 2), np.uint64)
    for part, salt in enumerate((0x1F83D9AB, 0x5BE0CD19)):
        np.add.at(key[:, part], text, bytesnp.mix(values ^ np.uint64(salt)))
    return values, text, size, key


def _keys(key: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() if s else None for k, s in zip(key, size, strict=True)], pa.binary())


def _signer(ids: list[str], text_col: str, words: int, slots: int, rows: int, fields: pa.Schema):
    bands = slots // rows
    salts = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, text_col, PORTION):
            values, text, size, key = _sets(data, bounds, words)
            sign = superminhash(values, text, part.num_rows, slots)
            hashes = np.tile(salts, (part.num_rows, 1))
            for j in range(rows):
                hashes = bytesnp.mix(hashes * np.uint64(0x9FB21C651E98DF25) + sign[:, j : bands * rows : rows])
            sketch = (bytesnp.mix(sign) >> np.uint64(56)).astype(np.uint8)
            some = size > 0
            offsets = np.r_[0, np.cumsum(np.where(some, bands, 0))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ids),
                    pa.array(size, pa.int64()),
                    _keys(key, size),
                    pa.ListArray.from_arrays(offsets, pa.array(hashes[some].view(np.int64).ravel())),
                    pa.array([s.tobytes() if k else None for s, k in zip(sketch, some, strict=True)], pa.binary()),
                ],
                schema=fields,
            )

    return run


def _set_maker(id_col: str, text_col: str, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in bytesnp.portions(batches, text_col, PORTION):
            values, _, size, key = _sets(data, bounds, words)
            ends = np.cumsum(size)
            rows = [values[e - s : e].tobytes() for e, s in zip(ends, size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), _keys(key, size), pa.array(rows, pa.binary())], ["first_id", "node", "set"]
            )

    return run


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x_set"), batch.column("y_set"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                lo, hi = sorted((len(x), len(y)))
                shared = 0
                if 100 * lo >= percent * hi:
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (lo + hi - shared))
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("y")], ["x", "y"])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept).

    Texts are linked where 100 * |A ∩ B| >= percent * |A ∪ B| for their sets of ``words``-word
    shingles (ASCII letters lower-cased); component_id is the smallest id reachable over links.
    A null or wordless text has an empty set and is linked with nothing: its component is its own id.
    A null id never becomes a component's id unless all ids of the component are null. Repeated rows
    have equal sets, so they share a component and each is ``kept`` if its id is the component's. A
    row that repeats an id with another text is linked by its own text, and so is one with a null id.
    Columns other than these two are not read, so clashing names do not matter.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (
        labelled(docs, words, percent, slots, rows)
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    )


def labelled(docs: DataFrame, words: int, percent: int, slots: int = SLOTS, rows: int = ROWS, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, keys…, n_shingles, component, component_id) of each row of (doc_id, text, keys…).

    ``component`` names the component also where its ids are null; it is null for wordless texts.
    ``keys`` are long columns.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = pa.schema(
        [
            ("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)),
            *((c, pa.int64()) for c in keys),
            ("n_shingles", pa.int64()),
            ("node", pa.binary()),
            ("bands", pa.list_(pa.int64())),
            ("sketch", pa.binary()),
        ]
    )
    signed = materialise(
        docs.mapInArrow(
            _signer(["doc_id", *keys], "text", words, slots, rows, fields),
            f"doc_id {kind}, {''.join(f'{c} long, ' for c in keys)}n_shingles long, node binary, bands array<long>, sketch binary",
        )
    )
    classes = materialise(
        signed.where("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    )
    labels = _linked(docs.select("doc_id", "text"), classes, words, percent)
    smallest = classes.select("node", "first_id").join(labels, "node").groupBy("root").agg(
        F.min("first_id").alias("component_id")
    )
    grouped = labels.join(smallest, "root").select("node", "root", "component_id")
    alone = classes.select("node", "first_id").join(grouped, "node", "left")
    alone = alone.select("node", F.coalesce("root", "node").alias("component"), F.coalesce("component_id", "first_id").alias("component_id"))
    names = ["doc_id", *keys, "n_shingles"]
    return signed.select(*names, "node").join(alone, "node", "left").select(*names, "component", "component_id")


def _linked(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) of every class that is linked with another."""
    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = materialise(bands.join(shared, "band"))
    # a class that shares much with many stands in the middle of its group
    weight = members.groupBy("node").agg(F.sum("members").alias("weight"))
    members = materialise(members.join(weight, "node"))
    sketches = materialise(classes.join(weight.select("node"), "node").select("node", "first_id", "sketch"))
    wanted = small(sketches.select("node"))
    firsts = small(sketches.select(F.col("first_id").alias("doc_id")).distinct())
    held = docs.join(firsts, "doc_id", "left_semi")
    if not sketches.where("first_id is null").isEmpty():  # classes of rows without ids
        held = held.unionByName(docs.where("doc_id is null"))
    sets = held.mapInArrow(
        _set_maker("doc_id", "text", words),
        f"first_id {docs.schema['doc_id'].dataType.simpleString()}, node binary, set binary",
    )
    sets = materialise(sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]).select("node", "set"))

    links = classes.select(F.col("node").alias("x"), F.col("node").alias("y")).limit(0)
    tried = links
    labels = members.select("node").distinct().withColumn("root", F.col("node"))
    centre = F.struct("weight", "node")
    stars = members.groupBy("band").agg(F.max(centre).getField("node").alias("x"))
    pairs = members.join(stars, "band").where("node <> x")
    pairs = pairs.select(F.least("x", "node").alias("x"), F.greatest("x", "node").alias("y"))
    links, tried, labels = _round(pairs, tried, links, sketches, sets, labels, percent)
    # what no centre settled: members of different components of one band
    seen = materialise(members.join(labels, "node").select("band", "node", "root", "members"))
    mixed = seen.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    seen = seen.join(mixed.select("band"), "band")
    few, many = seen.where(F.col("members") <= HOT), seen.where(F.col("members") > HOT)
    other = few.select("band", F.col("node").alias("y"), F.col("root").alias("y_root"))
    pairs = few.join(other, "band").where("node < y and root <> y_root").select(F.col("node").alias("x"), "y")
    links = links.unionByName(_searched(many, labels, sets, percent))
    return _round(pairs, tried, links, sketches, sets, labels, percent)[2]


def _searched(many: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the nodes that stand outside the main component of a large band.

    They are a query set, taken in blocks against slices of that component and of each other, so that
    only links become rows. Each slice and each block holds a bounded number of sets.
    """
    sizes = many.groupBy("band", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    asks = materialise(many.join(main, "band").where("root <> main").select("main", "node", "root").distinct())
    if asks.isEmpty():
        return asks.select(F.col("node").alias("x"), F.col("node").alias("y"))
    mains = asks.select("main").distinct()
    held = labels.join(mains.withColumnRenamed("main", "root"), "root").select(F.col("root").alias("main"), "node", "root")
    held = held.unionByName(asks)
    parts = held.groupBy("main").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
    parts = parts.join(asks.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "main")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = held.join(parts, "main").join(sets, "node").select("main", "node", "root", "set", place("slices").alias("slice"), every("blocks").alias("block"))
    asked = asks.join(parts, "main").join(sets, "node").select("main", "node", "root", "set", place("blocks").alias("block"), every("slices").alias("slice"))

    def search(group: pa.Table) -> pa.Table:
        x, y = _linked_blocks(*(group.filter(pc.equal(group["asks"], a)) for a in (False, True)), percent)
        return pa.table({"x": pa.array(x, pa.binary()), "y": pa.array(y, pa.binary())})

    both = rows.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    return materialise(both.groupBy("main", "slice", "block").applyInArrow(search, "x binary, y binary"))


def _linked_blocks(rows: pa.Table, asked: pa.Table, percent: int) -> tuple[list, list]:
    """Verified links of rows and asked nodes of other components; one per row and component."""
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in asked["set"]]
    if not sets or not rows.num_rows:
        return [], []
    sizes = np.array([len(v) for v in sets])
    values, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    known, first, times = np.unique(values[order], return_index=True, return_counts=True)
    of = of[order]
    nodes, roots = asked["node"].to_pylist(), asked["root"].to_pylist()
    number = {r: k for k, r in enumerate(dict.fromkeys(roots))}
    component = np.array([number[r] for r in roots])
    found: tuple[list, list] = ([], [])
    for node, root, own in zip(rows["node"].to_pylist(), rows["root"].to_pylist(), rows["set"], strict=True):
        own = np.frombuffer(own.as_buffer(), np.uint64)
        at = np.searchsorted(known, own)
        at[at == len(known)] = 0
        at = at[known[at] == own]
        n = times[at]
        entry = np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(of[entry], minlength=len(sets))
        linked = (100 * shared >= percent * (len(own) + sizes - shared)) & (component != number.get(root, -1))
        hits = np.flatnonzero(linked)
        for k in hits[np.unique(component[hits], return_index=True)[1]]:
            found[0].append(node)
            found[1].append(nodes[k])
    return found


def _round(pairs, tried, links, sketches, sets, labels, percent):
    """Verify the pairs not tried before: all links, tried pairs and labels so far."""
    pairs = pairs.distinct().join(tried, ["x", "y"], "left_anti")
    x = sketches.select(F.col("node").alias("x"), F.col("sketch").alias("x_sketch"))
    y = sketches.select(F.col("node").alias("y"), F.col("sketch").alias("y_sketch"))
    new = materialise(_likely(pairs.join(x, "x").join(y, "y"), percent))
    sized = new.join(sets.select(F.col("node").alias("y"), F.col("set").alias("y_set")), "y")
    sized = sized.join(sets.select(F.col("node").alias("x"), F.col("set").alias("x_set")), "x")
    found = materialise(sized.mapInArrow(_verifier(percent), "x binary, y binary"))
    links = links.unionByName(found)
    roots = components(links, "x", "y")
    labels = labels.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    return links, tried.unionByName(new), materialise(labels)


def _likely(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches agree as far as six standard deviations below the bound allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.array([np.frombuffer(v.as_buffer(), np.uint8) for v in batch.column(c)]) for c in ("x_sketch", "y_sketch"))
            bound = percent / 100
            bound -= 6 * (bound * (1 - bound) / x.shape[1]) ** 0.5
            keep = (x == y).mean(axis=1) >= bound
            part = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("y")], ["x", "y"])

    return pairs.select("x", "y", "x_sketch", "y_sketch").mapInArrow(run, "x binary, y binary")
