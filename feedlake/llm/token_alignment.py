"""Cross-tokenizer alignment: divide and conquer at the byte offsets where both vocabularies cut.

A text is encoded by a byte-level vocabulary (A, with a space before the text) and by a piece
vocabulary (B, which adds that space itself). Of an interval of tokens the end of A's middle token is
looked up among B's ends by bisection, then the ends beside it, outwards; the first one that both
share cuts the interval and both halves go on alike. An interval without a shared end is a group.

Both vocabularies always cut where a blank follows a character that is none, so a text is a row of
chunks between such places. Equal chunks are encoded and aligned once a portion, all of them together:
one round of the recursion is one bisection for every open interval.

Links are counted per text first, summed over all texts by Spark, and looked up again per text. The
counted pairs are broadcast in blocks of a fixed number of pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm import bytesnp
from feedlake.scale import materialise

#: Chunks whose alignment a task keeps, and counted pairs in one broadcast (17 bytes each).
CHUNKS, PAIRS = 250_000, 2_000_000
_BLANK = "▁"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabularies:
    """Both encoders and the bytes of every token of theirs."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.a_bytes[k] = bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(_BLANK, " ").encode() for k, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in one]) for one in (self.a_bytes, self.b_bytes))
        #: A piece over a blank inside would join chunks; then texts stay whole.
        self.cut = not any(re.search(f"[^{_BLANK}]{_BLANK}", p) for p in pieces)
        bytesnp.release()

    def encoded(self, strings: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each string with a blank before it."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + s for s in strings], add_special_tokens=False)]
        return a, self.b.encode(strings, num_threads=1)

    def spells(self, string: str, a: list[int], b: list[int]) -> bool:
        """Do the tokens of both sides spell the blank and the string?"""
        body = b" " + string.encode()
        return body == b"".join([self.a_bytes[i] for i in a]) == b"".join([self.b_bytes[i] for i in b])


def chunk_spans(data: np.ndarray, bounds: np.ndarray, cut: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of all texts, without the blank that each one begins with.

    A cut is a blank after a visible character, but not as a text's last byte. After characters whose
    first byte is 0xC2 or 0xE1 to 0xE3 (some of them are white space) there is none.
    """
    first, end = bounds[:-1], bounds[1:]
    some = first < end
    first, end = first[some], end[some]
    if not cut:
        return first, end
    space = np.flatnonzero(data == 0x20)
    last = np.zeros(len(data) + 1, bool)
    last[end - 1] = True
    opens = np.zeros(len(data) + 1, bool)
    opens[first] = True
    space = space[~last[space] & ~opens[space]]
    before = data[space - 1]
    wide = (before >= 0x80) & (data[space - 2] != 0xC2) & ~np.isin(data[np.maximum(space - 3, 0)], (0xE1, 0xE2, 0xE3))
    space = space[((before > 0x20) & (before < 0x7F)) | wide]
    return np.sort(np.concatenate([first, space + 1])), np.sort(np.concatenate([end, space]))


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray) -> np.ndarray:
    """Indices of the A ends that close a group, by divide and conquer.

    ``a_ends`` and ``b_ends`` ascend over all chunks; chunk k has the tokens up to ``a_stops[k]`` and
    ``b_stops[k]`` from where the chunk before it stops. Both end every chunk at the same offset.
    """
    a0, a1 = np.r_[0, a_stops[:-1]], a_stops
    b0, b1 = np.r_[0, b_stops[:-1]], b_stops
    cuts = [a_stops - 1]
    while len(a0):
        inner = (a1 - a0 > 1) & (b1 - b0 > 1)  # else the interval is a leaf
        a0, a1, b0, b1 = a0[inner], a1[inner], b0[inner], b1[inner]
        middle = (a0 + a1 - 2) // 2
        at, meet = np.full(len(a0), -1), np.zeros(len(a0), np.int64)
        still, step = np.arange(len(a0)), 0
        while len(still):
            reach = np.zeros(len(still), bool)
            for probe in (middle[still] + step, middle[still] - step) if step else (middle,):
                valid = (probe >= a0[still]) & (probe <= a1[still] - 2)
                reach |= valid
                valid &= at[still] < 0
                look, who = probe[valid], still[valid]
                place = np.searchsorted(b_ends, a_ends[look])
                hit = (b_ends[place] == a_ends[look]) & (place < b1[who] - 1)
                at[who[hit]], meet[who[hit]] = look[hit], place[hit]
            still = still[reach & (at[still] < 0)]
            step += 1
        found = at >= 0
        at, meet = at[found], meet[found]
        cuts.append(at)
        a0, a1 = np.r_[a0[found], at + 1], np.r_[at + 1, a1[found]]
        b0, b1 = np.r_[b0[found], meet + 1], np.r_[meet + 1, b1[found]]
    return np.sort(np.concatenate(cuts))


def _strings(chunks: list[str], limit: int = 2048) -> Iterator[list[int]]:
    """Chunks (their numbers) that can be encoded in a row: a chunk that ends in white space ends its row."""
    row: list[int] = []
    size = 0
    for k, chunk in enumerate(chunks):
        row.append(k)
        size += len(chunk)
        if size >= limit or not ("!" <= chunk[-1:] <= "~"):
            yield row
            row, size = [], 0
    if row:
        yield row


@dataclass
class Aligned:
    """Aligned chunks in a row: sizes, links (a << 32 | b) and groups as text, both up to a stop per chunk."""

    hashes: np.ndarray
    sizes: np.ndarray  # A tokens, B tokens, groups; -1 where the tokens do not spell the chunk
    links: np.ndarray
    link_stops: np.ndarray
    text: bytes
    text_stops: np.ndarray

    @classmethod
    def none(cls) -> Aligned:
        empty = np.zeros(0, np.int64)
        return cls(empty.astype(np.uint64), np.zeros((3, 0), np.int64), empty, empty, b"", empty)

    def __add__(self, other: Aligned) -> Aligned:
        return Aligned(
            np.concatenate([self.hashes, other.hashes]),
            np.concatenate([self.sizes, other.sizes], axis=1),
            np.concatenate([self.links, other.links]),
            np.concatenate([self.link_stops, other.link_stops + len(self.links)]),
            self.text + other.text,
            np.concatenate([self.text_stops, other.text_stops + len(self.text)]),
        )


def _written(a: np.ndarray, b: np.ndarray, cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of all groups, and where each group ends in it."""
    n = len(a) + len(b)
    a_group = np.searchsorted(cuts, np.arange(len(a)))
    b_group = np.searchsorted(b_cuts, np.arange(len(b)))
    a_at = np.arange(len(a)) + np.r_[0, b_cuts + 1][a_group]
    b_at = np.arange(len(b)) + cuts[b_group] + 1
    ids, ends = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[a_at], ids[b_at] = a, b
    ends[a_at[cuts]], ends[b_at[b_cuts]] = ord("|"), ord(";")
    digits = np.ones(n, np.int64)
    for power in range(1, 10):
        digits += ids >= 10**power
    stops = np.cumsum(digits + 1)
    out = np.zeros(stops[-1] if n else 0, np.uint8)
    out[stops - 1] = ends
    rest, place = ids, stops - 2
    while len(rest):
        out[place] = rest % 10 + ord("0")
        more = rest >= 10
        rest, place = rest[more] // 10, place[more] - 1
    return out.tobytes(), stops[b_at[b_cuts]]


def align(tools: Vocabularies, chunks: list[bytes], hashes: np.ndarray) -> Aligned:
    """All chunks encoded and aligned together."""
    if not chunks:
        return Aligned.none()
    texts = [c.decode() for c in chunks]
    rows = list(_strings(texts))
    strings = [" ".join([texts[k] for k in row]) for row in rows]
    a_ids, b_ids = tools.encoded(strings)
    good = np.ones(len(chunks), bool)
    for r, (row, string) in enumerate(zip(rows, strings, strict=True)):
        if tools.spells(string, a_ids[r], b_ids[r]):
            continue
        each_a, each_b = tools.encoded([texts[k] for k in row])
        spelt = [tools.spells(texts[k], x, y) for k, x, y in zip(row, each_a, each_b, strict=True)]
        good[row] = spelt
        a_ids[r], b_ids[r] = ([i for x, ok in zip(ids, spelt, strict=True) if ok for i in x] for ids in (each_a, each_b))
    a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
    ends = np.cumsum([(len(c) + 1) * ok for c, ok in zip(chunks, good.tolist(), strict=True)])
    sizes, link_stops, text_stops = np.zeros((3, len(chunks)), np.int64), np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
    links, text = np.zeros(0, np.int64), b""
    if len(a):
        a_ends, b_ends = np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b])
        stops = ends[good]
        a_stops, b_stops = (np.searchsorted(e, stops) + 1 for e in (a_ends, b_ends))
        cuts = shared_cuts(a_ends, b_ends, a_stops, b_stops)
        text, written = _written(a, b, cuts, np.searchsorted(b_ends, a_ends[cuts]))
        groups = np.searchsorted(a_ends[cuts], ends, "right")  # up to the end of each chunk
        # one link for each piece between neighbouring ends of either side
        pieces = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        pieces = pieces[np.r_[True, pieces[1:] != pieces[:-1]]]
        links = a[np.searchsorted(a_ends, pieces)] << 32 | b[np.searchsorted(b_ends, pieces)]
        totals = np.stack([np.searchsorted(a_ends, ends, "right"), np.searchsorted(b_ends, ends, "right"), groups])
        sizes = np.diff(totals, axis=1, prepend=0)
        link_stops, text_stops = np.searchsorted(pieces, ends, "right"), np.r_[0, written][groups]
    sizes[0, ~good] = -1
    return Aligned(hashes, sizes, links, link_stops, text, text_stops)


def _lists(values: np.ndarray, limits: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(values, pa.int32()))


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, known = Vocabularies(a_path, b_path), Aligned.none()
        for part, data, bounds in bytesnp.portions(batches, "text"):
            body = data.tobytes()
            starts, ends = chunk_spans(data, bounds, tools.cut)
            hashes = bytesnp.span_hashes(bytesnp.prefix_hashes(data), starts, ends)
            _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
            distinct = hashes[first]
            have = np.sort(known.hashes)
            new = np.r_[have, np.uint64(0)][np.searchsorted(have, distinct)] != distinct if len(have) else np.ones(len(distinct), bool)
            if len(known.hashes) + np.count_nonzero(new) > CHUNKS:
                known, new = Aligned.none(), np.ones(len(distinct), bool)
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            known += align(tools, [body[i:j] for i, j in spans], distinct[new])
            order = np.argsort(known.hashes)
            found = order[np.searchsorted(known.hashes, distinct, sorter=order)]
            text, texts = bytesnp.owner(bounds, starts), part.num_rows
            sizes = known.sizes[:, found]
            none = np.zeros(texts, bool)
            none[text[sizes[0, word] < 0]] = True
            keep = ~none[text]
            word, text = word[keep], text[keep]
            sums = [np.bincount(text, each[word], texts).astype(np.int64) for each in sizes]

            # the links of each text, equal ones counted
            stop = known.link_stops[found]
            begin = np.r_[0, known.link_stops][found]
            times = (stop - begin)[word]
            last = np.cumsum(times)
            links = known.links[np.repeat(begin[word] - last + times, times) + np.arange(last[-1] if len(last) else 0)]
            low = len(tools.b_bytes).bit_length()
            high = low + len(tools.a_bytes).bit_length()
            links = np.repeat(text, times) << high | links >> 32 << low | links & 0xFFFFFFFF
            links.sort()
            change = np.flatnonzero(np.r_[True, links[1:] != links[:-1]][: len(links)])
            n, pairs = np.diff(np.r_[change, len(links)]), links[change]
            owner, a, b = pairs >> high, (pairs & ((1 << high) - 1)) >> low, pairs & ((1 << low) - 1)
            limits = np.searchsorted(owner, np.arange(texts + 1))
            at = np.searchsorted(text, np.arange(texts + 1)).tolist()
            spans = zip(np.r_[0, known.text_stops][found].tolist(), known.text_stops[found].tolist(), strict=True)
            groups, word = [known.text[i:j] for i, j in spans], word.tolist()
            digests = [
                hashlib.sha256(b"".join([groups[w] for w in word[i:j]])[:-1]).hexdigest() if i < j else ""
                for i, j in zip(at[:-1], at[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *(pa.array(x) for x in (*sums, np.bincount(text, times, texts).astype(np.int64))),
                    pa.array(digests, pa.string()),
                    *(_lists(x, limits) for x in (a, b, n)),
                ],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "n"],
            )

    return run


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of all rows, how often each row has them, and the row of each."""
    a, b, n = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in "abn")
    sizes = batch.column("a").value_lengths().to_numpy(zero_copy_only=False)
    return a << 32 | b, n, np.repeat(np.arange(batch.num_rows), sizes)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each batch before the shuffle."""
    for batch in batches:
        code, n, _ = _codes(batch)
        pairs, where = np.unique(code, return_inverse=True)
        total = np.bincount(where, n, len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], ["pair", "total"])
    bytesnp.release()


def _looked_up(block, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, totals, best = block.value
        for batch in batches:
            code, n, row = _codes(batch)
            at = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
            n = np.where(pairs[at] == code, n, 0)  # the others are in other blocks
            total, high = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row, n * totals[at])
            np.add.at(high, row, n * best[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(high), pa.array(total)], [*names, "n_best", "count_sum"]
            )
        bytesnp.release()

    return run


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, a, b, n): the alignment of every text.

    ``a``, ``b`` and ``n`` list the text's linked id pairs and how often it links them. A null or empty
    text, or one whose tokens do not spell it (a text with U+2581), has no tokens: zeros, empty lists
    and an empty digest. Rows stay as they are, repeated ones and null ids too; other columns are not
    read. The vocabulary files must be there on every executor.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        _aligned(a_path, b_path),
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "a array<int>, b array<int>, n array<int>",
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, total, best): links of every id pair over all texts, and whether its B id has none with more.

    ``pair`` is the A id times 2**32 plus the B id.
    """
    totals = aligned.select("a", "b", "n").mapInArrow(_counted, "pair long, total long")
    totals = materialise(totals.groupBy("pair").agg(F.sum("total").alias("total")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    most = totals.groupBy(b).agg(F.max("total").alias("most"))  # a row for each B id at most
    return totals.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))


def align_tokens(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block: int = PAIRS
) -> DataFrame:
    """One row per text: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    ``n_best`` are the links whose pair is the most frequent one of its B id over all texts, ties
    included; ``count_sum`` sums the pairs' counts over the links. See ``aligned_texts`` for the rest.
    No rows give no rows.
    """
    spark = docs.sparkSession
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    stored = materialise(aligned_texts(docs, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    pairs = materialise(pair_counts(stored))
    blocks = -(-pairs.count() // block)
    kept = [*names, "row"]
    schema = ", ".join(f"{c} {stored.schema[c].dataType.simpleString()}" for c in kept) + ", n_best long, count_sum long"
    parts = []
    for k in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k).toArrow().sort_by("pair")
        arrays = tuple(own.column(c).to_numpy() for c in ("pair", "total", "best"))
        parts.append(stored.mapInArrow(_looked_up(spark.sparkContext.broadcast(arrays), kept), schema))
    if not parts:  # no text has a token
        parts = [stored.select(*kept, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))]
    found = parts[0]
    if blocks > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        found = found.groupBy("row").agg(
            *(F.first(c).alias(c) for c in names), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
