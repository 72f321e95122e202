"""Operator 5: best-fit packing of tokenised documents into fixed-length sequences.

A document is its ids followed by the end id.  Only documents of more than
``capacity`` tokens are cut, into ``capacity``-token pieces of which the first
may be shorter.  Pieces are packed by best-fit decreasing over the *whole*
table: a segment tree over the remaining capacities gives the tightest open
bin that fits in logarithmic time.

Best-fit decreasing sees nothing of a piece but its length, so the packing is
planned from the histogram of lengths (at most ``capacity`` rows, whatever the
corpus), a run of equal lengths and equally filled bins at a time; this gives the
bins that the one-by-one procedure gives.  Each planned step says "the pieces of
this length with ranks a..b go to bins c.. at this offset".  A piece's rank is its
number among those of its length that its task wrote, behind those of the tasks before:
pieces are numbered as they are written, and no piece is moved to be placed.

The ids are those of the ``tokenizers`` library for the same vocabulary file; they
are made by the rank-based coder over the vocabulary read from that file, which is
about four times as fast (the tests hold them equal).

Defined cases: a null or empty text is one piece of one token (the end id); every
input row is packed, repeated rows included; an empty table gives no piece.
"""

from __future__ import annotations

import json
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY = 1_024
END_ID = 2
#: Where a stored piece was numbered (a task of the write), and its number there among those of its length.
DEAL, NUMBER = "_deal", "_number"
#: So many (deal, length) pairs are sent to every task; with more, pieces are moved to meet them.
SENT_PAIRS = 2_500_000

_CODERS: dict[tuple[str, str], tiktoken.Encoding] = {}


def coder(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` file; one per process.

    Requires what makes ranks and merges the same thing: the id of every merged
    token is 256 more than the position of its merge.
    """
    if (path, pattern) not in _CODERS:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*printable}))}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        for i, merge in enumerate(merges):
            if vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)] != 256 + i:
                raise ValueError(f"{path}: ids do not follow the merges; use the tokenizers library for this file")
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        _CODERS[path, pattern] = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _CODERS[path, pattern]


def tokenise(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int = END_ID, width: int = 4) -> DataFrame:
    """One row per input row: ``id_col``, ``ids`` (binary, little-endian unsigned, end id included).

    ``width`` is an id's number of bytes, 4 or, for vocabularies of at most 65,536 ids, 2.
    """
    common.workers_see_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = coder(vocab, pattern)
        for batch in common.slices(batches):
            out = []
            for text in batch.column("text"):
                ids = array({2: "H", 4: "I"}[width], enc.encode(text.as_py(), allowed_special="all"))
                ids.append(end_id)
                out.append(ids.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "ids"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary").withColumnRenamed("id", id_col)


def cut(tokenised: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", width: int = 4) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids`` (the piece's, ``width`` bytes each)."""
    n = (F.length("ids") / width).cast("long")
    first = F.when(n <= capacity, n).otherwise((n - 1) % capacity + 1)
    rows = tokenised.select(id_col, "ids", n.alias("n"), first.alias("first"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil((F.col("n") - F.col("first")) / capacity).cast("int"))))
    start = F.when(F.col("piece") == 0, F.lit(0)).otherwise(F.col("first") + (F.col("piece") - 1) * capacity).cast("long")
    length = F.when(F.col("piece") == 0, F.col("first")).otherwise(F.lit(capacity)).cast("long")
    return rows.select(id_col, "piece", start.alias("start"), length.alias("length"), "ids").withColumn(
        "ids", F.expr(f"substring(ids, cast(start * {width} + 1 as int), cast(length * {width} as int))"))


class TightestFit:
    """Segment tree over remaining capacities 0..capacity: which of them some open bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, remaining: int, there: bool) -> None:
        node = remaining + self.size
        self.any[node] = there
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def at_least(self, need: int) -> int | None:
        """The smallest remaining capacity >= need that some open bin has."""
        node = need + self.size
        if self.any[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing over ``{length: pieces}``.

    Steps (length, first rank, first bin, offset): the pieces of that length from that
    rank up to the next step's go to consecutive bins from that bin on, at that offset.
    """
    steps: list[tuple[int, int, int, int]] = []
    tree, open_bins, bins = TightestFit(capacity), defaultdict(list), 0

    def keep(remaining: int, first: int, count: int) -> None:
        if count and remaining:
            open_bins[remaining].append((first, count))
            tree.set(remaining, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.at_least(length)
            if room is None:  # nothing fits: open as many empty bins as the rest of this run needs
                room, each = capacity, capacity // length
                first, count = bins, -(-left // each)
                bins += count
            else:
                each = room // length
                first, count = open_bins[room].pop()
                if not open_bins[room]:
                    tree.set(room, False)
            # A bin takes as many of the run as fit before the next bin is touched.
            full = min(count, left // each)
            for layer in range(each if full else 0):
                steps.append((length, rank, first, capacity - room + layer * length))
                rank += full
            left -= full * each
            keep(room - each * length, first, full)
            first, count = first + full, count - full
            if count and left and left < each:
                for layer in range(left):
                    steps.append((length, rank, first, capacity - room + layer * length))
                    rank += 1
                keep(room - left * length, first, 1)
                left, first, count = 0, first + 1, count - 1
            if room < capacity:
                keep(room, first, count)
    return steps


def numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``DEAL`` and ``NUMBER``, which hold for the rows as one write makes them: store the result before it is read twice."""
    common.workers_see_package(pieces.sparkSession)
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal, seen = TaskContext.get().partitionId(), np.zeros(1, np.int64)
        for batch in batches:
            length = batch.column("length").to_numpy()
            if not len(length):
                continue
            seen = np.concatenate([seen, np.zeros(max(0, int(length.max()) + 1 - len(seen)), np.int64)])
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            number = np.empty(len(length), np.int64)
            number[order] = np.arange(len(length)) - np.searchsorted(sorted_, sorted_, side="left") + seen[sorted_]
            seen += np.bincount(length, minlength=len(seen))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(np.full(len(length), deal, np.int64)), pa.array(number)], [*names, DEAL, NUMBER])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.mapInArrow(run, f"{schema}, {DEAL} long, {NUMBER} long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` in 1..capacity.

    ``pieces`` is read twice: give it a stored table of :func:`numbered` pieces.  Others are numbered and stored first.
    """
    spark = pieces.sparkSession
    common.workers_see_package(spark)
    if DEAL not in pieces.columns:
        pieces = common.stored(numbered(pieces), "numbered-pieces")
    counts = common.stored(pieces.groupBy(DEAL, "length").agg(F.count("*").alias("n")), "piece-counts")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = sorted(plan(by_length, capacity))  # bounded by the capacity, not by the corpus
    lengths, ranks, bins, offsets = (np.array(x, np.int64) for x in (zip(*steps) if steps else ((), (), (), ())))
    span = max(by_length.values(), default=0) + 1
    starts = lengths * span + ranks

    names = [c for c in pieces.columns if c not in (DEAL, NUMBER)]
    rank = common.fresh(pieces, "rank")
    before = Window.partitionBy("length").orderBy(DEAL).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(DEAL, "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(rank))
    if counts.count() <= SENT_PAIRS:
        base = F.broadcast(base)
    ranked = pieces.join(base, [DEAL, "length"]).select(*names, (F.col(rank) + F.col(NUMBER)).alias(rank))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("length").to_numpy() * span + batch.column(rank).to_numpy()
            step = np.searchsorted(starts, at, side="right") - 1
            columns = [*(batch.column(c) for c in names), pa.array(bins[step] + (at - starts[step])), pa.array(offsets[step])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in names)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
