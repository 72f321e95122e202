"""Operator 12: spelling variant grouping, by a bit-sliced position index.

Words one insertion, deletion or replacement apart are near.  A word's form is its near word with
the largest count, if that has at least ``RATIO`` times its own; its root is where the forms end.

1. Tasks count words in a dictionary of bounded size; counts are summed by word.
2. Near words share their first half, or what is behind it.  With L the shorter one's length and h = L // 2:
   if the difference lies behind the first h letters, these are equal, otherwise the last L - h are.  So a
   word of m letters goes to four groups, by its first and its last letters with L = m - 1 and L = m; a pair of equal
   first halves counts in the group of first halves, any other in that of last ones.
3. Groups of one length share bins, and a bin of any size is cut into blocks, of which each pair is a task.  A block is an index of
   bitsets: for each (position, letter) the words that have it there.  All words of the other block
   run through it at once, letter by letter, keeping four bitsets each: no error so far, and one error with the
   position unchanged (replaced), one ahead (inserted) or one behind (deleted).
4. A task gives each word's number of near words and the best of them, never the pairs.
5. Roots by doubling: each round replaces a word's root by that root's root.  Counts grow ``RATIO``-fold along
   the forms, so 63 words at most follow each other and 6 rounds are enough.

Defined cases: a null or empty text has no words; a null id reads as '' in the words' checksums; repeated rows count
again; an empty table, or one without words, gives no rows.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_LENGTH, MIN_COUNT = 5, 3
RATIO = 2
#: A word whose checksum with the document's id this divides loses a letter there.
DIVISOR = 97
#: Words of a block, and their letters, at most.
BLOCK, BLOCK_LETTERS = 1_024, 1 << 22
#: Entries of a task's dictionary before its rows go out, and rows of a batch.
ENTRIES, ROWS = 500_000, 50_000
#: Characters of a text that are split at once.
SLICE = 1 << 20

#: Letters as Latin-1 bytes, A-Z lower-cased; all else separates (characters beyond Latin-1 become a question mark before).
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def runs_of(text: str) -> Iterator[list[bytes]]:
    """The lower-cased runs of letters of a text, in Latin-1, in lists of bounded size."""
    raw = text.encode("latin-1", "replace").translate(_FOLD)
    low = 0
    while low < len(raw):
        cut = raw.find(b" ", low + SLICE)
        high = len(raw) if cut < 0 else cut
        yield raw[low:high].split()
        low = high


def word_of(run: bytes, start: int) -> bytes:
    """The word a run stands for; ``start`` is the checksum of the document's id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % DIVISOR:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def counted(docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of at least ``min_count`` occurrences."""
    def rows(words: Counter) -> Iterator[pa.RecordBatch]:
        names = list(words)
        for low in range(0, len(names), ROWS):
            some = names[low:low + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in some], pa.string()), pa.array([words[w] for w in some], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for batch in common.slices(batches):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                start = zlib.crc32(f"{doc}:".encode())
                for found in runs_of(text.as_py()):
                    for r, n in Counter(found).items():
                        if len(r) >= min_length:
                            w = word_of(r, start)
                            if len(w) >= min_length:
                                words[w] += n
                    if len(words) > ENTRIES:
                        yield from rows(words)
                        words = Counter()
        yield from rows(words)

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), common.text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _places(words: DataFrame, min_length: int) -> DataFrame:
    """(word, n, len, side, bin, blocks, block) for each bin of two words or more."""
    m = F.length("word")
    parts = F.explode(F.array(*(F.struct((m - less).alias("len"), F.lit(side).alias("side")) for less in (1, 0) for side in (0, 1)))).alias("part")
    out = words.select("word", "n", parts).select("word", "n", "part.*").filter(F.col("len") >= min_length)
    first = F.floor(F.col("len") / 2).cast("int")
    half = F.when(F.col("side") == 0, F.substring("word", F.lit(1), first)).otherwise(F.substring("word", first - F.col("len"), F.col("len") - first))
    # Halves of one length and side share bins of about half a block: small groups are one task's work together.
    bins = common.stored(out.groupBy("len", "side").agg(F.ceil(F.count("*") * 2 / BLOCK).alias("bins")), "spelling-bins")
    out = out.withColumn("hash", F.xxhash64(half)).join(bins, ["len", "side"]).withColumn("bin", F.pmod("hash", "bins"))
    group = ["len", "side", "bin"]
    share = F.least(F.lit(BLOCK), F.greatest(F.lit(1), F.floor(BLOCK_LETTERS / (F.col("len") + 3))))
    sizes = out.groupBy(*group).agg(F.count("*").alias("size")).filter("size > 1").withColumn("blocks", F.ceil(F.col("size") / share).cast("int")).drop("size")
    return out.select("word", "n", *group).join(sizes, group).withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))


def near_matrix(queries: np.ndarray, lengths: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bitsets, a row for each query: which words are one insertion, deletion or replacement from it.

    Rows of ``queries`` and ``words`` are letters, padded with 0 to a common width that is at least one more than the longest.
    """
    n, cells = len(words), -(-len(words) // 64)
    letters = np.unique(np.concatenate((queries.ravel(), words.ravel())))
    asked = np.searchsorted(letters, queries)

    def packed(flags: np.ndarray) -> np.ndarray:
        """Bitsets of the rows of a (.., n) table of flags."""
        full = np.zeros((*flags.shape[:-1], cells * 64), bool)
        full[..., :n] = flags
        return np.packbits(full, axis=-1, bitorder="little").view(np.uint64)

    def slice_at(position: int) -> np.ndarray:
        """The index's bitsets of one position, a row for each letter."""
        return packed(words[:, position][None, :] == letters[:, None])

    def sized(delta: int) -> np.ndarray:
        wanted = np.unique(lengths)
        table = packed(sizes[None, :] == wanted[:, None] + delta)
        return table[np.searchsorted(wanted, lengths)]

    shape = len(queries), cells
    exact = np.full(shape, np.iinfo(np.uint64).max, np.uint64)
    replaced, ahead, behind = (np.zeros(shape, np.uint64) for _ in range(3))
    near = np.zeros(shape, np.uint64)
    width = queries.shape[1]
    last, here, after = None, slice_at(0), slice_at(1)
    for at in range(int(lengths.max())):
        live = lengths > at
        letter = asked[:, at]
        equal, next_equal = here[letter], after[letter]
        last_equal = last[letter] if last is not None else np.zeros(shape, np.uint64)
        some = packed(sizes[None, :] > at)
        new_replaced = (replaced & equal) | (exact & ~equal & some)
        new_ahead = (ahead | exact) & next_equal
        new_behind = (behind & last_equal) | exact
        exact &= equal
        replaced, ahead, behind = new_replaced, new_ahead, new_behind
        ended = live & (lengths == at + 1)
        if ended.any():
            near[ended] = ((replaced & sized(0)) | ((ahead | exact) & sized(1)) | (behind & sized(-1)))[ended]
        last, here, after = here, after, slice_at(at + 2) if at + 2 < width else np.zeros_like(here)
    return near


def _compare(table: pa.Table) -> pa.RecordBatch | None:
    """For each word of the task its number of near words in the other block (or its own) and the place of the best."""
    length, side = table.column("len")[0].as_py(), table.column("side")[0].as_py()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    names = np.array([w.encode("latin-1") for w in table.column("word").to_pylist()], object)
    n, block = table.column("n").to_numpy(), table.column("block").to_numpy()
    # Words of larger counts first, ties by their text: the first of a word's near words is the best.
    order = sorted(range(len(names)), key=lambda k: (-n[k], names[k]))
    names, n, block = names[order], n[order], block[order]
    lengths = np.array([len(w) for w in names])
    width = int(lengths.max()) + 2
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in names), np.uint8).reshape(len(names), width)
    half = length // 2
    parts = [(i, j), (j, i)] if i != j else [(i, i)]
    out = []
    for mine, theirs in parts:
        a, b = np.flatnonzero(block == mine), np.flatnonzero(block == theirs)
        if not len(a) or not len(b):
            continue
        near = near_matrix(letters[a], lengths[a], letters[b], lengths[b])
        found = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little", count=len(b)).astype(bool)
        x, y = np.nonzero(found)
        # Pairs of this group: the shorter one has its length, and the halves agree as the group says.
        x, y = x[keep := np.minimum(lengths[a[x]], lengths[b[y]]) == length], y[keep]
        same = (letters[a[x], :half] == letters[b[y], :half]).all(axis=1)
        x, y = (x[same], y[same]) if side == 0 else (x[~same], y[~same])
        if len(x):
            first = np.concatenate(([True], x[1:] != x[:-1]))
            out.append((a[x[first]], np.bincount(x)[x[first]], b[y[first]]))
    if not out:
        return None
    at, near, best = (np.concatenate(c) for c in zip(*out, strict=True))
    text = lambda places: pa.array([names[k].decode("latin-1") for k in places], pa.string())
    return pa.RecordBatch.from_arrays([text(at), pa.array(near.astype(np.int64)), text(best), pa.array(n[best])], ["word", "near", "best", "best_n"])


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n_near, form, form_n) of (word, n), for words with a near one; ``form`` is the near word of the largest count."""
    task = ["len", "side", "bin", "i", "j"]
    rows = common.block_pairs(_places(words, min_length), "blocks", "block").repartition(*task).sortWithinPartitions(*task)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.runs(batches, task):
            out = _compare(table) if table.num_rows > 1 else None
            if out is not None:
                yield out

    found = rows.select("word", "n", "block", *task).mapInArrow(run, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("first")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", F.col("first.word").alias("form"), (-F.col("first.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where the forms end."""
    found = common.stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = common.stored(found.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if found.filter("moved").isEmpty():
            return found.select("word", "root")
        found = found.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    common.workers_see_package(docs.sparkSession)
    words = common.stored(counted(docs, id_col, text_col, min_length, min_count), "spelling-words")
    out = words.join(near_words(words, min_length), "word", "left")
    formed = F.col("form_n") >= ratio * F.col("n")
    out = out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"))
    out = common.stored(out, "spelling-forms")
    ends = roots(out.filter("form is not null").select("word", "form"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
