"""Operator 3: language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary.
A word (a run of letters, lower-cased, with the vocabulary's word mark in front) is
the sum over *all* its segmentations into pieces, which the forward algorithm gives;
a text is the product of its words.  Piece probabilities are learned by
expectation-maximisation: forward-backward gives the expected uses of each piece.

Learning reads a sample of about ``SAMPLE_PER_LANG`` whole documents of each
language, chosen by a hash of the id (the bound is the parameter); scoring reads every
document whole.  The model has languages x pieces numbers, whatever the corpus.

``score`` is the posterior of the predicted language, where the log-likelihood is
divided by the square root of the number of words, since words of a text are not
independent evidence.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text when no labelled document could be learned from.  Ties go to the first language in
order.  Every input row gives one output row, an empty table none; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

UNDETERMINED = "und"
SAMPLE_PER_LANG = 1_500
ITERATIONS = 3
#: Added to the expected uses of each piece.
SMOOTHING = 0.05
#: Probability of a character that no piece covers.
UNKNOWN = 1e-7
#: Letters between two rescalings of the forward values; shorter words are scored many at a time.
RESCALE = 24
#: Words that a worker process remembers.
REMEMBERED = 400_000

MARK = "▁"
WORDS = re.compile(r"[^\W\d_]+")
LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    langs: list[str]
    index: dict[str, int]
    prob: np.ndarray  # pieces x langs

    def __post_init__(self):
        self.longest = max(map(len, self.index), default=1)
        self.by_lang = [column.tolist() for column in self.prob.T]
        self.name = hash((tuple(self.langs), self.prob.tobytes()))


def pieces(path: str) -> list[str]:
    """The vocabulary's pieces that lower-cased words can use."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return sorted({p for p in map(model.id_to_piece, plain) if p == p.lower() and WORDS.fullmatch(p.removeprefix(MARK) or "a")})


def lattice(word: str, model: Model) -> list[list[tuple[int, int]]]:
    """For each start, the (end, piece) that the vocabulary allows; piece -1 is an uncovered character."""
    n, index = len(word), model.index
    out = []
    for i in range(n):
        ends = [(j, index[word[i:j]]) for j in range(i + 1, min(n, i + model.longest) + 1) if word[i:j] in index]
        if not ends or ends[0][0] != i + 1:
            ends.append((i + 1, -1))
        out.append(ends)
    return out


def forward(steps: list[list[tuple[int, int]]], prob: list[float], longest: int) -> float:
    """Log of the sum over all segmentations."""
    n, log = len(steps), 0.0
    a = [1.0] + [0.0] * n
    for i, ends in enumerate(steps):
        here = a[i]
        if i and i % RESCALE == 0:
            log += math.log(here)
            for j in range(i, min(n, i + longest) + 1):
                a[j] /= here
            here = 1.0
        for j, piece in ends:
            a[j] += here * (prob[piece] if piece >= 0 else UNKNOWN)
    return log + math.log(a[n])


def log_likelihoods(word: str, model: Model) -> list[float]:
    steps = lattice(MARK + word, model)
    return [forward(steps, prob, model.longest) for prob in model.by_lang]


class PieceTable:
    """Pieces by the hash of their characters, looked up for whole arrays of hashes.

    A piece has its slot in a first table, or in a second one where two share a slot of the first.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, model: Model):
        self.hashes = np.empty(len(model.index) + 1, np.uint64)
        for piece, i in model.index.items():
            self.hashes[i] = self.rolled(np.array([[ord(c) for c in piece]], np.uint64))[0, -1]
        self.hashes[-1] = 0  # where a slot is empty: no piece
        rest = np.arange(len(model.index))
        self.tables = []
        while len(rest):
            slots = np.full(1 << (20 if not self.tables else 16), len(model.index), np.int32)
            at = self.slot(self.hashes[rest], len(self.tables), len(slots))
            first = np.unique(at, return_index=True)[1]
            slots[at[first]] = rest[first]
            self.tables.append(slots)
            rest = np.delete(rest, first)
        self.missing = len(model.index)
        self.powers = self.BASE ** np.arange(model.longest + 1, dtype=np.uint64)

    @staticmethod
    def rolled(codes: np.ndarray) -> np.ndarray:
        """Hashes of the first 0, 1, ... characters of each row."""
        out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            out[:, k + 1] = out[:, k] * PieceTable.BASE + codes[:, k]
        return out

    @staticmethod
    def slot(hashes: np.ndarray, table: int, size: int) -> np.ndarray:
        return ((hashes * np.uint64(0xBF58476D1CE4E5B9 + 2 * table)) >> np.uint64(65 - size.bit_length())).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(hashes.shape, self.missing, np.int32)
        for k, slots in enumerate(self.tables):
            there = slots[self.slot(hashes, k, len(slots))]
            out = np.where(self.hashes[there] == hashes, there, out)
        return out


def many_log_likelihoods(words: list[str], model: Model, pieces_by_hash: PieceTable) -> np.ndarray:
    """``log_likelihoods`` of each word, words x languages: short words of one length at a time."""
    out = np.empty((len(words), len(model.langs)))
    by_size: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_size.setdefault(len(word), []).append(k)
    prob = np.vstack([model.prob, np.zeros(len(model.langs))])
    single = np.vstack([model.prob, np.full(len(model.langs), UNKNOWN)])
    for size, members in by_size.items():
        if size >= RESCALE:
            for k in members:
                out[k] = log_likelihoods(words[k], model)
            continue
        codes = np.frombuffer("".join(MARK + words[k] for k in members).encode("utf-32-le"), np.uint32).reshape(len(members), size + 1)
        prefix = pieces_by_hash.rolled(codes.astype(np.uint64))
        a = np.zeros((size + 2, len(members), len(model.langs)))
        a[0] = 1.0
        found = [None, *(pieces_by_hash.find(prefix[:, n:] - prefix[:, :-n] * pieces_by_hash.powers[n])
                         for n in range(1, min(size + 1, model.longest) + 1))]
        for i in range(size + 1):
            for n in range(1, min(size + 1 - i, model.longest) + 1):
                a[i + n] += a[i] * (single if n == 1 else prob)[found[n][:, i]]
        out[members] = np.log(a[size + 1])
    return out


def expected_uses(word: str, model: Model, lang: int) -> list[tuple[int, float]]:
    """(piece, expected uses in one occurrence of the word), by forward-backward."""
    word = MARK + word
    steps, prob, n = lattice(word, model), model.by_lang[lang], len(word)
    p = lambda piece: prob[piece] if piece >= 0 else UNKNOWN
    # Forward and backward values relative to each position's own, so that long words keep their precision.
    back, scale = [0.0] * (n + 1), [0.0] * (n + 1)
    back[n] = 1.0
    for i in range(n - 1, -1, -1):
        top = max(scale[j] for j, _ in steps[i])
        total = sum(p(piece) * back[j] * math.exp(scale[j] - top) for j, piece in steps[i])
        back[i], scale[i] = 1.0, top + math.log(total)
    reach, out = [0.0] * (n + 1), []
    reach[0] = 1.0  # probability that a boundary lies here
    for i in range(n):
        for j, piece in steps[i]:
            use = reach[i] * p(piece) * math.exp(scale[j] - scale[i])
            reach[j] += use
            if piece >= 0:
                out.append((piece, use))
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that learning never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_per_lang: int = SAMPLE_PER_LANG, iterations: int = ITERATIONS) -> Model:
    """Piece probabilities of each language in ``lang_col``, from a sample of its documents."""
    common.workers_see_package(docs.sparkSession)
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    vocabulary = pieces(vocab)
    index = {p: i for i, p in enumerate(vocabulary)}
    langs = sorted(sizes)
    if not langs:
        return Model([], index, np.zeros((len(index), 0)))
    grain = 1 << 30
    share = F.lit(0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(grain, grain * sample_per_lang // sizes[lang]))).otherwise(share)
    sample = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(grain)) < share)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in Counter(WORDS.findall((text or "").lower())).items():
                    counts[lang, word] += n
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                              pa.array(counts.values(), pa.int64())], ["lang", "word", "n"])

    words = sample.mapInArrow(count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = common.stored(words, "langid-words")
    model = Model(langs, index, np.full((len(index), len(langs)), 1.0 / len(index)))
    for _ in range(iterations):
        model = Model(langs, index, _maximised(_expected(words, model).collect(), langs, len(index)))
    return model


def _expected(words: DataFrame, model: Model) -> DataFrame:
    """(lang, piece, uses): at most one row for each language and piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter = Counter()
        at = {lang: k for k, lang in enumerate(model.langs)}
        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                for piece, use in expected_uses(word, model, at[lang]):
                    uses[at[lang], piece] += n * use
        keys = list(uses)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                          pa.array(uses.values(), pa.float64())], ["lang", "piece", "uses"])

    return words.mapInArrow(run, "lang int, piece int, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses"))


def _maximised(rows: list, langs: list[str], size: int) -> np.ndarray:
    uses = np.full((size, len(langs)), SMOOTHING)
    for r in rows:
        uses[r["piece"], r["lang"]] += r["uses"]
    return uses / uses.sum(axis=0)


class Memory:
    """Log-likelihoods of the words that a worker process met last."""

    def __init__(self, model: Model):
        self.model, self.pieces, self.known, self.table = model, PieceTable(model), {}, np.empty((0, len(model.langs)))

    def learn(self, documents: list[list[str]]) -> None:
        new = list(set().union(*documents).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.table = {}, np.empty((0, len(self.model.langs)))
            new = list(set().union(*documents))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            if len(self.known) > len(self.table):
                more = np.empty((max(len(self.known), min(2 * len(self.known), REMEMBERED)) - len(self.table), len(self.model.langs)))
                self.table = np.vstack([self.table, more])
            self.table[len(self.known) - len(new):len(self.known)] = many_log_likelihoods(new, self.model, self.pieces)

    def total(self, words: list[str]) -> np.ndarray:
        return self.table[list(map(self.known.__getitem__, words))].sum(axis=0)


_MEMORY: dict[int, Memory] = {}


def _memory(model: Model) -> Memory:
    """The memory of this process for the model; that of another model goes."""
    if model.name not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[model.name] = Memory(model)
    return _MEMORY[model.name]


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
             into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``id_col``, the ``keep`` columns, and the language and score (named ``into``) of every row."""
    common.workers_see_package(docs.sparkSession)
    kept = list(dict.fromkeys([id_col, *keep]))
    rows = docs.select(*kept) if text_col in kept else docs.select(*kept, text_col)
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), f"`{into[0]}` string", f"`{into[1]}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(model)
        for batch in common.slices(batches):
            texts = [t.as_py() or "" for t in batch.column(text_col)]
            words = [WORDS.findall(t.lower()) if model.langs and LETTER.search(t) else [] for t in texts]
            memory.learn(words)
            langs, scores = [], []
            for own in words:
                if not own:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                total = memory.total(own)
                best = int(total.argmax())
                langs.append(model.langs[best])
                scores.append(float(1.0 / np.exp((total - total[best]) / math.sqrt(len(own))).sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*kept, *into])

    return rows.mapInArrow(run, schema)
