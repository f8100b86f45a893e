"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy (operator 1)."""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fraudlens.llm.common import carried, in_chunks, run_starts, ship

SLOTS = 1 << 16  # hashed n-gram vectors
WIDTH = 8  # components of a vector
SIZES = (3, 4, 5)  # characters of an n-gram; a word's ends are marked
SEGMENT = 16  # words that are averaged
TOXIC_ROWS, CLEAN_ROWS = 2_000, 4_000  # bound of the training sample
TRAIN_BYTES = 64_000  # longer texts are not trained on
CACHED = 100_000  # word scores in each of the two generations of a worker's cache
CHUNK = 2 << 20
LEARNT = 4_000  # words whose n-grams are found at once
BLOCK = 1 << 18  # words or n-grams that a training step looks at together
RATES = (5.0, 0.1, 0.1)  # step lengths of vectors, softmax rows and biases
EMPTY = 0.05  # weight of an empty clean text beside the training texts

_WORD = regex.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of all words, and where each word's begin; every word has one at least."""
    marked = "".join([f"<{w}>" for w in words])
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(w) + 2 for w in words])
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(code))  # characters from here to the word's end
    rows, slots = [], []
    value = np.zeros(len(code), np.uint64)
    for n in range(1, max(SIZES) + 1):
        fits = len(code) - n + 1
        value = value[:fits] * np.uint64(0x100000001B3) + code[n - 1:]
        if n in SIZES:
            at = np.flatnonzero(left[:fits] >= n)
            x = value[at] * np.uint64(0x9E3779B97F4A7C15)
            rows.append(at)
            slots.append(((x ^ (x >> np.uint64(32))) >> np.uint64(8)) % np.uint64(SLOTS))
    at, slot = np.concatenate(rows), np.concatenate(slots).astype(np.int64)
    word = np.searchsorted(ends, at, side="right")
    order = np.argsort(word, kind="stable")
    return slot[order], np.searchsorted(word[order], np.arange(len(words)))


@dataclass
class Model:
    """N-gram vectors and the two softmax rows with their biases."""

    vectors: np.ndarray
    rows: np.ndarray
    bias: np.ndarray

    def slopes(self) -> np.ndarray:
        """What each n-gram adds to the difference of the two logits: averages are linear, so it can be found once."""
        return (self.vectors.astype(np.float64) * (self.rows[1] - self.rows[0])).sum(1)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])

    def pack(self) -> bytes:
        return b"".join(a.astype(np.float32).tobytes() for a in (self.vectors, self.rows, self.bias))

    @staticmethod
    def unpack(data: bytes) -> "Model":
        flat = np.frombuffer(data, np.float32)
        cut = SLOTS * WIDTH
        return Model(flat[:cut].reshape(SLOTS, WIDTH), flat[cut:cut + 2 * WIDTH].reshape(2, WIDTH), flat[cut + 2 * WIDTH:])


def segments(words: list[str]) -> Iterator[tuple[list[str], int]]:
    """Different words of each segment of a text, and its length; a short rest joins its predecessor.

    A word that is repeated adds nothing more to the average, so a text of one odd word is not extreme.
    """
    last = max(len(words) // SEGMENT, 1) - 1
    for k in range(last + 1) if words else ():
        part = words[k * SEGMENT:(k + 1) * SEGMENT if k < last else len(words)]
        yield list(dict.fromkeys(part)), len(part)


class Cut:
    """Segments of many texts: their different words, the numbers of all their words in a row, where each segment
    begins, its length and its text. No word is held twice."""

    def __init__(self, texts: Iterable[str]):
        self.number: dict[str, int] = {}
        number, every = self.number, array("i")
        starts, lengths, of = array("q"), array("q"), array("q")
        for i, text in enumerate(texts):
            for part, length in segments(words_of(text)):
                starts.append(len(every))
                lengths.append(length)
                of.append(i)
                every.extend([number.setdefault(w, len(number)) for w in part])
        self.word = np.array(every, np.int32)
        self.starts, self.lengths, self.text = (np.array(x, np.int64) for x in (starts, lengths, of))
        self.ends = np.append(self.starts, len(self.word))[1:]
        self.first = np.flatnonzero(run_starts(self.text))

    def means(self, each: np.ndarray) -> np.ndarray:
        """Average of each segment, where the different words have the values ``each``."""
        sums = [np.zeros(0)] + [np.add.reduceat(each[self.word[self.starts[a]:self.ends[b - 1]]], self.starts[a:b] - self.starts[a]) for a, b in blocks(self.ends)]
        return np.concatenate(sums) / self.lengths

    def on_words(self, chosen: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Sum of the ``share`` of the ``chosen`` segments (in order) over each different word in them."""
        found = np.zeros(len(self.number))
        size = (self.ends - self.starts)[chosen]
        for a, b in blocks(np.cumsum(size)):
            n = size[a:b]
            at = np.arange(n.sum()) + np.repeat(self.starts[chosen[a:b]] - (np.cumsum(n) - n), n)
            np.add.at(found, self.word[at].astype(np.intp), np.repeat(share[a:b], n))
        return found


class Grams:
    """Slots of the n-grams of words, found and added up in blocks, so that what is held beside them stays small."""

    def __init__(self, words: list[str]):
        slots, counts = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for lo in range(0, len(words), LEARNT):
            slot, begin = subwords(words[lo:lo + LEARNT])
            slots.append(slot.astype(np.uint16))  # there are SLOTS of them
            counts.append(np.diff(np.append(begin, len(slot))))
        self.slot, self.counts = np.concatenate(slots), np.concatenate(counts)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts

    def means(self, slopes: np.ndarray) -> np.ndarray:
        """Average over each word's n-grams, where the slots have the values ``slopes``."""
        sums = [np.zeros(0)] + [np.add.reduceat(slopes[self.slot[self.starts[a]:self.ends[b - 1]]], self.starts[a:b] - self.starts[a]) for a, b in blocks(self.ends)]
        return np.concatenate(sums) / self.counts

    def on_slots(self, on_word: np.ndarray) -> np.ndarray:
        """What falls on each slot, if that on a word is divided among its n-grams."""
        found, each = np.zeros(SLOTS), on_word / self.counts
        for a, b in blocks(self.ends):
            np.add.at(found, self.slot[self.starts[a]:self.ends[b - 1]].astype(np.intp), np.repeat(each[a:b], self.counts[a:b]))
        return found


def blocks(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of parts, whose ends are ``ends``, of ``BLOCK`` places or one part each."""
    at = 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        to = max(int(np.searchsorted(ends, done + BLOCK, side="right")), at + 1)
        yield at, to
        at = to


class _Descent:
    """Momentum descent whose step length is scaled by the running size of the whole gradient, not of each
    component: what few texts hold moves little."""

    def __init__(self, value: np.ndarray, rate: float):
        self.value, self.rate, self.t = value, rate, 0
        self.mean, self.square = np.zeros_like(value), 0.0

    def step(self, slope: np.ndarray) -> None:
        self.t += 1
        self.mean += 0.1 * (slope - self.mean)
        self.square += 0.02 * (float((slope * slope).sum()) - self.square)
        size = np.sqrt(self.square / (1 - 0.98**self.t)) + 1e-12
        self.value -= self.rate / (1 - 0.9**self.t) / size * self.mean


def train(texts: Iterable[str], labels: np.ndarray, warm: int = 10, steps: int = 110, seed: int = 7) -> Model:
    """Fit vectors and softmax together, full batch, on segments of texts.

    First every segment has its text's label. Then each text is judged by its most toxic segment, the
    classes weighing the same, so that clean parts of toxic texts no longer count as toxic. Without
    texts of both classes the model is constant.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1e-3, (SLOTS, WIDTH)).astype(np.float32)
    rows = rng.normal(0, 0.5, (2, WIDTH)).astype(np.float32)
    toxic = np.asarray(labels) == 1
    if toxic.all() or not toxic.any():
        share = float(toxic.mean()) if len(toxic) else 0.0
        share = min(max(share, 0.01), 0.99)
        return Model(vectors * 0, rows * 0, np.log(np.array([1 - share, share], np.float32)))
    cut = Cut(texts)
    grams = Grams(list(cut.number))
    bias = np.zeros(2, np.float32)
    fit = [_Descent(value, rate) for value, rate in zip((vectors, rows, bias), RATES)]
    for step in range(warm + steps):
        difference = rows[1] - rows[0]
        logit = cut.means(grams.means(vectors @ difference)) + (bias[1] - bias[0])
        if step < warm:
            chosen = np.arange(len(logit))
        else:  # the most toxic segment of each text
            chosen = np.lexsort((-logit, cut.text))[cut.first]
        own = toxic[cut.text[chosen]]
        weight = np.where(own, 0.5 / own.sum(), 0.5 / (~own).sum())
        sure = 1 / (1 + np.exp(-np.clip(logit[chosen], -30, 30)))
        if step >= warm:  # a toxic text without anything toxic is a wrong label: it pulls less the less it is believed
            weight = weight * np.where(own, np.minimum(1, 2 * sure), 1)
        error = weight * (sure - own)
        nothing = EMPTY / (1 + np.exp(bias[0] - bias[1]))  # a text without words is clean
        on_slot = grams.on_slots(cut.on_words(chosen, error / cut.lengths[chosen])).astype(np.float32)
        pull = on_slot @ vectors
        fit[0].step(np.outer(on_slot, difference))
        fit[1].step(np.stack([-pull, pull]))
        fit[2].step(np.array([-1, 1], np.float32) * (error.sum() + nothing))
    return Model(vectors, rows, bias)


class Scorer:
    """Scores texts with a model; words through a bounded cache."""

    def __init__(self, model: Model):
        self.slopes, self.offset = model.slopes(), model.offset()
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _learn(self, words: set[str]) -> None:
        for w in words & self.old.keys():
            self.young[w] = self.old[w]
        fresh = list(words - self.young.keys())
        for lo in range(0, len(fresh), LEARNT):
            part = fresh[lo:lo + LEARNT]
            slot, begin = subwords(part)
            sums = np.add.reduceat(self.slopes[slot], begin) / np.diff(np.append(begin, len(slot)))
            self.young.update(zip(part, sums.tolist()))

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Probability of being toxic of each text: that of its most toxic segment."""
        cut = Cut(texts)
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        self._learn({w for w in cut.number if w not in self.young})
        logit = np.full(len(texts), self.offset)
        if cut.number:
            mean = cut.means(np.array(list(map(self.young.__getitem__, cut.number))))
            logit[cut.text[cut.first]] += np.maximum.reduceat(mean, cut.first)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def train_toxicity(
    docs: DataFrame,
    labelled: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Model from the texts of ``labelled`` rows (``id_col``, ``label_col`` 0 or 1; others are left out).

    The sample is bounded: at most ``toxic_rows`` and ``clean_rows`` rows of ``TRAIN_BYTES`` bytes, those
    least by a hash of the id; of rows with one id, the least text. Rows without an id are not learnt from. One task fits it, so neither the driver nor the task grows with the data.
    """
    ship(docs.sparkSession)
    known = labelled.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().dropDuplicates(["id"])
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    short = texts.filter(F.octet_length("text") <= TRAIN_BYTES)
    known = known.join(short.select("id"), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.filter("label = 1").orderBy(*order).limit(toxic_rows).unionAll(known.filter("label = 0").orderBy(*order).limit(clean_rows))

    def fit(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("id").to_numpy(), kind="stable")
        texts, labels = group.column("text"), group.column("label").to_numpy()
        model = train((texts[int(i)].as_py() or "" for i in order), labels[order])  # one text at a time
        return pa.table([pa.array([model.pack()], pa.binary())], names=["model"])

    # of rows with one id, one text: ids that repeat cannot make the sample larger
    rows = short.join(chosen, "id").groupBy("id", "label").agg(F.min("text").alias("text")).withColumn("all", F.lit(0))
    packed = rows.groupBy("all").applyInArrow(fit, "model binary").collect()  # one row of fixed size
    return Model.unpack(packed[0]["model"]) if packed else train([], np.zeros(0))


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, unless given) and ``score``, 0 to 1: the softmax of the averaged
    subword vectors of a text's most toxic segment.

    Whole texts are read; a text without words (null, empty, punctuation) has the score of the biases
    alone. The model has a fixed size and is broadcast. No shuffle; every row is scored by itself, so
    repeated rows have equal scores; a column that is called ``score`` already gives way; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model.pack())
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    once = text_col in names and docs.schema[text_col].dataType.simpleString() == "string"  # a kept text is not sent twice
    rows, kinds, place = carried(docs, names if once else [*names, text_col])
    at = names.index(text_col) if once else len(names)
    if not once:
        rows = rows.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
        place |= {c: f"c{i}" for i, c in enumerate(names)}
        kinds = kinds.rpartition(", ")[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(Model.unpack(shared.value))
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(at))  # not all of a batch at once
            found = [score(part) for part in in_chunks(texts, len, CHUNK)]
            values = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], values], [*batch.schema.names[:len(names)], "score"])

    scored = rows.mapInArrow(run, f"{kinds}, score double" if names else "score double")
    return scored.select(*(F.col(place[c]).alias(c) for c in names), "score")
