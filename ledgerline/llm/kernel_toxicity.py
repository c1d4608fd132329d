"""Toxicity (operator 8): a subsequence string-kernel support vector machine with Nyström landmarks.

Two words are alike by the gap-weighted subsequence kernel: common subsequences of ``LENGTH``
letters, each weighing ``DECAY`` to the power of the stretch it takes in either word, with at most
``GAP`` - 1 letters skipped between two of its own; normalised, and raised to ``POWER``. Signs and
digits inside a word are skipped and runs of single letters joined first, so i.d-i o t and idxiot
stay near idiot. Landmarks are the labelled words that tell toxic texts best, and common words of
the others; the Nyström map of a stretch of words is the sum of its words'. A squared-hinge machine
is trained on stretches: all of the clean texts against, in each toxic text, the one that scores
highest (three rounds). As the map adds up over words, a word's part of the decision is one
number, which a worker computes once and remembers. A text scores as its worst stretch, through a
logistic fit. A stretch is a sentence's distinct words, or any ``SENTENCE`` of them in a row where it has more
(every start counts in scores, every ``SENTENCE``-th and the last one in the fit).

The fit reads a bounded sample of labelled rows: at most ``sample`` toxic and clean ones, of least id hash.
Their words are counted and their stretches mapped in tasks. To the driver come the landmarks' candidates, one
vector a toxic text, one number a text, and for each Newton step the clean side's normal equations
(a matrix of landmarks by landmarks a task), so its memory does not depend on the texts' lengths.
In the logistic fit each stands for (labelled rows of its kind) / (sampled ones), so scores keep their meaning
whatever the caps leave of the true mix.
Null or empty texts score like a text without words. Without words in toxic or in clean labelled
rows every score is 0. Columns the operator adds replace those of the same name; others pass through.
"""

from __future__ import annotations

import pickle
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.byte_bpe import mapped
from ledgerline.llm.common import drop, pair_hash, release, slices, small_batches, text_bytes, word_hashes, written
from ledgerline.llm.pretokens import WHITE_SPACE, HashIndex, ragged

LENGTH, GAP, DECAY, POWER, SENTENCE = 3, 2, 0.6, 4, 8
#: Labelled toxic and clean rows the fit may read, landmarks from toxic and from clean texts, and words a worker remembers.
SAMPLE, TOXIC_LANDMARKS, CLEAN_LANDMARKS, REMEMBERED = (1000, 2400), 96, 24, 1_000_000
BEGIN, END, BREAK, SKIP = 62, 63, 254, 0
#: Stretches, text bytes and rows the fit handles at a time, rows it reads at a time, words whose kernel is computed together, Newton steps a round,
#: steps after which the driver's JVM may collect, and partitions of the sample.
BLOCK, PIECE, ROWS, READ_ROWS, PART, STEPS, REST, SPREAD = 2048, 1 << 18, 128, 16, 1024, 30, 5, 12


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """Code of every code point: 1-26 for a-z, 27-60 for other letters (case folded), 254 for white space, 0 for the rest."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ord(ch.lower()[0])
            table[c] = low - 96 if 97 <= low <= 122 else 27 + low % 34
    table[WHITE_SPACE] = BREAK
    return table


@dataclass
class Split:
    """Words of a batch of texts, each once a sentence: word w's letters are ``letters[start[w]:start[w] + length[w]]``."""

    letters: np.ndarray
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray
    sentence: np.ndarray  # ascending
    names: np.ndarray


def split(column: pa.Array) -> Split:
    data, bounds = text_bytes(column)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), bounds)  # texts' bounds in code points
    kind = letter_codes()[code]
    stop = (code == 10) | np.isin(code, [46, 33, 63])
    stop[:-1] &= (code[:-1] == 10) | (kind[1:] == BREAK)  # a sentence ends with a line, or a sign before white space
    border = np.zeros(len(code) + 1, np.int64)
    border[at] += 1
    sentence = np.concatenate(([0], np.cumsum(stop)[:-1])) + np.cumsum(border[:-1]) if len(code) else np.empty(0, np.int64)
    word_no = np.cumsum((kind == BREAK) + border[:-1])  # changes with every white space and text
    is_letter = (kind > SKIP) & (kind < BEGIN)
    letters, word_no, sentence = kind[is_letter], word_no[is_letter], sentence[is_letter]
    text = np.searchsorted(at, np.flatnonzero(is_letter), side="right") - 1
    start = np.flatnonzero(np.concatenate(([True], word_no[1:] != word_no[:-1]))) if len(letters) else np.empty(0, np.int64)
    length = np.diff(np.append(start, len(letters)))
    # runs of three or more single letters in one text are one word
    single = length == 1
    joined = np.zeros(len(start), bool)
    if len(start) > 2:
        same = text[start[1:]] == text[start[:-1]]
        link = single[1:] & single[:-1] & same
        triple = np.zeros(len(start), bool)
        triple[:-2] |= link[:-1] & link[1:]
        inside = triple.copy()
        inside[1:] |= triple[:-1]
        inside[2:] |= triple[:-2]
        joined[1:] = link & inside[1:] & inside[:-1]
    start = start[~joined]
    length = np.diff(np.append(start, len(letters)))
    sentence = sentence[start]
    names = word_hashes(letters, start, start + length)
    once = np.sort(np.unique(pair_hash(sentence.astype(np.uint64), names), return_index=True)[1])
    return Split(letters, start[once], length[once], text[start[once]], sentence[once], names[once])


def _parts(column: pa.Array) -> list[pa.Array]:
    """``column`` in pieces of bounded size."""
    batch = pa.RecordBatch.from_arrays([column], ["text"])
    return [part.column(0) for part in slices(batch, "text", PIECE)]


def stretches(s: Split, every: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, end) of the stretches of each sentence that start at each ``every``-th word, and of its last one."""
    head = np.flatnonzero(np.concatenate(([True], s.sentence[1:] != s.sentence[:-1]))) if len(s.start) else np.empty(0, np.int64)
    size = np.diff(np.append(head, len(s.start)))
    over = np.maximum(0, size - SENTENCE)  # starts behind the first
    more = -(-over // every)
    first = np.minimum(np.repeat(head, more + 1) + ragged(np.zeros(len(head), np.int64), more + 1) * every, np.repeat(head + over, more + 1))
    return first, np.minimum(first + SENTENCE, np.repeat(head + size, more + 1))


def subsequences(letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, subsequence, weight) of words between a begin and an end mark, by word."""
    size = length + 2
    begin = np.cumsum(size) - size
    marked = np.empty(int(size.sum()), np.int64)
    marked[begin], marked[begin + size - 1] = BEGIN, END
    marked[ragged(begin + 1, length)] = letters[ragged(start, length)]
    word = np.repeat(np.arange(len(size)), size)
    left = np.repeat(begin + size, size) - np.arange(len(marked))  # letters from here to the word's end
    words, codes, weights = [], [], []
    for one in range(1, GAP + 1):
        for two in range(1, GAP + 1):
            i = np.flatnonzero(left > one + two)
            codes.append((marked[i] << 12) | (marked[i + one] << 6) | marked[i + one + two])
            words.append(word[i])
            weights.append(np.full(len(i), DECAY ** (one + two + 1)))
    key = np.concatenate(words) << 18 | np.concatenate(codes)
    order = np.argsort(key)
    key, weight = key[order], np.concatenate(weights)[order]
    if not len(key):
        return key, key, weight
    fresh = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[fresh] >> 18, key[fresh] & (2**18 - 1), np.add.reduceat(weight, fresh)


@dataclass
class Landmarks:
    """Landmark words' subsequence weights, and the index of those subsequences."""

    rows: np.ndarray  # subsequence -> row of weights, or -1
    weights: np.ndarray  # one column a landmark, normalised

    @classmethod
    def of(cls, letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> "Landmarks":
        word, code, weight = subsequences(letters, start, length)
        seen, row = np.unique(code, return_inverse=True)
        rows = np.full(1 << 18, -1, np.int32)
        rows[seen] = np.arange(len(seen))
        table = np.zeros((len(seen), len(start)), np.float32)
        table[row, word] = weight
        return cls(rows, table / np.sqrt((table**2).sum(axis=0)))

    def kernel(self, letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Normalised kernel, to ``POWER``, of each word with each landmark."""
        out = np.zeros((len(start), self.weights.shape[1]), np.float32)
        for k in range(0, len(start), PART):
            part = slice(k, min(k + PART, len(start)))
            word, code, weight = subsequences(letters, start[part], length[part])
            norm = np.sqrt(np.bincount(word, weight**2, part.stop - part.start))
            row = self.rows[code]
            hit = np.flatnonzero(row >= 0)
            if len(hit):
                word, value = word[hit], self.weights[row[hit]] * weight[hit, None].astype(np.float32)
                fresh = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                out[k + word[fresh]] = np.add.reduceat(value, fresh) / norm[word[fresh], None]
        return out**POWER


@dataclass
class Machine:
    landmarks: Landmarks | None
    part: np.ndarray | None  # of a word's kernel vector in the decision
    bias: float
    slope: float
    offset: float
    known: HashIndex = field(default_factory=lambda: HashIndex(16), repr=False)
    values: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"known": None, "values": []}

    def word_parts(self, s: Split) -> np.ndarray:
        if self.known is None or self.known.size > REMEMBERED:
            self.known, self.values = HashIndex(16), []
        entry = self.known.look(s.names)
        new = np.flatnonzero(entry < 0)
        if len(new):
            names, one = np.unique(s.names[new], return_index=True)
            found = self.landmarks.kernel(s.letters, s.start[new[one]], s.length[new[one]]) @ self.part
            self.known.add(names, np.round(found * 1e9).astype(np.int64) + (1 << 60))  # kept as whole numbers above any "missing"
            entry[new] = self.known.look(s.names[new])
        return (entry - (1 << 60)) / 1e9

    def decide(self, column: pa.Array) -> np.ndarray:
        """The worst stretch's decision value of each text."""
        return np.concatenate([np.empty(0), *map(self._decide, _parts(column))])  # a piece's arrays are many times its size

    def _decide(self, column: pa.Array) -> np.ndarray:
        s, out = split(column), np.full(len(column), self.bias)
        if len(s.start):
            total = np.concatenate(([0.0], np.cumsum(self.word_parts(s))))
            first, end = stretches(s, 1)
            np.maximum.at(out, s.text[first], total[end] - total[first] + self.bias)
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        if self.landmarks is None:
            return np.zeros(len(column))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decide(column) + self.offset, -30, 30)))


def normal_equations(x: np.ndarray, sign: float, part: np.ndarray, bias: float, all_: bool) -> np.ndarray:
    """Of one kind's kernel vectors inside the margin (``all_``: of all), the squared hinge's matrix and, as its last row, right side."""
    if not all_:
        x = x[sign * (x @ part + bias) < 1]
    a = np.column_stack([x, np.ones(len(x))]).astype(float)
    return np.vstack([a.T @ a, sign * a.sum(axis=0)])


def _platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    x = np.column_stack([z, np.ones(len(z))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        h = x.T @ (x * (weight * p * (1 - p) + 1e-9)[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-3 * np.array([a, b]))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


class Sample:
    """Blocks (kind, data) of the sampled texts, or of what was made of each: 1 for toxic, 0 for clean ones."""

    def __init__(self, blocks: list[tuple[np.ndarray, pa.Array]]):
        self.blocks = blocks

    def over(self, work) -> "Sample":
        """The sample with ``work(data)`` (binary, one a text) in place of its data."""
        return Sample([(kind, work(data)) for kind, data in self.blocks])

    def gather(self, work) -> list:
        """``work(kind, data)`` of each block; the results come to the driver."""
        return [work(kind, data) for kind, data in self.blocks]

    def total(self, work):
        """The sum of ``work(kind, data)``, of which one a task comes to the driver."""
        return sum(self.gather(work))

    def drop(self) -> None:
        pass

    def rest(self) -> None:
        pass


class SpreadSample(Sample):
    """A sample in a table (kind, data) that tasks read."""

    def __init__(self, rows: DataFrame):
        self.rows = written(rows, "toxicity-sample")

    def over(self, work) -> "SpreadSample":
        def run(batches):
            for batch in batches:
                for part in slices(batch, "data", PIECE):
                    yield pa.RecordBatch.from_arrays([part.column("kind"), work(part.column("data"))], ["kind", "data"])

        return SpreadSample(self.rows.mapInArrow(run, "kind int, data binary"))

    def _found(self, made) -> list:
        """What ``made`` of a task's blocks yields, from all tasks."""
        def run(batches):
            blocks = ((part.column("kind").to_numpy(), part.column("data")) for batch in batches for part in slices(batch, "data"))
            for found in made(blocks):
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["found"])

        return [pickle.loads(r.found) for r in self.rows.mapInArrow(run, "found binary").collect()]

    def gather(self, work) -> list:
        return self._found(lambda blocks: (work(*block) for block in blocks))

    def total(self, work):
        return sum(self._found(lambda blocks: [sum(work(*block) for block in blocks)]))

    def drop(self) -> None:
        release(self.rows.sparkSession, self.rows)

    def rest(self) -> None:
        """Lets the driver's JVM give back what the jobs so far have left in its heap."""
        release(self.rows.sparkSession)


def word_counts(kind: np.ndarray, column: pa.Array) -> pa.RecordBatch:
    """(name, letters, toxic, clean): each word of a block, and how many texts of either kind hold it."""
    s = split(column)
    once = np.unique(pair_hash(s.text.astype(np.uint64), s.names, 5), return_index=True)[1]
    names, one, back = np.unique(s.names[once], return_index=True, return_inverse=True)
    toxic = np.bincount(back, kind[s.text[once]] == 1, len(names)).astype(np.int64)
    first = once[one]
    edge = np.concatenate(([0], np.cumsum(s.length[first]))).astype(np.int32)
    letters = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(edge), pa.py_buffer(s.letters[ragged(s.start[first], s.length[first])].tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), letters, pa.array(toxic), pa.array(np.bincount(back, minlength=len(names)) - toxic)],
                                      ["name", "letters", "toxic", "clean"])


def landmarks_of(words: pa.Table, n_toxic: int, n_clean: int) -> tuple[Landmarks, np.ndarray, np.ndarray]:
    """Landmarks from counted words, how telling each is, and their Nyström map."""
    name, toxic, clean = (words.column(c).to_numpy() for c in ("name", "toxic", "clean"))
    telling = np.where(toxic > 0, toxic * np.log(((toxic + 0.5) / max(1, n_toxic)) / ((clean + 0.5) / max(1, n_clean))), -np.inf)
    best = np.lexsort((name, -telling))[:min(TOXIC_LANDMARKS, int((toxic > 0).sum()))]
    common = np.lexsort((name, -clean))
    common = common[~np.isin(common, best) & (clean[common] > 0)][:CLEAN_LANDMARKS]
    letters = [np.frombuffer(words.column("letters")[int(i)].as_py(), np.uint8) for i in (*best, *common)]
    length = np.array([len(x) for x in letters])
    letters, start = np.concatenate(letters), np.cumsum(length) - length
    landmarks = Landmarks.of(letters, start, length)
    value, vector = np.linalg.eigh(landmarks.kernel(letters, start, length).astype(float))
    keep = value > 1e-6
    return landmarks, np.concatenate([np.maximum(0.0, telling[best]), np.zeros(len(common))]), (vector[:, keep] / np.sqrt(value[keep])).astype(np.float32)


def stretch_vectors(landmarks: Landmarks, column: pa.Array) -> pa.Array:
    """Each text's stretches as kernel vectors (rows of float32, one after another)."""
    s = split(column)
    first, end = stretches(s, SENTENCE)
    width = landmarks.weights.shape[1]
    edge = np.searchsorted(s.text[first] if len(first) else first, np.arange(len(column) + 1)) * width * 4
    parts = []
    for k in range(0, len(first), BLOCK):  # a block of stretches at a time
        a, b = first[k:k + BLOCK], end[k:k + BLOCK]
        _, one, back = np.unique(s.names[a[0]:b.max()], return_index=True, return_inverse=True)
        at = a[0] + one
        kernel = np.vstack([landmarks.kernel(s.letters, s.start[at], s.length[at])[back], np.zeros((1, width), np.float32)])
        edges = np.column_stack([a, b]).ravel() - a[0]
        parts.append(np.add.reduceat(kernel, edges)[::2].astype(np.float32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(b"".join(parts))])


def matrix(kind: np.ndarray, data: pa.Array, which: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, text) of the stretches of a block's texts of one kind."""
    mine = data.filter(pa.array(kind == which))
    n = np.asarray(pc.binary_length(mine), np.int64) // (4 * width)
    return np.frombuffer(b"".join(x.as_buffer() for x in mine), np.float32).reshape(-1, width), np.repeat(np.arange(len(mine)), n)


def fit(toxic: pa.Array, clean: pa.Array, labelled: tuple[int, int] | None = None) -> Machine:
    """A machine of a sample of toxic and clean texts; ``labelled``: how many rows of either kind it stands for."""
    blocks = [(np.full(len(part), kind), part) for kind, column in ((1, toxic), (0, clean))
              for part in (p.column(0) for p in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text", PIECE))]
    sample, sizes = Sample(blocks), (len(toxic), len(clean))
    words = sample.gather(word_counts)
    words = pa.Table.from_batches(words).group_by("name").aggregate([("letters", "min"), ("toxic", "sum"), ("clean", "sum")]) \
        .rename_columns(["name", "letters", "toxic", "clean"]) if words else pa.table({"toxic": [], "clean": []})
    return fit_sample(sample, words, sizes, labelled or sizes)


def fit_sample(sample: Sample, words: pa.Table, sizes: tuple[int, int], labelled: tuple[int, int]) -> Machine:
    """A machine of a sample of ``sizes`` (toxic, clean) texts; ``words`` holds, of its counted words, those that can become landmarks."""
    if not all(pc.sum(words.column(c)).as_py() for c in ("toxic", "clean")):
        return Machine(None, None, 0.0, 1.0, 0.0)
    landmarks, telling, root = landmarks_of(words, *sizes)
    width = len(telling)
    mapped_ = sample.over(lambda data: stretch_vectors(landmarks, data))

    def worst(part: np.ndarray) -> np.ndarray:
        """In each toxic text, the stretch that scores highest."""
        def of(kind, data):
            x, text = matrix(kind, data, 1, width)
            order = np.lexsort((-(x @ part), text))
            return x[order[np.flatnonzero(np.diff(text, prepend=-1))]]
        return np.vstack(mapped_.gather(of))

    def against(part: np.ndarray, bias: float, all_: bool) -> np.ndarray:
        return mapped_.total(lambda kind, data: normal_equations(matrix(kind, data, 0, width)[0], -1.0, part, bias, all_))

    n_clean = mapped_.total(lambda kind, data: len(matrix(kind, data, 0, width)[0]))
    chosen, w, part = worst(telling.astype(np.float32)), None, np.zeros(width, np.float32)
    project = np.block([[root, np.zeros((width, 1))], [np.zeros((1, root.shape[1])), np.ones((1, 1))]])
    for _ in range(3):
        cost = 10.0 * np.sqrt(n_clean / len(chosen))
        for step in range(STEPS):  # Newton steps over the rows inside the margin
            if step % REST == REST - 1:
                mapped_.rest()
            margin = (part, 0.0 if w is None else w[-1], w is None)
            both = cost * normal_equations(chosen, 1.0, *margin) + 10.0 * against(*margin)
            left = project.T @ both[:-1] @ project + np.diag([1.0] * root.shape[1] + [1e-6])
            new = np.linalg.solve(left, both[-1] @ project)
            done = w is not None and np.allclose(new, w, rtol=1e-5, atol=1e-7)
            w, part = new, (root @ new[:-1]).astype(np.float32)
            if done:
                break
        chosen = worst(part)
        mapped_.rest()
    mapped_.drop()
    made = Machine(landmarks, part, float(w[-1]), 1.0, 0.0)
    decided = sample.gather(lambda kind, data: (kind, made.decide(data)))
    y, z = (np.concatenate([d[k] for d in decided]) for k in (0, 1))
    stands_for = [total / max(1, size) for total, size in zip(labelled, sizes)]
    made.slope, made.offset = _platt(z, y.astype(float), np.where(y > 0, *stands_for))
    return made


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: tuple[int, int] = SAMPLE) -> Machine:
    """Fits on the rows of ``docs`` with a label in ``labels`` (``doc_id``, ``toxic`` 0 or 1)."""
    spark = docs.sparkSession
    small_batches(spark)
    most = {"spark.sql.execution.arrow.maxRecordsPerBatch": ROWS, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
    before = {key: spark.conf.get(key) for key in most}
    for key, rows in most.items():  # for the fit: a text's vectors are many times its size
        spark.conf.set(key, str(min(int(before[key]), rows)))
    try:
        return _train(docs, labels, doc_id, text, toxic, sample)
    finally:
        for key, rows in before.items():
            spark.conf.set(key, rows)


def _train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, sample: tuple[int, int]) -> Machine:
    kinds, labelled = [], []
    for value, limit in zip((1, 0), sample):
        all_ids = labels.filter(F.col(toxic) == value).select(doc_id).distinct()
        ids = all_ids.orderBy(F.xxhash64(doc_id), doc_id).limit(limit)
        rows = docs.select(doc_id, F.col(text).alias("text")).join(F.broadcast(ids), doc_id, "left_semi")  # at most ``limit`` ids
        kinds.append(rows.orderBy(F.xxhash64(doc_id), doc_id).limit(limit).select(F.lit(value).alias("kind"), F.coalesce("text", F.lit("")).cast("binary").alias("data")))
        labelled.append(docs.select(doc_id).join(all_ids, doc_id, "left_semi").count())
    texts = SpreadSample(kinds[0].unionByName(kinds[1]).repartition(SPREAD))
    sizes = {r.kind: r.n for r in texts.rows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    sizes = sizes.get(1, 0), sizes.get(0, 0)

    def count(batches):
        for batch in batches:
            for part in slices(batch, "data", PIECE):
                yield word_counts(part.column("kind").to_numpy(), part.column("data"))

    words = texts.rows.mapInArrow(count, "name long, letters binary, toxic long, clean long").groupBy("name").agg(
        F.min("letters").alias("letters"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = written(words, "toxicity-words")
    telling = F.col("toxic") * F.log((F.col("toxic") + 0.5) / max(1, sizes[0]) / ((F.col("clean") + 0.5) / max(1, sizes[1])))
    near = words.filter("toxic > 0").orderBy(F.desc(telling), "name").limit(TOXIC_LANDMARKS + 8) \
        .unionByName(words.filter("clean > 0").orderBy(F.desc("clean"), "name").limit(TOXIC_LANDMARKS + CLEAN_LANDMARKS)).distinct().toArrow()
    drop(docs.sparkSession, words)
    machine = fit_sample(texts, near, sizes, tuple(labelled))
    texts.drop()
    return machine


def score(df: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` plus ``out``: each text's probability of being toxic."""
    return mapped(df, text, out, T.DoubleType(), lambda col: pa.array(machine.score(col), pa.float64()))
