"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word is the bag of its character 3- to 5-grams, word edges included; each has a
vector in a hashed table. A span of ``SPAN`` words is the mean of its
words' vectors, and a linear softmax tells toxic spans from others. Table and
softmax are trained jointly in numpy, so a misspelling that was never seen is
near the words whose n-grams it shares.

Labels are given for texts, not for spans: each round trains toxic texts on the
spans that score highest so far, and other texts on their highest and on random
ones. A text's score is that of its highest span over the whole text, through a
logistic calibration.

Training takes a bounded sample on the driver: of each label at most
``PER_LABEL`` texts in the order of a hash, of a longer one an excerpt of ``TEXT_CHARS``
from anywhere in it, of a toxic one ``TOXIC_EXCERPT`` times that. The whole corpus is scored where it lies, without a shuffle. As all after the table is
linear, tasks get one number for each subword.

Defined cases: a null or empty text has no span and gets the calibrated score of
a neutral span. Labels other than 0 and 1, or null, are not learned from.
Without examples of both labels every score is the share of toxic ones (0 if
there is none). A row without an id counts as held out. Very long texts are scored whole.
Repeated rows are scored alike; of an id's rows at most ``PER_LABEL`` are learned from. An empty
table gives no rows. A column called like the score is refused; others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import trimmed
from eventloom.llm.words import LETTERS_AND_DIGITS, Words, buffer_of, mixed, ranges, row_blocks, words_of

BUCKETS = 1 << 16
DIM = 16
SPAN = 4
PER_LABEL = 2500
TEXT_CHARS = 8 << 10
#: Times as many of a toxic text.
TOXIC_EXCERPT = 4
ROUNDS = 6
SEED = 17
#: How often a subword must occur to be learned.
LEAST_SEEN = 3
#: Texts that a round goes through at least, with repeats.
LEAST_SPANS = 3000
CHUNK_BYTES = 2 << 20

_EDGE = 10  # a line feed is in no word


@dataclass
class Model:
    """Score of each subword, and intercept and slope from span score to log odds."""

    subword: np.ndarray
    intercept: float
    slope: float


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word at these bytes, and the splits; made in blocks of words."""
    parts = [_subwords(data, start[k : k + block], end[k : k + block]) for k in range(0, len(start), block)]
    counts = np.concatenate([np.zeros(1, np.int64), *(np.diff(splits) for _, splits in parts)])
    return np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in parts)]), np.cumsum(counts)


def _subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = end - start + 1
    where = ranges(start, length)
    chars = _lowered(data[np.minimum(where, len(data) - 1)])
    chars[np.cumsum(length) - 1] = _EDGE
    code = np.frombuffer((b"\n" + chars.tobytes()).decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    edge = code == _EDGE
    word = np.cumsum(edge) - 1  # of the character that follows this place's edge
    owners, buckets = [], []
    for n in (3, 4, 5):
        if len(code) < n:
            continue
        inner = np.zeros(len(code) - n + 1, bool)
        h = np.full(len(inner), n, np.uint64)
        for k in range(n):
            h = mixed(h * np.uint64(31) + code[k : k + len(inner)])
            if 0 < k < n - 1:
                inner |= edge[k : k + len(inner)]
        good = np.flatnonzero(~inner)
        owners.append(word[good])
        buckets.append(h[good])
    owner, bucket = np.concatenate(owners), (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(start) + 1))


def _span_means(values: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean value of every span, its first word, and the row splits of the spans."""
    n = np.diff(splits)
    count = np.where(n >= SPAN, n - SPAN + 1, np.minimum(n, 1))
    first = ranges(splits[:-1], count)
    size = np.repeat(np.minimum(n, SPAN), count)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return (total[first + size] - total[first]) / np.maximum(size, 1), first, np.concatenate(([0], np.cumsum(count)))


def _highest(means: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """The highest of each row; 0 for a row without any."""
    out = np.zeros(len(splits) - 1)
    some = np.flatnonzero(np.diff(splits))
    if len(some):
        out[some] = np.maximum.reduceat(means, splits[some])
    return out


def _row_scores(data: np.ndarray, offsets: np.ndarray, subword: np.ndarray) -> np.ndarray:
    words = words_of(data, offsets, LETTERS_AND_DIGITS)
    if not len(words.hash):
        return np.zeros(len(offsets) - 1)
    _, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    ids, splits = subwords(data, words.start[first], words.end[first])
    value = np.add.reduceat(subword[ids], splits[:-1]) / np.diff(splits)
    means, _, spans = _span_means(value[back], words.splits)
    return _highest(means, spans)


def fit(texts: list, toxic: list, *, rounds: int = ROUNDS, seed: int = SEED) -> Model:
    """Model of these labelled texts."""
    label = np.asarray(toxic, np.int64)
    if label.size == 0 or label.min() == label.max():
        share = float(label.mean()) if label.size else 0.0
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0)
        return Model(np.zeros(BUCKETS), odds, 0.0)
    rng = np.random.default_rng(seed)
    data, offsets = buffer_of(pa.array(texts, pa.string()))
    words = words_of(data, offsets, LETTERS_AND_DIGITS)
    _, first, back = np.unique(words.hash, return_index=True, return_inverse=True)
    ids, splits = subwords(data, words.start[first], words.end[first])
    size, back = np.diff(splits), back.astype(np.int32)
    none = np.zeros(0, np.int64)
    words, data = Words(none, none, none, words.splits), None  # only the splits are needed from here on
    table = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    seen = np.bincount(ids, np.repeat(np.bincount(back), size), BUCKETS)
    table[seen < LEAST_SEEN] = 0  # too rare to learn anything of
    learned = (table != 0).any(1)
    weight, bias = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    square = [np.full(BUCKETS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)]
    used = np.diff(words.splits) > 0
    for turn in range(rounds):
        per_bucket = table @ (weight[:, 1] - weight[:, 0])
        value = np.add.reduceat(per_bucket[ids], splits[:-1]) / size
        means, at, spans = _span_means(value[back], words.splits)
        top = _top_spans(means, spans, used)
        random = lambda rows: (spans[rows] + rng.random(len(rows)) * (spans[rows + 1] - spans[rows])).astype(np.int64)
        bad, good = np.flatnonzero(used & (label == 1)), np.flatnonzero(used & (label == 0))
        again = max(1, LEAST_SPANS // len(label))  # few texts are gone through more often
        if turn == 0:  # nothing is known yet: several spans of every text
            parts = [random(x) for _ in range(24 * again) for x in (bad, good)]
            signs = [k for _ in range(24 * again) for k in (1, 0)]
        else:
            parts = [top[bad], top[bad], top[bad], top[good], *(random(good) for _ in range(4))] * again
            signs = [1, 1, 1, 0, 0, 0, 0, 0] * again
        chosen = np.concatenate(parts)
        marks = np.concatenate([np.full(len(x), k) for x, k in zip(parts, signs, strict=True)])
        order = rng.permutation(len(chosen))
        for lo in range(0, len(order), 1024):
            part = chosen[order[lo : lo + 1024]]
            _step(at[part], marks[order[lo : lo + 1024]], words, back, ids, splits, table, weight, bias, square)
            table[~learned] = 0
    per_bucket = (table @ (weight[:, 1] - weight[:, 0])).astype(np.float64)
    value = np.add.reduceat(per_bucket[ids], splits[:-1]) / size
    means, _, spans = _span_means(value[back], words.splits)
    return Model(per_bucket, *_calibrated(_highest(means, spans), label))


def _top_spans(means: np.ndarray, spans: np.ndarray, used: np.ndarray) -> np.ndarray:
    best = _highest(means, spans)
    row = np.repeat(np.arange(len(spans) - 1), np.diff(spans))
    hit = np.flatnonzero(means == best[row])
    out = np.zeros(len(used), np.int64)
    out[row[hit[::-1]]] = hit[::-1]  # the first of equal ones
    return out


def _step(first, marks, words, back, ids, splits, table, weight, bias, square, rate: float = 0.2) -> None:
    """One batch: forward, gradients of softmax and table, AdaGrad update in place."""
    row = np.searchsorted(words.splits, first, "right") - 1
    many = np.minimum(SPAN, words.splits[row + 1] - first)
    word = back[ranges(first, many)]
    own, local = np.unique(word, return_inverse=True)
    many_sub = splits[own + 1] - splits[own]
    sub = ids[ranges(splits[own], many_sub)]
    vector = np.add.reduceat(table[sub], np.concatenate(([0], np.cumsum(many_sub)[:-1]))) / many_sub[:, None]
    edges = np.concatenate(([0], np.cumsum(many)[:-1]))
    hidden = np.add.reduceat(vector[local], edges) / many[:, None]
    logits = hidden @ weight + bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(marks)), marks] -= 1
    # both classes count alike
    share = marks.mean()
    p *= np.where(marks == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))[:, None]
    d_hidden = (p @ weight.T) / many[:, None]
    d_word = np.zeros_like(vector)
    np.add.at(d_word, local, np.repeat(d_hidden, many, axis=0))
    buckets, to = np.unique(sub, return_inverse=True)
    d_table = np.zeros((len(buckets), DIM), np.float32)
    np.add.at(d_table, to, np.repeat(d_word / many_sub[:, None], many_sub, axis=0).astype(np.float32))
    d_weight, d_bias = hidden.T @ p, p.sum(0)
    square[0][buckets] += (d_table**2).mean(1)
    table[buckets] -= rate * d_table / np.sqrt(square[0][buckets])[:, None]
    for value, grad, total in ((weight, d_weight, square[1]), (bias, d_bias, square[2])):
        total += grad**2
        value -= (rate * 0.25 * grad / np.sqrt(total)).astype(np.float32)


def _calibrated(score: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through the texts' highest spans, classes weighed alike."""
    middle, wide = score.mean(), score.std() + 1e-9
    x = np.stack((np.ones(len(score)), (score - middle) / wide), 1)
    weight = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - label)) + 1e-4 * beta
        beta -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2), grad)
    return float(beta[0] - beta[1] * middle / wide), float(beta[1] / wide)


def learn(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", toxic: str = "toxic", per_label: int = PER_LABEL, text_chars: int = TEXT_CHARS) -> Model:
    """Model of a bounded sample of the labelled documents outside the held-out third."""
    texts = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    marked = labels.select(F.col(doc).alias("doc_id"), F.col(toxic).alias("toxic")).where(~held_out("doc_id") & F.col("toxic").isin(0, 1))
    known = marked.distinct().join(texts.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(per_label) for k in (0, 1)]
    # a longer text takes part with an excerpt from anywhere in it; a toxic one's is longer, as it should hold what is toxic
    chars = F.when(F.col("toxic") == 1, F.lit(TOXIC_EXCERPT * text_chars)).otherwise(F.lit(text_chars))
    start = F.pmod(F.xxhash64("doc_id", "text"), F.greatest(F.lit(1), F.char_length("text") - chars + 1)).cast("int") + 1
    rows = texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id").withColumn("order", order)  # 2 * per_label ids
    rows = rows.withColumn("text", F.substring("text", start, chars))
    rows = rows.where("toxic = 0").orderBy("order", "doc_id", "text").limit(per_label).union(rows.where("toxic = 1").orderBy("order", "doc_id", "text").limit(per_label))
    found = rows.select("text", "toxic", "order", "doc_id").toPandas().sort_values(["order", "doc_id", "text"])
    texts, marks = found["text"].tolist(), found["toxic"].tolist()
    del found
    return fit(texts, marks)


def held_out(doc: str):
    """The third of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def scored(docs: DataFrame, model: Model, *, text: str = "text", score: str = "score") -> DataFrame:
    """The rows with a ``score`` column, 0 to 1; a table that has a column of that name is refused."""
    if score in docs.columns:
        raise ValueError(f"the table has a column {score}; name another for the score")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructType

    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number for each bucket
    schema = StructType([*docs.schema.fields]).add(score, DoubleType())
    arrow = to_arrow_schema(schema)

    def of(batches):
        for batch in batches:
            data, offsets = buffer_of(batch.column(text))
            for a, b in row_blocks(offsets, CHUNK_BYTES):
                x = _row_scores(data, offsets[a : b + 1], shared.value.subword)
                odds = shared.value.intercept + shared.value.slope * x
                p = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
                columns = [c.cast(f.type) for c, f in zip(batch.slice(a, b - a).columns, arrow, strict=False)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(p)], schema=arrow)

    return docs.mapInArrow(trimmed(of), schema)
