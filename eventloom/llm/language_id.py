"""Language of whole texts: sparse multinomial logistic regression on character n-grams.

Features are character 1- to 3-grams of the lower-cased text in a hashed table,
weighed by ``log(1 + count)`` and inverse document frequency, then brought to
length one. Weights are trained with follow-the-regularised-leader and an
elastic net (L1 keeps most at zero), and a temperature that makes the
probabilities honest is fitted on texts that training has not seen.

Document frequencies are counted over all documents that may be learned from.
The weights come from a bounded sample on the driver: at most ``SAMPLE`` texts,
shared evenly among the languages, in hash order, of a longer one an excerpt of ``TEXT_CHARS``
from anywhere in it. Every text is then classified whole, where it lies.

Defined cases: ``und`` with score 0 for a null text or one without a letter, and
for all texts if there is nothing to learn from. Null languages are not learned.
Rows without an id count as held out. Very long texts are classified whole, repeated rows
alike and learned from once; an empty table gives no rows. Columns called like the
results are refused; others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 14
SAMPLE = 6000
TEXT_CHARS = 32 << 10
UNKNOWN = "und"

#: FTRL: learning rate, its smoothing, L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.01, 2


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def grams(text: str) -> np.ndarray:
    """Bucket of every character 1-, 2- and 3-gram."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    out, h = [], np.zeros(len(code), np.uint32)
    for n in range(min(3, len(code))):
        h = (h[: len(code) - n] ^ code[n:]) * np.uint32(0x9E3779B1)
        h = h ^ (h >> np.uint32(15))
        out.append(h)
    return (np.concatenate(out) if out else h) & np.uint32(BUCKETS - 1)


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and their values."""
    count = np.bincount(grams(text), minlength=BUCKETS)
    at = np.flatnonzero(count)
    value = np.log1p(count[at]) * idf[at]
    return at, value / max(float(np.sqrt(value @ value)), 1e-12)


def _log_odds(model: Model, text: str) -> np.ndarray:
    at, value = features(text, model.idf)
    return value @ model.weights[at] + model.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(texts: list[str], languages: list[str], idf: np.ndarray) -> Model:
    """Weights by FTRL on four of five texts, temperature on the fifth."""
    names = sorted(set(languages))
    if not names:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    k, label = len(names), np.array([names.index(x) for x in languages])
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))
    made = [features(t, idf) for t in texts]
    test = np.arange(len(texts)) % 5 == 4

    def weights_at(at):
        shrunk = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) > L1, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    order = np.random.default_rng(5).permutation(np.flatnonzero(~test))
    for _ in range(PASSES):
        for i in order:
            at, value = np.append(made[i][0], BUCKETS), np.append(made[i][1], 1.0)  # the last is the bias
            w = weights_at(at)
            p = _softmax(value @ w)
            p[label[i]] -= 1
            grad = value[:, None] * p
            step = (np.sqrt(n[at] + grad**2) - np.sqrt(n[at])) / ALPHA
            z[at] += grad - step * w
            n[at] += grad**2
    w = weights_at(np.arange(BUCKETS + 1))
    model = Model(names, idf, w[:-1], w[-1], 1.0)
    odds = np.array([made[i][1] @ model.weights[made[i][0]] + model.bias for i in np.flatnonzero(test)])
    if len(odds):
        grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
        loss = [-np.log(_softmax(odds / t)[np.arange(len(odds)), label[test]] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def _frequencies(batches):
    """For mapInArrow: in how many texts of this task each bucket occurs; bucket -1 counts the texts."""
    count, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for value in batch.column(0):
            count[np.bincount(grams(value.as_py()), minlength=BUCKETS) > 0] += 1
            texts += 1
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(count[at], texts), pa.int64())], names=["bucket", "texts"])


def held_out(doc: str):
    """The fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, text_chars: int = TEXT_CHARS) -> Model:
    """Model of the documents outside the held-out fifth."""
    known = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = known.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = known.select("text").mapInArrow(_frequencies, "bucket int, texts long").groupBy("bucket").agg(F.sum("texts")).collect()  # one row per bucket
    found = {r[0]: r[1] for r in counted}
    idf = np.full(BUCKETS, np.log(1 + found.get(-1, 0)) + 1)
    for bucket, n in found.items():
        if bucket >= 0:
            idf[bucket] = np.log((1 + found[-1]) / (1 + n)) + 1
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    each = max(1, sample // max(1, len(sizes)))
    # equal rows are one; a hash threshold per language leaves few more than are wanted to be put in order
    row = F.xxhash64("doc_id", "text")
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 4.0 * (each + 25) / n))]) if sizes else None
    some = known.withColumn("order", row)
    if share is not None:
        some = some.where(F.pmod("order", F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30))
    start = F.pmod("order", F.greatest(F.lit(1), F.char_length("text") - text_chars + 1)).cast("int") + 1
    some = some.groupBy("lang", "order").agg(F.first(F.substring("text", start, F.lit(text_chars))).alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    rows = some.withColumn("nth", nth).where(F.col("nth") <= each).select("text", "lang", "order").toPandas()
    rows = rows.sort_values(["order", "lang", "text"])
    return fit(rows["text"].tolist(), rows["lang"].tolist(), idf)


def predicted(docs: DataFrame, model: Model, *, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with the likeliest language and its probability; a table that has columns of their names is refused."""
    if {language, score} & set(docs.columns):
        raise ValueError(f"the table has a column {language} or {score}; name others for the results")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StringType, StructType

    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of one number per language
    schema = StructType([*docs.schema.fields]).add(language, StringType()).add(score, DoubleType())
    arrow = to_arrow_schema(schema)

    def of(batches):
        model = shared.value
        for batch in batches:
            names, scores = [], []
            for value in batch.column(text):
                value = value.as_py()
                if not value or not model.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = _softmax(_log_odds(model, value) / model.temperature)
                names.append(model.languages[int(p.argmax())])
                scores.append(float(p.max()))
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=arrow)

    letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    out = docs.mapInArrow(of, schema)
    return out.withColumn(score, F.when(letter, F.col(score)).otherwise(0.0)).withColumn(language, F.when(letter, F.col(language)).otherwise(UNKNOWN))
