"""Language identification: averaged hashed subword embeddings under a linear softmax, with rejection.

A text is the mean of the embeddings of its subwords: runs of 2 to 4 UTF-8 bytes inside a word and its two
borders (A-Z as a-z; other ASCII than letters separates words), hashed to 2^16 rows. The classes' linear
softmax over that mean and the embeddings are trained together by stochastic gradient descent (AdaGrad steps)
in numpy. As both maps are linear, a worker only needs one score per subword and class, and a text costs one
pass over its bytes.

Training rows are a bounded sample, the one documented bound here: of the documents offered, about
SAMPLE_ROWS / languages of each of the MAX_LANGUAGES most frequent languages, chosen by a hash of the row, at
most 2 * SAMPLE_ROWS altogether. Executors count their subwords; the driver trains on the counts. A fifth of
the sample is kept out of training to calibrate: one temperature that minimises its log loss, and the score
below which texts are rejected (the lowest REJECT share of its rightly classified texts, 0.5 at most).

Defined cases. Null text, or text without a letter: `und`, score 0, rejected. Null lang or null id: never
trained on. Repeated rows: predicted alike. No row to learn from: every text is `und`. Empty table: empty
result. Text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridcast.llm import words as w
from gridcast.llm.tables import bounded_batches

UNKNOWN = "und"
SAMPLE_ROWS = 3200
MAX_LANGUAGES = 100
BITS = 16
DIMENSIONS = 16
EPOCHS = 8
REJECT = 0.001
PART_VALUES = 1 << 22

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.full(256, 32, np.uint8)
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # 2^BITS x languages: a subword's share of the logits, temperature included
    bias: np.ndarray
    threshold: float


def _subwords(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and buckets of all subwords of the bytes, one length after the other."""
    folded = _FOLD[data].astype(np.uint32)
    solid = folded != 32
    for n, salt in ((2, 0x9E3779B1), (3, 0x85EBCA77), (4, 0xC2B2AE3D)):
        if len(data) < n:
            continue
        m = len(data) - n + 1
        key = folded[:m].copy()
        for k in range(1, n):
            key |= folded[k:k + m] << np.uint32(8 * k)
        inside = solid[:m] | solid[1:1 + m] if n == 2 else solid[1:1 + m] if n == 3 else solid[1:1 + m] & solid[2:2 + m]
        at = np.flatnonzero(inside)
        key = key[at] * np.uint32(salt)
        key ^= key >> np.uint32(15)
        yield at, (key * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)


def _bordered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    text = column.cast(pa.large_string()).fill_null("")
    return w.buffers(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar(" ", pa.large_string()),
                                                 pa.scalar("", pa.large_string())))


def _has_letter(column: pa.Array) -> np.ndarray:
    return np.array([t is not None and _LETTER.search(t) is not None for t in column.to_pylist()], bool)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = _bordered(b.column(1))
        buckets, numbers = [], []
        for low, high in zip(offsets[:-1], offsets[1:]):
            got = np.concatenate([np.zeros(0, np.uint32), *[h for _, h in _subwords(data[low:high])]])
            found, times = np.unique(got, return_counts=True)
            buckets.append(found.astype("<u4").tobytes())
            numbers.append(times.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(buckets, pa.binary()), pa.array(numbers, pa.binary())],
                                         names=["lang", "buckets", "numbers"])


def learnable(id_col: str = "doc_id", lang_col: str = "lang") -> Column:
    """The rows that may be learnt from: not held out, with a language."""
    return (F.crc32(F.col(id_col).cast("string")) % 4 != 2) & F.col(lang_col).isNotNull()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS,
          seed: int = 11) -> Model | None:
    """Fit on the labelled rows of `docs`; None without any."""
    rows = docs.select(docs[lang_col].alias("lang"), docs[text_col].alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    found = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not found:
        return None
    share = F.lit(0.0)
    for r in found:
        share = F.when(F.col("lang") == r.lang, sample_rows / len(found) / r["count"]).otherwise(share)
    draw = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    taken = rows.where(draw < share).limit(2 * sample_rows).mapInArrow(_counts, "lang string, buckets binary, numbers binary")
    sample = sorted((r.lang, bytes(r.buckets), bytes(r.numbers)) for r in taken.collect() if r.buckets)
    return _fit([(lang, np.frombuffer(b, "<u4"), np.frombuffer(n, "<u4")) for lang, b, n in sample], seed) if sample else None


def _fit(sample: list[tuple[str, np.ndarray, np.ndarray]], seed: int) -> Model:
    languages = sorted({lang for lang, _, _ in sample})
    spread = np.random.default_rng(seed)
    order = spread.permutation(len(sample))
    examples = [(languages.index(sample[i][0]), sample[i][1], sample[i][2].astype(np.float32)) for i in order]
    kept = len(examples) // 5
    check, learn = examples[:kept], examples[kept:]
    table = spread.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    table_sum, weights_sum, bias_sum = np.full(1 << BITS, 1e-8, np.float32), np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)

    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    for _ in range(EPOCHS):
        for i in spread.permutation(len(learn)):
            label, buckets, numbers = learn[i]
            if (some := spread.integers(8, 1024)) < len(buckets):  # parts of texts stand for short texts
                at = spread.choice(len(buckets), some, replace=False)
                buckets, numbers = buckets[at], numbers[at]
            part = numbers / numbers.sum()
            mean = part @ table[buckets]
            error = softmax(mean @ weights + bias)
            error[label] -= 1
            back = weights @ error
            grad = np.outer(mean, error)
            weights_sum += grad * grad
            bias_sum += error * error
            weights -= 0.3 * grad / np.sqrt(weights_sum)
            bias -= 0.05 * error / np.sqrt(bias_sum)
            table_sum[buckets] += part * part * np.mean(back * back)
            table[buckets] -= 0.05 * (part / np.sqrt(table_sum[buckets]))[:, None] * back
    scores = table @ weights
    logits = np.array([(n / n.sum()) @ scores[b] + bias for _, b, n in check or learn], np.float64)
    labels = np.array([label for label, _, _ in check or learn])
    each = np.arange(len(labels))
    heats = np.geomspace(0.2, 20, 60)
    loss = [-np.log(np.maximum(softmax(logits / t)[each, labels], 1e-12)).mean() for t in heats]
    heat = heats[int(np.argmin(loss))]
    sure = softmax(logits / heat)
    right = sure[each, labels][sure.argmax(1) == labels]
    threshold = min(0.5, float(np.quantile(right, REJECT))) if len(right) else 0.0
    return Model(languages, (scores / heat).astype(np.float32), (bias / heat).astype(np.float32), threshold)


def _predict(model: Model | None, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and acceptance of each text."""
    known = _has_letter(column)
    n = len(column)
    if model is None or not n:
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
    data, offsets = _bordered(column)
    sums, totals = np.zeros((n, len(model.languages))), np.zeros(n)
    for low, high in w.slices(offsets, max(1 << 16, PART_VALUES // len(model.languages))):
        part, edges = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        for at, buckets in _subwords(part):
            cut = np.searchsorted(at, edges)
            some = cut[1:] > cut[:-1]
            if some.any():
                sums[low:high][some] += np.add.reduceat(model.scores[buckets], cut[:-1][some], axis=0, dtype=np.float64)
            totals[low:high] += np.diff(cut)
    logits = sums / np.maximum(totals, 1)[:, None] + model.bias
    sure = np.exp(logits - logits.max(1, keepdims=True))
    sure /= sure.sum(1, keepdims=True)
    best, score = sure.argmax(1), np.where(known, sure.max(1), 0.0)
    langs = [model.languages[i] if k else UNKNOWN for i, k in zip(best, known)]
    return langs, score, known & (score >= model.threshold)


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType())])


def predictor(model: Model | None):
    """A column of texts to a column of predictions; the rows themselves stay in the JVM."""
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            langs, score, accepted = _predict(model, column)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                                             names=PREDICTION.names)
            w.give_back()

    # Not to be evaluated again where a filter on its result is pushed down.
    return F.arrow_udf(run, PREDICTION).asNondeterministic()


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", carried: list[str] | None = None) -> DataFrame:
    """Columns lang_pred, score, accepted and `row`, a struct of the carried columns (default: all)."""
    bounded_batches(docs.sparkSession)
    carried = docs.columns if carried is None else carried
    return docs.select(predictor(model)(docs[text_col]).alias("found"), F.struct(*[docs[c] for c in carried]).alias("row")).select(
        "found.*", "row")
