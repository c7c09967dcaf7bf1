"""Toxicity: a convolutional text classifier trained in numpy.

Words are hashed; the hashes of words that training documents share have an
embedding, all others the zero vector.  Filters of several widths run over a
document's whole sequence of words, each filter's largest response over the
document is kept (max pooling), and a linear layer gives a logit.  As the
filters are linear in the embeddings, a response is a sum of table look-ups.

The weights are fitted on ``TRAIN_ROWS`` labelled documents of either class
at most (chosen by a hash of the id); the threshold of each language is
calibrated on all labelled documents of a fold kept apart for that.  The language is
guessed from the text's function words, so a score depends on the text alone.

Edge cases: null and empty texts have no words and get the score of their
(empty) features; null labels and null ids teach nothing; of several labels of
one document the largest counts.  With no labelled document of either class
the model scores every text 0.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import small_batches

#: Most labelled documents of each class that the weights are fitted on.
TRAIN_ROWS = 2000
#: Training documents that must share a word for it to get an embedding, and
#: the most words that get one (the most frequent).
MIN_DOCS = 3
#: Word hashes that tell near copies among training documents.
SKETCH = 3
MAX_WORDS = 30_000
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
#: Passes over the training documents, and steps at least.
EPOCHS = 4
STEPS = 200
BATCH = 64
RATE = 0.02
EMBEDDING_RATE = 0.002
#: Share of a text's words left out at each training step.
DROP = 0.3
SEED = 7
#: Logits are counted in bins this wide for calibration, up to +-LIMIT.
BIN = 0.05
LIMIT = 30.0
#: A language's own threshold needs so many documents of each class.
LEAST_OF_CLASS = 20

# Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in that it is was for with as on be at by this from or an are which",
    "fr": "le les et du pour dans une est au avec par sur pas ce qui ne sont aux",
    "de": "der die und das von zu den mit ist des im nicht ein eine auf als auch dem",
    "es": "el los las y en del se por con para no su al lo como una es",
}
LANGUAGES = (*FUNCTION_WORDS, "other")

#: Bytes of a text that are hashed at once.
SLICE = 1 << 20
_SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 0 for b in range(256)
)
_PRIME = np.uint64(0x100000001B3)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words, in order: A-Z lower-cased, letters
    and digits and all non-ASCII characters belong to words."""
    split = (text or "").encode().translate(_SPLIT)
    if len(split) <= SLICE:
        return _hashes(split)
    parts, start = [], 0
    while start < len(split):  # in slices that end between words
        end = split.find(b"\0", start + SLICE)
        end = len(split) if end < 0 else end
        parts.append(_hashes(split[start:end]))
        start = end
    return np.concatenate(parts)


def _hashes(split: bytes) -> np.ndarray:
    raw = np.frombuffer(split, np.uint8)
    inside = np.r_[False, raw != 0, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    size = edges[1::2] - edges[::2]
    if not len(size):
        return np.zeros(0, np.uint64)
    letters = raw[raw != 0].astype(np.uint64)
    begin = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(begin, size)
    h = np.add.reduceat(letters * _powers(int(size.max()))[place], begin)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.r_[np.uint64(1), np.full(2 * n, _PRIME, np.uint64)])
    return _POWERS


@dataclass
class Weights:
    """words: sorted hashes; row 0 of the tables is for all other words."""

    words: np.ndarray
    language: np.ndarray  # of each row, as a place in LANGUAGES; -1: none
    embedding: np.ndarray  # (rows, DIM)
    filters: list[np.ndarray]  # for each width (width, DIM, FILTERS)
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float

    def tables(self) -> list[list[np.ndarray]]:
        """For each width and offset, every word's share in the responses."""
        return [[(self.embedding @ f[o]).astype(np.float32) for o in range(f.shape[0])] for f in self.filters]

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at + 1, 0) if len(self.words) else np.zeros(len(hashes), int)

    def guess(self, rows: np.ndarray) -> int:
        own = self.language[rows]
        counts = np.bincount(own[own >= 0], minlength=len(LANGUAGES))
        return int(counts.argmax()) if counts.any() else len(LANGUAGES) - 1


def responses(rows: np.ndarray, table: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    """Filter responses at every position; a text shorter than the filter is
    followed by zero vectors."""
    padded = np.r_[rows, np.zeros(max(0, len(table) - max(1, len(rows))) + (len(rows) == 0), rows.dtype)]
    n = len(padded) - len(table) + 1
    total = table[0][padded[:n]]
    for o in range(1, len(table)):
        total = total + table[o][padded[o : o + n]]
    return total + bias


def pooled(rows: np.ndarray, tables: list[list[np.ndarray]], w: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Largest responses (after ReLU) over the text, and where they are."""
    values, places = [], []
    for table, bias in zip(tables, w.biases, strict=True):
        r = responses(rows, table, bias)
        at = r.argmax(axis=0)
        values.append(r[at, np.arange(r.shape[1])])
        places.append(at)
    return np.maximum(np.concatenate(values), 0), np.concatenate(places)


def logit(rows: np.ndarray, tables: list[list[np.ndarray]], w: Weights) -> float:
    values, _ = pooled(rows, tables, w)
    return float(values @ w.out + w.bias)


def unlike(hashed: list[np.ndarray]) -> list[int]:
    """Places of documents that are not near copies of an earlier one, as far
    as their smallest word hashes tell: copies would make words look common."""
    seen: set[bytes] = set()
    out = []
    for i, h in enumerate(hashed):
        key = np.unique(h)[:SKETCH].tobytes()
        if not key or key not in seen:
            seen.add(key)
            out.append(i)
    return out


def fit(texts: list[str], toxic: np.ndarray) -> Weights:
    """Fit the weights; Adam on the logistic loss, with words dropped at
    random so that no document rests on one of them."""
    rng = np.random.default_rng(SEED)
    hashed = [word_hashes(t) for t in texts]
    chosen = unlike(hashed)
    hashed = [hashed[i] for i in chosen]
    y = toxic.astype(float)[chosen]
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    distinct = [np.unique(h) for h in hashed]
    words, where = np.unique(np.concatenate([*distinct, np.zeros(0, np.uint64)]), return_inverse=True)
    owner = np.repeat(np.arange(len(distinct)), [len(d) for d in distinct])
    df = np.bincount(where, minlength=len(words))
    df_toxic = np.bincount(where, weights=y[owner], minlength=len(words))
    kept = np.flatnonzero(df >= MIN_DOCS)
    kept = np.sort(kept[np.argsort(-df[kept], kind="stable")[:MAX_WORDS]])
    function = {h: i for i, k in enumerate(FUNCTION_WORDS) for h in word_hashes(FUNCTION_WORDS[k]).tolist()}
    vocabulary = np.unique(np.r_[words[kept], np.array(sorted(function), np.uint64)])
    # The first dimension starts from how surely toxic documents hold the
    # word more often (in standard deviations); training moves it on.
    sure = np.zeros(len(vocabulary))
    surplus = df_toxic[kept] - df[kept] * share
    sure[np.searchsorted(vocabulary, words[kept])] = surplus / np.sqrt(df[kept] * share * (1 - share) + 1)
    w = Weights(
        words=vocabulary,
        language=np.array([-1, *(function.get(int(h), -1) for h in vocabulary)]),
        embedding=np.vstack([np.zeros(DIM), rng.normal(0, 0.02, (len(vocabulary), DIM))]),
        filters=[rng.normal(0, 0.2, (n, DIM, FILTERS)) for n in WIDTHS],
        biases=[np.zeros(FILTERS) for _ in WIDTHS],
        out=rng.normal(0, 0.2, FILTERS * len(WIDTHS)),
        bias=float(np.log(share / (1 - share))),
    )
    w.embedding[1:, 0] = np.clip(sure, -LIMIT, LIMIT) / 4
    for f, b in zip(w.filters, w.biases, strict=True):
        f[0, 0, 0] = 1.0
        b[0] = -1.0
    w.out[::FILTERS] = 1.0
    rows = [w.rows(h) for h in hashed]
    rates = [EMBEDDING_RATE, *[RATE] * (2 * len(WIDTHS) + 1)]
    params = [w.embedding, *w.filters, *w.biases, w.out]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    bias_state = [0.0, 0.0]
    step = 0
    n_f = len(WIDTHS)
    batches = max(1, len(rows) // BATCH)
    for _ in range(max(EPOCHS, -(-STEPS // batches))):
        for batch in np.array_split(rng.permutation(len(rows)), batches):
            tables = w.tables()
            grads = [np.zeros_like(p) for p in params]
            bias_grad = 0.0
            for i in batch:
                own = np.where(rng.random(len(rows[i])) < DROP, 0, rows[i])
                values, places = pooled(own, tables, w)
                z = values @ w.out + w.bias
                d = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[i]) / len(batch)
                grads[-1] += d * values
                bias_grad += d
                for k, f in enumerate(w.filters):
                    for c in range(FILTERS):
                        u = k * FILTERS + c
                        if values[u] <= 0:
                            continue
                        g = d * w.out[u]
                        grads[1 + n_f + k][c] += g
                        for o in range(f.shape[0]):
                            p = places[u] + o
                            r = own[p] if p < len(own) else 0
                            if r:
                                grads[1 + k][o, :, c] += g * w.embedding[r]
                                grads[0][r] += g * f[o, :, c]
            step += 1
            scale = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, a, b, rate in zip(params, grads, first, second, rates, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * scale * a / (np.sqrt(b) + 1e-8)
            w.embedding[0] = 0
            bias_state[0] += 0.1 * (bias_grad - bias_state[0])
            bias_state[1] += 0.001 * (bias_grad**2 - bias_state[1])
            w.bias -= float(RATE * scale * bias_state[0] / (np.sqrt(bias_state[1]) + 1e-8))
    return w


@dataclass
class Model:
    weights: Weights | None
    thresholds: dict[str, float]

    def logits(self, text: Column) -> Column:
        """struct<logit: double, lang: string> of a text column."""
        weights = self.weights
        tables = weights.tables() if weights else None

        @F.arrow_udf("struct<logit:double,lang:string>")
        def run(texts: pa.Array) -> pa.Array:
            z, lang = [], []
            for t in texts:
                if weights is None:
                    z.append(-LIMIT)
                    lang.append(LANGUAGES[-1])
                    continue
                rows = weights.rows(word_hashes(t.as_py()))
                z.append(logit(rows, tables, weights))
                lang.append(LANGUAGES[weights.guess(rows)])
            return pa.StructArray.from_arrays([pa.array(z, pa.float64()), pa.array(lang, pa.string())], ["logit", "lang"])

        return run(text)

    def score(self, found: Column) -> Column:
        """0 to 1 from the struct of logits(); 0.5 at the threshold of the
        text's language."""
        limit = F.lit(self.thresholds["other"])
        for lang, value in self.thresholds.items():
            limit = F.when(found["lang"] == lang, F.lit(value)).otherwise(limit)
        return 1 / (1 + F.exp(-(found["logit"] - limit)))


def fold(id_col: str) -> Column:
    """crc32 of the id mod 5.  Labels in fold 0 are never used, those in folds
    1 to 3 are for the weights, those in fold 4 for the thresholds."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    own = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
        .where("id is not null and y is not null")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .where(fold("id") != 0)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample, toxic = [], []
    for y in (0, 1):
        ids = own.where((F.col("y") == y) & (fold("id") != 4)).orderBy(F.xxhash64("id"), "id").limit(train_rows)
        # At most train_rows ids: a broadcast of known size.
        for row in texts.join(F.broadcast(ids), "id").orderBy("id", "text").select("text").toLocalIterator():
            sample.append(row["text"])
            toxic.append(y)
    if len(set(toxic)) < 2:
        return Model(None, {"other": 0.0})
    model = Model(fit(sample, np.array(toxic)), {"other": 0.0})
    found = texts.where(fold("id") == 4).select("id", model.logits(F.col("text")).alias("found")).join(own, "id")
    bins = (
        found.groupBy(
            F.col("found.lang").alias("lang"),
            F.round(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("found.logit"))) / BIN).cast("int").alias("bin"),
            "y",
        )
        .agg(F.count("*").alias("n"))
        .collect()  # at most languages x bins x 2 rows
    )
    model.thresholds = calibrated([(r["lang"], r["bin"], r["y"], r["n"]) for r in bins])
    return model


def calibrated(bins: list[tuple[str, int, int, int]]) -> dict[str, float]:
    """The logit of each language from which on a document counts as toxic:
    the largest F1, in the middle of the gap below."""
    half = int(LIMIT / BIN) + 1

    def best(chosen: list[tuple[str, int, int, int]]) -> float | None:
        hist = np.zeros((2, 2 * half + 1))
        for _, b, y, n in chosen:
            hist[1 if y else 0, b + half] += n
        if hist.sum(axis=1).min() < LEAST_OF_CLASS:
            return None
        above = hist[:, ::-1].cumsum(axis=1)[:, ::-1]
        f1 = 2 * above[1] / (above[1] + above[0] + hist[1].sum())
        at = int(f1.argmax())
        below = np.flatnonzero(hist[:, :at].sum(axis=0))
        low = int(below[-1]) if len(below) else at - 1
        return ((at + low) / 2 - half) * BIN

    pooled_limit = best(bins)
    out = {"other": 0.0 if pooled_limit is None else pooled_limit}
    for lang in FUNCTION_WORDS:
        own = best([b for b in bins if b[0] == lang])
        out[lang] = out["other"] if own is None else own
    return out
