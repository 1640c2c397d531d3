"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's letters, lower-cased, with everything else as one boundary mark, give n-grams of two
to four characters inside words (boundaries included). Each n-gram hashes to a row of an
embedding table; the mean of the rows goes through a linear layer and a softmax, trained by
stochastic gradient descent in numpy. Scores are calibrated by a temperature fitted on part
of the sample that training does not see, and a text is rejected if its calibrated score
is below what all but ``false_rejects`` of that part's right answers reach.

Training reads a bounded sample: of each language at most ``per_language`` labelled rows, those
first by a hash of id and text, equal rows once, of all languages together at most
``sample_rows``, the first row of every language before any second one; and of each row at most
``windows`` windows of ``window_chars`` characters spread over the whole text. So every label is
learned, however rare, as long as there are no more labels than ``sample_rows``. Nothing else
comes to the driver. The model that is broadcast takes 2 MB and 64 bytes per language
(or, with up to 16 languages, one table of buckets x languages, 128 KB per language: the
network is linear behind the mean). Every text is predicted whole, in its own task.

Defined results: a null text, or one without letters, is ``und`` with score 0 and rejected;
without any labelled row every text is, but ``accepted`` keeps those with letters; with one
language every text with letters is it. A null label or doc_id is not learned from. Equal
texts have equal results. An empty table gives no rows. Other columns pass through, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sessionloom.llm.common import col, free_names, map_text, whole_text, working
from sessionloom.operators.skew import fits_broadcast, left_join

UNKNOWN = "und"
SHORTEST, LONGEST = 2, 4
BUCKET_BITS, DIMENSIONS = 15, 16
PER_LANGUAGE, WINDOWS, WINDOW_CHARS, SAMPLE_ROWS = 800, 6, 256, 204_800
EPOCHS, BATCH, RATE, SEED = 6, 16, 2.0, 7
FALSE_REJECTS, STRICTEST = 0.001, 0.5
CHUNK = 1 << 20
#: Rows of a language that are ranked, as a multiple of those that are wanted.
DRAWN = 1.5

_PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)
_SPACE = 32
_letters: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters[codes]


def buckets(text: str) -> np.ndarray:
    """Buckets of all n-grams of a text; empty if it has no letter."""
    out = []
    for start in range(0, len(text), CHUNK):
        part = text[max(0, start - LONGEST) : start + CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), np.uint32)
        letters = _is_letter(codes)
        if not letters.any():
            continue
        codes = np.where(letters, codes, _SPACE)
        keep = letters.copy()
        keep[1:] |= letters[:-1]  # one boundary behind a word is enough
        c = np.concatenate(([_SPACE], codes[keep], [_SPACE])).astype(np.uint64)
        inner = c != _SPACE
        h = c[:-1] * _PRIMES[0] + c[1:]
        sound = inner[:-1] | inner[1:]
        for n in range(SHORTEST, LONGEST + 1):
            if n > SHORTEST:  # one character more; what is now inside has to be a letter
                h = h[:-1] * _PRIMES[n - 1] + c[n - 1 :]
                sound = sound[:-1] & inner[n - 2 : len(c) - 1]
            mixed = (h[sound] ^ (h[sound] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.empty(0, np.int32)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages, what an n-gram adds to the mean of each; or the embeddings
    bias: np.ndarray
    weights: np.ndarray | None = None  # embeddings to languages, where the table holds embeddings
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        found = buckets(text)
        if not len(found):
            return None
        mean = self.table[found].mean(axis=0, dtype=np.float64)
        return (mean if self.weights is None else mean @ self.weights) + self.bias

    def predict(self, text: str) -> tuple[str, float, bool]:
        """Language, calibrated score, and whether the text is rejected."""
        logits = self.logits(text) if self.languages else None
        if logits is None:
            return UNKNOWN, 0.0, True
        p = _softmax(logits[None, :] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(examples: list[tuple[str, str]], seed: int = SEED) -> Model:
    """Fit on (text, language) by stochastic gradient descent; one part in five calibrates."""
    languages = sorted({lang for _, lang in examples})
    grams = [buckets(text) for text, _ in examples]
    number = {lang: i for i, lang in enumerate(languages)}
    label = np.array([number[lang] for _, lang in examples], np.int64)
    usable = np.array([i for i, g in enumerate(grams) if len(g)], np.int64)
    k, rng = len(languages), np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, k), np.float32), np.zeros(k, np.float32)
    weights += rng.normal(0, 0.1, weights.shape).astype(np.float32)
    held = usable[np.arange(len(usable)) % 5 == 4]
    fit = usable[np.arange(len(usable)) % 5 != 4] if len(held) else usable
    share = 1.0 / np.maximum(np.bincount(label[fit], minlength=k), 1)  # languages count alike
    share *= len(fit) / max(1, k)
    steps = max(1, EPOCHS * -(-len(fit) // BATCH))
    done = 0
    for _ in range(EPOCHS if k > 1 else 0):
        order = rng.permutation(fit)
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            index = np.concatenate([grams[i] for i in rows])
            sizes = np.array([len(grams[i]) for i in rows])
            at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            mean = np.add.reduceat(embedding[index], at, axis=0) / sizes[:, None]
            p = _softmax(mean @ weights + bias)
            p[np.arange(len(rows)), label[rows]] -= 1
            p *= (np.minimum(share[label[rows]], 10.0) / len(rows))[:, None]
            back = (p @ weights.T) * (len(rows) / sizes)[:, None]
            weights -= rate * (mean.T @ p).astype(np.float32)
            bias -= rate * p.sum(axis=0).astype(np.float32)
            np.add.at(embedding, index, np.repeat((-rate * back).astype(np.float32), sizes, axis=0))
    if k <= DIMENSIONS:  # the smaller form of the same network
        model = Model(languages, embedding @ weights, bias.astype(np.float64))
    else:
        model = Model(languages, embedding, bias.astype(np.float64), weights=weights.astype(np.float64))
    _calibrate(model, [examples[i][0] for i in (held if len(held) else fit)], label[held if len(held) else fit])
    return model


def _calibrate(model: Model, texts: list[str], label: np.ndarray) -> None:
    """Temperature of the least loss, then the score that nearly all right answers reach."""
    if len(model.languages) < 2 or not texts:
        return
    logits = np.array([model.logits(t) for t in texts])
    rows = np.arange(len(texts))

    def loss(t: float) -> float:
        return float(-np.log(_softmax(logits / t)[rows, label] + 1e-12).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.05, 5, 41)), key=loss)
    p = _softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == label]
    if len(right):
        model.threshold = min(STRICTEST, float(np.quantile(right, FALSE_REJECTS)))


def sample(docs: DataFrame, may_learn: Column, per_language: int = PER_LANGUAGE, windows: int = WINDOWS,
           window_chars: int = WINDOW_CHARS, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id",
           text: str = "text", label: str = "lang") -> list[tuple[str, str]]:
    """Windows of text with their language, in a fixed order; bounded by the parameters."""
    chars = F.char_length("text")
    rows = docs.select(
        col(doc_id).cast("string").alias("id"), whole_text(text).alias("text"), col(label).cast("string").alias("lang"),
    ).filter(may_learn & F.col("lang").isNotNull() & F.col("id").isNotNull() & (chars > 0))
    rows = rows.withColumn("spot", F.shiftrightunsigned(F.xxhash64("id", "text"), 1))
    # somewhat more than wanted by a limit on the hash, then exactly so many by rank, on the hash alone
    spots = rows.groupBy("lang").agg(F.approx_count_distinct("spot").alias("spots"))
    limits = spots.select("lang", (F.least(F.lit(1.0), DRAWN * per_language / F.greatest("spots", F.lit(1))) * float(1 << 63)).alias("limit"))
    narrow = rows.select("lang", "spot")
    drawn = narrow.join(F.broadcast(limits), "lang") if fits_broadcast(limits) else left_join(narrow, limits, ["lang"])
    drawn = drawn.filter(F.col("spot") <= F.col("limit")).select("lang", "spot").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("spot"))
    chosen = drawn.withColumn("rank", rank).filter(F.col("rank") <= per_language).orderBy("rank", "spot", "lang").limit(sample_rows)
    chosen = F.broadcast(chosen.select("lang", "spot"))  # at most sample_rows
    pieces = F.least(F.lit(windows), F.ceil(chars / window_chars)).cast("int")
    gap = F.when(pieces > 1, (chars - window_chars) / (pieces - 1)).otherwise(0)
    cut = F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.substring(
        F.col("text"), F.floor(i * gap).cast("int") + 1, F.lit(window_chars)))
    found = rows.join(chosen, ["lang", "spot"], "left_semi").select("spot", "id", "lang", cut.alias("cut"))
    found = found.groupBy("lang", "spot").agg(F.min(F.struct("id", "cut")).alias("row")).select("spot", "row.id", "lang", "row.cut").collect()
    examples = []
    for r in sorted(found, key=lambda r: (r["spot"], r["id"], r["lang"], r["cut"])):
        examples += [(w, r["lang"]) for w in r["cut"]]
        # short texts are learned too: some words from the middle of the first window
        examples.append((" ".join(r["cut"][0].split()[2:5]), r["lang"]))
    return examples


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """Add language, score and rejection to every row."""
    if free_names(docs, *names) != list(names):
        raise ValueError(f"one of {names} is a column already")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()))]

    def make():
        model = sent.value
        return lambda texts: list(map(list, zip(*map(model.predict, texts)))) if texts else [[], [], []]

    return map_text(docs, fields, make, text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame, **options) -> Model:
    """A model of the rows that may be learned from."""
    return train(sample(docs, F.crc32(F.col("id").cast("binary")) % 3 != 1, **options))


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with letters whose language the model does not reject, with all their columns.

    A model that has learned nothing rejects only what has no letters. Python is given the
    texts and gives back the verdicts; the rows themselves stay where they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def keep(texts: pa.Array) -> pa.Array:
        model = working(lambda: sent.value)
        if not model.languages:
            return pa.array([any(map(str.isalpha, t)) for t in _each(texts)], pa.bool_())
        return pa.array([not model.predict(t)[2] for t in _each(texts)], pa.bool_())

    return docs.filter(keep(whole_text(text)))


def _each(texts: pa.Array):
    """One text at a time, so that a task never holds a batch of them as Python strings."""
    return (t.as_py() for t in texts)
