"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its hashed character n-grams; a
linear softmax over that average gives a probability per language. Embeddings
and weights are trained by stochastic gradient descent in numpy on a bounded
sample of labelled texts, with short cuts of them added so that short texts
are known too. A temperature fitted on texts left out of training calibrates the
probabilities. They only compare the languages, so they tell nothing of a text
in another one. Whether a text is rejected is measured against an even spread
over the buckets: the mean log-odds of its n-grams under the predicted language,
which does not depend on how many languages there are. Every sampled text is
measured by the others of its language, and a text is rejected when it falls
below nearly all of those of like length.

The model is linear in the average, so for prediction it becomes one small
table of weights per n-gram bucket, beside the log-odds; every whole text is
scored with them where it is read.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and
is rejected; rows without a label are never learned from; repeated rows are
predicted each; without any labelled text everything is ``und``; an empty table
gives no rows; other columns are carried along or not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bounds of training: texts per language, texts of all languages as long as each
#: has LEAST_TEXTS, and bytes of a text that the sample reads from one random place
#: on (prediction reads whole texts). Every label is learned.
SAMPLE_TEXTS, ALL_TEXTS, LEAST_TEXTS, SAMPLE_BYTES = 600, 120_000, 20, 20_000
BUCKETS, DIMENSIONS = 1 << 13, 16
SHORT_CUTS = 2
EPOCHS, RATE, DECAY = 8, 2.0, 1e-6
#: Share of good texts that may be rejected; it lies beyond what a sample shows,
#: so the tail below TAIL_SHARE of the texts is carried on as an exponential.
#: Texts of like length are LIKE_TEXTS at least, and TAIL_TEXTS make a tail, of
#: which the lowest is left out of the mean: labels can be wrong.
REJECTED_SHARE, TAIL_SHARE = 0.0005, 0.05
LIKE_TEXTS, TAIL_TEXTS = 200, 10
#: What each bucket counts before any text is seen.
UNSEEN = 0.5
SEED = 11

# A to Z folded, digits one class, other ASCII signs one class; bytes of letters
# beyond ASCII stay as they are.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57
    else 32 if b <= 32 or b == 127 else 46
    for b in range(256)
)


def features(text: bytes) -> np.ndarray:
    """How often each bucket is hit by the text's 2-, 3- and 4-grams of bytes."""
    codes = np.frombuffer(b" " + text.translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    grams = codes
    for length in (2, 3, 4):
        if len(codes) < length:
            break
        grams = (grams[:-1] << np.uint32(8)) | codes[length - 1 :]
        mixed = (grams + np.uint32(length)) * np.uint32(2_654_435_761)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2_246_822_519)
        counts += np.bincount(mixed >> np.uint32(32 - 13), minlength=BUCKETS)
    return counts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language, embeddings times output weights
    bias: np.ndarray
    temperature: float = 1.0
    odds: np.ndarray | None = None  # language x bucket
    usual: list[tuple[float, np.ndarray, np.ndarray]] | None = None  # see usual_odds

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated score, rejected)."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = features(text.encode("utf-8", "replace"))
        best, score = self.scored(self.logits(counts))
        return self.languages[best], score, self.unusual(best, counts)

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.weights / max(1, counts.sum()) + self.bias

    def scored(self, logits: np.ndarray) -> tuple[int, float]:
        z = np.exp((logits - logits.max()) / self.temperature)
        best = int(z.argmax())
        return best, float(z[best] / z.sum())

    def unusual(self, language: int, counts: np.ndarray) -> bool:
        """Whether the text falls below the language's texts of like length."""
        if self.odds is None:
            return False
        n = int(counts.sum())
        centre, longest, lowest = self.usual[language]
        like = min(int(np.searchsorted(longest, n)), len(longest) - 1)
        away = float(counts @ self.odds[language]) / max(1, n) - centre
        return away * min(n, int(longest[-1])) ** 0.5 < lowest[like]


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], calibration: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """Fit on (language, buckets, counts); temperature from ``calibration``."""
    languages = sorted({label for label, _, _ in samples})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    index = {label: i for i, label in enumerate(languages)}
    random = np.random.default_rng(SEED)
    embeddings = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    output, bias = random.normal(0, 0.1, (DIMENSIONS, len(languages))), np.zeros(len(languages))
    by_label = np.bincount([index[label] for label, _, _ in samples], minlength=len(languages))
    steps, done = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(samples)):
            label, buckets, counts = samples[k]
            rate = RATE * (1 - done / steps) + 0.01
            done += 1
            share = (counts / counts.sum())[:, None]
            mean = (embeddings[buckets] * share).sum(axis=0)
            logits = mean @ output + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[index[label]] -= 1
            # Languages weigh the same however many samples they have.
            p *= len(samples) / (len(languages) * by_label[index[label]])
            pull = output @ p
            output -= 0.1 * rate * np.outer(mean, p) + DECAY * output
            bias -= 0.01 * rate * p
            embeddings[buckets] -= rate * len(buckets) ** 0.5 * share * pull
    model = Model(languages, embeddings @ output, bias)
    return calibrated(model, calibration, index)


def calibrated(model: Model, held: list[tuple[str, np.ndarray, np.ndarray]], index: dict[str, int]) -> Model:
    known = [(index[label], b, c) for label, b, c in held if label in index]
    if not known:
        return model
    logits = np.array([
        (c[:, None] * model.weights[b]).sum(axis=0) / c.sum() + model.bias for _, b, c in known
    ])
    truth = np.array([label for label, _, _ in known])

    def loss(temperature: float) -> float:
        z = logits / temperature
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

    grid = np.geomspace(0.2, 20, 60)
    model.temperature = float(grid[np.argmin([loss(t) for t in grid])])
    return model


def log_odds(totals: np.ndarray) -> np.ndarray:
    """Of each bucket under counts, against an even spread."""
    seen = totals + UNSEEN
    return np.log(seen * (BUCKETS / seen.sum(axis=-1, keepdims=True)))


def usual_odds(lengths: np.ndarray, means: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Centre of the texts' mean log-odds, and by class of length the longest text and the lowest usual value.

    Values are distances from the centre times the root of the length, as means
    over more n-grams spread less.
    """
    centre, by_length = float(np.median(means)), np.argsort(lengths, kind="stable")
    longest, lowest = [], []
    for rows in np.array_split(by_length, max(1, len(by_length) // LIKE_TEXTS)):
        away = np.sort((means[rows] - centre) * lengths[rows] ** 0.5)
        tail = min(len(away), max(TAIL_TEXTS, int(len(away) * TAIL_SHARE)))
        start = away[tail - 1]
        step = float((start - away[tail // TAIL_TEXTS : tail]).mean())
        longest.append(lengths[rows].max())
        lowest.append(start - step * max(0.0, np.log(tail / len(away) / REJECTED_SHARE)))
    return centre, np.array(longest), np.array(lowest)


def with_odds(model: Model, texts: list[tuple[str, list[tuple[np.ndarray, np.ndarray]]]]) -> Model:
    """Add the log-odds; ``texts`` are (language, parts), the first part being the text and the others cuts of it.

    A text and its cuts are measured without what the text itself adds.
    """
    index = {label: i for i, label in enumerate(model.languages)}
    known = [(index[label], parts) for label, parts in texts if label in index]
    totals = np.zeros((len(index), BUCKETS))
    for label, parts in known:
        buckets, counts = parts[0]
        totals[label, buckets] += counts
    measured: list[list[tuple[float, float]]] = [[] for _ in index]
    own = np.zeros(BUCKETS)
    for label, parts in known:
        buckets, counts = parts[0]
        own[buckets] = counts
        even = BUCKETS / (totals[label].sum() - counts.sum() + UNSEEN * BUCKETS)
        for b, c in parts:
            odds = np.log((totals[label, b] - own[b] + UNSEEN) * even)
            measured[label].append((c.sum(), float((c * odds).sum() / c.sum())))
        own[buckets] = 0
    model.odds = log_odds(totals)
    model.usual = [usual_odds(*np.array(rows).T) for rows in measured]
    return model


def fold_of(key: Column) -> Column:
    """crc32 of the key as text, modulo 4; 2 is the fold that is never learned from."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def sample(documents: DataFrame, key: str, text: str, lang: str) -> tuple[list, list, list]:
    """Training and calibration samples of the learnable rows, in an order of their own, and both by text.

    Rows are drawn by a hash of key and text, about SAMPLE_TEXTS per language, or
    fewer where there are many languages; a row that repeats key, text and label
    counts once. Features are counted where the texts are read, so only those travel,
    and of repeated rows the text once per task.
    """
    learnable = documents.where((fold_of(F.col(key)) != 2) & F.col(lang).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"),
        F.xxhash64(F.col(key), F.col(text), F.lit(SEED)).alias("hash"),
    )
    counts = (
        learnable.select("lang", "hash").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    if not counts:
        return [], [], []
    each = min(SAMPLE_TEXTS, max(LEAST_TEXTS, ALL_TEXTS // len(counts)))
    shares = documents.sparkSession.createDataFrame(
        sorted((r["lang"], min(1.0, each / r["n"])) for r in counts), "lang string, share double"
    )
    drawn = learnable.join(F.broadcast(shares), "lang").where(F.pmod("hash", F.lit(1_000_000)) / 1_000_000 < F.col("share"))
    # Texts of one key stay apart by their hash.
    chosen = drawn.groupBy("lang", "hash").agg(F.first("key").alias("key"), F.first("text").alias("text")).select(
        F.concat_ws("/", "key", F.hex("hash")).alias("key"), "text", "lang"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content, label in zip(*(c.to_pylist() for c in batch.columns)):
                if not content or not has_letter(content):
                    continue
                # Runs of blanks become one, so every window holds words.
                raw = b" ".join(content.encode("utf-8", "replace").split())
                random = np.random.default_rng([len(raw), *name.encode()])
                at = int(random.integers(0, max(1, len(raw) - SAMPLE_BYTES + 1)))
                words = raw[at : at + SAMPLE_BYTES].split()
                parts = [b" ".join(words)]
                for _ in range(SHORT_CUTS):
                    first = int(random.integers(0, len(words)))
                    parts.append(b" ".join(words[first : first + int(random.integers(2, 12))]))
                for k, part in enumerate(parts):
                    if has_letter(part.decode("utf-8", "ignore")):
                        found = features(part)
                        hit = np.flatnonzero(found)
                        rows.append((f"{name}/{k}", label, hit.astype("<u2").tobytes(), found[hit].astype("<u4").tobytes()))
            columns = list(zip(*rows)) or [[]] * 4
            types = (pa.string(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], ["key", "lang", "buckets", "counts"]
            )

    found = sorted(map(tuple, chosen.mapInArrow(count, "key string, lang string, buckets binary, counts binary").collect()))
    # Views of the collected bytes: six bytes a bucket, held once.
    rows = [
        (name.rpartition("/")[0], (label, np.frombuffer(b, "<u2"), np.frombuffer(c, "<u4"))) for name, label, b, c in found
    ]
    # A text comes before its cuts; without a letter in its window it has none of its own.
    texts: dict[tuple[str, str], list[tuple[np.ndarray, np.ndarray]]] = {}
    for (name, label, _, _), (_, (_, buckets, counts)) in zip(found, rows):
        texts.setdefault((name.rpartition("/")[0], label), []).append((buckets, counts))
    by_text = [(label, parts) for (_, label), parts in texts.items()]
    # Every fifth text calibrates.
    names = {name: i for i, name in enumerate(dict.fromkeys(name for name, _ in rows))}
    return [r for name, r in rows if names[name] % 5], [r for name, r in rows if names[name] % 5 == 0], by_text


def fitted(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    learned, calibration, by_text = sample(documents, key, text, lang)
    model = train(learned, calibration)
    return with_odds(model, by_text) if model.languages else model


def predicted(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``row`` (all columns of the document), lang_pred, score and rejected."""
    rows = documents.select(F.struct("*").alias("row"))
    row_type = rows.schema["row"].dataType.simpleString()
    # BUCKETS x languages numbers; plain values, which any worker can read.
    known = documents.sparkSession.sparkContext.broadcast(astuple(model))
    field = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Model(*known.value).predict
        for batch in batches:
            found = [predict(t.as_py()) for t in batch.column(0).field(field)]
            columns = list(zip(*found)) or [[], [], []]
            types = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types)]],
                ["row", "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(run, f"row {row_type}, lang_pred string, score double, rejected boolean")


def languages(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: key, held_out, lang_pred, score, rejected."""
    model = fitted(documents, key, text, lang)
    found = predicted(documents.select(key, text), model, text)
    row_key = F.col(f"row.`{key}`")
    return found.select(
        row_key.alias(key), (fold_of(row_key) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def accepted_rows(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents whose language is recognised, with their own columns."""
    found = predicted(documents, fitted(documents, key, text, lang), text)
    return found.where(~F.col("rejected")).select("row.*")
