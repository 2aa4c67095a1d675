"""Language identification in two levels: family first, then the language within it.

A text is a vector of hashed byte trigrams, the square roots of their shares
(so every vector has length one). Linear support vector machines, one against
the rest, choose the language family; inside it one machine for each pair of
languages votes. The machines are fitted on a bounded sample of labelled
rows; prediction covers every whole text in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.llm import common
from simpairs.session import ship_package

DIM = 4096
#: distinct labelled texts a model is fitted on, over all languages (each gets an equal part), and languages learned at most
SAMPLE, LABELS = 2400, 200
#: bytes of a text whose trigrams are counted at once
BLOCK = 1 << 20

# Families of common languages by ISO 639-1 code; any other code is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nb nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
    "indic": "as bn gu hi mr ne or pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
}


def family(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes.split()), f"only {lang}")


def features(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, A-Z lower-cased; zeros without a trigram."""
    data = np.frombuffer(b" " + text.lower() + b" ", np.uint8)
    counts = np.zeros(DIM)
    for at in range(0, len(data) - 2, BLOCK):
        b = data[at:at + BLOCK + 2].astype(np.uint32)
        grams = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
        counts += np.bincount(grams * np.uint32(2654435761) >> np.uint32(20), minlength=DIM)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else counts.astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge, classes weighed evenly), by accelerated gradient."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    step = 1 / (l2 + 4.0)  # rows have length √2, so the loss is 4-smooth
    w = v = np.zeros(x.shape[1], np.float32)
    for i in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = l2 * v - 2 * x.T @ (weight * slack * y)
        w, old = v - step * grad, w
        v = w + i / (i + 3) * (w - old)
    return w


@dataclass
class Model:
    """Family machines (rows of ``root``) and pair machines per family."""

    families: list[str] = field(default_factory=list)
    languages: dict[str, list[str]] = field(default_factory=dict)
    root: np.ndarray | None = None
    pairs: dict[str, tuple[list[tuple[int, int]], np.ndarray]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 … 1) of each row of ``x``."""
        n = len(x)
        x = np.hstack([x, np.ones((n, 1), np.float32)])
        share = np.ones((n, 1))
        if len(self.families) > 1:
            share = _soften(x @ self.root.T)
        best = share.argmax(axis=1)
        names, score = np.empty(n, object), share[np.arange(n), best]
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(best == f)
            langs = self.languages[name]
            if not len(rows):
                continue
            if len(langs) == 1:
                names[rows] = langs[0]
                continue
            pairs, weights = self.pairs[name]
            sure = 1 / (1 + np.exp(-4 * (x[rows] @ weights.T).astype(np.float64)))
            votes = np.zeros((len(rows), len(langs)))
            for k, (a, b) in enumerate(pairs):
                # a vote, and below one vote the certainty, which settles ties
                votes[:, a] += (sure[:, k] >= 0.5) + sure[:, k] / len(pairs) / 2
                votes[:, b] += (sure[:, k] < 0.5) + (1 - sure[:, k]) / len(pairs) / 2
            first = votes.argmax(axis=1)
            names[rows] = np.array(langs, object)[first]
            for r, (row, lang) in enumerate(zip(rows, first)):
                own = [sure[r, k] if a == lang else 1 - sure[r, k] for k, (a, b) in enumerate(pairs) if lang in (a, b)]
                score[row] *= float(np.mean(own))
        return list(names), np.clip(score, 0.0, 1.0)


def _soften(margins: np.ndarray) -> np.ndarray:
    e = np.exp(4 * (margins - margins.max(axis=1, keepdims=True)).astype(np.float64))
    return e / e.sum(axis=1, keepdims=True)


def fit_model(langs: list[str], x: np.ndarray) -> Model:
    model, of = Model(), np.array(langs, object)
    family_of = np.array([family(l) for l in langs], object)
    model.families = sorted(set(family_of))
    if len(model.families) > 1:
        model.root = np.stack([fit_svm(x, np.where(family_of == f, 1, -1).astype(np.float32)) for f in model.families])
    for f in model.families:
        names = model.languages[f] = sorted(set(of[family_of == f]))
        pairs = list(combinations(range(len(names)), 2))
        weights = []
        for a, b in pairs:
            rows = (of == names[a]) | (of == names[b])
            weights.append(fit_svm(x[rows], np.where(of[rows] == names[a], 1, -1).astype(np.float32)))
        if pairs:
            model.pairs[f] = pairs, np.stack(weights)
    return model


def _sampled(batches):
    for batch in batches:
        rows = [features(t) for t in common.byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang"), pa.array([r.astype(np.float16).tobytes() for r in rows], pa.binary())], names=["lang", "x"])


def learn(labelled: DataFrame, sample: int = SAMPLE, labels: int = LABELS) -> Model:
    """Model from ``(doc_id, text, lang)``: a sample of about ``sample`` distinct texts with a label.

    The ``labels`` values of ``lang`` with most distinct texts are learned
    (counted over all rows, to a few per cent; ties by name). Texts are drawn
    by their hash, at a rate for each language that gives all the same expected
    number; copies of a text count once. At most twice ``sample`` rows of
    ``DIM`` numbers and ``labels`` counts come to the driver.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    rows = (labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
            .withColumn("hash", F.xxhash64("text")))
    counts = (rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(labels).collect())
    if not counts:
        return Model()
    bounds = [(r["lang"], int(min(1.0, sample / len(counts) / r["n"]) * (1 << 62))) for r in counts]
    # one row for each of at most ``labels`` languages
    bounds = F.broadcast(spark.createDataFrame(bounds, "lang string, bound long"))
    drawn = (rows.join(bounds, "lang").filter(F.shiftrightunsigned("hash", 2) < F.col("bound"))
             .select("lang", "text").distinct().limit(2 * sample))
    got = drawn.mapInArrow(_sampled, "lang string, x binary").toPandas()
    got = got.sort_values(["lang", "x"])  # the same machines whatever the order of arrival
    x = np.frombuffer(b"".join(got["x"]), np.float16).reshape(-1, DIM).astype(np.float32)
    return fit_model(list(got["lang"]), x)


def _languages(texts: pa.Array, model: Model):
    """Languages and scores of texts; ``und`` for a null text or one without a letter."""
    import regex

    letter = regex.compile(r"\p{L}")
    names, scores = ["und"] * len(texts), [0.0] * len(texts)
    if not model.families:
        return names, scores
    held, at = [], []

    def flush():
        for i, name, score in zip(at, *model.predict(np.stack(held))):
            names[i], scores[i] = name, float(score)
        held.clear(), at.clear()

    for i, text in enumerate(common.byte_texts(texts)):
        if text and letter.search(text.decode()):
            held.append(features(text))
            at.append(i)
            if len(held) == 256:
                flush()
    if held:
        flush()
    return names, scores


def identify(docs: DataFrame, model: Model, keep: tuple = ("doc_id",)) -> DataFrame:
    """``(*keep, lang_pred, score)``, one row per input row; only the text is looked at.

    ``lang_pred`` is a language of the model, or ``und`` with score 0 for a
    null text, a text without a letter, or a model without languages. Repeated
    rows get equal answers; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)  # DIM numbers per family and per pair of languages in one

    def run(batches):
        for batch in batches:
            names, scores = _languages(batch.columns[-1], shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names[:-1], "lang_pred", "score"])

    rows = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("text to identify"))
    ddl = ", ".join(f"`{c}` {common.sql_type(docs, c)}" for c in keep) + ", lang_pred string, score double"
    return rows.mapInArrow(run, ddl)


def known_only(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language; ``und`` rows go."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, _ = _languages(batch.column("text"), shared.value)
            yield batch.filter(pa.array([n != "und" for n in names], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """True for ids whose crc32 (of the id as text) falls into the fold kept from learning; null ids: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def learning_rows(docs: DataFrame) -> DataFrame:
    """Rows a model may learn from: not held out, with an id and a label."""
    return docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
