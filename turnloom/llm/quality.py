"""Quality classifier by co-training on two views.

The text view sees hashed character trigrams, how much a text repeats itself, and which of ``n_words`` telling words it holds (those whose
presence goes most with the label, by chi-squared, in the labelled training sample).  The metadata view sees language, source and stated
length only.  A document is good if its quality label is 1 and it is not labelled toxic.

Each round, each view marks all documents without a label, and those of which it is confident join the other view's training set, anew in
every round, so a mark that a view no longer stands by is taken back.  Metadata has few distinct values (cells), so its training set is a
count of confident documents for each cell and label, however many documents there are; documents that the metadata view is confident of
are fitted over the partitions.  If neither training set changes, further rounds would change nothing and are left out.  After the last
round each view is calibrated on held-out labels (Platt), and the calibrated log-odds are added, less the prior they share.  A view that
knows nothing is calibrated to the prior and so has no say.

Labelled documents are a sample of about ``max_labelled``, chosen by hash; a fifth of them is held out.  Marking and scoring cover all whole
texts, and move none of them; only texts of which the metadata view is confident meet the labels, to leave labelled ones out.

Defined results: a null text is an empty text; null metadata is a value of its own; rows that repeat are scored alike; several labels of one
document count by majority, a tie as good; null labels are left out (a toxic document without a quality label is bad); if labels of both
classes are lacking, all documents get the prior (0.5 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm import kernel
from turnloom.llm.storage import discard, materialize, release

TRIGRAMS = 1024
REPEATS = 2
N_WORDS = 256
#: values of each metadata field, after hashing or rounding
LANGS, SOURCES, SIZES = 8, 64, 48
ITERATIONS = 40
#: rows of the labelled sample that one fitting task takes
FIT_ROWS = 1000
_MIX = np.array([7919, 31337, 104729], dtype=np.int64)
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 0x20


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return word hashes without case and ASCII punctuation, and the first word of each row."""
    return kernel.word_hashes(_PLAIN[data], offsets, lower=True)


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return the hashed trigram at each byte that begins one inside its row, and each row's first one."""
    at = np.concatenate([[0], np.cumsum(np.maximum(np.diff(offsets) - 2, 0))])
    wide = data.astype(np.int64)
    hashed = (wide[:-2] * _MIX[0] + wide[1:-1] * _MIX[1] + wide[2:] * _MIX[2]) >> 3 & (TRIGRAMS - 1) if len(data) > 2 else np.zeros(0, np.int64)
    return hashed[np.arange(at[-1]) + np.repeat(offsets[:-1] - at[:-1], np.diff(at))], at


def _repeats(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Return, for each row, the shares of words that repeat the one before and of distinct words."""
    again = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
    again[first[:-1][first[:-1] < len(words)]] = False
    sizes = np.maximum(np.diff(first), 1)
    sums = np.concatenate([[0], np.cumsum(again)])
    return np.stack([(sums[first[1:]] - sums[first[:-1]]) / sizes, np.diff(kernel.distinct(words, first)[1]) / sizes], axis=1)


def _present(words: np.ndarray, first: np.ndarray, telling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Return (row, telling word) of every telling word that a row holds, each once."""
    if not len(telling) or not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = np.minimum(np.searchsorted(telling, words), len(telling) - 1)
    at = np.flatnonzero(telling[k] == words)
    once = np.unique((np.searchsorted(first, at, side="right") - 1) * len(telling) + k[at])
    return once // len(telling), once % len(telling)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        _, all_offsets = kernel.text_buffers(texts)
        for i, j in kernel.blocks(all_offsets):
            yield batch.slice(i, j - i), *kernel.text_buffers(texts.slice(i, j - i))


def _examples(telling: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Columns in: text and others; out: the others, and ``view``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in _blocks(batches):
            hashed, at = _trigrams(data, offsets)
            words, first = _words(data, offsets)
            n = part.num_rows
            view = np.zeros((n, TRIGRAMS + REPEATS + len(telling)), dtype=np.float32)
            row = np.repeat(np.arange(n), np.diff(at))
            counts = np.bincount(row * TRIGRAMS + hashed, minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
            view[:, :TRIGRAMS] = counts * (100.0 / np.maximum(np.diff(at), 1))[:, None]
            view[:, TRIGRAMS : TRIGRAMS + REPEATS] = _repeats(words, first)
            r, k = _present(words, first, telling)
            view[r, TRIGRAMS + REPEATS + k] = 1
            names = [x for x in part.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(x)) for x in names], pa.array(list(view), pa.list_(pa.float32()))], names=[*names, "view"])

    return run


class TextView:
    """A fitted text view: weights and bias over trigram shares, repeats and telling words."""

    def __init__(self, telling: np.ndarray, weights: np.ndarray, bias: float):
        self.telling, self.bias = telling, bias
        self.trigrams, self.repeats, self.words = weights[:TRIGRAMS] * 100, weights[TRIGRAMS : TRIGRAMS + REPEATS], weights[TRIGRAMS + REPEATS :]

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Return the log-odds of each row."""
        hashed, at = _trigrams(data, offsets)
        words, first = _words(data, offsets)
        sums = np.concatenate([[0.0], np.cumsum(self.trigrams[hashed])])
        r, k = _present(words, first, self.telling)
        return (sums[at[1:]] - sums[at[:-1]]) / np.maximum(np.diff(at), 1) + _repeats(words, first) @ self.repeats + np.bincount(r, self.words[k], len(offsets) - 1) + self.bias

    def add_to(self, docs: DataFrame, name: str, keep_text: bool = True) -> DataFrame:
        """Return ``docs`` (with a column text) and the column ``name`` of log-odds."""
        kept = [f for f in docs.schema.fields if f.name != name and (keep_text or f.name != "text")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, data, offsets in _blocks(batches):
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(self.logits(data, offsets))], names=[*[f.name for f in kept], name])

        return docs.mapInArrow(kernel.tidy(run), T.StructType([*kept, T.StructField(name, T.DoubleType())]))


def _slots() -> list[Column]:
    """The cell of a document: hashed language and source, and its stated length in half octaves."""
    slot = lambda c, n: F.pmod(F.crc32(F.encode(F.coalesce(F.col(c), F.lit("\0")), "UTF-8")), F.lit(n)).cast("int")
    size = F.col("n_chars").cast("double")
    bins = F.when(size.isNull(), 0).when(size < 1, 1).otherwise(F.least(F.lit(SIZES - 1), 2 + F.floor(2 * F.log2(F.greatest(size, F.lit(1.0)))))).cast("int")
    return [slot("lang", LANGS).alias("lang_slot"), slot("source", SOURCES).alias("source_slot"), bins.alias("size_slot")]


CELL = ["lang_slot", "source_slot", "size_slot"]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 30) -> np.ndarray:
    """Return the coefficients (the bias last, without a penalty) of a weighted logistic regression, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    ridge = np.append(np.full(x.shape[1] - 1, penalty), 1e-9) * weight.sum()
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return float((weight * np.logaddexp(0.0, np.where(y > 0, -1.0, 1.0) * (x @ w))).sum() + (ridge * w * w).sum() / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (p - y)) + ridge * w)
        scale = 1.0
        while scale > 1e-4 and loss(w - scale * step) > loss(w):
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    return w


class MetaView:
    """A fitted metadata view: a weight for each value of each field."""

    def __init__(self, cells: list[tuple], penalty: float = 1e-3):
        """cells: (language, source, size, label, documents), at most one row for each value of the five."""
        rows = np.array(cells, dtype=np.float64).reshape(-1, 5)
        x = np.concatenate([np.eye(n)[rows[:, k].astype(int)] for k, n in enumerate((LANGS, SOURCES, SIZES))], axis=1)
        self.weights = logistic(x, rows[:, 3], rows[:, 4], penalty)

    def logit(self) -> Column:
        """The log-odds as a column over the cell's."""
        total = F.lit(float(self.weights[-1]))
        at = 0
        for name, n in zip(CELL, (LANGS, SOURCES, SIZES), strict=True):
            total = total + F.element_at(F.array(*[F.lit(float(w)) for w in self.weights[at : at + n]]), F.col(name) + 1)
            at += n
        return total


class Classifier:
    """Two fitted views, their calibrations (slope, intercept) and the prior log-odds."""

    def __init__(self, text: TextView, meta: MetaView, text_scale: tuple[float, float], meta_scale: tuple[float, float], prior: float):
        self.text, self.meta, self.text_scale, self.meta_scale, self.prior = text, meta, text_scale, meta_scale, prior


def telling_words(known: DataFrame, n: int) -> np.ndarray:
    """Return the sorted hashes of the ``n`` words whose presence goes most with the label, by chi-squared."""

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in _blocks(batches):
            words, at = kernel.distinct(*_words(data, offsets))
            label = np.repeat(part.column(part.schema.get_field_index("label")).to_numpy(), np.diff(at))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(label)], names=["word", "label"])

    good, total = known.agg(F.sum("label"), F.count("*")).first()
    seen = known.select("text", "label").mapInArrow(kernel.tidy(distinct_words), "word bigint, label double").groupBy("word").agg(F.sum("label").alias("g"), F.count("*").cast("double").alias("n"))
    a, b = F.col("g"), F.col("n") - F.col("g")
    spread = a * (float(total - good)) - b * float(good)
    score = spread * spread / (F.col("n") * (float(total) - F.col("n") + 0.5))
    best = seen.where("n >= 5").orderBy(score.desc(), "word").limit(n).collect()  # as many words as asked for
    return np.sort(np.array([r.word for r in best], dtype=np.int64).view(np.uint64))


def _fit_text(telling: np.ndarray, rows: DataFrame, labelled: int, penalty: float = 3e-4) -> TextView:
    slim = rows.select(array_to_vector(F.col("view")).alias("features"), "label").coalesce(max(1, labelled // FIT_ROWS))
    model = LogisticRegression(maxIter=ITERATIONS, regParam=penalty, tol=1e-6).fit(slim)
    return TextView(telling, model.coefficients.toArray(), float(model.intercept))


def _counted(cells: DataFrame) -> list[tuple]:
    """Collect the number of documents for each cell and label: at most two rows for each of LANGS x SOURCES x SIZES cells."""
    return [tuple(r) for r in cells.groupBy(*CELL, "label").agg(F.count("*").alias("n")).collect()]


def votes(labels: DataFrame) -> DataFrame:
    """Return doc_id and label (1: good) of the labelled documents."""
    toxic = (F.col("toxic") == 1) if "toxic" in labels.columns else F.lit(False)
    good = F.when(toxic, 0.0).when(F.col("quality").isNotNull(), (F.col("quality") == 1).cast("double"))
    return labels.where("doc_id IS NOT NULL").select("doc_id", good.alias("good")).where("good IS NOT NULL").groupBy("doc_id").agg((F.avg("good") >= 0.5).cast("double").alias("label"))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 8000, rounds: int = 3, confident: float = 0.99, n_words: int = N_WORDS) -> Classifier | float:
    """Fit by co-training; without labels of both classes, return the prior."""
    voted = materialize(votes(labels), "quality-votes")
    share = min(1.0, max_labelled / max(voted.count(), 1))
    # about max_labelled rows, whatever the input
    chosen = F.broadcast(voted.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))))
    need = docs.select("doc_id", "text", *_slots())
    known = materialize(need.join(chosen, "doc_id").withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0), "quality-known")
    counts = {(r.held, r.label): r.n for r in known.groupBy("held", "label").agg(F.count("*").alias("n")).collect()}
    if any((h, c) not in counts for h in (True, False) for c in (0.0, 1.0)):
        total = sum(counts.values())
        return sum(n for (_, c), n in counts.items() if c) / total if total else 0.5
    labelled, sure = sum(counts.values()), float(np.log(confident / (1 - confident)))
    telling = telling_words(known.where("NOT held"), n_words)
    views = materialize(known.where("NOT held").select("text", "label").mapInArrow(kernel.tidy(_examples(telling)), "label double, view array<float>"), "quality-views")
    own_cells = _counted(known.where("NOT held"))
    text, meta = _fit_text(telling, views, labelled), MetaView(own_cells)
    from_meta, from_text, marks = None, [], None
    for _ in range(rounds):
        # the text view's confident documents, counted by cell, for the metadata view
        if marks is None:
            marked = text.add_to(need, "logit", keep_text=False).join(voted, "doc_id", "left_anti").where(F.abs("logit") >= sure)
            marks = sorted(_counted(marked.withColumn("label", (F.col("logit") > 0).cast("double"))))
        # the metadata view's confident documents, for the text view
        logit = meta.logit()
        picked = need.where(F.abs(logit) >= sure).withColumn("label", (logit > 0).cast("double")).join(voted, "doc_id", "left_anti")
        gained = materialize(picked.select("text", "label").mapInArrow(kernel.tidy(_examples(telling)), "label double, view array<float>"), "quality-gained")
        signature = gained.agg(F.count("*"), F.sum(F.xxhash64("label", "view").cast("decimal(38,0)"))).first()
        same = signature == from_meta or not (signature[0] or from_meta)
        new_text = text if same else _fit_text(telling, views.unionByName(gained), labelled + signature[0])
        meta = MetaView(own_cells + marks) if marks != from_text else meta
        discard(gained)
        if new_text is text and marks == from_text:
            break
        from_text, from_meta = marks, signature
        if new_text is not text:
            text, marks = new_text, None
    held = text.add_to(known.where("held").select("text", "label", *CELL), "t", keep_text=False).select("label", "t", meta.logit().alias("m")).collect()  # a fifth of the sample
    table = np.array([tuple(r) for r in held], dtype=np.float64)
    scale = []
    for k in (1, 2):
        slope, intercept = logistic(table[:, k : k + 1], table[:, 0], np.ones(len(table)), 1e-4)
        scale.append((max(float(slope), 0.0), float(intercept)) if slope > 0 else (0.0, float(np.log(table[:, 0].mean() / (1 - table[:, 0].mean())))))
    discard(known, views, voted)
    release(docs.sparkSession)
    good = counts[(True, 1.0)] / (counts[(True, 1.0)] + counts[(True, 0.0)])
    return Classifier(text, meta, *scale, float(np.log(good / (1 - good))))


def with_quality(docs: DataFrame, model: Classifier | float, name: str = "_quality") -> DataFrame:
    """Return ``docs`` with the column ``name``, the probability that a document is good, over whole texts."""
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    columns = [c for c in docs.columns if c != name]
    work = docs.select(F.struct(*[c for c in columns if c != "text"]).alias("row"), "text", *_slots())
    logit = F.col("text_logit") * model.text_scale[0] + model.text_scale[1] + model.meta.logit() * model.meta_scale[0] + model.meta_scale[1] - model.prior
    scored = model.text.add_to(work, "text_logit")
    return scored.select(*["text" if c == "text" else F.col("row").getField(c).alias(c) for c in columns], (1 / (1 + F.exp(-logit))).alias(name))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and judge all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_quality(docs.select("doc_id", "text", "lang", "source", "n_chars"), model).select("doc_id", F.col("_quality").alias("quality"), (F.col("_quality") >= 0.5).alias("kept"))
