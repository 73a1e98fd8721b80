"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm import arrays

#: Bytes of text handled together; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20
#: Labelled rows that the classifier is fitted on at most; those with the smallest hashes of their ids.
MAX_EXAMPLES = 16_000
BITS, EPOCHS = 28, 4
#: FTRL: learning rate alpha / (beta + root of squared gradients) per coordinate, and both penalties.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2.0, 1.0


def features(texts: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and the text of each, one entry for each occurrence: words (runs of letters and digits
    in lower case), pairs and triples of words in a row, and pairs with one word between."""
    texts = texts._replace(data=arrays.LOWER[texts.data])
    spans = arrays.runs(texts, arrays.WORD_CHARACTER[texts.data])
    word, text = arrays.run_hashes(texts.data, spans), spans.text_of()
    made, owner = [word], [text]
    for salt, gaps in ((1, (0, 1)), (2, (0, 1, 2)), (3, (0, 2))):
        last = len(word) - gaps[-1]
        if last <= 0:
            continue
        value = np.full(last, salt, np.uint64)
        for gap in gaps:
            value = value * np.uint64(0x9E3779B97F4A7C15) + word[gap:gap + last]
        keep = np.flatnonzero(text[:last] == text[gaps[-1]:])
        made.append(arrays.mix(value[keep]))
        owner.append(text[keep])
    return (np.concatenate(made) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owner)


def fit(examples: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over the examples (each its distinct features), in the given order.

    Returns the features of non-zero weight, their weights, and the bias.
    """
    if not examples or labels.min() == labels.max():
        rate = (labels.sum() + 0.5) / (len(labels) + 1.0) if len(labels) else 0.5
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(rate / (1 - rate)))
    # features of one example only move alike, so they are one coordinate of the example, counted as often as they are
    repeated = np.concatenate([_repeated([e[e >> (BITS - 3) == part] for e in examples]) for part in range(8)])
    rows, alone = [], np.zeros(len(examples))
    for i, example in enumerate(examples):
        at = _places(repeated, example)
        rows.append(at[at >= 0].astype(np.int32))
        alone[i] = len(at) - len(rows[-1])
    bias = len(repeated)  # a coordinate without L1; those of the examples follow
    z, n = np.zeros(bias + 1 + len(rows)), np.zeros(bias + 1 + len(rows))

    def weights(at: np.ndarray) -> np.ndarray:
        pull = z[at]
        grip = np.where(at == bias, 0.0, L1)
        return np.where(np.abs(pull) <= grip, 0.0,
                        -(pull - np.sign(pull) * grip) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, (row, label) in enumerate(zip(rows, labels)):
            at = np.append(row, (bias, bias + 1 + i))
            w = weights(at)
            total = w[:-1].sum() + alone[i] * w[-1]
            gradient = 1 / (1 + np.exp(-np.clip(total, -35, 35))) - label
            grown = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    used = np.flatnonzero(np.abs(z[:bias]) > L1)  # L1 alone decides which features stay
    feature, weight = [repeated[used].astype(np.int64)], [weights(used)]
    for i in np.flatnonzero((np.abs(z[bias + 1:]) > L1) & (alone > 0)).tolist():
        feature.append(examples[i][_places(repeated, examples[i]) < 0].astype(np.int64))
        weight.append(np.repeat(weights(np.array([bias + 1 + i])), len(feature[-1])))
    feature, weight = np.concatenate(feature), np.concatenate(weight)
    order = np.argsort(feature)
    return feature[order], weight[order], float(weights(np.array([bias]))[0])


def _repeated(examples: list[np.ndarray]) -> np.ndarray:
    """The features that several examples have, in order."""
    every = np.sort(np.concatenate(examples))
    return np.unique(every[1:][every[1:] == every[:-1]])


def _places(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The places of values in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on the labelled rows of ``labels`` (id, label), at most ``max_examples`` of them.

    The features of the examples are made where the documents are read. The bounded sample is fitted by one
    task, in the order of hashed ids; only the weights that L1 leaves come to the driver.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .withColumn("turn", F.xxhash64("id")).orderBy("turn", "id").limit(max_examples))
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the sample's rows are bounded, so they may go to every executor
    examples = flat.join(F.broadcast(chosen), "id").select("turn", "id", "label", "text")

    def extract(batches):
        for block in arrays.blocks(batches, BLOCK_BYTES):
            feature, owner = features(arrays.texts_of(block.column("text")))
            pair = np.unique(owner << BITS | feature)
            first = np.searchsorted(pair >> BITS, np.arange(block.num_rows + 1))
            feature = (pair & (1 << BITS) - 1).astype("<u4")
            yield pa.RecordBatch.from_pydict({
                "turn": block.column("turn"), "id": block.column("id"), "label": block.column("label"),
                "features": pa.array([feature[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
            })

    def learn(whole: pa.Table) -> pa.Table:
        # the features stay where they are, only their order is sorted
        order = np.lexsort((whole.column("id").to_numpy(), whole.column("turn").to_numpy()))
        found = whole.column("features")
        rows = [np.frombuffer(found[int(i)].as_buffer(), "<u4") for i in order]
        feature, weight, bias = fit(rows, whole.column("label").to_numpy()[order].astype(float))
        return pa.table({"feature": pa.array(np.append(feature, -1)), "weight": pa.array(np.append(weight, bias))})

    rows = examples.mapInArrow(extract, "turn long, id long, label int, features binary").withColumn("fit", F.lit(0))
    made = rows.groupBy("fit").applyInArrow(learn, "feature long, weight double").collect()
    model = {r["feature"]: r["weight"] for r in made}
    bias = model.pop(-1, 0.0)
    feature = np.array(sorted(model), np.int64)
    return feature, np.array([model[f] for f in feature.tolist()]), bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], threshold: float = 0.3,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score and predicted for every row; a text is the set of its features, at any length.

    A null or empty text has none and gets the bias alone. Other columns are not looked at.
    """
    feature, weight, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((feature, weight))

    def rate(batches):
        known, weights = shared.value
        there = np.zeros(1 << 20, bool)  # most features are no weight's; their low bits say so
        there[known & (1 << 20) - 1] = True
        for block in arrays.blocks(batches, BLOCK_BYTES):
            found, owner = features(arrays.texts_of(block.column("text")))
            hit = np.flatnonzero(there[found & (1 << 20) - 1])
            pair = np.unique(owner[hit] << BITS | found[hit])
            owner, found = pair >> BITS, pair & (1 << BITS) - 1
            total = np.full(block.num_rows, bias)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                same = known[at] == found
                total += np.bincount(owner[same], weights=weights[at[same]], minlength=block.num_rows)
            value = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_pydict({
                "id": block.column("id"), "score": pa.array(value),
                "predicted": pa.array((value >= threshold).astype(np.int32)),
            })

    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return flat.mapInArrow(rate, "id long, score double, predicted int").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> F.Column:
    """The rows kept from the fit: one in four by the checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """``id_col``, held_out, score and predicted for every row of ``docs``.

    Learned from the labels of rows that are not held out. A null label says nothing; of repeated labels of an
    id the largest counts; without any label every score is one half, and with one class alone it is that
    class's rate. Repeated rows and null ids get a row each; an empty table gives none.
    """
    model = train(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col, max_examples)
    scored = score(docs, model, id_col=id_col, text_col=text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
