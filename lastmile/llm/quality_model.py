"""Quality scores: random-indexing word vectors pooled per document, a small network, calibrated.

Every word has a fixed sparse random index vector. A word's vector is the sum of the index
vectors of its neighbours, gathered over all documents into a hashed vocabulary of fixed
size. A document is the mean of its words' vectors beside that of their own index
vectors; signs of layout (capitals, symbols, repetition, length) enter as words of their
own. A two-layer network in numpy scores it and a temperature calibrates its probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastmile.llm.batches import SLICE, per_slice
from lastmile.llm.sample import labelled
from lastmile.operators.sizing import release, written

MOST_LABELLED = 8_000  # bound of the labelled sample that network and temperature are fitted on
THRESHOLD = 0.7
VOCABULARY = 1 << 14  # hashed words
SIZE = 64  # numbers in a word vector
NONZERO = 4  # of them set in an index vector
REACH = 2  # neighbours on each side
HIDDEN = 32
EPOCHS = 60
SEED = 5
LOOSE = re.compile(r"[^\W\d_]+|[^\s\w]+|[\d_]+")


def index_vectors() -> np.ndarray:
    """Sparse vectors of +1 and -1, fixed by the seed."""
    rnd = np.random.default_rng(SEED)
    out = np.zeros((VOCABULARY, SIZE), np.float32)
    at = rnd.integers(0, SIZE, (VOCABULARY, NONZERO))
    np.put_along_axis(out, at, rnd.choice(np.float32([-1, 1]), (VOCABULARY, NONZERO)), axis=1)
    return out


INDEX = index_vectors()
SET_AT = np.argsort(-np.abs(INDEX), axis=1, kind="stable")[:, :NONZERO]  # places of the numbers that are set
SET_TO = np.take_along_axis(INDEX, SET_AT, axis=1).astype(float)
PAIRS_AT_ONCE = 100_000
GAP = np.full(REACH, -1, np.int64)  # between texts, whose words are no neighbours


def word_id(word: str) -> int:
    return xxhash.xxh64_intdigest(word, SEED) % VOCABULARY


def shape(word: str) -> str:
    if word.isalpha():
        return "<upper>" if len(word) > 1 and word.isupper() else "<title>" if word[0].isupper() else "<lower>"
    return "<number>" if word.isdigit() else "<sign" + word[0] + ">"


def level(share: float, steps: int = 8) -> int:
    return min(int(share * steps), steps - 1)


def document_words(text: str) -> tuple[list[str], list[str]]:
    """(words in order, words that describe the document as a whole)."""
    raw = text.split()
    words = [w.lower() for w in raw]
    count = len(words)
    if not count:
        return [], ["<empty>"]
    different = len(set(words))
    lines = [x for x in text.split("\n") if x.strip()]
    triples = count - 2 - len(set(zip(words, words[1:], words[2:]))) if count > 2 else 0
    pieces = {"<upper>": 0, "<sign>": 0, "<number>": 0, "<end>": 0}
    for w in raw:
        last = w[-1]
        pieces["<upper>"] += w.isupper() and len(w) > 1
        pieces["<number>"] += last.isdigit()
        pieces["<end>"] += last in ".,;:"
        pieces["<sign>"] += not (last.isalnum() or last in ".,;:")
    whole = [
        f"<length {count.bit_length()}>", f"<different {level(different / count)}>",
        f"<repeated {level(triples / count)}>", f"<same lines {level(1 - len(set(lines)) / len(lines))}>",
        f"<word length {min(len(text) // count, 20)}>", f"<line length {min((count // len(lines)).bit_length(), 10)}>",
        *[f"{k}{level(n / count)}" for k, n in pieces.items()],
    ]
    return words, whole


def ids_of(words: list[str], known: dict[str, int]) -> np.ndarray:
    """Vocabulary numbers; ``known`` keeps those of words met before, up to a bound."""
    out = []
    for w in words:
        if (i := known.get(w)) is None:
            i = word_id(w)
            if len(known) < 200_000:
                known[w] = i
        out.append(i)
    return np.array(out, np.int64)


def context_sums(ids: np.ndarray, into: np.ndarray) -> None:
    """Add to each word's row the index vectors of its neighbours within reach; negative ids are gaps."""
    for at in range(0, len(ids), PAIRS_AT_ONCE):
        for step in range(1, REACH + 1):
            right = ids[at + step : at + PAIRS_AT_ONCE + step]
            left = ids[at : at + len(right)]
            real = (left >= 0) & (right >= 0)
            word = np.concatenate([left[real], right[real]])
            near = np.concatenate([right[real], left[real]])
            found = np.bincount((word[:, None] * SIZE + SET_AT[near]).ravel(), SET_TO[near].ravel(), VOCABULARY * SIZE)
            into += found.reshape(into.shape).astype(into.dtype)


def signs(word: str) -> list[str]:
    return [shape(p) for p in LOOSE.findall(word)]


def pooled(text: str | None, vectors: np.ndarray, known: dict[str, int]) -> np.ndarray:
    """Mean context vector, mean index vector, and index vectors of signs and of the whole document."""
    words, whole = document_words(text or "")
    out = np.zeros(4 * SIZE, np.float32)
    if words:
        counts = np.bincount(ids_of(words, known), minlength=VOCABULARY)
        used = np.flatnonzero(counts)
        weight = counts[used, None].astype(np.float32) / len(words)
        out[:SIZE] = (weight * vectors[used]).sum(0)
        out[SIZE : 2 * SIZE] = (weight * INDEX[used]).sum(0)
        ends = ids_of([shape(w[-1]) + shape(w[:1]) for w in (text or "").split()], known)
        out[2 * SIZE : 3 * SIZE] = INDEX[ends].mean(0)
    out[3 * SIZE :] = INDEX[ids_of(whole, known)].sum(0)
    return out


@dataclass
class Network:
    """Two layers with a tanh between, fitted by Adam on log-loss; ``temperature`` divides the margin."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) / self.temperature, -30, 30)))

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 3e-3, decay: float = 1e-3) -> Network:
        rnd = np.random.default_rng(SEED)
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        net = Network(
            x.mean(0) if len(x) else np.zeros(x.shape[1]), x.std(0) + 1e-2 if len(x) else np.ones(x.shape[1]),
            rnd.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
            rnd.normal(0, 0.1, HIDDEN), float(np.log(share / (1 - share))),
        )
        if not len(y) or y.min() == y.max():
            net.w2[:] = 0
            return net
        z = (x - net.mean) / net.scale
        params = [net.w1, net.b1, net.w2, np.array([net.b2])]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        t = 0
        for _ in range(epochs):
            for part in np.array_split(rnd.permutation(len(y)), max(1, len(y) // 64)):
                t += 1
                h = np.tanh(z[part] @ params[0] + params[1])
                p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
                g = (p - y[part]) / len(part)
                back = np.outer(g, params[2]) * (1 - h**2)
                grads = [z[part].T @ back + decay * params[0], back.sum(0), h.T @ g + decay * params[2], np.array([g.sum()])]
                for i, grad in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * grad
                    second[i] = 0.999 * second[i] + 0.001 * grad**2
                    params[i] -= rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
        net.w1, net.b1, net.w2, net.b2 = *params[:3], float(params[3][0])
        return net

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log-loss on rows the network was not fitted on."""
        if len(y) < 20 or y.min() == y.max():
            return
        margin = self.margin(x)
        loss = lambda t: np.logaddexp(0, np.where(y > 0, -margin, margin) / t).mean()
        self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def scorer(self):
        known: dict[str, int] = {}

        def scores(texts) -> list[float]:
            rows = np.array([pooled(t, self.vectors, known) for t in texts], np.float32).reshape(-1, 4 * SIZE)
            return self.network.probability(rows).tolist()

        return scores


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit context vectors of the hashed vocabulary from the texts of all documents.

    Each task sums its texts into one matrix of whole numbers of a fixed 8 MB, so that sums are
    exact in any order; tasks are few for each core, their matrices are added in groups, and
    the driver adds those of the groups one by one. Words without a neighbour keep their index
    vector.
    """

    def given(sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known = np.zeros((VOCABULARY, SIZE), np.int64), {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                pieces = []
                for text in batch.column(0).slice(at, SLICE).to_pylist():
                    pieces += [ids_of((text or "").lower().split(), known), GAP]
                context_sums(np.concatenate(pieces), sums)
        yield given(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((VOCABULARY, SIZE), np.int64)
        for batch in batches:
            for value in batch.column(0):
                sums += np.frombuffer(value.as_buffer(), np.int64).reshape(sums.shape)
        yield given(sums)

    tasks = max(16, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    parts = written(docs.select(text).coalesce(tasks).mapInArrow(run, "sums binary"))
    total = np.zeros((VOCABULARY, SIZE), np.int64)
    for row in parts.repartition(8).mapInArrow(add, "sums binary").toLocalIterator():
        total += np.frombuffer(row.sums, np.int64).reshape(total.shape)
    release(parts)
    vectors = INDEX + total
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)).astype(np.float32)


def fit(
    docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, id_column: str = "doc_id",
    text: str = "text",
) -> QualityModel:
    """Word vectors from all documents, the network from at most ``most_labelled`` labelled ones,
    whose pooled vectors alone reach the driver.

    Four fifths fit the network, the last fifth its temperature. Without labels of both
    classes every text gets the share of good labels (one half without labels).
    """
    sample = written(labelled(docs, labels, "quality", most_labelled, id_column, text))
    vectors = word_vectors(docs, text)

    def prepare():
        known: dict[str, int] = {}
        return lambda texts: [pooled(t, vectors, known) for t in texts]

    table = (
        sample.select("_id", "y", per_slice("text", "array<float>", prepare).alias("x"))
        .groupBy("_id").agg(F.max("y").alias("y"), F.min("x").alias("x")).orderBy("_id")
        .select("y", F.pmod(F.xxhash64("_id"), F.lit(5)).alias("fold"), "x").toArrow()
    )
    y = table.column("y").to_numpy().astype(float)
    flat = table.column("x").combine_chunks()
    x = np.asarray(flat.flatten(), np.float32).reshape(-1, 4 * SIZE)
    last = table.column("fold").to_numpy() == 0
    network = Network.fit(x[~last], y[~last])
    network.calibrate(x[last], y[last])
    return QualityModel(vectors, network)


def score(model: QualityModel, text: str = "text") -> Column:
    """Probability that the text is good; null and empty texts are scored as empty."""
    return per_slice(text, "double", model.scorer)


def scored(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most_labelled: int = MOST_LABELLED,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""
    model = fit(docs, labels, most_labelled, id_column, text)
    own = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*own, score(model, text).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
