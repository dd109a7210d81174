"""Toxicity by a classifier chain: categories are predicted in turn, and the probabilities of earlier
ones are features of the linear models of later ones.

In training these features are out-of-fold predictions: for the rows of a fold they come from models
that have not seen them, so a later model learns how far an earlier one can be trusted on new text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tokens import chunks, words_of

#: Labelled documents that models are fitted on at most, words they know, folds, steps, ridge penalty.
SAMPLE, VOCABULARY, FOLDS, STEPS, RIDGE = 5_000, 2_000, 4, 80, 1e-3
#: Beginnings of words that count as words of their own, in bytes: inflected and compound forms share them.
HEADS = (4, 5, 6)
#: Kinds of toxic documents that are told apart, rounds in which they settle, words that tell toxic ones most.
KINDS, ROUNDS, TELLING = 3, 12, 300
#: Letters, digits and bytes of other alphabets make words; all else ends one.
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Chain:
    """Word hashes in order, the categories, and weights: words, earlier categories, bias."""

    words: np.ndarray
    names: list[str]
    weights: list[np.ndarray]

    def probabilities(self, doc: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
        """From distinct pairs (document, place of word in ``words``)."""
        out = np.zeros((n, 0))
        for w in self.weights:
            out = np.column_stack([out, _sigmoid(_linear(w, doc, word, out))])
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _linear(w: np.ndarray, doc: np.ndarray, word: np.ndarray, extra: np.ndarray) -> np.ndarray:
    k = extra.shape[1]
    size = len(w) - k - 1
    return np.bincount(doc, w[:size][word], minlength=len(extra)) + extra @ w[size : size + k] + w[-1]


def _fit(doc: np.ndarray, word: np.ndarray, extra: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Logistic regression on the presence of words; classes weigh the same. Adam on all rows."""
    n, k = extra.shape
    w = np.zeros(size + k + 1)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        error = (_sigmoid(_linear(w, doc, word, extra)) - y) * weight
        slope = np.concatenate([np.bincount(word, error[doc], minlength=size), error @ extra, [error.sum()]]) + RIDGE * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w -= 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w


def fit_chain(doc: np.ndarray, word: np.ndarray, labels: np.ndarray, words: np.ndarray, names: list[str]) -> Chain:
    """``doc``, ``word``: distinct pairs; ``labels``: a column of 0 and 1 per category, in chain order."""
    n = len(labels)
    fold = np.random.default_rng(5).permutation(n) % FOLDS
    held, weights = np.zeros((n, 0)), []
    for k in range(len(names)):
        y, out = labels[:, k].astype(float), np.zeros(n)
        for f in range(FOLDS):
            train = np.flatnonzero(fold != f)
            place = np.full(n, -1)
            place[train] = np.arange(len(train))
            mine = place[doc] >= 0
            w = _fit(place[doc[mine]], word[mine], held[train], y[train], len(words))
            rest = fold == f
            out[rest] = _sigmoid(_linear(w, doc, word, held))[rest]
        weights.append(_fit(doc, word, held, y, len(words)))
        held = np.column_stack([held, out])
    return Chain(words, names, weights)


def _presence(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, and pairs (row, hash of a word or its beginning) of each run of rows."""
    for first, end, data, at in chunks(column):
        words = words_of(data, at, lower=True, gap=_GAP)
        doc, found = [np.repeat(np.arange(end - first), words.counts)], [words.hashes]
        for size in HEADS:
            heads, which = words.heads(size)
            doc.append(doc[0][which])
            found.append(heads)
        yield first, end, np.concatenate(doc), np.concatenate(found)


def kinds_of(doc: np.ndarray, word: np.ndarray, n: int, size: int) -> np.ndarray:
    """The kind (0 to ``KINDS`` - 1, larger kinds first) of each of n documents, by which of ``size`` words they hold.

    Spherical k-means: the first centre is the document most like the mean, the others those least like the
    centres before. Documents without a word are of the first kind.
    """
    x = np.zeros((n, size))
    x[doc, word] = 1
    x *= np.log(n / np.maximum(x.sum(axis=0), 1)) + 0.1  # a word that most hold tells little apart
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    centres = x[[int(np.argmax(x @ x.mean(axis=0)))]]
    while len(centres) < KINDS:
        centres = np.vstack([centres, x[int(np.argmin((x @ centres.T).max(axis=1)))]])
    for _ in range(ROUNDS):
        kind = np.argmax(x @ centres.T, axis=1)
        centres = np.vstack([x[kind == k].sum(axis=0) if (kind == k).any() else centres[k] for k in range(KINDS)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    order = np.argsort(-np.bincount(kind, minlength=KINDS), kind="stable")
    return np.argsort(order)[kind]


def train_chain(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Chain | None:
    """A chain fitted on at most ``sample`` labelled documents, those with the smallest hashed ids.

    The earlier categories are the kinds that toxic documents fall into by the words that set them apart from
    others; the last is the label itself. Labels other than 0 and 1, and labels without a document, are
    left out. Without both labels there is no chain.
    """
    picked = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    )
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # At most ``sample`` ids, so the broadcast is bounded; each row comes back as its distinct words.
    rows = source.join(F.broadcast(picked), "id").select("id", "label", "text").mapInArrow(_distinct, "id long, label int, words binary").limit(2 * sample).collect()
    rows.sort(key=lambda r: (r["id"], r["label"], bytes(r["words"])))
    toxic = np.array([r["label"] for r in rows])
    if len(set(toxic.tolist())) < 2:
        return None
    sets = [np.frombuffer(r["words"], np.uint64) for r in rows]
    doc, word = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    names, seen = np.unique(word, return_inverse=True)
    bad = np.bincount(seen[toxic[doc] == 1], minlength=len(names))
    good = np.bincount(seen[toxic[doc] == 0], minlength=len(names))
    # Words that tell most, by the chi-square statistic, of those that some documents share.
    a, b, c, d = (x.astype(float) for x in (bad, good, toxic.sum() - bad, (1 - toxic).sum() - good))
    chi = (a * d - b * c) ** 2 * len(sets) / np.maximum((a + b) * (c + d) * toxic.sum() * (1 - toxic).sum(), 1)
    # A word of a few documents is as good as chance.
    chi[bad + good < max(3, len(sets) // 500)] = -1
    chosen = np.sort(names[np.argsort(-chi, kind="stable")[:VOCABULARY]])
    place = np.searchsorted(chosen, word)
    mine = chosen[np.minimum(place, len(chosen) - 1)] == word
    doc, place = doc[mine], place[mine]
    telling = np.argsort(-np.where(a * d > b * c, chi, -1)[np.searchsorted(names, chosen)], kind="stable")[:TELLING]
    rank = np.full(len(chosen), -1)
    rank[telling] = np.arange(len(telling))
    number = np.cumsum(toxic) - 1
    told = (toxic[doc] == 1) & (rank[place] >= 0)
    kinds = np.full(len(sets), -1)
    kinds[toxic == 1] = kinds_of(number[doc[told]], rank[place[told]], int(toxic.sum()), len(telling))
    return fit_chain(doc, place, np.column_stack([*(kinds == k for k in range(KINDS)), toxic]), chosen, [*_kind_names(), label_col])


def _kind_names() -> list[str]:
    return [f"kind_{k + 1}" for k in range(KINDS)]


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, doc, words in _presence(batch.column(2)):
            sets = [np.unique(words[doc == k]).tobytes() for k in range(end - first)]
            yield pa.RecordBatch.from_arrays([batch.column(k).slice(first, end - first) for k in (0, 1)] + [pa.array(sets, pa.binary())], ["id", "label", "words"])


def _scored(chain: Chain | None, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, doc, words in _presence(batch.column(1)):
                n = end - first
                if chain is None or not len(chain.words):
                    p = np.zeros((n, len(names)))
                else:
                    place = np.minimum(np.searchsorted(chain.words, words), len(chain.words) - 1)
                    hit = chain.words[place] == words
                    pairs = np.unique(doc[hit] * len(chain.words) + place[hit])
                    p = chain.probabilities(pairs // len(chain.words), pairs % len(chain.words), n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *[pa.array(np.round(p[:, k], 6)) for k in range(len(names))]], ["id", *names])

    return run


def score_toxicity(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """A row per input row: id, a probability ``p_<category>`` per category of the chain, and ``toxic``.

    Null and empty texts have no words and the probability that follows from that. Without a chain all
    probabilities are 0. Rows with the same id, or none, are scored each for itself. Other columns are
    not carried along.
    """
    names = [f"p_{c}" for c in (chain.names if chain else [*_kind_names(), "toxic"])]
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = source.mapInArrow(_scored(chain, names), "id long, " + ", ".join(f"{n} double" for n in names))
    return scored.withColumn("toxic", F.col(names[-1]) >= threshold).withColumnRenamed("id", id_col)
