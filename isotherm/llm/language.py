"""Language identification by a byte-level convolutional network, trained here with numpy.

A text's bytes are cut into windows of fixed length. Filters of widths 2, 3 and 4
over byte embeddings are max-pooled over the window and lead to a softmax over
the languages; a text's probabilities are the mean over all its windows.

As an input is one of 256 bytes, embedding and filters fold into tables by byte
pair after training, so a window costs two look-ups per byte.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
rows without a language teach nothing; without any labelled row all is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import lean, texts
from isotherm.session import configure

WINDOW, EMBEDDING, FILTERS, WIDTHS = 128, 8, 16, (2, 3, 4)
#: Labelled documents that the network is fitted on, chosen by a hash of the id, and windows of each.
TRAIN_DOCS, TRAIN_WINDOWS = 6000, 4
#: Up to so many documents of each language besides; fewer where ids share a cell by hash.
LANGUAGE_DOCS = 100
UNKNOWN = "und"
#: Windows that go through the network at once.
BLOCK = 512


def held_out(id_col: Column, modulus: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id is held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == rest, F.lit(True))


def windows(text: str) -> np.ndarray:
    """All windows of the text's UTF-8 bytes, the last one filled up with zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(max(1, -(-len(data) // WINDOW)) * WINDOW, np.uint8)
    out[: len(data)] = data
    return out.reshape(-1, WINDOW)


@dataclass
class ByteNetwork:
    """Parameters of the network: embedding, one (width * embedding, filters) matrix per width, output layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def initial(cls, languages: list[str], rng: np.random.Generator) -> ByteNetwork:
        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        filters = [normal(w * EMBEDDING, FILTERS, scale=(2 / (w * EMBEDDING)) ** 0.5) for w in WIDTHS]
        biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        hidden = FILTERS * len(WIDTHS)
        out = normal(hidden, len(languages), scale=hidden**-0.5)
        return cls(languages, normal(256, EMBEDDING, scale=1), filters, biases, out, np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.out, self.out_bias]

    def gradients(self, batch: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over a batch of windows."""
        n = len(batch)
        padded = np.pad(batch, ((0, 0), (0, max(WIDTHS) - 1)))
        embedded = self.embedding[padded]
        pooled, seen = [], []
        for width, kernel, bias in zip(WIDTHS, self.filters, self.biases, strict=True):
            spans = np.concatenate([embedded[:, j : j + WINDOW] for j in range(width)], axis=2)
            act = spans @ kernel + bias
            best = act.argmax(1)
            top = np.take_along_axis(act, best[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            seen.append((best, top))
        hidden = np.concatenate(pooled, 1)
        error = _softmax(hidden @ self.out + self.out_bias)
        error[np.arange(n), labels] -= 1
        error /= n
        to_hidden = error @ self.out.T
        d_embedding, d_filters, d_biases = np.zeros_like(self.embedding), [], []
        for k, (width, kernel) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            best, top = seen[k]
            d_top = to_hidden[:, k * FILTERS : (k + 1) * FILTERS] * (top > 0)
            rows = np.arange(n)[:, None, None]
            at = best[:, :, None] + np.arange(width)
            spans = embedded[rows, at].reshape(n, FILTERS, width * EMBEDDING)  # only the pooled places learn
            d_filters.append(np.einsum("nfk,nf->kf", spans, d_top))
            d_biases.append(d_top.sum(0))
            d_spans = (d_top[:, :, None] * kernel.T[None]).reshape(-1, EMBEDDING)
            np.add.at(d_embedding, padded[rows, at].ravel(), d_spans)
        return [d_embedding, *d_filters, *d_biases, hidden.T @ error, error.sum(0)]

    def fit(self, data: np.ndarray, labels: np.ndarray, steps: int = 900, batch: int = 128, rate: float = 0.01, seed: int = 1) -> None:
        """Adam over shuffled batches, for at least so many steps and two passes."""
        rng, step = np.random.default_rng(seed), 0
        epochs = max(2, -(-steps * batch // len(data)))
        means = [np.zeros_like(p) for p in self.parameters()]
        squares = [np.zeros_like(p) for p in self.parameters()]
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for rows in np.array_split(order, max(1, len(order) // batch)):
                step += 1
                grads = self.gradients(data[rows], labels[rows])
                for p, g, m, s in zip(self.parameters(), grads, means, squares, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses by byte pair: of the pair where a filter starts, and of the pair two bytes on."""
        parts = [[self.embedding @ k[j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(w)] for w, k in zip(WIDTHS, self.filters, strict=True)]
        first = [p[0][:, None] + p[1][None] + b for p, b in zip(parts, self.biases, strict=True)]
        none = np.zeros((256, 256, FILTERS), np.float32)
        later = [none, parts[1][2][:, None] + none, parts[2][2][:, None] + parts[2][3][None]]
        return tuple(np.concatenate(x, 2).reshape(65536, -1).astype(np.float32) for x in (first, later))

    def probabilities(self, data: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Of each language for each window."""
        first, later = tables
        out = []
        for block in (data[i : i + BLOCK] for i in range(0, len(data), BLOCK)):
            wide = np.pad(block, ((0, 0), (0, 3))).astype(np.int32)
            pairs = wide[:, :-1] << 8 | wide[:, 1:]
            act = first[pairs[:, :WINDOW]]
            act += later[pairs[:, 2 : WINDOW + 2]]
            out.append(_softmax(np.maximum(act.max(1), 0) @ self.out + self.out_bias))
        return np.concatenate(out)


def _softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(1, keepdims=True))
    return shifted / shifted.sum(1, keepdims=True)


def lowest(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """About the ``most`` rows of ``rows`` with the smallest hash of their first column, at most so many.

    A limit alone would take so many from every task into one. A threshold for the
    hash, from the number of rows, leaves half as many again before it.
    """
    n = rows.count()
    digest = F.xxhash64(by[0])
    if n > 2 * most:
        share = 1.5 * (most + 10 * most**0.5) / n
        rows = rows.where(digest < int(min(share, 1.0) * (2**64 - 1)) - 2**63)
    return rows.distinct().orderBy(digest, *by).limit(most)


def training_sample(docs: DataFrame, most_docs: int = TRAIN_DOCS, per_language: int = LANGUAGE_DOCS) -> DataFrame:
    """``doc_id, lang, text`` of the ids with the smallest hashes, and of up to ``per_language`` more ids of each language.

    The latter have the smallest hash in one of so many cells by hash, so that
    tasks hand on one row a cell. Rows that share id and language are one, by
    their smallest text.
    """
    labelled = texts(docs, F.col("lang").cast("string").alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL AND text <> ''")
    digest = F.xxhash64("doc_id")
    low = lowest(labelled.select("lang", "doc_id"), most_docs, "doc_id", "lang")  # bounded by the parameter
    cells = labelled.groupBy("lang", F.pmod(digest, F.lit(per_language)).alias("cell"))
    each = cells.agg(F.min(F.struct(digest.alias("digest"), "doc_id")).alias("least")).select("lang", "least.doc_id")
    chosen = low.union(each).distinct()
    return labelled.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def train(docs: DataFrame, most_docs: int = TRAIN_DOCS, per_doc: int = TRAIN_WINDOWS, seed: int = 7) -> ByteNetwork | None:
    """Fit on a sample of ``doc_id, text, lang``; None if no row has a language.

    Of each row of the sample ``per_doc`` windows are spread over the text; so
    the driver gets a few megabytes at any size.
    """
    schema = pa.schema([("lang", pa.string()), ("data", pa.binary())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, data = [], []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = windows(text)
                for i in np.unique(np.linspace(0, len(found) - 1, per_doc).astype(int)):
                    langs.append(lang)
                    data.append(found[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(data, pa.binary())], schema=schema)

    sample = training_sample(docs, most_docs).select("doc_id", "text", "lang")
    rows = sample.mapInArrow(lean(task), "lang string, data binary").toArrow().sort_by([("lang", "ascending"), ("data", "ascending")])
    if not rows.num_rows:
        return None
    languages = sorted(set(rows["lang"].to_pylist()))
    labels = np.searchsorted(languages, rows["lang"].to_pylist())
    data = np.frombuffer(b"".join(rows["data"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    network = ByteNetwork.initial(languages, np.random.default_rng(seed))
    network.fit(data, labels)
    return network


class LanguageJudge:
    """Language and score of a whole text."""

    def __init__(self, network: ByteNetwork | None):
        self.network = network
        self.tables = network.tables() if network else None

    def by_window(self, text: str) -> np.ndarray | None:
        """Probabilities of each window; None without a network or a letter."""
        if self.network is None or not any(c.isalpha() for c in text):
            return None
        return self.network.probabilities(windows(text), self.tables)

    def __call__(self, text: str) -> tuple[str, float]:
        found = self.by_window(text)
        if found is None:
            return UNKNOWN, 0.0
        mean = found.mean(0, dtype=np.float64)
        return self.network.languages[int(mean.argmax())], min(1.0, float(mean.max()))

    def known(self, text: str) -> float | None:
        """Mean over the windows of the probability of each one's likeliest language, whichever that is; None if there is none."""
        found = self.by_window(text)
        return None if found is None else float(found.max(1).mean(dtype=np.float64))


def identify(docs: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = LanguageJudge(network)
        for batch in batches:
            found = [judge(text) for text in batch.column(1).to_pylist()]
            langs, scores = [lang for lang, _ in found], [score for _, score in found]
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = texts(docs, id_col=id_col, text_col=text_col)
    return rows.mapInArrow(lean(task), "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, network: ByteNetwork | None, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose windows are in known languages with at least that mean probability.

    A text may divide among any number of languages.
    """
    place = docs.columns.index(text_col)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = LanguageJudge(network)
        for batch in batches:
            found = [judge.known(text or "") for text in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([score is not None and score >= least_score for score in found], pa.bool_()))

    configure(docs.sparkSession)
    return docs.mapInArrow(lean(task), docs.schema)
