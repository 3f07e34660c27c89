"""Language identification by a byte convolutional network in numpy.

Text is cut into windows of ``WINDOW`` bytes of its UTF-8 (A-Z folded, the last one padded with zeros),
all of it, whatever its length. Filters of several widths slide over the bytes; the maximum of each over
a window, through a rectifier, goes to a softmax over the learned languages. A document's prediction is
the softmax of its windows' mean log probabilities, each window weighing as much as it has bytes.

Training happens on the driver on a sample bounded by ``SAMPLE_DOCS`` documents per language and
``SAMPLE_WINDOWS`` windows of each, chosen by hash of the id; up to ``LANGUAGES`` languages, the most
frequent ones. Sampling rates come from counts per language, so no language is gathered in one task.
For prediction only the text is used. A filter over a pair of bytes is tabulated per worker, so a width
costs a lookup for every two bytes.

Null text, and text without any letter, is ``und`` with score 1. A null language isn't learned from; with
nothing to learn from every document is ``und``. Rows that repeat an id are predicted each. A null id is
not held out and not learned from. Ties between languages go to the first by name. An empty table gives
no rows. Extra columns are kept by ``with_language``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfolio.llm.common import SMALL_ARROW_BYTES, batches, map_texts
from tallyfolio.llm.textscan import _LOWER, bytes_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_DOCS = 500
SAMPLE_WINDOWS = 4
SAMPLE_ROWS = 100_000
"""Rows of the sample over all languages, of which there may be any number."""
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """``filters[w][k]`` is (256, FILTERS): what byte b at place k adds to the filters of width w."""

    languages: list[str]
    filters: dict[int, np.ndarray]
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (n, WINDOW) of all texts, the text of each, and its bytes. A text has one at least."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // WINDOW))
    text = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[:-1][text] + nth * WINDOW
    used = np.clip(offsets[1:][text] - begin, 0, WINDOW)
    padded = np.concatenate([_LOWER[data], np.zeros(WINDOW, np.uint8)])
    found = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[begin].copy()
    found[np.arange(WINDOW)[None, :] >= used[:, None]] = 0
    return found, text, used


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], rounds: int = 8, seed: int = 3) -> Network:
    """Adam on the cross entropy. The gradient of a maximum goes to the place that attains it."""
    rng = np.random.default_rng(seed)
    n_out = len(languages)
    net = Network(
        languages,
        {w: rng.normal(0, 0.2, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS},
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), n_out)).astype(np.float32),
        np.zeros(n_out, np.float32),
    )
    values = [*(net.filters[w] for w in WIDTHS), net.shift, net.out, net.bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step, columns = 0, np.arange(FILTERS)
    for _ in range(rounds):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), 64):
            x, y = windows[order[at : at + 64]], labels[order[at : at + 64]]
            rows = np.arange(len(x))[:, None]
            tops, places = [], []
            for w in WIDTHS:
                n = WINDOW - w + 1
                z = net.filters[w][0][x[:, :n]]
                for k in range(1, w):
                    z = z + net.filters[w][k][x[:, k : k + n]]
                where = z.argmax(1)
                tops.append(z[rows, where, columns])
                places.append(where)
            raw = np.concatenate(tops, 1) + net.shift
            hidden = np.maximum(raw, 0)
            keep = rng.random(hidden.shape) < 0.8
            dropped = hidden * keep / 0.8
            logits = dropped @ net.out + net.bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ net.out.T) * (raw > 0) * keep / 0.8
            grads = []
            for i, w in enumerate(WIDTHS):
                g = np.zeros_like(net.filters[w])
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(w):
                    np.add.at(g[k], (x[rows, places[i] + k], np.broadcast_to(columns, part.shape)), part)
                grads.append(g)
            grads += [back.sum(0), dropped.T @ p, p.sum(0)]
            step += 1
            for v, g, a, b in zip(values, grads, first, second, strict=True):
                a *= 0.9
                a += 0.1 * g
                b *= 0.999
                b += 0.001 * g * g
                v -= (0.01 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


class Predictor:
    """The network with its filters tabulated by pairs of bytes."""

    def __init__(self, net: Network):
        self.net = net
        self.pairs = {}
        for w in WIDTHS:
            f = net.filters[w]
            self.pairs[w] = [(f[k][None, :, :] + f[k + 1][:, None, :]).reshape(65536, FILTERS) for k in range(0, w - 1, 2)]

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.languages)), np.float32)
        for at in range(0, len(windows), 128):
            x = windows[at : at + 128]
            pair = x[:, :-1].astype(np.int32) | (x[:, 1:].astype(np.int32) << 8)
            tops = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                z = self.pairs[w][0].take(pair[:, :n], axis=0)
                for j, table in enumerate(self.pairs[w][1:], 1):
                    z += table.take(pair[:, 2 * j : 2 * j + n], axis=0)
                if w % 2:
                    z += self.net.filters[w][w - 1].take(x[:, w - 1 : w - 1 + n], axis=0)
                tops.append(z.max(1))
            hidden = np.maximum(np.concatenate(tops, 1) + self.net.shift, 0)
            logits = hidden @ self.net.out + self.net.bias
            top = logits.max(1, keepdims=True)
            out[at : at + 128] = logits - top - np.log(np.exp(logits - top).sum(1, keepdims=True))
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        data, offsets = bytes_of(column)
        windows, text, used = windows_of(data, offsets)
        weight = np.maximum(used, 1).astype(np.float64)
        logs = self.log_probabilities(windows) * weight[:, None]
        begin = np.searchsorted(text, np.arange(len(column)))
        mean = np.add.reduceat(logs, begin, axis=0) / np.add.reduceat(weight, begin)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        named, scores = [], []
        for i, t in enumerate(column.to_pylist()):
            known = t is not None and _LETTER.search(t) is not None
            named.append(self.net.languages[best[i]] if known else UNKNOWN)
            scores.append(float(p[i, best[i]]) if known else 1.0)
        return named, scores


def held_out(id: str) -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.encode(F.col(id).cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network from the labelled documents that aren't held out; None if there are none."""
    usable = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    counts = {r[0]: r[1] for r in usable.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(id)), F.lit(1 << 30)) / float(1 << 30)
    each = min(SAMPLE_DOCS, max(1, SAMPLE_ROWS // len(counts)))
    rates = docs.sparkSession.createDataFrame([(k, each / n) for k, n in counts.items()], "name string, rate double")
    chosen = usable.select(F.col(lang).alias("name"), F.col(text).alias("text"), place.alias("place")).join(F.broadcast(rates), "name")
    chosen = chosen.filter(F.col("place") < F.col("rate")).select("name", "text")

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in batches(frames, "text"):
            found, text, used = windows_of(*bytes_of(frame.column("text")))
            first = np.searchsorted(text, np.arange(frame.num_rows + 1))
            at = [j for a, b in zip(first, first[1:], strict=False) for j in np.unique(np.linspace(a, b - 1, SAMPLE_WINDOWS).astype(int))]
            at = [j for j in at if used[j] > 20 or used[j] == used[first[text[j]]]]
            names = frame.column("name").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[text[j]] for j in at], pa.string()), pa.array([found[j].tobytes() for j in at], pa.binary())], ["name", "bytes"]
            )

    rows = sorted(tuple(r) for r in map_texts(chosen, cut, "name string, bytes binary").collect())
    languages = sorted({r[0] for r in rows})
    if not rows:
        return None
    windows = np.frombuffer(b"".join(bytes(r[1]) for r in rows), np.uint8).reshape(-1, WINDOW)
    labels = np.array([languages.index(r[0]) for r in rows])
    return train(windows, labels, languages)


def with_language(docs: DataFrame, net: Network | None, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns and rows of ``docs`` and the prediction."""
    if net is None:
        return docs.withColumns({lang_pred: F.lit(UNKNOWN), score: F.lit(1.0)})
    schema = docs.select("*", F.lit("").alias(lang_pred), F.lit(0.0).alias(score)).schema

    def predict(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net)
        for frame in batches(frames, text):
            named, scores = predictor.predict(frame.column(text))
            yield pa.RecordBatch.from_arrays(
                [*frame.columns, pa.array(named, pa.string()), pa.array(scores, pa.float64())], [*frame.schema.names, lang_pred, score]
            )

    return map_texts(docs, predict, schema, SMALL_ARROW_BYTES)
