"""Language of a text by a byte convolutional network, trained here in numpy.

A text is cut into windows of WINDOW bytes. Filters of several widths run over
the bytes of a window, the greatest answer of each filter goes into a softmax
over the languages, and the windows' probabilities are averaged by length.

A filter of width w is w tables of one weight per byte value, which is what an
embedding followed by a convolution amounts to. Two neighbouring bytes are
looked up at once when texts are judged.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.llm.batches import map_text, place, SPAN

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
# Bounds of what is learned from: documents, and characters of each, from a place in it that its id decides.
TRAINING_DOCUMENTS = 2_000
TRAINING_CHARS = 1_024
LANGUAGES = 1_000
EPOCHS = 6
STEP_WINDOWS = 64
RATE = 0.01
SEED = 7
# Windows judged at once.
TILE = 256
UNKNOWN = "und"
FOLDS = 5


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # per width: (width, 256, FILTERS)
    dense: np.ndarray  # (len(WIDTHS) * FILTERS + 1, languages), the last row is the bias


def windows(text: str) -> np.ndarray:
    """(n, WINDOW) bytes of the text with A-Z lower-cased, the last window filled up with zeros."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    filled = np.zeros(-(-len(raw) // WINDOW) * WINDOW, np.uint8)
    filled[: len(raw)] = raw
    return filled.reshape(-1, WINDOW)


def _answers(tables: list[np.ndarray], cut: np.ndarray) -> list[np.ndarray]:
    """Per width, (n, positions, FILTERS)."""
    found = []
    for table in tables:
        width = len(table)
        n = WINDOW - width + 1
        answer = table[0][cut[:, :n]]
        for k in range(1, width):
            answer += table[k][cut[:, k : k + n]]
        found.append(answer)
    return found


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, str]]) -> Network | None:
    """A network from (text, language) pairs; None if there are none. The same samples give the same network."""
    languages = sorted({language for _, language in samples})
    if not languages:
        return None
    parts = [(windows(text), languages.index(language)) for text, language in samples if text]
    cut = np.concatenate([np.zeros((0, WINDOW), np.uint8), *(p for p, _ in parts)])
    target = np.concatenate([np.zeros(0, int), *(np.full(len(p), y) for p, y in parts)])
    rng = np.random.default_rng(SEED)
    tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS + 1, len(languages))).astype(np.float32)
    params = [*tables, dense]
    mean = [np.zeros_like(p) for p in params]
    square = [np.zeros_like(p) for p in params]
    # Rare languages weigh as much as common ones.
    weight = len(target) / (len(languages) * np.maximum(1, np.bincount(target, minlength=len(languages))))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(cut))
        for start in range(0, len(cut), STEP_WINDOWS):
            chosen = order[start : start + STEP_WINDOWS]
            batch, y, step = cut[chosen], target[chosen], step + 1
            answers = _answers(tables, batch)
            where = [a.argmax(axis=1) for a in answers]
            pooled = np.concatenate([a.max(axis=1) for a in answers], axis=1)
            hidden = np.concatenate([np.maximum(pooled, 0), np.ones((len(batch), 1), np.float32)], axis=1)
            slope = _softmax(hidden @ dense)
            slope[np.arange(len(y)), y] -= 1
            slope *= (weight[y] / len(y))[:, None]
            back = (slope @ dense[:-1].T) * (pooled > 0)
            grads = [np.zeros_like(p) for p in params]
            grads[-1] = (hidden.T @ slope).astype(np.float32)
            rows = np.arange(len(batch))[:, None]
            for i, width in enumerate(WIDTHS):
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for k in range(width):
                    np.add.at(grads[i][k], (batch[rows, where[i] + k], np.arange(FILTERS)[None, :]), part)
            for p, g, m, v in zip(params, grads, mean, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, tables, dense)


class Judge:
    """Applies a network; the tables of byte pairs are made once per task."""

    def __init__(self, network: Network):
        self.network = network
        self.pairs = [
            [
                (table[k][:, None, :] + table[k + 1][None, :, :]).reshape(65536, FILTERS)
                if k + 1 < len(table)
                else table[k]
                for k in range(0, len(table), 2)
            ]
            for table in network.tables
        ]

    def _window_scores(self, cut: np.ndarray) -> np.ndarray:
        two = cut[:, :-1].astype(np.uint16) << 8 | cut[:, 1:]
        pooled = []
        for table, width in zip(self.pairs, WIDTHS, strict=True):
            n = WINDOW - width + 1
            answer = table[0][two[:, :n]]
            for k in range(2, width, 2):
                source = two if k + 1 < width else cut
                answer += table[k // 2][source[:, k : k + n]]
            pooled.append(answer.max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        return _softmax(hidden @ self.network.dense[:-1] + self.network.dense[-1])

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        judged = [i for i, text in enumerate(texts) if text and any(map(str.isalpha, text))]
        held: list[tuple[int, np.ndarray]] = []
        totals: dict[int, np.ndarray] = {}

        def judge() -> None:
            cut = np.concatenate([c for _, c in held])
            owners = np.concatenate([np.full(len(c), i) for i, c in held])
            share = self._window_scores(cut) * (cut != 0).sum(axis=1, keepdims=True)
            for i in {i for i, _ in held}:
                totals[i] = totals.get(i, 0) + share[owners == i].sum(axis=0)
            held.clear()

        waiting = 0
        for i in judged:
            cut = windows(texts[i])
            for start in range(0, len(cut), TILE):
                part = cut[start : start + TILE]
                if waiting + len(part) > TILE and held:
                    judge()
                    waiting = 0
                held.append((i, part))
                waiting += len(part)
        if held:
            judge()
        for i, total in totals.items():
            best = int(total.argmax())
            found[i], scores[i] = self.network.languages[best], float(total[best] / total.sum())
        return found, scores


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS


def training_sample(docs: DataFrame, most: int = TRAINING_DOCUMENTS) -> list[tuple[str, str]]:
    """At most `most` pieces of labelled texts outside fold 0, as many of each language as there are."""
    labelled = docs.filter((fold() != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return []
    each = most / len(counts)
    taken = F.lit(False)
    for row in counts:
        share = min(1.0, each / row["count"])
        taken = taken | ((F.col("lang") == row["lang"]) & (place("doc_id") < int(share * SPAN)))
    last = F.greatest(F.length("text") - TRAINING_CHARS, F.lit(0)) + 1
    piece = F.substr("text", (1 + F.pmod(F.xxhash64("doc_id"), last)).cast("int"), F.lit(TRAINING_CHARS))
    chosen = labelled.filter(taken).select(piece.alias("piece"), "lang", place("doc_id").alias("place"))
    rows = chosen.orderBy("place", "piece", "lang").limit(most).collect()
    return [(row.piece, row.lang) for row in rows if row.piece]


def fit(docs: DataFrame, most: int = TRAINING_DOCUMENTS) -> Network | None:
    return train(training_sample(docs, most))


def identify(docs: DataFrame, network: Network | None, keep: list[str]) -> DataFrame:
    """The kept columns, `lang_pred` and `score` (0 to 1) of every whole text.

    A text that is NULL or has no letter is `und` with score 0; so is every
    text if nothing labelled was there to learn from. Only the text decides.
    Repeated rows are all returned; an empty table gives no rows.
    """

    def start():
        judge = Judge(network) if network else lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts))
        return judge

    return map_text(docs, "text", keep, "lang_pred string, score double", start)
