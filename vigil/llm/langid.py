"""Language identification by a byte convolutional network: several filter widths, max pooling, softmax.

The network is trained in numpy on a bounded sample of labelled texts and applied to all fixed-length windows of whole
texts, in batches. A window's bytes are embedded, filters of 2, 3 and 4 bytes slide over it, each filter keeps its
maximum, and a softmax layer turns the maxima into probabilities. A text's probabilities are the mean over its windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import units, words

WINDOW = 192  # bytes of a window
WIDTHS = (2, 3, 4)
EMBED, FILTERS = 6, 12  # numbers per byte, filters per width
SAMPLE_ROWS = 4000  # at most so many labelled texts are learned from, labels in turn, each in hash order of (doc_id, text)
SAMPLE_WINDOWS = 4  # windows of each, spread evenly over the text
STEPS, STEP, BATCH = 1200, 0.004, 64  # of the training: batches, step size, windows of a batch
AT_ONCE = 128  # windows convolved at a time; their filter scores take about 6 MB
_LETTER = regex.compile(r"\p{L}")
_FOLD = words._FOLD


class Network:
    """Embedding, filters of each width, and the softmax layer."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        n = FILTERS * len(WIDTHS)
        # One matrix for all widths: a filter of width w has zero rows beyond its w bytes.
        self.mask = np.zeros((max(WIDTHS) * EMBED, n), dtype=np.float32)
        for k, w in enumerate(WIDTHS):
            self.mask[:w * EMBED, k * FILTERS:(k + 1) * FILTERS] = 1
        self.weights = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "filters": (rng.normal(0, 0.4, self.mask.shape) * self.mask).astype(np.float32),
            "bias": np.zeros(n, dtype=np.float32),
            "out": rng.normal(0, 0.1, (n, len(classes))).astype(np.float32),
            "out_bias": np.zeros(len(classes), dtype=np.float32),
        }

    def pooled(self, windows: np.ndarray, argmax: bool = False):
        """Maxima of the filters over each window (rows of bytes, padded with zeros)."""
        span, places = max(WIDTHS), windows.shape[1] - max(WIDTHS) + 1
        embedded = self.weights["embed"][windows]
        stretched = np.lib.stride_tricks.as_strided(
            embedded, (len(windows), places, span * EMBED), (embedded.strides[0], embedded.strides[1], embedded.strides[2])
        )
        flat = np.ascontiguousarray(stretched).reshape(-1, span * EMBED)
        scores = (flat @ self.weights["filters"]).reshape(len(windows), places, -1)
        if not argmax:
            return np.maximum(scores.max(1) + self.weights["bias"], 0)
        at = scores.argmax(1)
        top = np.take_along_axis(scores, at[:, None, :], 1)[:, 0] + self.weights["bias"]
        return np.maximum(top, 0), at, stretched

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.classes)), dtype=np.float32)
        for i in range(0, len(windows), AT_ONCE):
            logits = self.pooled(windows[i:i + AT_ONCE]) @ self.weights["out"] + self.weights["out_bias"]
            e = np.exp(logits - logits.max(1, keepdims=True))
            out[i:i + AT_ONCE] = e / e.sum(1, keepdims=True)
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray, seed: int = 11) -> None:
        """Adam on the weighted cross entropy, in a fixed order of batches."""
        rng, w = np.random.default_rng(seed), self.weights
        moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
        step = 0
        while step < STEPS:
            order = rng.permutation(len(windows))
            for i in range(0, min(len(order), (STEPS - step) * BATCH), BATCH):
                pick = order[i:i + BATCH]
                x = windows[pick]
                top, at, stretched = self.pooled(x, argmax=True)
                logits = top @ w["out"] + w["out_bias"]
                e = np.exp(logits - logits.max(1, keepdims=True))
                delta = e / e.sum(1, keepdims=True)
                delta[np.arange(len(x)), labels[pick]] -= 1
                delta *= (weight[pick] / len(x))[:, None]
                back = (delta @ w["out"].T) * (top > 0)
                inputs = stretched[np.arange(len(x))[:, None], at]  # the bytes under each maximum
                grads = {
                    "out": top.T @ delta, "out_bias": delta.sum(0), "bias": back.sum(0),
                    "filters": np.einsum("bnk,bn->kn", inputs, back) * self.mask,
                }
                into = back[:, :, None] * w["filters"].T[None]
                touched = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.repeat(np.arange(max(WIDTHS)), EMBED)]
                embed = np.zeros_like(w["embed"])
                np.add.at(embed, (touched.ravel(), np.tile(np.arange(EMBED), touched.size // EMBED)), into.ravel())
                grads["embed"] = embed
                step += 1
                for k, g in grads.items():
                    m, v = moments[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w[k] -= (STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def windows_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, the text of each): every text cut into windows; a text's last window is padded with zeros."""
    sizes = np.diff(starts)
    per_text = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), per_text)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * WINDOW + starts[:-1][text]
    index = begin[:, None] + np.arange(WINDOW)
    inside = index < starts[1:][text][:, None]
    return np.where(inside, _FOLD[data[np.minimum(index, max(len(data) - 1, 0))]], 0).astype(np.uint8), text


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Network | None:
    """A network trained on at most ``SAMPLE_ROWS`` rows with text and label, spread evenly over the labels.

    Rows are taken in hash order of (id, text), so that tied or null ids are spread like any other; the labels take turns,
    so that a label with few rows gives all of them before others fill the rest. None if there is no such row. Rare
    labels weigh more, so that every label counts the same in all.
    """
    size = F.length(text_col)
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
        lambda k: F.substring(F.col(text_col), (k * F.greatest(size - WINDOW, F.lit(0)) / max(SAMPLE_WINDOWS - 1, 1)).cast("int") + 1, F.lit(WINDOW)),
    )
    usable = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    # One count per label; hashes below a label's bar are about twice the rows it may give, so few rows reach the sort.
    counts = {r[0]: r[1] for r in usable.groupBy(label_col).count().collect()}
    share = -(-SAMPLE_ROWS // max(len(counts), 1))
    bars = F.create_map(*[x for label, n in counts.items() for x in (F.lit(label), F.lit(min(1.0, 2 * share / n) * (1 << 32)))])
    place = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 32))
    turn = Window.partitionBy("label").orderBy("place", "id", "parts")
    rows = (
        usable.select(place.alias("place"), F.col(id_col).alias("id"), F.array_distinct(cut).alias("parts"), F.col(label_col).alias("label"))
        .filter(F.col("place") <= bars[F.col("label")])
        .withColumn("turn", F.row_number().over(turn))
        .orderBy("turn", "place", "label", "id", "parts").limit(SAMPLE_ROWS).collect()
    ) if counts else []
    if not rows:
        return None
    classes = sorted({r["label"] for r in rows})
    texts = [(p.encode()[:WINDOW], classes.index(r["label"])) for r in rows for p in r["parts"] if p]
    data, starts = words.text_bytes(pa.array([t.decode("utf-8", "ignore") for t, _ in texts]))
    windows, text = windows_of(data, starts)
    labels = np.array([c for _, c in texts])[text]
    weight = (len(labels) / len(classes) / np.maximum(np.bincount(labels, minlength=len(classes)), 1))[labels].astype(np.float32)
    network = Network(classes)
    network.train(windows, labels, weight)
    return network


def predict(docs: DataFrame, network: Network | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of ``docs`` with the language and its score (the class's mean probability), named by ``out``.

    A text that is null or has no letter is ``und`` with score 0, and so is every text when there is no network. Every
    window of the whole text counts. Nothing is shuffled; memory is bounded by a few MB of text or the longest text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)  # a few kilobytes whatever the data
    names, sent_columns = [*keep, *out], [*keep, *([] if text_col in keep else [text_col])]

    def run(rows):
        units.forget()
        net = sent.value
        for batch in units.batches(rows, text_col, 1 << 20):
            texts = batch.column(sent_columns.index(text_col))
            data, starts = words.text_bytes(texts)
            lettered = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
            langs, scores = np.full(len(lettered), "und", dtype=object), np.zeros(len(lettered))
            if net is not None and lettered.any():
                windows, text = windows_of(data, starts)
                mean = np.zeros((len(lettered), len(net.classes)))
                np.add.at(mean, text, net.probabilities(windows))
                mean /= np.maximum(np.bincount(text, minlength=len(lettered)), 1)[:, None]
                best = mean.argmax(1)
                langs[lettered] = np.array(net.classes, dtype=object)[best[lettered]]
                scores[lettered] = np.clip(mean[np.arange(len(best)), best], 0, 1)[lettered]
            yield pa.record_batch([*(batch.column(i) for i in range(len(keep))), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names)

    kinds = dict(docs.dtypes)
    fields = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*sent_columns).mapInArrow(run, f"{fields}, `{out[0]}` string, `{out[1]}` double")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of its id as text leaves 2 by division by 4."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang; other columns are not read).

    Learns from text and lang of rows that are not held out. Repeated rows give repeated results. Without rows to learn
    from, all are ``und``. An empty table gives an empty result.
    """
    network = fit(docs.filter(~held_out()))
    return predict(docs.select("doc_id", "text"), network).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
