"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows of ``WINDOW`` bytes, once forwards and once
backwards, labels every byte position with a probability for each language it has learned, and a
document's probabilities are the mean over all its positions. It is trained here, in numpy, by
backpropagation through time, from text and label alone.

Training uses a bounded sample: about ``SAMPLE_PER_LANGUAGE`` documents of different ids of each language, at most
``SAMPLE_DOCUMENTS`` in all (one of each language, where there are more languages than that), of which every language has an equal quota, and ``SAMPLE_WINDOWS`` windows of each,
spread over its text and cut where the text is read: two MB of windows come to the driver at most, and no
text. The sample is chosen by a hash of the id, so it is the same on every run and
at every partitioning, and the weights are a few tens of KB whatever the input. A language with fewer documents
than its quota is sampled whole, and every label is learned. Every label takes a number at every position, so the more labels
there are the fewer windows are worked on at a time: memory is the same for any number. Prediction
reads every byte of every text. A window that a text does not fill is
filled up with zero bytes; so are some windows in training, and no such position counts.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if
nothing can be learned from. Repeated rows repeat; an empty table gives an empty result. A null id
counts as the empty text for the held-out remainder. Only id, text and, in training, the label are
read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW, HIDDEN, BATCH, CELLS = 128, 12, 2048, 8 << 20
SAMPLE_PER_LANGUAGE, SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 400, 8000, 4
TRAIN_WINDOW, TRAIN_BATCH, TRAIN_STEPS, RATE, CUT_SHORT = 64, 192, 700, 0.02, 0.4
UNKNOWN, MIN_EXCESS = "und", 0.08
Weights = dict[str, np.ndarray]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def new_weights(n_labels: int, hidden: int = HIDDEN, seed: int = 0) -> Weights:
    """Small random weights; ``in`` holds the gate inputs of every byte, update and reset gate first."""
    rng = np.random.default_rng(seed)
    w: Weights = {}
    for d in "fb":
        w[f"in_{d}"] = (rng.standard_normal((256, 3 * hidden)) * 0.3).astype(np.float32)
        w[f"rec_{d}"] = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        w[f"out_{d}"] = (rng.standard_normal((hidden, n_labels)) * 0.1).astype(np.float32)
    w["bias"] = np.zeros(n_labels, np.float32)
    return w


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _scan(x: np.ndarray, w_in: np.ndarray, w_rec: np.ndarray) -> tuple[np.ndarray, list]:
    """States after each of the T steps over x (T, B), and what backpropagation needs."""
    steps, rows = x.shape
    hidden = len(w_rec)
    h = np.zeros((rows, hidden), np.float32)
    states, tape = np.empty((steps, rows, hidden), np.float32), []
    w_in, w_rec = w_in.copy(), w_rec.copy()
    w_in[:, :2 * hidden] *= 0.5  # both gates are sigmoids, taken as 0.5 + 0.5 tanh(x / 2)
    w_rec[:, :2 * hidden] *= 0.5
    a, r = np.empty((rows, 3 * hidden), np.float32), np.empty((rows, 3 * hidden), np.float32)
    for t in range(steps):
        np.take(w_in, x[t], 0, out=a)
        np.matmul(h, w_rec, out=r)
        gates = a[:, :2 * hidden]
        gates += r[:, :2 * hidden]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, reset = gates[:, :hidden], gates[:, hidden:]
        new = reset * r[:, 2 * hidden:]
        new += a[:, 2 * hidden:]
        np.tanh(new, out=new)
        tape.append((gates.copy(), new.copy(), r[:, 2 * hidden:].copy(), h))
        h = h - new
        h *= z
        h += new
        states[t] = h
    return states, tape


def _unscan(x: np.ndarray, w_rec: np.ndarray, tape: list, d_states: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and recurrent weights, given those of the states."""
    steps, rows = x.shape
    hidden = len(w_rec)
    d_in, d_rec = np.zeros((vocabulary, 3 * hidden), np.float32), np.zeros_like(w_rec)
    dh = np.zeros((rows, hidden), np.float32)
    for t in range(steps - 1, -1, -1):
        gates, new, inner, before = tape[t]
        z, reset = gates[:, :hidden], gates[:, hidden:]
        dh = dh + d_states[t]
        d_new = dh * (1 - z) * (1 - new * new)
        d_z = dh * (before - new) * z * (1 - z)
        d_reset = d_new * inner * reset * (1 - reset)
        d_gate = np.concatenate([d_z, d_reset, d_new], 1)
        d_through = np.concatenate([d_z, d_reset, d_new * reset], 1)
        np.add.at(d_in, x[t], d_gate)
        d_rec += before.T @ d_through
        dh = dh * z + d_through @ w_rec.T
    return d_in, d_rec


def _tanh(x: np.ndarray, square: np.ndarray, top: np.ndarray) -> None:
    """tanh in place, as a continued fraction to the seventh power: within 1e-4, at a third of the cost."""
    np.clip(x, -4.97, 4.97, out=x)
    np.multiply(x, x, out=square)
    np.add(square, 378, out=top)
    top *= square
    top += 17325
    top *= square
    top += 135135
    x *= top
    np.multiply(square, 28, out=top)
    top += 3150
    top *= square
    top += 62370
    top *= square
    top += 135135
    x /= top


def _states(x: np.ndarray, w_in: np.ndarray, w_rec: np.ndarray) -> np.ndarray:
    """The states of ``_scan``, (T, hidden, B): a row for each hidden unit, so that every step works on whole rows."""
    (steps, rows), hidden = x.shape, len(w_rec)
    w_in, w_rec = np.ascontiguousarray(w_in.T), np.ascontiguousarray(w_rec.T)
    w_in[:2 * hidden] *= 0.5  # both gates are sigmoids, taken as 0.5 + 0.5 tanh(x / 2)
    w_rec[:2 * hidden] *= 0.5
    states = np.empty((steps, hidden, rows), np.float32)
    h = np.zeros((hidden, rows), np.float32)
    a, r, square, top = (np.empty((3 * hidden, rows), np.float32) for _ in range(4))
    gates, z, reset, new = a[:2 * hidden], a[:hidden], a[hidden:2 * hidden], a[2 * hidden:]
    for t in range(steps):
        np.take(w_in, x[t], 1, out=a, mode="clip")
        np.matmul(w_rec, h, out=r)
        gates += r[:2 * hidden]
        _tanh(gates, square[:2 * hidden], top[:2 * hidden])
        gates *= 0.5
        gates += 0.5
        r[2 * hidden:] *= reset
        new += r[2 * hidden:]
        _tanh(new, square[:hidden], top[:hidden])
        after = states[t]
        np.subtract(h, new, out=after)
        after *= z
        after += new
        h = after
    return states


def _rows_at_once(n_labels: int, width: int, most: int) -> int:
    """Windows whose probabilities fit into ``CELLS`` numbers: the more labels, the fewer at a time."""
    return max(1, min(most, CELLS // (width * n_labels)))


def position_probabilities(w: Weights, windows: np.ndarray) -> np.ndarray:
    """(rows, T, labels) probabilities for byte windows (rows, T)."""
    x = np.ascontiguousarray(windows.T)
    scores = np.matmul(w["out_f"].T, _states(x, w["in_f"], w["rec_f"]))
    scores += np.matmul(w["out_b"].T, _states(x[::-1], w["in_b"], w["rec_b"]))[::-1]
    scores += w["bias"][:, None]
    scores -= scores.max(1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(1, keepdims=True)
    return scores.transpose(2, 0, 1)


def gradients(w: Weights, windows: np.ndarray, label: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over the positions that hold a byte (0 fills up), and its gradients by backpropagation through time."""
    x = np.ascontiguousarray(windows.T)
    filled = (x != 0).astype(np.float32)
    n = max(1.0, float(filled.sum()))
    forward, tape_f = _scan(x, w["in_f"], w["rec_f"])
    backward, tape_b = _scan(x[::-1], w["in_b"], w["rec_b"])
    backward = backward[::-1]
    scores = forward @ w["out_f"] + backward @ w["out_b"] + w["bias"]
    scores -= scores.max(2, keepdims=True)
    p = np.exp(scores)
    p /= p.sum(2, keepdims=True)
    rows = np.arange(len(label))
    loss = float(-(np.log(p[:, rows, label] + 1e-9) * filled).sum() / n)
    d = p
    d[:, rows, label] -= 1
    d *= (filled / n)[:, :, None]
    g: Weights = {"bias": d.sum((0, 1))}
    flat = d.reshape(-1, d.shape[2])
    g["out_f"] = forward.reshape(len(flat), -1).T @ flat
    g["out_b"] = np.ascontiguousarray(backward).reshape(len(flat), -1).T @ flat
    g["in_f"], g["rec_f"] = _unscan(x, w["rec_f"], tape_f, d @ w["out_f"].T, len(w["in_f"]))
    g["in_b"], g["rec_b"] = _unscan(x[::-1], w["rec_b"], tape_b, (d @ w["out_b"].T)[::-1], len(w["in_b"]))
    return loss, g


def _summed(w: Weights, windows: np.ndarray, label: np.ndarray) -> Weights:
    """The gradients of a batch; with many labels from parts of it, each weighted by its positions that hold a byte."""
    size = _rows_at_once(len(w["bias"]), windows.shape[1], len(windows))
    if size == len(windows):
        return gradients(w, windows, label)[1]
    total, filled = {k: np.zeros_like(v) for k, v in w.items()}, max(1, np.count_nonzero(windows))
    for at in range(0, len(windows), size):
        part = windows[at:at + size]
        _, g = gradients(w, part, label[at:at + size])
        for k in total:
            total[k] += g[k] * (np.count_nonzero(part) / filled)
    return total


def train(windows: np.ndarray, label: np.ndarray, n_labels: int, steps: int = TRAIN_STEPS, seed: int = 0) -> Weights:
    """Weights learned from byte windows (rows, T) and their labels, by Adam with clipped gradients."""
    rng = np.random.default_rng(seed)
    w = new_weights(n_labels, seed=seed)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    # every language is drawn equally often
    share = 1.0 / np.maximum(np.bincount(label, minlength=n_labels), 1)[label]
    share /= share.sum()
    for step in range(1, steps + 1):
        at = rng.choice(len(windows), TRAIN_BATCH, p=share)
        # some windows end early, as the last window of a text does
        end = np.where(rng.random(TRAIN_BATCH) < CUT_SHORT, rng.integers(8, windows.shape[1], TRAIN_BATCH), windows.shape[1])
        cut = np.where(np.arange(windows.shape[1])[None, :] < end[:, None], windows[at], 0)
        g = _summed(w, cut, label[at])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in w:
            v = g[k] * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return w


def _training_windows(text: str) -> np.ndarray:
    """Windows spread over a text; one filled up with zero bytes if it is shorter."""
    raw = np.frombuffer(text.encode(), np.uint8)
    room = len(raw) - TRAIN_WINDOW
    if room < 0:
        raw, room = np.pad(raw, (0, -room)), 0
    n = min(SAMPLE_WINDOWS, 1 + room // TRAIN_WINDOW)
    return np.array([raw[at:at + TRAIN_WINDOW] for at in np.linspace(0, room, n).astype(int)], np.uint8)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(order, lang, text) to (order, lang, windows): whole texts stay where they are read."""
    for batch in batches:
        windows = [_training_windows(text.as_py()).tobytes() for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(windows, pa.binary())],
                                         ["order", "lang", "windows"])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], Weights] | None:
    """Languages and weights from the documents that are not held out; None if there are none to learn from."""
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # ids, not rows: an id that very many rows share is in the sample as a whole or not at all
    counts = {r["lang"]: max(1, r["n"]) for r in known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
              .collect()}
    if not counts:
        return None
    quota = max(1, SAMPLE_DOCUMENTS // len(counts))
    drawn = min(SAMPLE_PER_LANGUAGE, 2 * quota)  # more than the quota, so that a small one is filled
    limits = [(lang, min(1.0, drawn / n) * float(1 << 40)) for lang, n in counts.items()]
    below = F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, below double"))
    order = F.pmod(F.xxhash64(F.lit(11), F.col("doc_id")), F.lit(1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "windows"))
    sample = (known.join(below, "lang").where(order < F.col("below")).select(order.alias("order"), "lang", "text")
              .mapInArrow(_cut, "order bigint, lang string, windows binary")
              .groupBy("order", "lang").agg(F.min("windows").alias("windows"))  # one row of each id
              .withColumn("rank", rank).where(F.col("rank") <= quota)
              .orderBy("order", "windows", "lang").collect())
    languages = sorted({r["lang"] for r in sample})
    number = {x: i for i, x in enumerate(languages)}
    windows = np.frombuffer(b"".join(r["windows"] for r in sample), np.uint8).reshape(-1, TRAIN_WINDOW)
    label = np.repeat([number[r["lang"]] for r in sample], [len(r["windows"]) // TRAIN_WINDOW for r in sample])
    return languages, train(windows, label, len(languages))


def predict(w: Weights, texts: list[bytes], batch: int = BATCH) -> np.ndarray:
    """(texts, labels) probabilities: the mean over all byte positions; zero for empty texts."""
    batch = _rows_at_once(len(w["bias"]), WINDOW, batch)
    size = np.array([len(t) for t in texts], np.int64)
    per = -(-size // WINDOW)
    total = np.zeros((len(texts), len(w["bias"])))
    owner = np.repeat(np.arange(len(texts)), per)
    padded = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, per.tolist()))
    windows = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
    last = np.cumsum(per) - 1
    filled = np.full(len(windows), WINDOW)
    some = per > 0
    filled[last[some]] = size[some] - (per[some] - 1) * WINDOW
    for at in range(0, len(windows), batch):
        p = position_probabilities(w, windows[at:at + batch])
        own = np.arange(WINDOW)[None, :] < filled[at:at + batch, None]
        np.add.at(total, owner[at:at + batch], np.einsum("rtl,rt->rl", p, own.astype(np.float32)))
    return total / np.maximum(size, 1)[:, None]


def label_positions(w: Weights, text: str) -> np.ndarray:
    """The most likely language (its number) at every byte of a text."""
    raw = text.encode()
    if not raw:
        return np.zeros(0, np.int64)
    padded = np.frombuffer(raw.ljust(-(-len(raw) // WINDOW) * WINDOW, b"\0"), np.uint8).reshape(-1, WINDOW)
    return position_probabilities(w, padded).argmax(2).ravel()[:len(raw)]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, held_out, lang_pred, score."""
    model = learn(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few tens of KB
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(2)
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_pylist() if known else [False] * len(texts)
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            at = [i for i, ok in enumerate(lettered) if ok]
            for lo in range(0, len(at), 512):
                part = at[lo:lo + 512]
                p = predict(known[1], [texts[i].as_py().encode() for i in part])
                for i, best, score in zip(part, p.argmax(1).tolist(), p.max(1).tolist()):
                    names[i], scores[i] = known[0][best], min(score, 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [id_col, "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col), held_out(F.col(id_col)), F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} {kind}, held_out boolean, lang_pred string, score double")


def least_score(n_labels: int, excess: float = MIN_EXCESS) -> float:
    """The score from which a document has a language. Of n labels one has 1/n at least whatever the text is; ``excess`` is the
    share of what lies between that and certainty that must be exceeded."""
    return 1 / n_labels + excess * (1 - 1 / n_labels) - 1e-6


def accepted(docs: DataFrame, min_excess: float = MIN_EXCESS, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """The documents with a language: rows predicted ``und`` or with a score below ``least_score`` go; all columns are kept."""
    model = learn(docs, id_col, text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return _filtered(docs, shared, least_score(len(model[0]), min_excess) if model else 1.0, text_col)


def _filtered(docs: DataFrame, shared, min_score: float, text_col: str) -> DataFrame:
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(at)
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_pylist() if known else [False] * len(texts)
            keep = np.zeros(len(texts), bool)
            rows = [i for i, ok in enumerate(lettered) if ok]
            for lo in range(0, len(rows), 512):
                part = rows[lo:lo + 512]
                keep[part] = predict(known[1], [texts[i].as_py().encode() for i in part]).max(1) >= min_score
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
