"""Language identification: a bidirectional gated recurrent network over bytes.

Texts are cut into windows of `WINDOW` bytes, all bytes of all windows get a language distribution from the forward and
backward states, and a document's probabilities are the means over its positions. Training is back-propagation through
time in numpy on a bounded sample: at most `SAMPLE_PER_LANGUAGE` documents of each language and `SAMPLE_WINDOWS`
evenly spaced windows of each.

Defined results: `und` with score 0 where the text is null or has no letter, or where nothing could be learned; repeated
rows are predicted each; an empty table gives an empty result; a null id belongs to remainder 0 and is learned from;
further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from arrivo.llm.sampling import crc_fold
from arrivo.llm.words import pieces, texts_of

HIDDEN = 8
WINDOW = 128
BLOCK = 4096  # windows that run side by side
TRAIN_WINDOW = 48
SAMPLE_PER_LANGUAGE = 250
SAMPLE_WINDOWS = 6
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
PAD = 256  # the byte after the end of a text


def _gates(inputs: np.ndarray, hidden: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One step for all columns: new state, update gate z with reset gate r stacked, candidate, recurrent part of it."""
    h = len(hidden)
    recurrent = weight @ hidden
    gate = inputs[: 2 * h] + recurrent[: 2 * h]
    gate *= 0.5
    np.tanh(gate, out=gate)
    gate *= 0.5
    gate += 0.5
    candidate = recurrent[2 * h :] * gate[h:]
    candidate += inputs[2 * h :]
    np.tanh(candidate, out=candidate)
    new = hidden - candidate
    new *= gate[:h]
    new += candidate
    return new, gate, candidate, recurrent[2 * h :]


@dataclass
class Network:
    """Per direction: `embed` (3H x 257, bytes to gate inputs) and `weight` (3H x H); then the output layer."""

    languages: list[str]
    embed: list[np.ndarray]
    weight: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def label(self, windows: np.ndarray) -> np.ndarray:
        """Sum over its bytes of the language distribution of each window; `windows` is positions x windows."""
        steps, n = windows.shape
        h = self.weight[0].shape[1]
        forward = np.empty((steps, h, n), np.float32)
        state = np.zeros((h, n), np.float32)
        for t in range(steps):
            state = _gates(self.embed[0].take(windows[t], axis=1), state, self.weight[0])[0]
            forward[t] = state
        state = np.zeros((h, n), np.float32)
        total = np.zeros((len(self.languages), n), np.float32)
        for t in range(steps - 1, -1, -1):
            real = windows[t] != PAD
            state = _gates(self.embed[1].take(windows[t], axis=1), state, self.weight[1])[0]
            state *= real  # padding leaves the backward state at its start
            logit = self.out[:, :h] @ forward[t] + self.out[:, h:] @ state + self.bias
            logit -= logit.max(0)
            np.exp(logit, out=logit)
            logit *= real / logit.sum(0)
            total += logit
        return total


def train(languages: list[str], windows: np.ndarray, y: np.ndarray, steps: int = 260, batch: int = 128, rate: float = 0.02) -> Network:
    """Adam over random batches of windows (positions x windows); every byte carries the label of its document."""
    rng = np.random.default_rng(11)
    h, k = HIDDEN, len(languages)
    params = {}
    for d in (0, 1):
        params[f"embed{d}"] = rng.normal(0, 0.3, (3 * h, 257)).astype(np.float32)
        params[f"weight{d}"] = rng.normal(0, 0.3, (3 * h, h)).astype(np.float32)
    params["out"], params["bias"] = rng.normal(0, 0.3, (k, 2 * h)).astype(np.float32), np.zeros((k, 1), np.float32)
    first, second = ({n: np.zeros_like(v) for n, v in params.items()} for _ in range(2))
    length = len(windows)
    recent = 1.0
    for step in range(1, steps + 1):
        pick = rng.integers(0, windows.shape[1], batch)
        x, target = windows[:, pick], y[pick]
        real = (x != PAD).astype(np.float32)
        states, kept = [], []
        for d, order in ((0, range(length)), (1, range(length - 1, -1, -1))):
            state, seen, trace = np.zeros((h, batch), np.float32), np.zeros((length, h, batch), np.float32), {}
            for t in order:
                before = state
                state, gate, candidate, inner = _gates(params[f"embed{d}"].take(x[t], axis=1), before, params[f"weight{d}"])
                state = state * real[t]
                seen[t], trace[t] = state, (before, gate, candidate, inner)
            states.append(seen)
            kept.append(trace)
        both = np.concatenate(states, 1)
        logit = np.matmul(params["out"], both) + params["bias"]
        logit -= logit.max(1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(1, keepdims=True)
        count = max(real.sum(), 1)
        chosen = p[:, target, np.arange(batch)]
        loss = float(-(np.log(chosen + 1e-9) * real).sum() / count)
        delta = p
        delta[:, target, np.arange(batch)] -= 1
        delta *= real[:, None, :] / count
        grads = {n: np.zeros_like(v) for n, v in params.items()}
        grads["out"] = np.einsum("tkn,thn->kh", delta, both)
        grads["bias"] = delta.sum((0, 2))[:, None]
        back = np.matmul(params["out"].T, delta)
        for d, order in ((0, range(length - 1, -1, -1)), (1, range(length))):
            weight, carried = params[f"weight{d}"], np.zeros((h, batch), np.float32)
            for t in order:
                before, gate, candidate, inner = kept[d][t]
                z, r = gate[:h], gate[h:]
                d_state = (back[t, d * h : (d + 1) * h] + carried) * real[t]
                d_candidate = d_state * (1 - z) * (1 - candidate**2)
                d_z = d_state * (before - candidate) * z * (1 - z)
                d_r = d_candidate * inner * r * (1 - r)
                d_inputs = np.concatenate([d_z, d_r, d_candidate])
                d_recurrent = np.concatenate([d_z, d_r, d_candidate * r])
                grads[f"weight{d}"] += d_recurrent @ before.T
                np.add.at(grads[f"embed{d}"].T, x[t], d_inputs.T)
                carried = weight.T @ d_recurrent + d_state * z
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for n, g in grads.items():
            g = g * min(1.0, 1.0 / (size + 1e-9))
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.999 * second[n] + 0.001 * g * g
            params[n] -= (rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        recent = 0.9 * recent + 0.1 * loss
        if recent < 0.08:
            break
    return Network(languages, [params["embed0"], params["embed1"]], [params["weight0"], params["weight1"]], params["out"], params["bias"])


def cut_windows(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts as positions x windows, padded with `PAD`, and the number of windows per text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    number = -(-sizes // length)
    flat = np.full(int(number.sum()) * length, PAD, np.int16)
    at = 0
    for text, n in zip(texts, number):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += int(n) * length
    return flat.reshape(-1, length).T, number


def lettered(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)


def predict(texts: pa.Array, model: Network | None) -> tuple[np.ndarray, np.ndarray]:
    """Language and its mean probability over all positions of each text."""
    names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    rows = np.flatnonzero(lettered(texts))
    if model is None or not len(rows):
        return names, score
    raw = texts.cast(pa.binary()).take(pa.array(rows)).to_pylist()
    windows, number = cut_windows(raw, WINDOW)
    total = [model.label(np.ascontiguousarray(windows[:, i : i + BLOCK])) for i in range(0, windows.shape[1], BLOCK)]
    starts = np.concatenate([[0], np.cumsum(number)])[:-1]
    mean = np.add.reduceat(np.concatenate(total, 1).astype(float), starts, axis=1) / np.array([len(t) for t in raw])
    best = mean.argmax(0)
    names[rows] = np.array(model.languages, object)[best]
    score[rows] = np.clip(mean[best, np.arange(len(rows))], 0, 1)
    return names, score


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Network | None:
    """Learn from texts with a language outside the held-out remainder; None where there is none.

    The list of languages is the label set of the model. Rows are thinned by the hash of their id to about four times
    the wanted number before they are ranked, so that a language with most rows does not meet in one task.
    """
    rows = docs.where((crc_fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & (F.length("text") >= 8)).select("doc_id", "lang", "text")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.create_map(*[F.lit(v) for name in languages for v in (name, min(1.0, 4.0 * per_language / counts[name]))])
    place = (F.xxhash64("doc_id", "text").bitwiseAND((1 << 30) - 1)) / float(1 << 30)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text", "doc_id")))
    sample = rows.where(place <= share[F.col("lang")]).withColumn("_rank", rank).where(F.col("_rank") <= per_language)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            names, found = [], []
            for lang, text in zip(part.column("lang").to_pylist(), texts_of(part).cast(pa.binary()).to_pylist()):
                for at in np.unique(np.linspace(0, max(0, len(text) - TRAIN_WINDOW), SAMPLE_WINDOWS).astype(int)):
                    names.append(lang)
                    found.append(text[at : at + TRAIN_WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], names=["lang", "bytes"])

    found = sorted(tuple(r) for r in sample.select("lang", "text").mapInArrow(cut, "lang string, bytes binary").collect())
    windows = np.full((TRAIN_WINDOW, len(found)), PAD, np.int16)
    for i, (_, text) in enumerate(found):
        windows[: len(text), i] = np.frombuffer(bytes(text), np.uint8)
    number = {name: i for i, name in enumerate(languages)}
    return train(languages, windows, np.array([number[lang] for lang, _ in found]))


def predict_documents(docs: DataFrame, model: Network | None) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            names, score = predict(texts_of(part), model)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", (crc_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(judge, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Network | None, doubt: float = 1.1) -> DataFrame:
    """The rows, with all columns, whose language is known: not `und`, and likelier than `doubt` times a blind guess.

    With fewer than two languages learned there is nothing to guess between: all texts with a letter stay.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            if model is None or len(model.languages) < 2:
                keep = lettered(texts_of(part))
            else:
                names, score = predict(texts_of(part), model)
                keep = (names != UNKNOWN) & (score * len(model.languages) >= doubt)
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
