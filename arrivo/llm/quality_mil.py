"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE_WORDS` words. Every passage is encoded from its words, a gated attention
(tanh times sigmoid) weighs the encodings within the document, and a logistic output scores the weighted sum. Only
documents carry labels; encoder, attention and output are learned together by back-propagation in numpy on a bounded
sample (`SAMPLE_PER_CLASS` documents of each class, at most `SAMPLE_PASSAGES` evenly spaced passages of each). Scoring
reads whole texts and all passages.

Defined results: a null text or one without words scores 0; repeated rows are scored each; an empty table gives an
empty result; a null id counts as held out; further columns are not looked at. Without labelled rows of both classes
every text with words scores the share of label 1 (one half if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from arrivo.llm.sampling import crc_fold, labelled_rows
from arrivo.llm.words import Words, pieces, table, texts_of, word_traits

PASSAGE_WORDS = 48
SAMPLE_PER_CLASS = 1500
SAMPLE_PASSAGES = 48
FOLDS = 5
GOOD_FROM = 0.3
HASH_SLOTS = 8
WIDTH, GATE = 12, 8


def passages(words: Words, size: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First word of each passage, and how many passages each text has; the last one of a text may be short."""
    number = -(-words.counts // size)
    first = np.concatenate([[0], np.cumsum(number)])[:-1]
    within = np.arange(number.sum()) - np.repeat(first, number)
    return np.repeat(words.starts[:-1], number) + within * size, number


def encode_passages(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of the encoder, one row per passage, and the number of passages per text."""
    starts, number = passages(words)
    if not len(starts):
        return np.zeros((0, 9 + HASH_SLOTS), np.float32), number
    size = np.diff(np.append(starts, len(words)))
    add = lambda v: np.add.reduceat(v[words.codes], starts)
    traits = word_traits(words.vocabulary)
    chars = np.maximum(add(traits["chars"]), 1)
    columns = [chars / size / 8]
    columns += [add(traits[k]) / chars for k in ("upper", "symbols", "bangs", "digits", "beyond_ascii")]
    columns.append(add(traits["stops"]) / size)
    code, owner = words.codes, np.repeat(np.arange(len(starts)), size)
    span = len(words.vocabulary) + 1
    distinct = np.bincount(np.unique(owner * span + code) // span, minlength=len(starts))
    again = np.zeros(len(code))
    again[1:] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
    columns += [distinct / size, np.add.reduceat(again, starts) / size]
    slot = (words.hashes() % np.uint64(HASH_SLOTS)).astype(np.int64)
    counts = np.bincount(owner * HASH_SLOTS + slot[code], minlength=len(starts) * HASH_SLOTS).reshape(-1, HASH_SLOTS)
    return np.concatenate([np.stack(columns, 1), counts / size[:, None]], 1).astype(np.float32), number


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


@dataclass
class Attention:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    shift: float

    def forward(self, x: np.ndarray, starts: np.ndarray, number: np.ndarray) -> dict[str, np.ndarray]:
        """All values of one pass over non-empty bags."""
        w = self.weights
        hidden = np.tanh(x @ w["encode"] + w["encode_bias"])
        content, gate = np.tanh(hidden @ w["content"]), _sigmoid(hidden @ w["gate"])
        energy = (content * gate) @ w["attend"]
        energy = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), number))
        share = energy / np.repeat(np.add.reduceat(energy, starts), number)
        bag = np.add.reduceat(hidden * share[:, None], starts)
        return {"hidden": hidden, "content": content, "gate": gate, "share": share, "bag": bag, "logit": bag @ w["out"] + w["bias"][0]}

    def score(self, x: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Per text; 0 for those without passages."""
        out = np.zeros(len(number))
        some = np.flatnonzero(number)
        if len(some):
            starts = np.concatenate([[0], np.cumsum(number[some])])[:-1]
            out[some] = _sigmoid(self.forward((x - self.mean) / self.scale, starts, number[some])["logit"] + self.shift)
        return out


def train(bags: list[np.ndarray], y: np.ndarray, prior: float, steps: int = 220, rate: float = 0.02, decay: float = 1e-4) -> Attention:
    """Adam on whole batches; `prior` is the share of label 1 among all labelled rows, which the sample balances away."""
    rng = np.random.default_rng(7)
    inputs = bags[0].shape[1] if bags else 9 + HASH_SLOTS
    shape = {"encode": (inputs, WIDTH), "encode_bias": (WIDTH,), "content": (WIDTH, GATE), "gate": (WIDTH, GATE), "attend": (GATE,), "out": (WIDTH,), "bias": (1,)}
    weights = {k: rng.normal(0, 0.3, s) for k, s in shape.items()}
    odds = lambda p: float(np.log(np.clip(p, 1e-3, 1 - 1e-3) / (1 - np.clip(p, 1e-3, 1 - 1e-3))))
    if not len(y) or y.min() == y.max():
        weights["out"][:], weights["bias"][:] = 0, 0
        return Attention(np.zeros(inputs), np.ones(inputs), weights, odds(prior))
    x = np.concatenate(bags).astype(float)
    number = np.array([len(b) for b in bags])
    starts = np.concatenate([[0], np.cumsum(number)])[:-1]
    model = Attention(x.mean(0), x.std(0) + 1e-3, weights, 0.0)
    x = (x - model.mean) / model.scale
    first, second = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    for step in range(1, steps + 1):
        v = model.forward(x, starts, number)
        d_logit = (_sigmoid(v["logit"]) - y) / len(y)
        d_bag = np.repeat(d_logit[:, None] * weights["out"], number, axis=0)
        d_share = (v["hidden"] * d_bag).sum(1)
        d_energy = v["share"] * (d_share - np.repeat(np.add.reduceat(v["share"] * d_share, starts), number))
        d_content = d_energy[:, None] * weights["attend"] * v["gate"] * (1 - v["content"] ** 2)
        d_gate = d_energy[:, None] * weights["attend"] * v["content"] * v["gate"] * (1 - v["gate"])
        d_hidden = v["share"][:, None] * d_bag + d_content @ weights["content"].T + d_gate @ weights["gate"].T
        d_hidden *= 1 - v["hidden"] ** 2
        grads = {
            "encode": x.T @ d_hidden, "encode_bias": d_hidden.sum(0), "content": v["hidden"].T @ d_content, "gate": v["hidden"].T @ d_gate,
            "attend": (v["content"] * v["gate"]).T @ d_energy, "out": v["bag"].T @ d_logit, "bias": np.array([d_logit.sum()]),
        }
        for k, g in grads.items():
            g = g + decay * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model.shift = odds(prior) - odds(float(y.mean()))
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, folds: int = FOLDS) -> Attention:
    """Learn from labelled rows outside fold 0."""
    learn = crc_fold("doc_id", folds) != 0
    schema = pa.schema([("y", pa.int32()), ("width", pa.int32()), ("x", pa.list_(pa.float32()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            x, number = encode_passages(Words(texts_of(part)))
            bags = np.split(x, np.cumsum(number)[:-1])
            bags = [b[np.unique(np.linspace(0, len(b) - 1, SAMPLE_PASSAGES).astype(int))] if len(b) > SAMPLE_PASSAGES else b for b in bags]
            yield table(schema, part.column("y").cast(pa.int32()), np.full(len(bags), x.shape[1]), pa.array([b.ravel() for b in bags], pa.list_(pa.float32())))

    sample = labelled_rows(docs, labels, "quality", per_class, learn)
    rows = sorted(r for r in sample.repartition(8).mapInArrow(measure, "y int, width int, x array<float>").collect() if r.x)
    prior = labels.where(learn & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    return train([np.array(r.x, np.float32).reshape(-1, r.width) for r in rows], np.array([r.y for r in rows], float), 0.5 if prior is None else prior)


def score_documents(docs: DataFrame, model: Attention, folds: int = FOLDS, good_from: float = GOOD_FROM) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, passages."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            x, number = encode_passages(Words(texts_of(part)))
            score = model.score(x, number)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= good_from).astype(np.int32)), pa.array(number.astype(np.int64))],
                names=["doc_id", "held_out", "score", "predicted", "passages"],
            )

    rows = docs.select("doc_id", (crc_fold("doc_id", folds) == 0).alias("held_out"), "text")
    return rows.mapInArrow(judge, f"doc_id {id_type}, held_out boolean, score double, predicted int, passages long")
