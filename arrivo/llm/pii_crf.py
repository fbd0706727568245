"""Personal data: pattern matches, and a skip-chain conditional random field that adds what they miss.

Base spans come from the patterns below, leftmost and non-overlapping per kind; matches that fail their test are
dropped without another try. The random field runs over the words that hold a digit or an at sign; all other words
have the label `none` by constraint, so that the field falls apart at them and inference stays exact there. Its nodes
have potentials over features of the word and its surroundings; neighbouring nodes share transition potentials; and
each node shares skip potentials with the next node of the document that repeats its characters (`same`) or its shape
(`alike`), however far away. Loopy message passing makes the labels of a document consistent.

Weights are learned by pseudo-likelihood from base spans of a bounded sample (`SAMPLE` documents with a node, `MOST_NODES`
nodes), some features hidden at random so that the field learns to trust its neighbours. Words outside base spans that would
pass the test of a kind by themselves, such as two cards with a space between, which the pattern takes for one, count as
unknown in training and not as `none`. A span is added where the belief is at least `SURE`, no base span is touched, and
either its text passes the whole test of its kind (for a single word `LIKELY` is enough then), or it can be of its kind and is backed by a base span: a word with the
characters or the shape of one inside the base span is backed, and so is one with those of a sure word of that kind that
is backed itself, at any distance.

Defined results: a null text is empty and has no spans; repeated rows are searched each; an empty table gives an empty
result; further columns are not looked at. The counts n_email to n_phone are those of base spans; n_added has the rest.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from arrivo.llm.sampling import first_places
from arrivo.llm.words import pieces, texts_of

KINDS = ("email", "ip", "card", "phone")
NONE = 0  # label of words outside spans; kind i has label i + 1
LABELS = len(KINDS) + 1
SAMPLE = 2000
MOST_NODES = 400_000  # of the sample, in the order of its hashes
SLOTS = 4096
ROUNDS = 12
SURE = 0.9
LIKELY = 0.1  # enough for the kind whose whole test a word passes
NODES_AT_ONCE, EDGES_AT_ONCE = 20_000, 100_000  # bounds of memory; a text is never cut
WHITE = " \t\n\x0b\x0c\r"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
NUMBERS = re.compile(r"[0-9][0-9.]*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
END_OF_WORD = re.compile(r"[\x20\x09-\x0D]")
DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind, start, end


# --- base spans ---


def passes(kind: int, value: str) -> bool:
    """Whether a whole text is what the base pattern of the kind and its test ask for."""
    if kind == 0:
        return "@" in value and list(emails(value)) == [(0, len(value))]
    if kind == 1:
        return value.count(".") == 3 and list(addresses(value)) == [(0, len(value))]
    pattern, least, most = ((CARD, 16, 19), (PHONE, 8, 15))[kind - 2]
    digits = "".join(DIGITS.findall(value))
    return least <= len(digits) <= most and pattern.fullmatch(value) is not None and (kind == 3 or luhn(digits))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """What the pattern finds, in one step per at sign: the local part reaches back to the last match at most."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and LOCAL_END.match(text, start - 1):
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of digits and dots, four numbers at a time; a gap between dots starts anew."""
    for run in NUMBERS.finditer(text):
        if run.group().count(".") < 3:
            continue
        at, numbers = run.start(), []
        for number in run.group().split("."):
            numbers = [*numbers, (at, at + len(number))] if number else []
            at += len(number) + 1
            if len(numbers) == 4:
                if all(int(text[a:b][-4:]) <= 255 and not text[a:b][:-4].strip("0") for a, b in numbers):
                    yield numbers[0][0], numbers[3][1]
                numbers = []


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if "@" in text:
        found += [(0, a, b) for a, b in emails(text)]
    if DIGITS.search(text):
        found += [(1, a, b) for a, b in addresses(text)]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
        if "+" in text:
            found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(DIGITS.findall(m.group())) <= 15]
    return found


# --- nodes ---


def nodes_of(text: str) -> list[tuple[int, int]]:
    """Words that hold a digit or an at sign."""
    out, end = [], 0
    for m in MARK.finditer(text):
        if m.start() < end:
            continue
        start = max(end, *(text.rfind(c, end, m.start()) + 1 for c in WHITE))
        stop = END_OF_WORD.search(text, m.start())
        end = stop.start() if stop else len(text)
        out.append((start, end))
    return out


def shape(word: str) -> str:
    """Digits as 9, letters as a; runs longer than four are cut to five."""
    kinds = "".join("9" if c in "0123456789" else "a" if c.isalpha() else c for c in word)
    return re.sub(r"(.)\1{4,}", r"\1\1\1\1\1", kinds)


def _bare(word: str) -> str:
    """The word without the marks around it."""
    start, end = 0, len(word)
    while start < end and not (word[start].isalnum() or word[start] in "+("):
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


def features(word: str, before: str, after: str, joined_left: bool, joined_right: bool) -> list[int]:
    bare = _bare(word)
    digits = len(DIGITS.findall(bare))
    names = [
        f"s{shape(bare)}", f"d{min(digits, 20)}", f"n{min(len(bare), 24)}", f".{min(bare.count('.'), 4)}", f"@{'@' in bare}",
        f"h{bare[:1] if not bare[:1].isalnum() else ''}", f"a{any(c.isalpha() for c in bare)}", f"l{joined_left}{joined_right}",
        f"b{shape(before)}" if joined_left else "b", f"f{shape(after)}" if joined_right else "f",
    ]
    return [zlib.crc32(n.encode()) % SLOTS for n in names]


@dataclass
class Graph:
    """The nodes of many documents with their edges; `owner` tells the document."""

    owner: list[int] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    slots: list[list[int]] = field(default_factory=list)
    base: list[int] = field(default_factory=list)
    unknown: list[bool] = field(default_factory=list)  # outside base spans, yet of a kind by itself
    chain: list[tuple[int, int]] = field(default_factory=list)
    same: list[tuple[int, int]] = field(default_factory=list)
    alike: list[tuple[int, int]] = field(default_factory=list)
    groups: list[tuple[int, int]] = field(default_factory=list)  # first node with the same characters, with the same shape

    def add(self, number: int, text: str, base: list[Span]) -> None:
        places = nodes_of(text)
        words = [text[a:b] for a, b in places]
        first, last_same, last_alike = len(self.owner), {}, {}
        first_same, first_alike = {}, {}
        touch = lambda i: i + 1 < len(places) and not text[places[i][1] : places[i + 1][0]].strip(WHITE)
        spans = sorted((a, b, kind) for kind, a, b in base)
        at = 0
        for i, (start, end) in enumerate(places):
            left, right = i > 0 and touch(i - 1), touch(i)
            self.owner.append(number)
            self.spans.append((start, end))
            self.slots.append(features(words[i], words[i - 1] if left else "", words[i + 1] if right else "", left, right))
            while at < len(spans) and spans[at][1] <= start:
                at += 1
            label, k = NONE, at
            while label == NONE and k < len(spans) and spans[k][0] < end:
                label, k = (spans[k][2] + 1 if spans[k][1] > start else NONE), k + 1
            me, bare = first + i, _bare(words[i])
            self.base.append(label)
            self.unknown.append(label == NONE and any(passes(kind, bare) for kind in range(len(KINDS))))
            if left:
                self.chain.append((me - 1, me))
            key, form = "".join(c for c in bare.lower() if c.isalnum()), shape(bare)
            if key in last_same:
                self.same.append((last_same[key], me))
            if form in last_alike and last_alike[form] != last_same.get(key):
                self.alike.append((last_alike[form], me))
            last_same[key] = last_alike[form] = me
            self.groups.append((first_same.setdefault(key, me), first_alike.setdefault(form, me)))

    def edges(self) -> list[np.ndarray]:
        return [np.array(e, np.int64).reshape(-1, 2) for e in (self.chain, self.same, self.alike)]


# --- the field ---


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top + np.log(np.exp(x - top).sum(axis, keepdims=True)), axis)


@dataclass
class Field:
    """`unary` by feature slot and label; `pair` by edge kind (chain, same, alike), label and label."""

    unary: np.ndarray
    pair: np.ndarray

    def beliefs(self, graph: Graph, rounds: int = ROUNDS) -> np.ndarray:
        """Label probabilities of all nodes after loopy sum-product message passing.

        Both directions of all edges are updated at once; messages are damped by one half.
        """
        own = self.unary[np.array(graph.slots)].sum(1)
        source, target, potential = [], [], []
        for kind, e in enumerate(graph.edges()):
            source += [e[:, 0], e[:, 1]]
            target += [e[:, 1], e[:, 0]]
            potential += [np.full(len(e), 2 * kind), np.full(len(e), 2 * kind + 1)]
        source, target, potential = np.concatenate(source), np.concatenate(target), np.concatenate(potential)
        turn = np.concatenate([np.arange(len(e)) for e in graph.edges() for _ in (0, 1)]) if len(source) else np.zeros(0, int)
        # the message that runs the other way along the same edge
        start = np.concatenate([[0], np.cumsum([len(e) for e in graph.edges() for _ in (0, 1)])])
        reverse = turn + start[potential ^ 1] if len(source) else turn
        table = np.stack([self.pair[k] if d == 0 else self.pair[k].T for k in range(3) for d in (0, 1)])
        messages = np.zeros((len(source), LABELS))
        for _ in range(rounds if len(source) else 0):
            total = own.copy()
            np.add.at(total, target, messages)
            fresh = np.empty_like(messages)
            for at in range(0, len(source), EDGES_AT_ONCE):
                cut = slice(at, at + EDGES_AT_ONCE)
                out = _log_sum((total[source[cut]] - messages[reverse[cut]])[:, :, None] + table[potential[cut]], 1)
                fresh[cut] = 0.5 * messages[cut] + 0.5 * (out - _log_sum(out, 1)[:, None])
            messages = fresh
        total = own.copy()
        np.add.at(total, target, messages)
        return np.exp(total - _log_sum(total, 1)[:, None])


def train(graph: Graph, steps: int = 150, rate: float = 0.05, decay: float = 1e-3, hidden: float = 0.4) -> Field:
    """Pseudo-likelihood: each label given its features and the labels of its neighbours, by Adam."""
    model = Field(np.zeros((SLOTS, LABELS)), np.zeros((3, LABELS, LABELS)))
    if not graph.owner:
        return model
    rng = np.random.default_rng(5)
    y, slots, edges = np.array(graph.base), np.array(graph.slots), graph.edges()
    truth, told = np.eye(LABELS)[y], ~np.array(graph.unknown, bool)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (model.unary, model.pair)]
    for step in range(1, steps + 1):
        shown = (rng.random(slots.shape) >= hidden) & (rng.random((len(slots), 1)) >= hidden / 2)
        logit = (model.unary[slots] * shown[:, :, None]).sum(1)
        for kind, e in enumerate(edges):
            np.add.at(logit, e[:, 1], model.pair[kind][y[e[:, 0]]])
            np.add.at(logit, e[:, 0], model.pair[kind].T[y[e[:, 1]]])
        error = (np.exp(logit - _log_sum(logit, 1)[:, None]) - truth) * told[:, None] / len(y)
        unary, pair = decay * model.unary / len(y) ** 0.5, decay * model.pair
        np.add.at(unary, slots[shown], np.repeat(error, shown.sum(1), axis=0))
        for kind, e in enumerate(edges):
            np.add.at(pair[kind], y[e[:, 0]], error[e[:, 1]])
            np.add.at(pair[kind].T, y[e[:, 1]], error[e[:, 0]])
        for p, g, (m, v) in zip((model.unary, model.pair), (unary, pair), moments):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Learn from the documents with a node that have the smallest hashes; their nodes, not their texts, reach the driver."""
    spec = "place long, text_hash long, start long, stop long, slots array<int>, base int, unknown boolean, chain int, same int, alike int"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            rows = []
            for place, digest, text in zip(part.column("place").to_pylist(), part.column("text_hash").to_pylist(), texts_of(part).to_pylist()):
                graph = Graph()
                graph.add(0, text, base_spans(text))
                back = [{b: a for a, b in e} for e in (graph.chain, graph.same, graph.alike)]
                for i, (span, slots, base, unknown) in enumerate(zip(graph.spans, graph.slots, graph.base, graph.unknown)):
                    rows.append((place, digest, *span, slots, base, unknown, *(i - e[i] if i in e else 0 for e in back)))
            names = ["place", "text_hash", "start", "stop", "slots", "base", "unknown", "chain", "same", "alike"]
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.int32(), pa.bool_()] + [pa.int32()] * 3
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    holding = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    hashed = holding.select(F.xxhash64("doc_id").alias("place"), F.xxhash64("text").alias("text_hash"), "text")
    picked = first_places(hashed, sample, holding.count(), "place", "text_hash")
    described = picked.repartition(8).mapInArrow(describe, spec)
    rows = described.orderBy("place", "text_hash", "start", "stop").limit(MOST_NODES).collect()
    graph = Graph()
    for i, r in enumerate(rows):
        graph.owner.append(0)
        graph.slots.append(r.slots)
        graph.base.append(r.base)
        graph.unknown.append(r.unknown)
        for edges, back in ((graph.chain, r.chain), (graph.same, r.same), (graph.alike, r.alike)):
            if back:
                edges.append((i - back, i))
    return train(graph)


# --- spans of documents ---


def _valid(kind: int, value: str) -> bool:
    """Whether a text that the field labelled can be of that kind."""
    numbers = re.findall("[0-9]+", value)
    digits = "".join(numbers)
    if kind == 0:
        return re.fullmatch(r"[^@\s]+@[^@\s]+", value) is not None
    if kind == 1:
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers) and not re.search(r"[^0-9.\[\]()]", value)
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[^0-9 -]", value)
    return 8 <= len(digits) <= 15 and not re.search(r"[^0-9 +().-]", value)


def backed_nodes(graph: Graph, kind: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Nodes whose kind reaches them from a base span, from group to group of equal characters or shape.

    `kind` is the label of nodes that can pass it on, else `NONE`. A node joins its two groups for its kind, so that one
    pass over the nodes finds what any number of steps along the skip edges would.
    """
    parent: dict[tuple, tuple] = {}

    def root(x: tuple) -> tuple:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    members = [(i, int(kind[i])) for i in np.flatnonzero(kind != NONE).tolist()]
    for i, k in members:
        same, alike = graph.groups[i]
        parent[root((k, "same", same))] = root((k, "alike", alike))
    held = {root((k, "same", graph.groups[i][0])) for i, k in members if base[i] == k}
    backed = np.zeros(len(kind), bool)
    backed[[i for i, k in members if root((k, "same", graph.groups[i][0])) in held]] = True
    return backed


def added_spans(graph: Graph, texts: dict[int, str], belief: np.ndarray) -> dict[int, list[Span]]:
    """By document: runs of joined nodes with one sure label outside base spans that pass the test of their kind, or that are
    backed by a base span elsewhere."""
    out: dict[int, list[Span]] = {}
    label, base = belief.argmax(1), np.array(graph.base)
    free = (label != NONE) & (base == NONE)
    sure = (belief.max(1) >= SURE) & free
    for i in np.flatnonzero(np.array(graph.unknown, bool) & ~sure).tolist():
        start, end = graph.spans[i]
        bare = _bare(texts[graph.owner[i]][start:end])
        for kind in range(len(KINDS)):
            if belief[i, kind + 1] >= LIKELY and passes(kind, bare):
                label[i], sure[i] = kind + 1, True
    if not sure.any():
        return out
    backed = backed_nodes(graph, np.where(sure, label, base), base)
    joined = {b for _, b in graph.chain}
    at = 0
    while at < len(label):
        stop = at + 1
        if sure[at]:
            while stop < len(label) and stop in joined and sure[stop] and label[stop] == label[at]:
                stop += 1
            kind, text = int(label[at]) - 1, texts[graph.owner[at]]
            for first, last in [(at, stop - 1)] if stop - at == 1 else [(at, stop - 1), *((i, i) for i in range(at, stop))]:
                start, value = graph.spans[first][0], text[graph.spans[first][0] : graph.spans[last][1]]
                bare = _bare(value)
                if bare and (passes(kind, bare) or backed[first : last + 1].any() and _valid(kind, bare)):
                    begin = start + value.index(bare)
                    out.setdefault(graph.owner[at], []).append((kind, begin, begin + len(bare)))
                    if first != last or stop - at == 1:
                        break
        at = stop
    return out


def find(texts: pa.Array, model: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text, ordered by kind and start."""
    out: list[tuple[list[Span], list[Span]]] = [([], []) for _ in range(len(texts))]
    rows = np.flatnonzero(pc.match_substring_regex(texts, "[0-9@]").to_numpy(zero_copy_only=False))
    if not len(rows):
        return out
    def infer() -> None:
        for row, spans in added_spans(graph, held, model.beliefs(graph)).items():
            clear = [s for s in spans if not any(a < s[2] and b > s[1] for _, a, b in out[row][0])]
            out[row] = (out[row][0], sorted(set(clear)))

    graph, held = Graph(), {}
    for row, text in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist()):
        base = sorted(base_spans(text))
        out[row] = (base, [])
        held[row] = text
        graph.add(row, text, base)
        if len(graph.owner) >= NODES_AT_ONCE:  # documents share no edge, so they can be inferred in any grouping
            infer()
            graph, held = Graph(), {}
    if graph.owner:
        infer()
    return out


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_spans(docs: DataFrame, model: Field) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            found = find(texts_of(part), model)
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found]
            listed = [_listed(sorted(base + more)) for base, more in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *counts, pa.array(digest, pa.string()), pa.array(listed, pa.string()), pa.array([len(more) for _, more in found], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    spec = f"doc_id {id_type}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return docs.select("doc_id", "text").mapInArrow(search, spec)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named after the first."""
    out, done = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= done:
            out.append(f"{text[done:start]}[{KINDS[kind]}]")
        done = max(done, end)
    return "".join(out) + text[done:]


def mask(docs: DataFrame, model: Field) -> DataFrame:
    """The same rows and columns with personal data masked in `text`; a null text stays null."""
    schema = docs.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            texts = part.column("text")
            found = find(texts_of(part), model)
            hit = [bool(base or more) for base, more in found]
            changed = iter([masked(t, base + more) for t, (base, more) in zip(texts.filter(pa.array(hit)).to_pylist(), (f for f, h in zip(found, hit) if h))])
            new = pc.replace_with_mask(texts, pa.array(hit), pa.array(list(changed), texts.type))
            yield part.set_column(part.schema.get_field_index("text"), "text", new)

    return docs.mapInArrow(replace, schema)
