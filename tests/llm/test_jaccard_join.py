import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import awkward_rows

from arrivo.llm import partenum
from arrivo.llm.components import components


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, threshold):
    """(doc_id, set size, smallest id of its component) by comparing all pairs that share a shingle."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g])
        for j, n in common.items():
            if 100 * n >= threshold * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = [v for v in (least.get(find(i)), doc_id) if v is not None]
        least[find(i)] = min(known) if known else None
    return sorted(((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def joined(docs, width=4, threshold=85):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in partenum.Join(docs, width, threshold).documents().collect()), key=str)


def edited(rng, words, share):
    return " ".join(f"x{rng.random()}" if rng.random() < share else w for w in words)


def family(seed, size=25, families=8):
    """Near copies around the threshold, a shared passage, short texts."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(60)]
    for f in range(families):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([5, 12, 40, 120, 400]))]
        if f % 2:
            words = words[: len(words) // 2] + passage + words[len(words) // 2 :]
        rows += [edited(rng, words, rng.choice([0, 0.005, 0.01, 0.02, 0.04])) for _ in range(size)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_signatures_lose_no_similar_pair():
    """Any two sets at or above the threshold share a signature, whatever they hold."""
    rng = np.random.default_rng(0)
    for threshold in (50, 80, 85, 95, 100):
        for _ in range(150):
            size = int(rng.choice([1, 2, 3, 7, 20, 100, 300, 900]))
            universe = np.unique(rng.integers(0, 1 << 63, 2 * size + 2, dtype=np.uint64))
            left = universe[:size]
            worst = (100 - threshold) * size // 100
            drop = rng.integers(0, worst + 1)
            add = rng.integers(0, worst - drop + 1) if worst > drop else 0
            right = np.sort(np.concatenate([left[drop:], universe[size : size + add]]))
            common = len(np.intersect1d(left, right))
            if 100 * common < threshold * (len(left) + len(right) - common):
                continue
            sig, owner = partenum.signatures(np.concatenate([np.sort(left), right]), np.array([0, len(left), len(left) + len(right)]), threshold)
            assert set(sig[owner == 0].tolist()) & set(sig[owner == 1].tolist()), (threshold, size, drop, add)


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for size in (3, 500, 9000):
        left = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for drop in (0, 1, 2, size // 10, size - 1):
            right = left[drop:]
            x, y = partenum.sketches(np.concatenate([left, right]), np.array([0, len(left), len(left) + len(right)]))
            assert partenum.least_difference(x, y) <= drop
            assert drop > 2 or partenum.least_difference(x, y) in (drop, drop - 2)
            brief = [partenum.folded(s, partenum.BRIEF_LONGS) for s in (x, y)]
            assert partenum.least_difference(*brief) <= partenum.least_difference(x, y)
        other = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        x, y = partenum.sketches(np.concatenate([left, other]), np.array([0, len(left), len(left) + len(other)]))
        assert partenum.least_difference(x, y) > size / 2  # tells unlike sets of any size apart


def test_sets_equal_plain_shingles():
    texts = [r[1] or "" for r in awkward_rows()] + ["a b c d a b c d a", "A b\tC\nd", "a", "a b c"]
    flat, starts = partenum.shingle_sets(pa.array(texts), 4)
    assert list(np.diff(starts)) == [len(shingles(t, 4)) for t in texts]
    assert all((np.diff(flat[a:b].astype(object)) > 0).all() for a, b in zip(starts[:-1], starts[1:]))


@pytest.mark.parametrize("width, threshold", [(4, 85), (5, 80)])
def test_equals_all_pairs(make, width, threshold):
    rows = family(width)
    assert joined(make(rows), width, threshold) == brute(rows, width, threshold)


def test_chain_of_links_is_one_component(make):
    """Neighbours are similar, the ends are not."""
    words = [f"w{i}" for i in range(140)]
    rows = [(100 - i, " ".join(words[3 * i : 3 * i + 100])) for i in range(13)]
    got = joined(make(rows))
    assert got == brute(rows, 4, 85) and {r[2] for r in got} == {88}


def test_awkward_rows(awkward, nothing):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert joined(awkward) == brute(rows, 4, 85)
    assert joined(nothing) == []


def test_one_of_each_group_stays(awkward, make):
    kept = partenum.one_of_each(awkward, 5, 80)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [*range(60), 100, 101, 102, 104, 105, 106, 107]
    assert ids.count(None) == 2
    rows = family(5)
    want = {r[2] for r in brute(rows, 5, 80)}
    assert {r.doc_id for r in partenum.one_of_each(make(rows), 5, 80).collect()} == want


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(50)] + [(rng.randint(100, 200), rng.randint(100, 200)) for _ in range(60)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_null_id_that_equals_another_row(make):
    """Equal sets of unlike texts, one without id: the class is still found, and the row with an id stands for it."""
    words = [f"w{i}" for i in range(120)]
    for spoiled in (str.upper, lambda t: t.replace(" ", "  "), lambda t: f"{t}\n"):
        rows = []
        for f in range(6):
            text = " ".join(f"{w}x{f}" for w in words)
            rows += [(10 * f + 7, text), (None, spoiled(text)), (10 * f + 3, f"{text} end{f}")]
        assert joined(make(rows)) == brute(rows, 4, 85)
        kept = partenum.one_of_each(make(rows), 5, 80).collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(((10 * f + 3, rows[3 * f + 2][1]) for f in range(6)), key=str)
    rows = [(7, "one two three four five six"), (None, "One two three four five six")]
    assert [(r.doc_id, r.text) for r in partenum.one_of_each(make(rows), 5, 80).collect()] == [rows[0]]


def _bucket_rows(rng, sizes):
    """Sorted rows of buckets dealt into parts, as the last step gets them, and the pairs it must find."""
    rows, number = [], 0
    for signature, size in enumerate(sizes):
        parts = -(-size // 8)
        for _ in range(size):
            home = rng.randrange(parts)
            bits = [rng.choice([0, 1 << 40, -1 << 62, 3]) for _ in range(partenum.BRIEF_LONGS)]
            n = rng.choice([90, 100, 40])
            rows += [(signature, p, p == home, number, n, bits, number // 3) for p in range(home + 1)]
            number += 1
    rows.sort(key=lambda r: (r[0], r[1], not r[2]))
    want = set()
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[3] < y[3] and x[6] != y[6] and 100 * min(x[4], y[4]) >= 80 * max(x[4], y[4]):
                odd = sum(((a ^ b) % (1 << 64)).bit_count() for a, b in zip(x[5], y[5]))
                if 180 * odd <= 20 * (x[4] + y[4]):
                    want.add((x[3], y[3], x[6], y[6]))
    return rows, want


@pytest.mark.parametrize("batch", [1, 7, 1000])
def test_every_pair_of_a_bucket_is_judged(batch):
    """Parts and batches of any size: no pair is lost, none comes from two buckets."""
    rng = random.Random(batch)
    rows, want = _bucket_rows(rng, [1, 2, 30, 5, 70, 1, 9, 60])
    names = ["signature", "part", "own", "class", "n", "brief", "root"]
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows[at : at + batch]), kinds)], names=names)
        for at in range(0, len(rows), batch)
    ]
    found = [tuple(r.values()) for b in partenum.compared(iter(batches), 80) for r in b.to_pylist()]
    assert len(want) > 50 and set(found) == want


def test_parts_of_buckets(make, monkeypatch):
    """The whole join with parts of two sets equals that with whole buckets."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.choice((1, 6, 12, 20))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = make(rows).repartition(3)
    whole = sorted(map(tuple, partenum.Join(docs).documents().select("doc_id", "n_shingles", "component_id").collect()))
    monkeypatch.setattr(partenum, "PART_ROWS", 2)
    assert sorted(map(tuple, partenum.Join(docs).documents().select("doc_id", "n_shingles", "component_id").collect())) == whole


def _one_bucket(sets, batch):
    """Rows of sets in one bucket, all its own, with the sketches that travel."""
    marks = partenum.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    rows = [(5, 0, True, i, len(s), partenum.travelling(m, len(s)).view(np.int64).tolist(), i) for i, (s, m) in enumerate(zip(sets, marks))]
    names = ["signature", "part", "own", "class", "n", "brief", "root"]
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    for at in range(0, len(rows), batch):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows[at : at + batch]), kinds)], names=names)


def _pairs(batches, **options):
    return {(r["a"], r["b"]) for b in partenum.compared(batches, 80, **options) for r in b.to_pylist()}


@pytest.mark.parametrize("batch", [1, 9, 1000])
def test_large_unlike_sets_stay_in_their_bucket(batch):
    """Of many sets of thousands of elements that share a bucket only the similar ones leave the task."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in rng.integers(100, 9000, 80)]
    sets += [s[len(s) // 12 :] for s in sets[:40]]  # sketches of two lengths among them
    assert _pairs(_one_bucket(sets, batch)) == {(i, 80 + i) for i in range(40)}


@pytest.mark.parametrize("batch", [1, 2, 1000])
def test_neighbours_are_next_to_each_other(batch):
    """Of many equal sets as many pairs come as there are rows, over the ends of batches as well."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))] * 7
    assert _pairs(_one_bucket(sets, batch), reach=1) == {(i, i + 1) for i in range(6)}
