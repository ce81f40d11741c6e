"""Families of one template: all links, without all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from timeline_engine.llm import families, parity_join


def shingles(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, n_shingles, component) with all texts of an id as one node."""
    sets = [(i, shingles(t or "")) for i, t in rows]
    least = {i: i for i, _ in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            common = len(x & y)
            if x and y and 100 * common >= 75 * (len(x) + len(y) - common) or i == j and x and y:
                a, b = sorted((root(i), root(j)))
                least[b] = a
    return sorted((i, len(x), root(i) if x else i) for i, x in sets)


def joined(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted(tuple(r) for r in parity_join.jaccard_components(docs).collect())


def template_texts(rng, n):
    """Texts of one template, some of them of a template within it."""
    core, out = [f"c{k}" for k in range(120)], []
    branch = [[f"b{x}w{k}" for k in range(rng.choice([4, 12, 20]))] for x in range(3)]
    for i in range(n):
        own = [f"o{i}x{k}" for k in range(rng.choice([0, 2, 6, 9, 12, 14, 20]))]
        text = core + (rng.choice(branch) if rng.random() < 0.6 else []) + own
        for _ in range(rng.choice([0, 0, 1, 2])):
            text[rng.randrange(len(text))] = f"r{rng.randrange(4)}"
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize(("seed", "small", "levels"), [(1, 32, 4), (2, 2, 3), (3, 4, 1)])
def test_families_equal_brute_force(spark, monkeypatch, seed, small, levels):
    monkeypatch.setattr(parity_join, "SMALL", small)
    monkeypatch.setattr(families, "SMALL", small)
    monkeypatch.setattr(families, "LEVELS", levels)
    monkeypatch.setattr(families, "PAIRS", 1_000 if small == 32 else 0)  # without room for pairs, all levels are used
    monkeypatch.setattr(families, "SMALLER", 1.0)
    rng = random.Random(seed)
    rows = template_texts(rng, 90) + [(200 + k, " ".join(f"z{k}y{j}" for j in range(40))) for k in range(5)]
    assert joined(spark, rows) == brute(rows)


def test_unlinked_family_verifies_few_pairs(spark, monkeypatch):
    """400 texts of one template, all just below the threshold."""
    core = [f"c{k}" for k in range(300)]
    rows = [(i, " ".join(core + [f"w{i}x{k}" for k in range(50)])) for i in range(400)]
    seen, plain = [], parity_join._linked
    monkeypatch.setattr(parity_join, "_linked", lambda pairs, docs: seen.append(pairs.count()) or plain(pairs, docs))
    got = joined(spark, rows)
    assert [r[2] for r in got] == list(range(400))
    assert sum(seen) < 4_000


def test_texts_of_one_id_are_one_node(spark):
    x, y, z = (" ".join(f"{name}{k}" for k in range(30)) for name in "xyz")
    rows = [(0, x), (1, x), (1, y), (5, y), (6, z), (7, z), (6, ""), (8, None)]
    assert joined(spark, rows) == brute(rows)
    assert {r[2] for r in joined(spark, rows) if r[0] in (0, 1, 5)} == {0}


def test_a_difference_from_any_template_decides():
    rng = np.random.default_rng(4)
    for _ in range(300):
        t = set(rng.choice(60, rng.integers(0, 40), replace=False).tolist())
        x, y = (set(rng.choice(60, rng.integers(1, 50), replace=False).tolist()) for _ in range(2))
        common = len(x & y)
        linked = 100 * common >= 75 * (len(x) + len(y) - common)
        p, q = x ^ t, y ^ t
        s = 7 * len(p) - len(x), 7 * len(q) - len(y)
        assert linked == (14 * len(p & q) >= sum(s)) == (7 * len(p ^ q) <= len(x) + len(y))
        if linked and sum(s) > 0:
            assert len(p & q) >= families.needed(max(s), min(s))


def plain_shared(sets, rows, columns):
    return [[len(set(sets[i].tolist()) & set(sets[j].tolist())) for j in columns] for i in rows]


@pytest.mark.parametrize("matrix", [4_000_000, 40])
def test_shared_counts(monkeypatch, matrix):
    monkeypatch.setattr(families, "MATRIX", matrix)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, k).astype(np.uint64)) for k in (0, 1, 5, 30, 30, 12)]
    rows, columns = np.array([0, 2, 3]), np.array([1, 4, 5])  # never a set with itself
    assert families.shared(sets, rows, columns).tolist() == plain_shared(sets, rows, columns)
    assert families.shared(sets[:1] * 2, np.arange(1), np.arange(1, 2)).tolist() == [[0]]


@pytest.mark.parametrize("alone", [True, False])
def test_lists_are_compared_in_blocks(monkeypatch, alone):
    """Whatever blocks a list is cut into, the components of its links are the same."""
    monkeypatch.setattr(families, "BLOCK", 4)
    rng = np.random.default_rng(7)
    node = np.arange(11, dtype=np.int64) * 3
    e = {int(n): np.unique(rng.integers(0, 14, 8).astype(np.uint64)) for n in node}
    s = {int(n): 7 * len(e[int(n)]) - 20 for n in node}
    a, b = (node, node[:0]) if alone else (node[:5], node[5:])
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([a.tobytes()]), pa.array([b.tobytes()])], names=["run", "a", "b"])
    dealt = sorted(pa.Table.from_batches(families._dealt([batch])).to_pylist(), key=lambda r: (r["run"], r["i"], r["j"]))
    rows = [{**{k: r[k] for k in ("run", "i", "j", "node")}, "component": r["node"] % 4, "second": r["second"], "s": s[r["node"]], "e": e[r["node"]].tobytes()} for r in dealt]
    kinds = [("run", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("node", pa.int64()), ("component", pa.int64()), ("second", pa.bool_()), ("s", pa.int64()), ("e", pa.binary())]
    table = pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
    found = [(int(x), int(y)) for out in families._compared([table.slice(0, 9), table.slice(9)]) for x, y in zip(*(out.column(k).to_pylist() for k in range(2)), strict=True)]
    pairs = [(int(x), int(y)) for k, x in enumerate(node) for y in (node[k + 1 :] if alone else b) if alone or x in a]
    want = [(x, y) for x, y in pairs if x % 4 != y % 4 and 14 * len(np.intersect1d(e[x], e[y])) >= s[x] + s[y]]
    assert want and classes(found) == classes(want)


def classes(links):
    least = {}

    def root(x):
        least.setdefault(x, x)
        while least[x] != x:
            x = least[x]
        return x

    for x, y in links:
        x, y = sorted((root(x), root(y)))
        least[y] = x
    return {x: root(x) for x in list(least)}
