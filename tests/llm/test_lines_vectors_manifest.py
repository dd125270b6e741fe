"""Whitening (11), line dedup (12) and the Merkle manifest (13) against
brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logflow.llm import line_dedup, merkle, whitening

# ---- whitening ---------------------------------------------------------------


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, x string, component string").repartition(3)


def check_whitening(rows, got, k=16):
    """``got`` against numpy's eigenvectors, up to signs."""
    ids = [r[0] for r in rows]
    x = np.floor(np.asarray([r[1] for r in rows], dtype=np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    c = u - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    rank = int((e > 1e-12 * np.trace(v)).sum())
    k = min(k, rank)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    want = (x - s / n) @ q / np.sqrt(e)
    assert len(got) == len(rows) * k and {r.n for r in got} <= {n}
    found = {(r.vec_id, r.component): r for r in got}
    mine = np.asarray([[found[i, j + 1].whitened for j in range(k)] for i in ids])
    sign = np.sign((mine * want).sum(axis=0))
    assert np.allclose(mine * sign, want, atol=1e-7)
    dev = ((n * x - s) ** 2).sum(axis=1)
    assert all(found[i, 1].deviation == d for i, d in zip(ids, dev))
    assert np.allclose([found[ids[0], j + 1].explained for j in range(k)], e / np.trace(v), rtol=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 24)) @ np.diag(np.linspace(3, 0.2, 24)) + rng.normal(size=24) * 5
    rows = [(i, [float(c) for c in np.float32(b)], None, None, None) for i, b in enumerate(base)]
    rows += [(1000 + i, rows[7][1], "a", None, None) for i in range(150)]  # a third of all rows is one vector
    check_whitening(rows, whitening.whiten(vectors_of(spark, rows)).collect())
    check_whitening(rows, whitening.whiten(vectors_of(spark, rows), components=3).collect(), 3)


def test_whitening_of_low_rank(spark):
    rng = np.random.default_rng(4)
    base = np.round(rng.normal(size=(200, 3)) * 8) @ np.round(rng.normal(size=(3, 10)) * 4)
    rows = [(i, [float(c) for c in b], None, None, None) for i, b in enumerate(base)]
    got = whitening.whiten(vectors_of(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    check_whitening(rows, got)


def test_whitening_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (3, [4.0, 2.0]), (3, [4.0, 2.0]), (None, [1.0, 0.0])]
    bad = [(4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, inf]), (8, []), (9, [1.0]), (10, [1e30, 0.0])]
    rows = [(*r, "s", None, "c") for r in good + bad]
    got = whitening.whiten(vectors_of(spark, rows)).collect()
    assert Counter(r.vec_id for r in got) == {1: 2, 2: 2, 3: 4, None: 2} and {r.n for r in got} == {4}
    assert whitening.whiten(vectors_of(spark, [(*r, None, None, None) for r in bad[:5]])).collect() == []
    assert whitening.whiten(vectors_of(spark, [])).collect() == []
    same = [(i, [1.0, 2.0], None, None, None) for i in range(4)]
    assert whitening.whiten(vectors_of(spark, same)).collect() == []  # nothing varies: no component


def test_whitening_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(size=8)], None, None, None) for i in range(200)]
    df = vectors_of(spark, rows)
    one, many = (sorted(map(tuple, whitening.whiten(df.repartition(p)).drop("identity_error").collect())) for p in (1, 9))
    assert one == many


def test_large_deviations_are_exact():
    w = whitening.Whitening(3, [3 << 40, 1], 1.0, np.ones(1), np.ones((2, 1)))
    x = np.asarray([[1 << 40, 0], [(1 << 40) + (1 << 29), 5], [1 << 45, 0]])
    want = [sum((3 * a - s) ** 2 for a, s in zip(row, w.sums)) for row in x.tolist()]
    assert w.deviation(x) == [v if v < 1 << 63 else None for v in want]


@pytest.mark.parametrize("d", [1, 2, 7, 16])
def test_cholesky_and_jacobi(d):
    rng = np.random.default_rng(d)
    m = rng.normal(size=(d, max(1, d - 2)))
    v = m @ m.T
    factor, p = whitening.pivoted_cholesky(v)
    assert np.allclose((factor @ factor.T), v[p][:, p]) and np.allclose(factor, np.tril(factor))
    turned = whitening.one_sided_jacobi(factor)
    gram = turned.T @ turned
    assert np.allclose(gram, np.diag(np.diag(gram)))
    assert np.allclose(np.sort(np.diag(gram)), np.sort(np.linalg.eigvalsh(v))[-len(gram):])


# ---- line dedup --------------------------------------------------------------


def lines_by_brute_force(rows, min_chars=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, text, *_ in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(i)
    out = Counter()
    for i, text, *_ in rows:
        if i is None:
            continue
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def rows_of_lines(seed, docs=300):
    rng = random.Random(seed)
    pool = [f"line number {k} of the pool É" for k in range(60)] + ["tiny", "", "\t", "  Mixed CASE line here", "mixed case LINE here\x0b"]
    return [(rng.randrange(10 * docs), "\n".join(
        rng.choice(pool) if rng.random() < 0.4 else f"own words {rng.random()}" for _ in range(rng.randint(0, 30))))
        for _ in range(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_against_brute_force(make_docs, odd_rows, seed, monkeypatch):
    monkeypatch.setattr(line_dedup, "SEGMENT_KEYS", 500)  # several segments
    rows = rows_of_lines(seed)
    rows += [(50_000 + k, "A line that a third of all documents hold\nend") for k in range(150)]
    rows += [r[:2] for r in odd_rows] + [(rows[0][0], "another text of the same document\n" + rows[1][1])]
    got = line_dedup.dedup_lines(make_docs(rows))
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == lines_by_brute_force(rows)
    got = line_dedup.dedup_lines(make_docs(rows), min_chars=30)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == lines_by_brute_force(rows, 30)


def test_line_dedup_of_an_empty_table(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).collect() == []
    assert [tuple(r) for r in line_dedup.dedup_lines(make_docs([(1, None), (None, "x")])).collect()] == [(1, "", 1, 0)]


def test_bloom_filters_miss_no_repeat():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64)
    h = np.concatenate([h, h[:3000]])
    rng.shuffle(h)
    several = rng.random(len(h)) < 0.01
    marked = line_dedup.suspected(h, several, chunk=1000)
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    repeated = count[back] > 1
    assert marked[repeated].all() and marked[several].all()
    assert marked[~repeated & ~several].mean() < 0.01  # few others are suspected


# ---- Merkle manifest -----------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k:k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def manifest_by_brute_force(rows):
    """rows: doc_id, source, lang, n_chars, text"""
    def leaf(r, lowered=False):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if lowered and r[4] is not None else r[4]
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*r[:4], text)))

    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        ordered = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = ordered, tree_levels([leaf(r) for r in ordered])
    top = tree_levels([trees[s][1][-1][0] for s in order])
    out = Counter()
    for rank, s in enumerate(order):
        ordered, tree = trees[s]
        for idx, r in enumerate(ordered):
            siblings, digest = [], leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
            for levels, at in ((tree, idx), (top, rank)):
                for nodes in levels[:-1]:
                    run = at // 16 * 16
                    left, right = nodes[run:at], nodes[at + 1:run + 16]
                    siblings += left + right
                    digest = sha(*left, digest, *right)
                    at //= 16
            out[r[0], leaf(r), tree[-1][0], top[-1][0], sha(*siblings), digest, digest == top[-1][0]] += 1
    return out


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, root string, proof int, tree string"


def manifest_docs(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, None) for r in rows], MANIFEST).repartition(4)


def manifest_cases():
    odd = [(1, None, "en", 3, "ABC"), (2, "", "en", 3, "ABC"), (3, "é", None, None, ""), (3, "é", None, None, ""),
           (3, "é", "en", 3, "ABd"), (None, "é", "en", 3, "ABd"), (4, "=", "x", 1, None), (-5, "/", "x", 1, "Z" * 50_000)]
    many = [(7 * k, f"s{k % 23}" if k % 3 else "hot", "en", k, f"Text {k} É") for k in range(2500)]
    few = [(k, "only", "en", k, "T") for k in range(17)]
    lone = [(k, f"host{k}", "en", k, "T") for k in range(300)]
    return {"odd": odd, "many": many, "one source": few, "lone leaves": lone, "one row": odd[:1], "empty": []}


@pytest.mark.parametrize("case", list(manifest_cases()))
def test_manifest_against_brute_force(spark, case):
    rows = manifest_cases()[case]
    got = merkle.verified(manifest_docs(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == manifest_by_brute_force(rows)


def test_manifest_sql(spark):
    rows = [r for name, case in manifest_cases().items() if name in ("odd", "many") for r in case]
    rows = [r for r in rows if r[0] is not None]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, source varchar, lang varchar, n_chars bigint, text varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    assert Counter(con.execute(merkle.ORACLE).fetchall()) == manifest_by_brute_force(rows)


def test_any_changed_field_breaks_the_proof(spark):
    rows = manifest_cases()["many"][:400]
    changed = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    got = merkle.manifest(manifest_docs(spark, rows), {"changed": changed})
    row = got.select(F.count_if(merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("good"),
                     F.count_if(merkle.fold(F.col("changed"), F.col("proof")) == F.col("root")).alias("bad")).first()
    assert (row.good, row.bad) == (400, 0)
