"""N-gram join (2) and substring dedup (5) against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from logflow.llm import ngram_join, substring_dedup


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, k = [], 100
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            if rng.random() < 0.3:
                words = words[:5] + rng.choices(vocab, k=3) + words[5:]
            rows.append((k, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
            k += 1
    return rows


def shingles(text, k=3):
    table = {k: k + 32 for k in range(65, 91)}
    words = (text or "").translate(table).encode().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < k else {tuple(words[at:at + k]) for at in range(len(words) - k + 1)}


def brute_components(rows, percent=90, k=3):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(i, len(s), find(i)) for i, s in sets.items()}


def test_join_equals_brute_force(make_docs, odd_rows):
    rows = corpus() + odd_rows
    got = ngram_join.jaccard_components(make_docs(rows), block_rows=7, part_shingles=32).collect()
    assert len(got) == len({r[0] for r in rows if r[0] is not None})
    assert {tuple(r) for r in got} == brute_components(rows)


def test_join_of_five_words_equals_brute_force(make_docs, odd_rows):
    rows = corpus(6) + odd_rows
    got = {tuple(r) for r in ngram_join.jaccard_components(make_docs(rows), k=5, percent=80, part_shingles=32).collect()}
    assert got == brute_components(rows, 80, 5)
    assert got != brute_components(rows, 90, 5)


@pytest.mark.parametrize("fanout", [4, 1024])
def test_join_of_differing_repeats(make_docs, fanout):
    """Rows that repeat a doc_id: the largest set stands for it, and the
    shingles of its other texts exclude nothing."""
    a = [f"a{k}" for k in range(102)]
    near = a[:-1] + ["z"]
    rows = [(1, " ".join(a)), (1, " ".join(f"b{k}" for k in range(92))), (2, " ".join(near)), (2, " ".join(near)),
            (3, "x y z"), (3, " ".join(a)), (4, "x y z")]
    standing = [(1, rows[0][1]), (2, rows[2][1]), (3, rows[5][1]), (4, rows[6][1])]
    got = {tuple(r) for r in ngram_join.jaccard_components(make_docs(rows), block_rows=2, fanout=fanout).collect()}
    assert got == brute_components(standing)
    assert {(1, 100, 1), (2, 100, 1), (3, 100, 1), (4, 1, 4)} == got


def test_two_cuts_count_as_one():
    """Fragments cut in two steps give the same counts as the sets have."""
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(rng.choice(pool, rng.integers(0, 60))) for _ in range(200)]
    blocks = [ngram_join.pack_fragments(np.arange(k, k + 50), sets[k:k + 50], 5) for k in range(0, 200, 50)]
    rows = [ngram_join.recut(p, 7) for b in blocks for _, p in b.groupby("frag")]
    every = pd.concat(rows)
    assert every["frag"].max() < 35
    counted = pd.concat([ngram_join.count_own(p) for _, p in every.groupby("frag")])
    facts = pd.concat([ngram_join.sum_block(p) for _, p in counted.groupby("block")]).set_index("doc_id")
    held = Counter(x for s in sets for x in s.tolist())
    assert facts["n"].sort_index().tolist() == [len(s) for s in sets]
    assert facts["own"].sort_index().tolist() == [sum(held[x] == 1 for x in s.tolist()) for s in sets]


def test_join_on_a_chain_and_on_copies(make_docs):
    words = [f"c{k}" for k in range(200)]
    chain = []
    for step in range(8):  # neighbours link, the ends do not
        words = words[:step * 20] + [f"n{step}"] + words[step * 20 + 1:]
        chain.append((50 - step, " ".join(words)))
    rows = chain + [(k, "same text " * 30) for k in range(200, 260)]
    got = {tuple(r) for r in ngram_join.jaccard_components(make_docs(rows)).collect()}
    assert got == brute_components(rows)


def test_join_empty(make_docs):
    assert ngram_join.jaccard_components(make_docs([])).count() == 0
    assert ngram_join.keep_one_of_each(make_docs([])).count() == 0


def test_keep_one_keeps_columns_and_rows_without_id(make_docs):
    rows = corpus(9) + [(None, "x"), (None, "x"), (1, None)]
    docs = make_docs(rows)
    got = ngram_join.keep_one_of_each(docs)
    assert got.columns == docs.columns
    want = sorted(i for i, _, c in brute_components(rows) if i == c)
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == want
    assert got.where("doc_id is null").count() == 2


@pytest.mark.parametrize("percent", [90, 80])
@pytest.mark.parametrize("n", [9, 10, 40, 333])
def test_signatures_guarantee(n, percent):
    """Sets that link share a signature."""
    rng = np.random.default_rng(n)
    for _ in range(200):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        extra = int(rng.integers(0, n * (100 - percent) // percent + 1))
        drop = int(rng.integers(0, extra + 1))
        y = np.concatenate([x[drop:], rng.integers(0, 1 << 63, extra - drop, dtype=np.uint64)])
        x, y = np.unique(x), np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both >= percent * (len(x) + len(y) - both) and (len(x) != len(y) or (x != y).any()):
            assert len(np.intersect1d(ngram_join.signatures(x, percent), ngram_join.signatures(y, percent)))


def brute_dedup(rows, window=13):
    docs = {}
    for i, t in rows:
        if i is not None:
            docs.setdefault(i, []).append((t or "").encode().split())
    seen, out = set(), []
    for i in sorted(docs):
        own = set()
        for words in docs[i]:
            grams = [tuple(words[k:k + window]) for k in range(len(words) - window + 1)]
            gone = [False] * len(words)
            for k, g in enumerate(grams):
                if g in seen:
                    gone[k:k + window] = [True] * window
            kept = [w for w, x in zip(words, gone) if not x]
            out.append((i, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
            own.update(grams)
        seen |= own
    return sorted(out)


def test_dedup_equals_brute_force(make_docs, odd_rows):
    rng = random.Random(2)
    rows = corpus(3)
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(300 + k, f"x{k} y " + passage[: rng.randint(50, 200)] + f" z{k}\n" + passage) for k in range(20)]
    rows += [(400, "a a a a " * 20), (401, "a a a " * 9)] + odd_rows
    got = substring_dedup.dedup_substrings(make_docs(rows), shard_rows=10)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == brute_dedup(rows)


def test_cut_keeps_columns_and_untouched_texts(make_docs, odd_rows):
    rows = [(1, "k " * 3 + " ".join(map(str, range(40)))), (2, " ".join(map(str, range(40))) + "\n\nend  here"), (3, "\n a  b ")]
    docs = make_docs(rows + [(None, "keep  me")])
    got = {r.doc_id: r for r in substring_dedup.cut_substrings(docs).collect()}
    assert got[2].text == "end here" and got[2].n_chars == 8 and got[2].found == "y"
    assert got[1].text == rows[0][1] and got[3].text == "\n a  b " and got[None].text == "keep  me"
    assert substring_dedup.dedup_substrings(make_docs([])).count() == 0


def test_wavelet_matrix_rank():
    rng = np.random.default_rng(0)
    s = rng.integers(0, 37, 1000)
    w = substring_dedup.WaveletMatrix(s, 37)
    c, i = rng.integers(0, 37, 500), rng.integers(0, 1001, 500)
    assert w.rank(c, i).tolist() == [int((s[:b] == a).sum()) for a, b in zip(c, i)]


def test_matching_statistics():
    rng = np.random.default_rng(4)
    text = np.concatenate([[0], rng.integers(1, 4, 300), [0], rng.integers(1, 4, 200), [0]])
    index = substring_dedup.FMIndex(text, 4)
    length, lo, hi = substring_dedup.statistics(index, text, np.arange(1, 300), 13)
    s = "".join(map(str, text))
    for end, n, a, b in zip(range(1, 300), length.tolist(), lo.tolist(), hi.tolist()):
        own = s[end - n:end]
        assert (n == 13 or s[end - n - 1] == "0") and b - a == sum(s.startswith(own, k) for k in range(len(s)))


@pytest.mark.parametrize("n", [0, 1, 50, 2000])
def test_parity_bounds_the_difference(n):
    """Sketches differ in no more bits than the sets do in shingles."""
    rng = np.random.default_rng(n)
    for change in (0, 1, 7, 300):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[change:], rng.integers(0, 1 << 63, change, dtype=np.uint64)]))
        for longs in (ngram_join.SKETCH, ngram_join.WIDE):
            bits = np.unpackbits((ngram_join.parity(x, longs) ^ ngram_join.parity(y, longs)).view(np.uint8)).sum()
            assert bits <= len(np.setxor1d(x, y)) and (bits > 0 or change != 1)


def test_info_travels_once_a_block():
    sets = [ngram_join.shingle_set(f"a{k} b c{k % 7}") for k in range(1600)] + [ngram_join.shingle_set("")]
    packed = ngram_join.pack_fragments(np.arange(1601), sets, 16)
    assert (packed["info"].map(len) > 0).sum() == 1  # once a block
    counted = pd.concat([ngram_join.count_own(p) for _, p in packed.groupby("frag")])
    facts, = [ngram_join.sum_block(p) for _, p in counted.groupby("block")]
    assert facts["doc_id"].tolist() == list(range(1601)) and facts["n"].tolist() == [1] * 1600 + [0]
    assert facts["own"].tolist() == [1] * 1600 + [0]


def test_info_of_blocks_is_dealt_over_fragments():
    sets = [ngram_join.shingle_set(f"a{k} b c") for k in range(400)]
    homes = [int(p["frag"][p["info"].map(len) > 0].iloc[0])
             for k in range(0, 400, 4) for p in [ngram_join.pack_fragments(np.arange(k, k + 4), sets[k:k + 4], 8)]]
    assert len(set(homes)) == 8 and max(Counter(homes).values()) < 30


def test_counts_take_few_bytes():
    """A document's part of a fragment costs two bytes, not six; steps and
    counts of any width come back."""
    rng = np.random.default_rng(8)
    docs = np.arange(0, 1000, 2)
    assert len(ngram_join.pack_counts(docs, rng.integers(1, 9, 500))) == 2 + 2 * 500
    for top in (255, 256, 70_000):
        docs = np.unique(np.append(rng.integers(0, 65_536, 20), [0, 65_535]))
        counts = np.append(rng.integers(1, 9, len(docs) - 1), top)
        back = ngram_join.unpack_counts(ngram_join.pack_counts(docs, counts))
        assert (back[0] == docs).all() and (back[1] == counts).all()
    assert [len(x) for x in ngram_join.unpack_counts(ngram_join.pack_counts(docs[:0], docs[:0]))] == [0, 0]


def test_filter_loses_no_id(spark):
    """All rows with a named id pass, few others do."""
    rows = spark.range(-50_000, 150_000).withColumnRenamed("id", "doc_id")
    ids = rows.where("doc_id % 5 = 0")
    left = ngram_join.among(rows, ids, 40_000)
    assert left.columns == ["doc_id"]
    assert left.join(ids, "doc_id").count() == 40_000 and left.count() < 45_000
    assert ngram_join.among(rows, ids, ngram_join.FILTER_IDS + 1) is rows


def test_texts_without_candidates_are_not_shuffled(spark, make_docs, tmp_path):
    """The representatives' texts and sets meet by a filter first, even if
    they are too many to be broadcast."""
    rows = [(k, " ".join(f"u{k}x{j}" for j in range(200))) for k in range(300)]
    rows += [(1000 + k, " ".join(f"c{j}" for j in range(199)) + f" end{k}") for k in range(3)]
    docs, held = make_docs(rows), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    docs.write.parquet(str(tmp_path / "docs"))
    seen = []

    def joined(df, ids, many, real=ngram_join.among):
        out = real(df, ids, many)
        seen.append((df.count(), out.count()))
        return out

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_join, "among", joined)
        got = ngram_join.jaccard_components(spark.read.parquet(str(tmp_path / "docs"))).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert {r.component_id for r in got if r.doc_id >= 1000} == {1000} and len(got) == 303
    assert seen[0][0] == 303 and seen[0][1] < 20 and all(b <= a for a, b in seen)


def test_verified_at_the_borders_of_levels(spark):
    """Pairs whose larger set needs more ranges than the smaller one."""
    rng = np.random.default_rng(3)
    sets, pairs, want = {}, [], set()
    for n in (1, 2, 31, 32, 33, 63, 64, 65, 128, 129, 513):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for extra in (1, n // 9, n // 4, n // 4 + 1):
            y = np.unique(np.append(x, rng.integers(0, 1 << 63, extra, dtype=np.uint64)))
            b, a = len(sets), len(sets) + 1
            sets[b], sets[a] = x, y
            pairs.append((a, b, len(y), len(x)))
            if 100 * len(x) >= 80 * len(y):
                want.add((a, b))
    frame = spark.createDataFrame([(k, len(x), x.astype("<u8").tobytes()) for k, x in sets.items()],
                                  "doc_id long, n long, tokens binary")
    found = ngram_join.verified(spark.createDataFrame(pairs, "a long, b long, na long, nb long"), frame, 80, 32)
    assert {tuple(r) for r in found.collect()} == want


def test_components_of_chains_and_stars(spark):
    edges = [(k + 1, k) for k in range(40)] + [(k, 100) for k in range(101, 120)] + [(203, 201), (203, 202)]
    got = {tuple(r) for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({(k, 0) for k in range(1, 41)} | {(k, 100) for k in range(101, 120)} | {(203, 201), (202, 201)})
    assert ngram_join.components(spark.createDataFrame([], "a long, b long")).isEmpty()
