"""Toxicity (3), licenses (4), quality (6), decontamination (7), HTML (8) and
chat (10)."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logflow.llm import chat, decontaminate, html_extract, licenses, quality, toxicity

SF = "/root/testdata/sf0.1"


def labels_of(spark, rows, column):
    return spark.createDataFrame(rows, f"doc_id long, {column} int")


@pytest.fixture(scope="module")
def toxic_data(spark, make_docs):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(900):
        words = [f"n{rng.randrange(300)}" for _ in range(rng.randint(10, 60))]
        bad = k % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = "vile" + rng.choice(["", "st", "ness", "ly"])
        rows.append((k, " ".join(words), rng.choice(["en", "fr"])))
        labels.append((k, int(bad)))
    return make_docs(rows + [(5000, None, None), (5001, "", "xx")]), labels_of(spark, labels, "toxic"), dict(labels)


def test_toxicity_on_held_out_rows(toxic_data):
    docs, labels, truth = toxic_data
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(got) == 902 and 0 <= got[5000].score <= 1 and got[5001].predicted in (0, 1)
    held = [r for i, r in got.items() if r.held_out and i in truth]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert sum(r.rejected == bool(truth[r.doc_id]) for r in held) >= 0.97 * len(held)


def test_toxicity_ignores_held_out_labels(spark, toxic_data):
    docs, labels, truth = toxic_data
    flipped = labels_of(spark, [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in truth.items()], "toxic")
    a = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, flipped).collect()}
    assert a == b


def test_toxicity_without_labels(spark, make_docs):
    docs = make_docs([(1, "a"), (None, None)])
    none = labels_of(spark, [], "toxic")
    assert [r.score for r in toxicity.score_toxicity(docs, none).collect()] == [0.0]
    kept = toxicity.drop_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == 2
    assert toxicity.score_toxicity(make_docs([]), none).count() == 0


def test_toxicity_calibrates_on_all_rows(spark, make_docs):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(3000):
        bad = k % 8 == 0
        words = [f"n{rng.randrange(300)}" for _ in range(40)]
        if rng.random() < (0.7 if bad else 0.15):
            words[rng.randrange(40)] = "vile"
        lang = rng.choice(["en", "xl"])
        if lang == "xl":  # longer than any training text
            words += [f"n{rng.randrange(300)}" for _ in range(200)]
        rows.append((k, " ".join(words), lang))
        labels.append((k, int(bad)))
    docs, known, truth = make_docs(rows), labels_of(spark, labels, "toxic"), dict(labels)
    model = toxicity.fit_toxicity(docs, known, max_per_class=100, max_train_chars=400)
    check = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 2]
    s = model.scores([r[1] for r in check])
    y = np.asarray([truth[r[0]] for r in check])
    # a calibrated output has the share of label 1 as its mean
    assert abs(s.mean() - y.mean()) < 0.01
    assert set(model.thresholds) == {"en", "xl"}
    for lang, cut in model.thresholds.items():
        own = np.asarray([r[2] == lang for r in check])
        f1 = {c: 2 * y[own & (s >= c)].sum() / max(1, (own & (s >= c)).sum() + y[own].sum()) for c in [cut, *s[own]]}
        assert f1[cut] >= max(f1.values()) - 0.02


def test_sparse_scoring_equals_the_dense_model():
    rng = random.Random(2)
    model = toxicity.Classifier(bits=10)
    drop = np.random.default_rng(2).random(len(model.emb)) < 0.6
    model.emb[drop] = 0
    texts = [" ".join(rng.choice(["vile", "n%d", "ünder", "x%d y"]).replace("%d", str(rng.randrange(40)))
                      for _ in range(rng.choice([0, 1, 2, 3, 50]))) for _ in range(200)]
    vocab = toxicity.Vocabulary()
    words = [np.asarray([vocab[w] for w in toxicity.text_words(t)], dtype=np.int64) for t in texts]
    buckets = np.asarray([[0] * 5] + [toxicity.word_buckets(w, model.bits) for w in vocab.words])
    flat, starts, sizes = toxicity.layout(words)
    x = model.emb[buckets[flat]].mean(axis=1)
    x[flat == 0] = 0
    top, _ = model.pooled(x @ model.w, starts, sizes)
    dense = np.maximum(top + model.b, 0) @ model.v + model.c
    small = model.small()
    assert np.allclose(small.margins(texts), dense, atol=1e-4)
    small.limit, small.table_rows = 5, 3  # tables that start anew all the time
    small.reset()
    assert np.allclose(small.margins(texts), dense, atol=1e-4)


def test_toxicity_of_long_and_repeated_rows(spark, toxic_data, make_docs):
    docs, labels, _ = toxic_data
    long = " ".join(f"n{k % 300}" for k in range(60_000))
    more = docs.unionByName(make_docs([(6000, long), (6001, long + " vilest"), (4, "vile"), (4, "vile"), (None, "vile")]))
    got = toxicity.score_toxicity(more, labels).collect()
    assert len(got) == docs.count() + 4
    score = {r.doc_id: r.score for r in got if r.doc_id >= 6000}
    assert score[6001] > 0.5 > score[6000]
    kept = toxicity.drop_toxic(more, labels)
    assert kept.columns == more.columns and {r.doc_id for r in kept.select("doc_id").collect()} >= {5000, 5001, 6000}
    assert kept.where("text = 'vile'").count() == 0


def test_toxicity_learns_from_few_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    held = [(r.score, truth[r.doc_id]) for r in toxicity.score_toxicity(docs, labels).collect()
            if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, y in held if y == k] for k in (0, 1))
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc >= 0.9


def test_threshold_of_counts_equals_that_of_rows():
    rng = np.random.default_rng(3)
    scores, clean, toxic = rng.random(40), rng.integers(0, 9, 40), rng.integers(0, 3, 40)
    cut = toxicity.best_threshold(scores, clean, toxic, 0.7)
    s, y = np.repeat(scores, clean + toxic), np.concatenate([[0] * c + [1] * t for c, t in zip(clean, toxic)])
    f1 = {c: 2 * y[s >= c].sum() / max(1, (s >= c).sum() + y.sum()) for c in [0.7, cut, *np.sort(scores)[1:]]}
    assert abs(f1[cut] - max(f1.values())) < 1e-12


def brute_places(words, phrase):
    return [k for k in range(len(words) - len(phrase) + 1) if words[k:k + len(phrase)] == phrase]


def test_license_base_columns(make_docs, odd_rows):
    rng = random.Random(6)
    pieces = ["under the MIT license", "Apache-License, Version 2", "cc by nc", "by nc cc", "the", "license version", "é", "2"]
    rows = [(100 + k, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))) for k in range(150)] + odd_rows
    got = licenses.scan_licenses(make_docs(rows)).collect()
    assert len(got) == sum(r[0] is not None for r in rows)
    texts = dict((r[0], r[1]) for r in rows)
    for r in got:
        low = (texts[r.doc_id] or "").translate({k: k + 32 for k in range(65, 91)})
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = {label: brute_places(words, phrase.split()) for phrase, label in licenses.PHRASES}
        every = [p for x in places.values() for p in x]
        base = sorted(x for x, p in places.items() if p)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(words), len(every), min(every, default=None), max(every, default=None))
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_license_spans_of_edited_notice(make_docs):
    label, notice = licenses.NOTICES[0]
    words = notice.split()
    edited = words[:12] + ["strange"] + words[12:30] + words[31:]
    r = licenses.scan_licenses(make_docs([(1, "intro here " + " ".join(edited) + " outro"), (2, "the software is good")])).collect()
    one = next(x for x in r if x.doc_id == 1)
    assert one.labels == "mit" and one.n_base == 0 and one.score > 0.8
    assert one.spans[0].first == 2 and one.spans[0].end == 2 + len(edited)
    assert next(x for x in r if x.doc_id == 2).labels == ""


def test_license_halves_around_a_stray_match(make_docs):
    words = licenses.NOTICES[0][1].split()
    n = len(words) // 2
    stray = " ".join(words[-6:-2])
    whole = " ".join(words)
    docs = [(1, " ".join(words[:n]) + f" {stray} " + " ".join(words[n:])),
            (2, " ".join(words[:n]) + f" x {stray} y {stray} " + " ".join(words[n:])),
            (3, f"{whole} and {whole} end {whole}"), (4, " ".join(words[n:] + words[:n]))]
    got = {r.doc_id: r for r in licenses.scan_licenses(make_docs(docs)).collect()}
    assert [got[k].labels for k in (1, 2, 3)] == ["mit"] * 3 and got[1].score == got[2].score == 1.0
    assert len(got[3].spans) == 3
    assert got[4].labels == "" and got[4].score < 0.6  # halves in the wrong order are no notice


def test_license_of_the_longer_chain_wins(make_docs):
    nc, by = (next(n for x, n in licenses.NOTICES if x == label and n.startswith("this work")) for label in ("cc-by-nc", "cc-by"))
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(make_docs([(1, nc), (2, by), (3, f"{by} or {nc}")])).collect()}
    assert got == {1: "cc-by-nc", 2: "cc-by", 3: "cc-by,cc-by-nc"}


def test_licenses_of_a_table(spark, make_docs):
    table = spark.createDataFrame([("own", "You may cook, serve and eat this text as you like"), (None, "x y z"), ("none", None),
                                   ("blank", " - ")], "label string, text string").withColumn("n", F.lit(1))
    docs = make_docs([(1, "you may cook serve and eat this text as you like it under the MIT license"), (2, licenses.NOTICES[0][1]), (3, None)])
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(docs, templates=table).collect()}
    assert got == {1: "mit,own", 2: "", 3: ""}
    none = {r.doc_id: r.labels for r in licenses.scan_licenses(docs, templates=table.limit(0)).collect()}
    assert none == {1: "mit", 2: "", 3: ""}
    assert licenses.scan_licenses(make_docs([]), templates=table).count() == 0
    with pytest.raises(ValueError):
        licenses.read_notices(table, max_words=3)


def test_chains_against_brute_force():
    rng = random.Random(11)

    def brute(found, size, j):
        at, n, pos = found[j]
        best = n
        for i in range(j):
            a, m, place = found[i]
            gain = n - max(0, a + m - at, place + m - pos)
            if a < at and place < pos and at - a - m <= size and gain > 0:
                best = max(best, brute(found, size, i) + gain)
        return best
    for _ in range(200):
        size = rng.randint(6, 20)
        found = sorted({(rng.randrange(60), n, rng.randrange(size - n + 1)) for n in (rng.randint(2, 6) for _ in range(9))})
        covered, before = licenses.best_chains(found, size)
        assert covered == [brute(found, size, j) for j in range(len(found))]
        assert all(i < j for j, i in enumerate(before))
        spans = sorted((p[0][0], p[-1][1]) for _, p in licenses.apart(found, covered, before, 4))
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_matching_statistics_of_automaton():
    rng = random.Random(8)
    seqs = [[rng.randrange(3) for _ in range(30)] for _ in range(4)]
    sam = licenses.Automaton(seqs)
    texts = ["".join(map(str, s)) for s in seqs]
    stream = [rng.randrange(3) for _ in range(200)]
    state = matched = 0
    for k, w in enumerate(stream):
        state, matched = sam.step(state, matched, w)
        s = "".join(map(str, stream[:k + 1]))
        assert matched == max(n for n in range(len(s) + 1) if any(s[len(s) - n:] in t for t in texts))


def test_quality_base_columns(spark, make_docs, odd_rows):
    rng = random.Random(4)
    rows = [(100 + k, "\n".join(" ".join(rng.choice("ab#c$é") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(1, 20))))
            for k in range(60)] + odd_rows
    got = quality.quality_rules(make_docs(rows), labels_of(spark, [(100 + k, k % 2) for k in range(60)], "quality")).collect()
    texts = dict((r[0], r[1]) for r in rows)
    assert len(got) == sum(r[0] is not None for r in rows)
    for r in got:
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {k + j for k in range(len(words) - 2) for j in range(3) if grams[tuple(words[k:k + 3])] > 1}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (r.base_failed and r.kept)


def test_trees_keep_constraints_and_learn():
    rng = np.random.default_rng(2)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.3)).astype(float)
    y[rng.random(3000) < 0.05] = 1
    trees = quality.fit_trees(x, y, [-1, 0, 0], n_trees=30)
    assert ((trees.score(x) > 0.5) == (y > 0)).mean() > 0.93
    probe = np.repeat(rng.random((40, 3)), 50, axis=0)
    probe[:, 0] = np.tile(np.linspace(0, 1, 50), 40)
    assert (np.diff(trees.score(probe).reshape(40, 50), axis=1) <= 1e-12).all()
    assert quality.fit_trees(x, np.ones(3000), [0, 0, 0]).score(x[:2]).min() > 0.99


def test_decontamination_finds_planted_passages(spark, make_docs, odd_rows):
    rng = random.Random(9)
    vocab = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randint(12, 60)))) for k in range(30)] + [(90, "tiny one"), (91, None), (92, "")]
    rows, planted = [], set()
    for k in range(120):
        words = rng.choices(vocab, k=rng.randint(30, 200))
        if k % 4 == 0:
            at = rng.randrange(len(words))
            words[at:at] = [w.upper() + rng.choice([",", ".", ""]) for w in items[k % 30][1].split()]
            planted.add(100 + k)
        rows.append((100 + k, " ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 500):  # one block of items, and many
        got = decontaminate.find_contamination(make_docs(rows + odd_rows), bench, max_bytes=size).collect()
        assert {r.doc_id for r in got if r.contaminated} == planted
        assert all(r.item_id == (r.doc_id - 100) % 30 for r in got if r.contaminated)
    kept = decontaminate.drop_contaminated(make_docs(rows), bench)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - planted
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(make_docs(rows), none).where("contaminated").count() == 0


def test_decontamination_finds_edited_copies_of_shared_wording():
    rng = random.Random(12)
    vocab = [f"v{k}" for k in range(2000)]
    template = rng.choices(vocab, k=50)
    items = [(k, " ".join(template[:25] + rng.choices(vocab, k=9) + template[25:])) for k in range(10)]
    same = " ".join(rng.choices(vocab, k=59))
    items += [(100 + k, same) for k in range(50)]
    items += [(200 + k, " ".join(rng.choices(vocab, k=rng.choice([14, 40])))) for k in range(10)]
    index = decontaminate.ItemIndex(items)
    want = 0
    for _ in range(150):
        item, text = rng.choice(items)
        words = text.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.choice([0, 1, -1, -2, rng.randrange(len(words))])] = rng.choice(vocab)
        words = rng.choices(vocab, k=rng.randint(0, 20)) + words + rng.choices(vocab, k=rng.randint(0, 20))
        h = decontaminate.WORD_HASHES.of([w.encode() for w in words])
        got = {}
        for i, _, _, similarity in index.search(h):
            got[i] = max(similarity, got.get(i, 0))
        for i, other in items:
            mine = other.split()
            n = len(mine)
            b = Counter(zip(*(mine[j:] for j in range(5))))
            plain = 0
            for a in range(max(0, len(words) - n) + 1):
                w = Counter(zip(*(words[a:a + n][j:] for j in range(5))))
                plain = max(plain, (w & b).total() / (w | b).total())
            if plain >= 0.8:
                want += 1
                assert got.get(i, 0) >= plain
    assert want > 500


def test_decontamination_does_not_depend_on_blocks(spark, make_docs, odd_rows):
    rng = random.Random(21)
    vocab = [f"v{k}" for k in range(900)]
    lead = rng.choices(vocab, k=25)
    items = [(k, " ".join(lead + rng.choices(vocab, k=rng.randint(5, 30)))) for k in range(24)]
    items += [(200 + k, items[k][1]) for k in range(6)] + [(300, "tiny one"), (None, "no id here at all"), (301, None), (302, "!")]
    rows = []
    for k in range(60):
        part = items[k % 24][1].split()
        part = part[:len(part) - rng.choice([0, 1, 3, 10])]
        rows.append((100 + k, " ".join(rng.choices(vocab, k=9) + part + rng.choices(vocab, k=9))))
    rows += rows[:5] + [(100, "tiny one, other text of a repeated id"), (900, "x " * 50_000 + items[3][1])] + odd_rows
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    docs = make_docs(rows)
    got = [sorted(map(str, decontaminate.find_contamination(docs, bench, max_bytes=size).collect()))
           for size in (1 << 20, 2000)]
    assert got[0] == got[1] and len(got[0]) == sum(r[0] is not None for r in rows)
    found = {r.doc_id: r for r in decontaminate.find_contamination(docs, bench).collect()}
    assert found[900].contaminated and found[900].item_id == 3 and found[900].matches[0].first == 50_000
    assert all(found[i].contaminated for i, t in rows[1:60] if any(x[1] in t for x in items[:24]))
    kept = [sorted(map(str, decontaminate.drop_contaminated(docs, bench, max_bytes=size).collect())) for size in (1 << 20, 2500)]
    assert kept[0] == kept[1]
    assert decontaminate.find_contamination(make_docs([]), bench).count() == 0
    assert decontaminate.drop_contaminated(make_docs([]), bench).columns == docs.columns


@pytest.mark.parametrize("size", [14, 20, 40, 59])
def test_recall_of_fingerprints_against_brute_force(size):
    rng = random.Random(size)
    vocab = [f"v{k}" for k in range(2000)]
    want = got = 0
    for _ in range(300):
        item = rng.choices(vocab, k=size)
        edited = list(item)
        for _ in range(rng.randint(0, 3)):
            edited[rng.choice([0, 1, -1, -2, rng.randrange(size)])] = rng.choice(vocab)
        words = rng.choices(vocab, k=8) + edited + rng.choices(vocab, k=8)
        mine = Counter(zip(*(item[j:] for j in range(5))))
        best = 0
        for a in range(len(words) - size + 1):
            w = Counter(zip(*(words[a:a + size][j:] for j in range(5))))
            best = max(best, (w & mine).total() / (w | mine).total())
        index = decontaminate.ItemIndex([(1, " ".join(item))])
        found = index.search(decontaminate.WORD_HASHES.of([w.encode() for w in words]))
        if best >= 0.8:
            want += 1
            got += bool(found)
        else:
            assert not found  # one item: weights are even, so weighted and plain agree
    assert want > 50 and got >= 0.99 * want


def test_hamming_blocks_miss_nothing():
    rng = np.random.default_rng(5)
    index = decontaminate.ItemIndex([(k, " ".join(f"q{x}" for x in rng.integers(0, 999, 20))) for k in range(50)], radius=11)
    for p in index.prints.tolist():
        for d in range(0, 14):
            q = p
            for b in rng.choice(64, d, replace=False).tolist():
                q ^= 1 << b
            want = {i for i, x in enumerate(index.prints.tolist()) if (x ^ q).bit_count() <= 11}
            assert index.near(q) == want


PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a href='/x'>menu {n}</a></li></ul></nav><div class=\"ad\">buy {n}</div><article><h1>T&amp;{n}</h1>"
        "<p><b>one\n {n}<br><p>two &lt;{n}</p><div class='notice box'>we use cookies {n}</div><section id=comments>"
        "<p>reader {n}</p></section><ul><li>item<li>last</ul></article><aside>side</aside><form>f</form>"
        "<footer>foot {n}</footer></body></html>")


def test_extraction(spark):
    rows = [(k, f"http://h{k % 2}.example.com/{k}", PAGE.format(n=k)) for k in range(8)]
    rows += [(20, None, None), (21, "odd", ""), (22, "http://h0.example.com/z", "<p>only &am"), (22, "http://h0.example.com/z", "<p>only &am")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    got = html_extract.extract_pages(pages).collect()
    assert len(got) == 12
    for r in got:
        if r.page_id < 8:
            assert r.text == f"T&{r.page_id}\n\none {r.page_id}\n\ntwo <{r.page_id}\n\nitem\n\nlast"
            assert r.n_chars == len(r.text)
    assert sorted(r.text for r in got if r.page_id > 8) == ["", "", "only &am", "only &am"]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_wrapper_leaves_repeated_nodes_out():
    page = "<body><div class=top><p>Same on all pages of the host</p></div><div class=story><p>{}</p></div></body>"
    merged = None
    for k in range(5):
        t = html_extract.template_of(html_extract.parse(page.format(f"story number {k} with its own words"))[0])
        merged = t if merged is None else html_extract.merge(merged, t)
    rule = html_extract.wrapper(merged, 3)
    assert html_extract.extract(page.format("a new story"), rule) == "a new story"


def one_page(body):
    return html_extract.extract(f"<html><body>{body}</body></html>", None)


@pytest.mark.parametrize("attr", ['style="overflow:hidden"', 'title="a hidden gem"', 'data-id="comments-1"', "data-class=ad",
                                  'class="search-results"', 'id="reply-42"', 'class="has-sidebar"', 'class="share-price"',
                                  'aria-hidden="false"', "data-hidden"])
def test_attributes_that_reject_nothing(attr):
    assert one_page(f"<h1>Title</h1><div {attr}><p>The story</p></div>") == "Title\n\nThe story"


@pytest.mark.parametrize("attr", ["hidden", "class=ad", 'class="cookie-bar"', 'class="post-comments wide"', "id='sidebar'",
                                  'class="ad-300"', 'role="complementary"', 'class="site-footer"', "ARIA-HIDDEN='true'",
                                  'class="box notice"', 'id="comments"', 'class="related-posts"', 'class="newsletter-signup"'])
def test_attributes_that_reject(attr):
    assert one_page(f"<h1>Title</h1><div {attr}><p>Other</p></div><p>The story</p>") == "Title\n\nThe story"


def host_pages(spark, page, n, host="h"):
    return spark.createDataFrame([(k, f"http://{host}/{k}", page(k)) for k in range(n)], "page_id long, url string, html string")


def test_siblings_beside_the_body_stay(spark):
    words = lambda k, n: " ".join(f"w{(k * 31 + j * 7) % 97}" for j in range(n))
    page = lambda k: (f"<body><div class=top><p>Site name and motto</p></div><ul><li><a href=/{k}>go {k}</a></li></ul>"  # noqa: E731
                      f"<div class=wrap><h1>Head {k}</h1><div class=lead><p>lead {words(k, 9)}</p></div>"
                      f"<div class=body><p>{words(k, 40)}</p></div><section><p>end {words(k + 1, 5)}</p></section></div>"
                      "<div class=bottom><p>All rights</p></div></body>")
    got = {r.page_id: r.text for r in html_extract.extract_pages(host_pages(spark, page, 6)).collect()}
    assert got == {k: f"Head {k}\n\nlead {words(k, 9)}\n\n{words(k, 40)}\n\nend {words(k + 1, 5)}" for k in range(6)}


def test_main_holds_more_than_its_article(spark):
    page = lambda k: (f"<body><p>welcome {k}</p><main><p>Follow us all</p><h1>Head {k}</h1><article><p>same on all</p>"  # noqa: E731
                      f"<p>story {k}</p></article><article class=comment><p>me too {k}</p></article></main></body>")
    got = {r.page_id: r.text for r in html_extract.extract_pages(host_pages(spark, page, 5)).collect()}
    assert got == {k: f"Head {k}\n\nsame on all\n\nstory {k}" for k in range(5)}


@pytest.mark.parametrize("copies,others", [(20, 1), (20, 4), (1, 6)])
def test_copies_count_once_in_any_partitioning(spark, copies, others):
    text = "<body><div class=top><p>Top line of the host</p></div><div class=x><p>story {} alone</p></div></body>"
    rows = [(k, "http://h/x", text.format(0)) for k in range(copies)]
    rows += [(100 + k, "http://h/y", text.format(k + 1)) for k in range(others)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    results = [sorted(html_extract.extract_pages(pages.repartition(n)).collect()) for n in (1, 8, 16)]
    assert results[0] == results[1] == results[2]
    alone = others + 1 >= 3  # three distinct pages tell template and content apart
    assert all(("Top line" not in r.text) == alone and "story" in r.text for r in results[0])


def brute_match(a, b):
    """Simple tree matching by trying every ordered pairing of children."""
    if a[0] != b[0]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max([best(xs[1:], ys), *(brute_match(xs[0], y) + best(xs[1:], ys[j + 1:]) for j, y in enumerate(ys))])
    return 1 + best(a[6], b[6])


def test_tree_matching_against_brute_force():
    rng = random.Random(5)

    def tree(depth, label="r"):  # siblings of one label are folded, so labels differ
        kids = [tree(depth - 1, x) for x in rng.sample("abcd", rng.randint(0, 3))] if depth else []
        return [label, "div", html_extract.ONE, "", True, 0, kids]

    def size(t):
        return 1 + sum(map(size, t[6]))
    for _ in range(200):
        a, b = tree(3), tree(3)
        paired = brute_match(a, b)
        assert html_extract._match(a, b) == paired
        assert size(html_extract.merge(a, b)) == size(a) + size(b) - paired


def test_very_long_and_tied_pages(spark):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [(1, "http://h/a", f"<body><article>{long}</article></body>"), (2, "http://h/b", "<body><div><p>a</p></div><div><p>a</p></div></body>")]
    got = {r.page_id: r for r in html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].n_chars == 999_999 and got[2].text == "a\n\na"


def test_reply_order(spark):
    rows = [(1, 0, "user", "First question about\nseveral things."), (1, 1, "assistant", "Answer one."),
            (1, 2, "user", "> first QUESTION about\n> several things\nMore on it"),
            (1, 3, "assistant", "> > First question about several things.\n> More on it\n\nAgreed"),
            (1, 4, "user", "> nobody said this\nplain"), (1, 4, "user", "> nobody said this\nplain"),
            (2, 7, None, None), (None, 1, "user", "x"), (3, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("position", F.lit(9))
    got = {(r.conv_id, r.turn): r for r in chat.format_conversations(df).collect()}
    assert len(got) == 6
    assert [got[1, k].reply_to for k in range(5)] == [None, 0, 0, 2, 3]
    assert [got[1, k].position for k in range(5)] == [0, 1, 2, 3, 4]
    assert [got[1, k].depth for k in range(5)] == [0, 1, 1, 2, 3]
    assert got[1, 2].text == "More on it" and got[1, 3].text == "Agreed" and got[1, 4].n_linked == 0
    assert got[2, 7].text == "" and got[2, 7].formatted == "<|unknown|>\n\n"


def test_reply_order_equals_depth_first_walk(spark):
    rng = random.Random(3)
    rows, parent = [], {}
    for c in range(4):
        for t in range(30):
            p = rng.randrange(t) if t and rng.random() < 0.6 else (t - 1 if t else None)
            parent[c, t] = p
            rows.append((c, t, "user", (f"> message {c} {p}\n" if p is not None else "") + f"message {c} {t}"))
    got = chat.reply_order(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == parent
    for c in range(4):
        order = []

        def walk(t):
            order.append(t)
            for x in sorted(k for k in range(30) if parent[c, k] == t):
                walk(x)
        walk(0)
        assert [r.turn for r in sorted((r for r in got if r.conv_id == c), key=lambda r: r.position)] == order


def test_partial_quotations(spark):
    rows = [(1, 0, "user", "Alpha line one here.\nBeta line two there.\nGamma line three. And a fourth sentence of it."),
            (1, 1, "assistant", "Something else. Beta line two there."),
            (1, 2, "user", "> Alpha line one here.\n> Beta line two there.\nTwo of three lines"),
            (1, 3, "user", "On Monday Ann wrote:\n\n> And a fourth sentence of it.\nA part of a line"),
            (1, 4, "user", "Code:\n>>> x = 1\n>>> y = 2\nend"),
            (1, 5, "user", "> x = 1\n> and forty other words which nobody has ever said in this place\nunlinked"),
            (1, 6, "user", ">>> Gamma line three.\nthird level alone"),
            (1, 7, "user", "> Beta line two\n> there.\nWrapped"),
            (2, 0, "user", ""), (2, 1, None, "> "), (2, 2, "user", "word " * 100_000 + ".\n" + "> deep\n" * 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("hash", F.lit(9))
    got = {(r.conv_id, r.turn): r for r in chat.reply_order(df).collect()}
    assert len(got) == len(rows)
    assert [got[1, k].reply_to for k in range(8)] == [None, 0, 0, 0, 3, 4, 0, 1]
    assert got[1, 3].text == "A part of a line" and got[1, 3].n_linked == 1
    assert got[1, 4].text == "Code:\n>>> x = 1\n>>> y = 2\nend" and got[1, 4].n_quotes == 0
    assert got[1, 5].n_linked == 0 and got[1, 5].n_quotes == 1 and got[1, 5].text == "unlinked"
    assert got[1, 6].text == "third level alone" and got[1, 6].n_linked == 1
    assert got[2, 1].text == "" and got[2, 1].reply_to == 0 and got[2, 2].n_linked == 0
    assert chat.reply_order(df.limit(0)).count() == 0
