"""Encoder, token files (1) and packing (9) against plain versions."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from logflow.llm import packing, token_files
from logflow.llm._tokens import Encoder, tokenizer_path


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    enc = Encoder(tokenizer_path(name))
    rng = random.Random(3)
    alphabet = " \n.,'a1éZs\t)|́中"
    texts = ["", " ", "a  b", "don't it's", "a <|endoftext|> b", "x y", "a\n\n b", "foo). bar!!"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 20))) for _ in range(1500)]
    for text, raw in zip(texts, enc.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == enc.full.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 65, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype("<u4")
    assert (token_files.from_planes(token_files.to_planes(ids, bits), n) == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_equal_plain_encoding(spark, make_docs, odd_rows, tmp_path, bits):
    docs = make_docs(odd_rows)
    got = token_files.token_files(spark, docs, f"{tmp_path}/files", chunk_ids=64, file_ids=500, bits=bits).collect()
    enc = Encoder(tokenizer_path("word_bpe_49k.json"))
    start, want = 0, []
    for doc_id, text in sorted((r[0], r[1] or "") for r in odd_rows if r[0] is not None):
        ids = enc.full.encode(text, add_special_tokens=False).ids + [1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in got) == want


def test_token_files_empty(spark, make_docs, tmp_path):
    assert token_files.token_files(spark, make_docs([]), f"{tmp_path}/none").count() == 0


def test_packing_places_every_id(spark, make_docs, odd_rows):
    rows = packing.pack(spark, make_docs(odd_rows), capacity=64, group_rows=4).collect()
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = {}
    for r in odd_rows:
        if r[0] is not None:
            texts.setdefault(r[0], []).append(enc.full.encode(r[1] or "", add_special_tokens=False).ids + [2])
    sequences = {}
    for r in rows:
        assert 1 <= r.length <= 64 and (r.length == 64 or r.piece == 0)
        ids = texts[r.doc_id][0][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(len(ids) for some in texts.values() for ids in some)
    assert sum(r.length for r in rows) == total
    assert packing.pack(spark, make_docs([])).count() == 0


def test_configurations_meet_the_histogram_near_the_bound():
    rng = np.random.default_rng(1)
    sizes, counts = np.unique(np.clip(rng.lognormal(5.5, 0.9, 20_000).astype(int), 1, 1024), return_counts=True)
    plan, bound = packing.solve_configurations(dict(zip(sizes.tolist(), counts.tolist())), 1024)
    got = {}
    for conf, times in plan:
        assert sum(conf) <= 1024 and times > 0
        for n in conf:
            got[n] = got.get(n, 0) + times
    assert got == dict(zip(sizes.tolist(), counts.tolist()))
    used = sum(t for _, t in plan)
    assert np.dot(sizes, counts) / 1024 <= bound + 1e-6 <= used + 1e-3 and used <= bound * 1.01


def plain_best_fit(sizes, capacity):
    rooms = []
    for n in sorted(sizes, reverse=True):
        fits = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("n,longest", [(1, 64), (200, 64), (200, 1024), (1000, 1024), (3000, 700)])
def test_packing_is_never_worse_than_best_fit(n, longest):
    rng = np.random.default_rng(n + longest)
    sizes = np.clip(rng.lognormal(5.0, 0.8, n).astype(int), 1, longest).tolist()
    counts = Counter(sizes)
    bulk = packing.best_fit(counts, 1024)
    assert sorted(1024 - sum(conf) for conf, k in bulk for _ in range(k)) == plain_best_fit(sizes, 1024)
    plan, bound = packing.solve_configurations(counts, 1024)
    got = Counter()
    for conf, k in plan:
        for m in conf:
            got[m] += k
    assert got == counts
    assert bound - 1e-6 <= sum(k for _, k in plan) <= sum(k for _, k in bulk)


def test_fractional_program_holds_the_demand():
    lengths, demand = np.array([3, 4, 7, 9]), np.array([5, 1, 1000, 7])
    usage, bound = packing.fractional_program(lengths, demand, 16)
    met = [sum(x * conf.count(n) for conf, x in usage.items()) for n in lengths.tolist()]
    assert np.allclose(met, demand) and all(sum(conf) <= 16 for conf in usage)
    assert bound <= sum(usage.values()) + 1e-6
    assert any(x != int(x) for x in usage.values())
    assert packing.solve_configurations({}, 16) == ([], 0.0)


def test_known_pre_tokens_are_not_gathered_again(monkeypatch):
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = ["a plain text", "", "ein anderer Text   <|x|>", "plain text a"]
    first, calls = enc.encode(texts), []
    monkeypatch.setattr(enc, "_learn", lambda wanted: calls.append(wanted))
    assert enc.encode(texts) == first and not calls
    assert first[0] == enc._ids(enc.full, texts[0]).tobytes()
