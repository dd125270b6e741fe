"""Exact BPE encoding with a memo of pre-tokens.

Byte-pair encoding never merges across pre-tokens, so the ids of a text are
the ids of its pre-tokens in order, and each distinct pre-token needs the
tokenizers library only once.  Pre-tokens are cut here on UTF-8 bytes, with
every non-ASCII byte taken as part of a letter; a text in which that is not
certain (marks, signs or blanks beyond ASCII, strings of special tokens) goes
to the library whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from logflow.llm._common import ASCII_LOWER, use_memo

# The two tokenizers' pre-token patterns, on bytes.
WORD_KIND = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xff]+|[0-9]|[^\sa-z0-9\x80-\xff]+")
BYTE_KIND = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\x80-\xff]+| ?[0-9]+"
                       rb"| ?[^\sA-Za-z0-9\x80-\xff]+|\s+(?!\S)|\s+")
#: Letters below it are in normal form C and lower-case to one letter.
PLAIN_BELOW = "İ"


class Encoder:
    """``encode(texts)`` gives for each text its ids as little-endian uint32
    bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    max_memo = 600_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        self.words = bool(suffix)
        self.pattern = WORD_KIND if self.words else BYTE_KIND
        self.full = Tokenizer.from_file(path)
        #: Without the library's slow patterns: for plain letters only.
        self.light = Tokenizer.from_file(path)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        vocab = self.full.get_vocab()
        self.mark = np.zeros(max(vocab.values()) + 1, dtype=bool)
        if self.words:  # a word's last token carries the suffix
            self.light.normalizer = normalizers.Lowercase()
            self.light.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
            self.mark[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        else:  # the first token of a piece carries its blank
            self.light.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.Split(" ", "merged_with_next"), byte_level])
            self.mark[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self.memo: dict[bytes, bytes | None] = {}

    def _ids(self, tokenizer, text: str) -> np.ndarray:
        return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, wanted: set[bytes]) -> None:
        new = wanted.difference(self.memo)
        if len(self.memo) + len(new) > self.max_memo:
            self.memo.clear()
            new = wanted
        joined = []
        for p in new:
            s = p.decode("utf-8")
            body = s[1:] if s[:1] == " " else s
            if not body.isascii() and not (body.isalpha() and max(body) < PLAIN_BELOW):
                self.memo[p] = None  # the texts that hold it go to the library whole
            elif body.isalpha() and (self.words or body is not s):
                joined.append(s)
            else:
                tokenizer = self.light if body.isalpha() else self.full
                self.memo[p] = self._ids(tokenizer, s).tobytes()
        for k in range(0, len(joined), 2000):
            block = joined[k:k + 2000]
            ids = self._ids(self.light, (" " if self.words else "").join(block))
            if self.words:
                ends = np.flatnonzero(self.mark[ids]) + 1
                starts = np.append(0, ends[:-1])
            else:
                starts = np.flatnonzero(self.mark[ids])
                ends = np.append(starts[1:], len(ids))
            if len(starts) != len(block):
                raise ValueError("the tokenizer's word marks do not delimit its words")
            raw = ids.tobytes()
            for s, a, b in zip(block, (4 * starts).tolist(), (4 * ends).tolist()):
                self.memo[s.encode("utf-8")] = raw[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        use_memo("tokens", _ENCODERS)
        cut = self.pattern.findall
        for at in range(0, len(texts), 100):
            block = texts[at:at + 100]
            pieces = []
            for t in block:
                b = t.encode("utf-8")
                pieces.append(cut(b.translate(ASCII_LOWER) if self.words else b) if b"<|" not in b else None)
            get = self.memo.__getitem__
            done: list[bytes | None] = []
            new: list[int] = []
            for k, p in enumerate(pieces):
                try:  # most texts hold only pre-tokens known by now
                    done.append(None if p is None else b"".join(map(get, p)))
                except KeyError:
                    new.append(k)
                    done.append(None)
                except TypeError:
                    done.append(None)
            if new:
                self._learn(set().union(*(pieces[k] for k in new)))
            for k in new:
                try:
                    done[k] = b"".join(map(get, pieces[k]))
                except TypeError:
                    pass
            out += [self._ids(self.full, t).tobytes() if ids is None else ids for t, ids in zip(block, done)]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker, until the worker
    goes on to another operator's memo."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
