"""Ids of whole texts by a given public tokenizer, one word at a time.

For tokenizers that drop white space and never join across it, the ids of a
text are the ids of its space-separated chunks in order. Each task then
encodes a distinct chunk once and looks the rest up: words are hashed and
made unique with numpy, and letters-only cores (lower-cased, the marks after
them set apart) are encoded once a call. Other tokenizers encode each whole
text. The tables are numpy arrays of about 36 bytes a word, kept per Python
worker and cleared when they reach ``MAX_WORDS`` entries or ``MAX_IDS`` ids,
so their memory is bounded; results never depend on what a table holds.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from meterlake.llm.words import SPACED, ragged, words_of

MAX_WORDS = 1_500_000
MAX_IDS = 8_000_000
_CORE = re.compile(r"([^\W\d_]+)([.,;:!?*#$%&|)]*)\Z")
_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        pre = json.dumps(spec.get("pre_tokenizer") or {})
        norm = json.dumps(spec.get("normalizer") or {})
        # white space is made one blank, then everything between matches is removed
        self.by_word = bool(self.suffix) and '"Removed"' in pre and "[^\\\\s\\\\p{L}\\\\p{N}]+" in pre and "\\\\s+" in norm and "Lowercase" in norm
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocab.items() if self.suffix and t.endswith(self.suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        """``known`` has the words' hashes, ascending; word i has the ids
        ``pool[at[i] : at[i] + len[i]]``."""
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_cores(self, cores: list[str]) -> dict[str, bytes]:
        made = {}
        for i in range(0, len(cores), 512):
            part = cores[i : i + 512]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            each = np.split(ids, cuts[:-1]) if len(cuts) == len(part) else self._raw(part)
            made.update((c, x.tobytes()) for c, x in zip(part, each))
        return made

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk, as bytes of unsigned 32-bit integers."""
        split: list[tuple[str, str] | None] = []
        for c in chunks:
            m = _CORE.match(c)
            # lower case by character: not where it depends on the place or adds a mark
            low = m[1].lower() if m and "Σ" not in c else ""
            split.append((low, m[2]) if low and len(low) == len(m[1]) else None)
        cores = self._encode_cores(list(dict.fromkeys(s[0] for s in split if s)))
        marks = list(dict.fromkeys(s[1] for s in split if s and s[1]))
        cores.update((m, x.tobytes()) for m, x in zip(marks, self._raw(marks) if marks else []))
        odd = iter(self._raw([c for c, s in zip(chunks, split) if s is None]) if None in split else [])
        get = cores.__getitem__
        return [next(odd).tobytes() if s is None else get(s[0]) + get(s[1]) if s[1] else get(s[0]) for s in split]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and the offset of each text (one
        entry more than texts). Null counts as empty."""
        if not self.by_word:
            each = self._raw([t or "" for t in texts.to_pylist()])
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.cumsum([0, *map(len, each)])
        w = words_of(texts, SPACED, lower=False)
        if not len(w.hash):
            return np.zeros(0, np.uint32), np.zeros(len(w.first), np.int64)
        if len(self.known) > MAX_WORDS or len(self.pool) > MAX_IDS:
            self._clear()
        unique, index, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, unique)
        fresh = np.ones(len(unique), bool)
        inside = place < len(self.known)
        fresh[inside] = self.known[place[inside]] != unique[inside]
        if fresh.any():
            raw = w.data.tobytes()
            made = self._encode_chunks([raw[a:b].decode("utf-8", "replace") for a, b in zip(w.start[index[fresh]].tolist(), w.end[index[fresh]].tolist())])
            lens = np.array([len(x) // 4 for x in made], np.int64)
            self.at = np.insert(self.at, place[fresh], len(self.pool) + np.cumsum(lens) - lens)
            self.len = np.insert(self.len, place[fresh], lens)
            self.known = np.insert(self.known, place[fresh], unique[fresh])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(made), np.uint32)])
            place = np.searchsorted(self.known, unique)
        slot = place[inverse]
        lens = self.len[slot].astype(np.int64)
        ids = self.pool[ragged(self.at[slot], lens)]
        return ids, np.concatenate([[0], np.cumsum(lens)])[w.first]
