"""Fast exact encoding with a tokenizer file of the tokenizers library.

A tokenizer that drops white space encodes each white-space-separated chunk by itself, so the ids of
a text are the ids of its chunks in order. Chunks repeat, so their ids are cached as packed bytes;
new chunks are encoded together. Texts or chunks whose characters could be normalized in
any other way go through the whole tokenizer, and so does every text of any other kind of tokenizer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks in each of the cache's two generations (a bound on memory, not on work).
CACHED = 500_000

#: Letters with one lower-case form and no other normal form; with ASCII signs they take the short way.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes are themselves, the others get code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in own}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(own))
    return table


class Encoder:
    """ids of whole texts, as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(open(path, encoding="utf-8").read())
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.specials = [x["content"] for x in spec["added_tokens"]]
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        pieces = self._piece_pattern(spec)
        self.cached = pieces is not None
        if self.cached:
            letters = _byte_letters()
            self.pieces = re.compile(pieces)
            self.letters = [(chr(b), letters[b]) for b in sorted({b for c in range(0xC0, 0x100) for b in chr(c).encode()}) if chr(b) != letters[b]]
            self.fast = Tokenizer(self.whole.model)
            self.fast.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = self.whole.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(self.whole.get_vocab_size(), dtype=bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True

    @staticmethod
    def _piece_pattern(spec: dict) -> str | None:
        """The pre-tokenizer's pattern over plain lower-case characters, if it is of the known kind."""
        try:
            kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
            split, level = spec["pre_tokenizer"]["pretokenizers"]
            known = (
                kinds == ["NFC", "Replace", "Lowercase"]
                and spec["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
                and split["behavior"] == "Removed"
                and split["invert"]
                and level["type"] == "ByteLevel"
                and not level["add_prefix_space"]
                and not level["use_regex"]
                and spec["model"]["type"] == "BPE"
                and spec["model"]["end_of_word_suffix"]
                and not spec["model"]["unk_token"]
                and not any(x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec["added_tokens"])
            )
            pattern = split["pattern"]["Regex"]
        except (KeyError, TypeError, ValueError):
            return None
        letters, digits = "a-zß-öø-ÿ", "0-9"
        plain = pattern.replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{digits}]").replace(r"[^\s\p{L}\p{N}]", f"[^\\s{letters}{digits}]")
        return plain if known and r"\p" not in plain else None

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of new chunks."""
        simple, plain, others = [], [], []
        for c in chunks:
            if c.isascii() and c.isalpha():
                simple.append(c)
            elif _PLAIN.fullmatch(c) and not ("<" in c and any(s in c for s in self.specials)):
                plain.append(c)
            else:
                others.append(c)
        out: dict[str, bytes] = {}
        self._fast(simple, None, out)
        self._fast(plain, [self.pieces.findall(c.lower()) for c in plain], out)
        for c, e in zip(others, self.whole.encode_batch_fast(others, add_special_tokens=False), strict=True):
            out[c] = np.array(e.ids, dtype=self.dtype).tobytes()
        return [out[c] for c in chunks]

    def _packed(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of each chunk. The cache has two generations; what is used moves to the newer."""
        packed = list(map(self.cache.get, chunks))
        gone = [i for i, v in enumerate(packed) if v is None]
        if gone:
            older = list(map(self.older.get, [chunks[i] for i in gone]))
            new = [i for i, v in zip(gone, older, strict=True) if v is None]
            learnt = iter(self._learn([chunks[i] for i in new]))
            found = [next(learnt) if v is None else v for v in older]
            for i, v in zip(gone, found, strict=True):
                packed[i] = v
            if len(self.cache) + len(gone) > CACHED:
                self.older, self.cache = self.cache, {}
            if len(gone) <= CACHED:
                self.cache.update(zip([chunks[i] for i in gone], found, strict=True))
        return packed

    def _fast(self, chunks: list[str], split: list[list[str]] | None, out: dict[str, bytes]) -> None:
        """Chunks of plain characters, by the model alone; split: their pieces, if any has several."""
        w = self.dtype.itemsize
        for i in range(0, len(chunks), 2048):
            part = chunks[i : i + 2048]
            if split is None:
                text, n = " ".join(part).lower(), np.arange(len(part))
            else:
                text = " ".join([" ".join(p) for p in split[i : i + 2048]])
                n = np.cumsum([len(p) for p in split[i : i + 2048]]) - 1
                if not text.isascii():
                    text = text.encode().decode("latin-1")
                    for byte, letter in self.letters:
                        text = text.replace(byte, letter)
            ids = np.array(self.fast.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            last = ((np.flatnonzero(self.ends[ids])[n] + 1) * w).tolist()
            raw = ids.tobytes()
            out.update(zip(part, map(raw.__getitem__, map(slice, [0, *last], last)), strict=True))

    def encode(self, texts: pa.Array | Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (and the end). Null texts are empty."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
        texts = pc.fill_null(texts, "")
        if not self.cached:
            parts = [self.whole.encode(t.as_py(), add_special_tokens=False).ids for t in texts]
            at = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
            return np.array([i for p in parts for i in p], dtype=self.dtype), at
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        packed = pa.array(self._packed(words.dictionary.to_pylist()), pa.large_binary())
        each = packed.take(words.indices)
        ends = np.frombuffer(each.buffers()[1], dtype=np.int64, count=len(each) + 1, offset=8 * each.offset) if len(each) else np.zeros(1, dtype=np.int64)
        data = each.buffers()[2] if len(each) else None
        ids = np.frombuffer(data, dtype=np.uint8, count=ends[-1]).view(self.dtype) if data is not None and ends[-1] else np.zeros(0, dtype=self.dtype)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids, ends[bounds] // self.dtype.itemsize


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker and tokenizer; its cache serves later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget(path: str) -> None:
    """Free this worker's encoder and its cache."""
    _ENCODERS.pop(path, None)
