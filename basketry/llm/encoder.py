"""Texts to token ids inside a task, with the tokenizers library and a memo of words.

The library encodes.  For a tokenizer that drops white space, words between
ASCII white space are encoded independently of each other, so a batch is
split and dictionary-coded by Arrow, each distinct word is looked up in a
memo (bounded, kept by the worker) or given to the library, and the ids are
gathered.  Any other tokenizer file is applied to whole texts.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a worker's remembered words take at most (about), and the longest word it remembers.
MEMO_BYTES, MEMO_LENGTH = 128 << 20, 32
#: Bytes of a remembered word beside its letters and ids: two objects and a place in the table.
MEMO_ENTRY = 190

#: Letters that lower-casing and composition handle one by one, and trailing signs.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


_LETTERS = _byte_letters()


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.vocab = self.tokenizer.get_vocab_size(with_added_tokens=True)
        norm, pre = json.dumps(spec["normalizer"]), json.dumps(spec["pre_tokenizer"])
        self.by_word = ("Removed" in pre and "invert\": true" in pre and "NFC" in norm and "Lowercase" in norm
                        and spec["post_processor"] is None and spec["decoder"] is None and spec["model"]["type"] == "BPE"
                        and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec["added_tokens"]))
        self.memo: dict[str, bytes] = {"": b""}
        self.memo_bytes = 0
        self.signs: dict[str, bytes] = {"": b""}

    def _library(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _word(self, word: str) -> bytes:
        m = _PLAIN.fullmatch(word)
        if m is None:
            return self._library(word)
        letters, signs = m.groups()
        letters = letters.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_LETTERS)
        tail = self.signs.get(signs)
        if tail is None:
            tail = self.signs[signs] = self._library(signs)
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(letters)]) + tail

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian uint32."""
        memo, out = self.memo, []
        for w in words:
            ids = memo.get(w)
            if ids is None:
                ids = self._word(w) if self.by_word else self._library(w)
                if len(w) <= MEMO_LENGTH and self.memo_bytes < MEMO_BYTES:
                    memo[w] = ids
                    self.memo_bytes += len(w) + len(ids) + MEMO_ENTRY
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the offsets of each text's ids; a null text has none."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            each = [x.ids for x in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return (np.array([i for x in each for i in x], np.uint32),
                    np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)]))
        lists = pc.ascii_split_whitespace(texts)
        if not len(lists):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        ends = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        each = self.words(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, each), np.int64, len(each)) >> 2
        begin = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(each), np.uint32)
        n = size[codes]
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat((begin[codes] - total[:-1]).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return flat[at], total[ends - ends[0]]

    @functools.cached_property
    def pieces(self) -> list[bytes]:
        return [(self.tokenizer.id_to_token(i) or "").encode() for i in range(self.vocab)]

    def decode(self, ids: np.ndarray) -> bytes:
        """As the library's decode(ids, skip_special_tokens=False), in UTF-8."""
        if self.by_word:
            pieces = self.pieces
            return b" ".join([pieces[i] for i in ids.tolist()])
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
