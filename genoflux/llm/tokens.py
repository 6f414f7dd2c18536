"""Exact, fast ids of the word-level BPE vocabulary.

The vocabulary lower-cases, drops white space, splits into pre-tokens and never
merges across them, so the ids of a text are the ids of its white-space-separated
chunks, joined. Chunks are looked up in a bounded cache; a missing plain chunk is
merged by a byte-pair engine in which a pre-token's end mark is a trailing space
byte that joins its neighbour before any other merge. Every other chunk (other
scripts, combining marks, special tokens, very long runs) goes to the tokenizer
library itself, so results equal the library's in every case.
"""

from __future__ import annotations

import json

import numpy as np
import regex

from .common import enter

#: Chunks of these characters alone behave alike in both engines: printable
#: ASCII, and letters of Latin-1 and Latin Extended-A with one-to-one lower case.
_PLAIN = regex.compile(r"[!-~À-ÖØ-öø-įıĴ-ķĹ-ľŁ-ňŊ-ŷ]*").fullmatch
#: Fixed value: the vocabulary's own split pattern.
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
#: Punctuation that ends a chunk as one pre-token (no apostrophe: contractions come first).
_TRAILING = ".,;:!?%$&*#|"
#: The byte-pair engine is quadratic in a pre-token's length; longer ones go to the library.
_LONGEST = 200
#: Entries of a cache (chunks, pre-tokens); some 150 bytes each.
_CACHE = 300_000


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _Chunks(dict):
    """chunk -> ids as little-endian unsigned 16- or 32-bit integers."""

    def __init__(self, owner: "WordBpe"):
        super().__init__()
        self.owner = owner

    def __missing__(self, chunk: str) -> bytes:
        found = self.owner.encode_chunk(chunk)
        if len(self) >= _CACHE:
            self.clear()
        if len(chunk) <= _LONGEST:
            self[chunk] = found
        return found


class WordBpe:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        alphabet = _byte_alphabet()
        mark = model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            end = token.endswith(mark)
            return bytes(alphabet[c] for c in (token[: -len(mark)] if end else token)) + b" " * end

        ranks: dict[bytes, int] = {}
        ids: list[int] = []

        def put(piece: bytes, token: str) -> None:
            if piece not in ranks:
                ranks[piece] = len(ids)
                ids.append(vocab.get(token, -1))

        for c, b in sorted(alphabet.items(), key=lambda x: x[1]):
            put(bytes([b]) + b" ", c + mark)
        for c, b in sorted(alphabet.items(), key=lambda x: x[1]):
            put(bytes([b]), c)
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            put(raw(a + b), a + b)
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 65536 and len(self.library.get_vocab(with_added_tokens=True)) <= 65536 else np.dtype("<u4")
        self._packed = [np.array([i], dtype=self.dtype).tobytes() if i >= 0 else None for i in ids]
        self._pieces: dict[str, bytes] = {}
        self._encode_piece = tiktoken.Encoding("word-bpe", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.chunks = _Chunks(self)

    def encode_chunk(self, chunk: str) -> bytes:
        plain = chunk.isprintable() if chunk.isascii() else _PLAIN(chunk)
        if not plain or len(chunk) > _LONGEST or "<|" in chunk:
            return np.array(self.library.encode(chunk, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        chunk = chunk.lower()
        if chunk.isalpha():
            return self._piece_of(chunk)
        core = chunk.rstrip(_TRAILING)
        if core.isalpha():
            return self._piece_of(core) + self._piece_of(chunk[len(core) :])
        return b"".join(map(self._piece_of, _PRETOKEN(chunk)))

    def _piece_of(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            packed = self._packed
            found = b"".join([packed[i] for i in self._encode_piece(piece.encode() + b" ")])
            if len(self._pieces) >= _CACHE:
                self._pieces.clear()
            self._pieces[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """All ids of a text, packed in ``dtype``."""
        if "<|" not in text:
            try:  # no combining marks and one-to-one case: lower-casing first gives the same ids
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))

    def ids_of(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), dtype=self.dtype).astype(np.uint32)


_loaded: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """Loaded once in each Python worker."""
    enter("tokens", _loaded.clear)
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))
