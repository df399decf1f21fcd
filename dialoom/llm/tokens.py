"""Token ids by the tokenizers library, with the pieces between blanks encoded once and remembered."""

from __future__ import annotations

import functools
import json
import os
import string
from array import array

import numpy as np
import regex

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Pieces and words that are remembered; beyond that the memory starts anew.
MEMORY = 800_000
#: How byte-level pre-tokenizers cut a text (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in plain else next(rest)) for b in range(0x100)}


class _Words(dict):
    """' ' + letters -> bytes of ids."""

    def __init__(self, encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        e = self.encoder
        got = self[word] = array(e.code, [t.id for t in e.model.tokenize(e.blank + word)]).tobytes() if word.isascii() else e.model_ids(" " + word)
        return got


class _Pieces(dict):
    """What stands between two blanks -> bytes of ids with the blank before it; with a leading line end, without a blank.

    None where ids depend on more than the piece: then the whole text is encoded.
    """

    def __init__(self, encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes | None:
        if len(self) >= MEMORY:
            self.clear()
        got = self[piece] = self.encoder.piece_ids(piece)
        return got


class Encoder:
    """encode(text) -> ids as a numpy array, those of Tokenizer.encode(text, add_special_tokens=False).

    The byte-level pre-tokenizer always cuts before a blank that stands between two other characters, and before and after a
    line end between two. So a text is the sequence of its pieces. Texts with other runs of white space, texts that hold the
    content of an added token, and vocabularies with another pre-tokenizer, are encoded whole. Null texts count as empty.
    """

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = path or vocabulary_path()
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        wide = self.tokenizer.get_vocab_size() > 0x10000
        self.kind = np.dtype("<u4" if wide else "<u2")
        pre = spec.get("pre_tokenizer") or {}
        self.pieced = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("ignore_merges")
        self.added = [t["content"] for t in spec.get("added_tokens") or [] if t["content"]]
        self.code = "I" if wide else "H"
        self.letters = _byte_letters()
        self.blank = self.letters[ord(" ")]
        self.model = self.tokenizer.model
        if self.pieced and hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)
        self.line_end = len(self.model_ids("\n") if self.pieced else b"")
        self.words, self.pieces, self.tails = _Words(self), _Pieces(self), {}
        self.cut = regex.compile(BYTE_LEVEL)

    def whole_ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def model_ids(self, word: str) -> bytes:
        """Of one pre-token."""
        if word.isascii() and word[1:].isalnum() and word[0] == " ":
            mapped = self.blank + word[1:]
        else:
            mapped = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def piece_ids(self, piece: str) -> bytes | None:
        if not piece:
            return None
        if piece.isalpha():
            return self.words[piece]
        own = piece[1:] if piece[0] == "\n" else piece
        if not own or own.isspace() or len(own.split()) != 1 or own[0].isspace() or own[-1].isspace():
            return None
        if piece[0] != "\n":
            base = own.rstrip(string.punctuation)
            if base.isalpha():
                return self.words[base] if base == own else self.words[base] + self.tail_ids(own[len(base):])
        return b"".join(map(self.model_ids, self.cut.findall(piece if piece[0] == "\n" else " " + piece)))

    def tail_ids(self, tail: str) -> bytes:
        got = self.tails.get(tail)
        if got is None:
            got = b"".join(map(self.model_ids, self.cut.findall(tail)))
            if len(self.tails) < 10_000:
                self.tails[tail] = got
        return got

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), self.kind)

    def encode_bytes(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.pieced and text[0] not in " \n" and not any(t in text for t in self.added):
            first, *rest = text.replace("\n", " \n").split(" ")
            try:
                head = self.pieces["\n" + first]
                if head is not None and not first.isspace():
                    return head[self.line_end:] + b"".join(map(self.pieces.__getitem__, rest))
            except TypeError:  # a piece that needs its surroundings
                pass
        return self.whole_ids(text)


@functools.lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """One for each Python worker: its next task finds the vocabulary read and the pieces remembered."""
    return Encoder(path)
