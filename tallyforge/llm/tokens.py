"""Token ids of whole texts by a byte-level BPE file of the tokenizers library."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DEFAULT_TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    return str(public_tokenizers.path(name))


def _byte_of_symbol() -> dict[str, int]:
    """The usual printable symbol for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids as the tokenizers library gives them without special tokens added.

    Texts of Latin-1 characters without a special token's string take tiktoken
    with ranks built from the same file, several times faster: there both
    libraries split alike, and the merges are in the order of their ids (which
    is checked). Every other text goes through tokenizers itself.
    """

    def __init__(self, path: str, special_is_text: bool = False):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = special_is_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.quick = self._quick(spec)

    def _quick(self, spec: dict) -> tiktoken.Encoding | None:
        vocab, byte = spec["model"]["vocab"], _byte_of_symbol()
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        order = [vocab["".join(m)] for m in pairs]
        if order != sorted(order) or spec.get("normalizer"):
            return None
        skip = set(self.special)
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in skip}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if self.quick is not None and not any(s in text for s in self.special):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return np.asarray(self.quick.encode_to_numpy(text), "<u4")
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")


@lru_cache(maxsize=4)
def encoder(path: str, special_is_text: bool = False) -> Encoder:
    """``special_is_text``: the strings of special tokens are ordinary text."""
    return Encoder(path, special_is_text)
