"""Token ids of texts by a public byte-level BPE vocabulary.

The vocabulary file is the tokenizers library's; its merges run in the tiktoken library, which gives the same ids about four times
as fast (the tests compare them). A text that holds the content of an added token, or that tiktoken refuses, is encoded by the tokenizers library
itself, with its default settings.
"""
from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def _byte_of_symbol() -> dict[str, int]:
    """Symbols of byte-level BPE files: printable bytes are themselves, the others follow from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Encoder:
    def __init__(self, path: str):
        import tiktoken
        self.path, self.slow = path, None
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        symbols = _byte_of_symbol()
        self.added = [t["content"] for t in content.get("added_tokens", [])]
        ranks = {bytes(symbols[s] for s in token): rank for token, rank in content["model"]["vocab"].items() if token not in self.added}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(added in text for added in self.added):
            return np.asarray(self.slow_ids(text), np.uint32)
        try:
            return np.asarray(self.fast.encode_ordinary(text), np.uint32)
        except BaseException as error:  # noqa: BLE001  the regex engine's panic is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.asarray(self.slow_ids(text), np.uint32)

    def slow_ids(self, text: str) -> list[int]:
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.path)
        return self.slow.encode(text, add_special_tokens=False).ids


def distinct_texts(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each row the number of its text among the distinct ones; NULL is empty."""
    coded = pc.fill_null(column, "").dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
