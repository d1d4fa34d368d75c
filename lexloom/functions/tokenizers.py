"""Tokenizers: bytes, white space, and the files of public vocabularies."""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Callable

# Fixed value: the pattern that splits a text before the merges of rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ids that end a document, where a tokenizer has none of its own in its vocabulary.
EOS = {"utf8": 256, "ws": 0}


@functools.lru_cache(maxsize=4)
def encoder(name: str) -> Callable[[str], list[int]]:
    """text -> ids.  name: `utf8`, `ws`, or the path of a .tiktoken, .json or .model file; loaded once per worker."""
    if name == "utf8":
        return lambda text: list(text.encode("utf-8"))
    if name == "ws":
        return lambda text: [1 + zlib.crc32(w.encode("utf-8")) % 0x7FFFFFFE for w in text.split()]
    if name.endswith(".tiktoken"):
        import tiktoken

        with open(name, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    if name.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=name).encode
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(name)
        model.encode_special_tokens = True
        return lambda text: model.encode(text, add_special_tokens=False).ids
    raise ValueError(f"no such tokenizer: {name}")
