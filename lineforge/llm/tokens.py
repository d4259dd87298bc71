"""Public tokenizers inside tasks: one per worker process, by the path of its vocabulary file."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# The pattern that splits text before the merges of byte-level vocabularies: a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache
def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token of a file with lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_symbols() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies in JSON write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache
def fast_tokenizer(path: str, special_as_text: bool = False) -> Callable[[str], np.ndarray]:
    """``tokenizers``' ids of a text, without added tokens around it, at several times the speed.

    The file's byte-level merges run in ``tiktoken``, which takes the vocabulary as ranks. Texts
    that hold an added token's string, or characters of which the two libraries' tables of letters
    and spaces could differ (beyond the Latin blocks), go through ``tokenizers`` itself, and so does
    everything if the file asks for more than byte-level merges. ``special_as_text`` takes added
    tokens' strings for ordinary text.
    """
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = special_as_text
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    if not _only_merges(model):
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    symbols = byte_symbols()
    added = [t["content"] for t in model.get("added_tokens", [])]
    ranks = {
        bytes(symbols[c] for c in token): rank for token, rank in model["model"]["vocab"].items() if token not in added
    }
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if _RARE.search(text) or any(token in text for token in added):
            return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def _only_merges(model: dict) -> bool:
    """Whether a tokenizer file splits text by ``PATTERN`` into bytes and merges them, and nothing else."""
    split, merges = model.get("pre_tokenizer") or {}, model["model"]
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    extras = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    return plain and not model.get("normalizer") and merges.get("type") == "BPE" and not any(merges.get(k) for k in extras)


# Anything but ASCII, Latin letters up to U+024F and general punctuation, and a few controls in them.
_RARE = re.compile("[^\x00-\x1b\x20-\x84\x86-\u024f\u2000-\u206f]")
