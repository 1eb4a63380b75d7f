"""Tokenizer handles, loaded once per Python worker from a path parameter."""

from __future__ import annotations

import base64
import functools
import json
import os


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The ``tokenizers`` object of a ``.json`` file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def special_strings(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f).get("added_tokens", []))


@functools.lru_cache(maxsize=2)
def rank_encoder(json_path: str, ranks_path: str):
    """A faster encoder of the same byte-level vocabulary.

    The rank file holds the vocabulary of the ``.json`` file; ``encode_ids``
    below uses it and proves it against the ``tokenizers`` library.
    """
    import tiktoken
    import public_tokenizers

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteBpe:
    """Token ids of a byte-level BPE ``.json`` file, as ``tokenizers`` gives
    them without added special tokens.

    Texts run through the rank encoder.  Those that hold a special string go
    to ``tokenizers`` itself, and so does every ``check_every``-th text of a task,
    of whatever length, whose ids must agree (an error otherwise).
    """

    def __init__(self, json_path: str, ranks_path: str, check_every: int = 512):
        self.lib = library(json_path)
        self.fast = rank_encoder(json_path, ranks_path)
        self.special = special_strings(json_path)
        self.check_every = check_every
        self.n = 0

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.lib.encode(text, add_special_tokens=False).ids
        ids = self.fast.encode_ordinary(text)
        if self.n % self.check_every == 0 and ids != self.lib.encode(text, add_special_tokens=False).ids:
            raise ValueError("the rank file and the tokenizer file do not hold the same vocabulary")
        self.n += 1
        return ids
