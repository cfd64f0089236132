"""Token ids of the public byte-level BPE vocabulary, and its files' places.

``byte_bpe_50k.json`` (tokenizers) and ``byte_bpe_50k.tiktoken`` hold the same
vocabulary. The second library is several times faster and gives the same ids for
ordinary text; texts that spell a special token go to the first. The tests compare
both on whole documents.
"""

from __future__ import annotations

import base64
import functools
import importlib

import numpy as np

SPECIAL = "<|endoftext|>"
END_ID = 50256
VOCABULARY = 50257


def vocabulary_file(name: str) -> str:
    """Place of a public vocabulary file (the ``public_tokenizers`` package gives it)."""
    return importlib.import_module("public_tokenizers").path(name)


@functools.lru_cache(maxsize=2)
def _fast(path: str):
    import tiktoken

    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            piece, rank = line.split()
            ranks[base64.b64decode(piece)] = int(rank)
    pattern = importlib.import_module("public_tokenizers").PATTERN
    return tiktoken.Encoding("byte_bpe_50k", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def _plain(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(text: str) -> np.ndarray:
    """Ids of one whole text, as ``tokenizers`` gives them with add_special_tokens=False."""
    if SPECIAL in text:
        return np.array(_plain(vocabulary_file("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.asarray(_fast(vocabulary_file("byte_bpe_50k.tiktoken")).encode_to_numpy(text, disallowed_special=()), np.uint32)
