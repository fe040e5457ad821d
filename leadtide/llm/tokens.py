"""Token ids by a public vocabulary that the environment provides; its name is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np

#: Texts of more characters go to the library whose splitter has no recursion limit.
LONG = 200_000


def encoder(name: str = "byte_bpe_50k") -> Callable[[str], np.ndarray]:
    """text -> ids, as ``Tokenizer.from_file(path(name.json)).encode(text, add_special_tokens=False)`` gives them.

    The same vocabulary is read as ranks by the faster library; ``tests/llm`` compare the two.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {"<|endoftext|>": len(ranks)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow = []

    def encode(text: str) -> np.ndarray:
        if len(text) <= LONG:
            return np.asarray(fast.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))
        return np.asarray(slow[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode
