"""Encoders over public vocabulary files; the files stay where they are and only their name travels."""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Callable

#: The name of a vocabulary file of the `public_tokenizers` package; an absolute path works as well.
BPE_JSON = "byte_bpe_50k.json"
BPE_RANKS = "byte_bpe_50k.tiktoken"
# Fixed value: the one special token of this vocabulary, with its number.
SPECIAL = {"<|endoftext|>": 50256}


def kept(key: str, make: Callable):
    """`make()`, once per process.  Functions travel to the executors by value, so a global of this module would not do."""
    known = sys.modules.setdefault("_vocabularies_of_this_process", types.ModuleType("_vocabularies_of_this_process")).__dict__
    if key not in known:
        known[key] = make()
    return known[key]


def place(name: str) -> str:
    if name.startswith("/"):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def ranks(name: str = BPE_RANKS) -> dict[bytes, int]:
    def read():
        with open(place(name), "rb") as lines:
            return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}

    return kept(f"ranks {name}", read)


def rank_encoder(name: str = BPE_RANKS):
    """Encoder over a rank file; text that spells a special token becomes that token, as the JSON file has it."""

    def make():
        import public_tokenizers
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(name), special_tokens=SPECIAL)

    return kept(f"encoder {name}", make)


def encode(text: str, name: str = BPE_RANKS) -> list[int]:
    return rank_encoder(name).encode(text, allowed_special="all")


def token_bytes(name: str = BPE_RANKS) -> list[bytes]:
    """The bytes of each token, by number."""

    def make():
        known = {rank: token for token, rank in ranks(name).items()} | {number: token.encode() for token, number in SPECIAL.items()}
        return [known[i] for i in range(len(known))]

    return kept(f"tokens {name}", make)
