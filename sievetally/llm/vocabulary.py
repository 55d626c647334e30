"""Token vocabularies of public tokenizers, read on the driver and sent to the tasks; their size is fixed by the file."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Beyond such a run without a break, the library that works in linear time takes over.
LONG_RUN = 20_000
_long_run = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a .tiktoken file by rank; ranks without a token are empty."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level JSON vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def json_encoder(text: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Encoder, to an array of ids, of a byte-level BPE tokenizer given as JSON text, without added special tokens.

    Same ids as tokenizers gives. Texts run through tiktoken, about four times as fast, whenever
    the merges are ordered as the ids, and through tokenizers otherwise or for very long runs.
    """
    spec = json.loads(text)
    added = {x["content"]: x["id"] for x in spec["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    merged = [ranks[bytes(alphabet[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in spec["model"]["merges"]]

    plain: list[Tokenizer] = []

    def slow(x: str) -> np.ndarray:
        # Made when it is first needed, as it takes more memory than all else.
        plain[:] = plain or [Tokenizer.from_str(text)]
        return np.array(plain[0].encode(x, add_special_tokens=False).ids, np.uint32)

    if merged != sorted(merged) or len(ranks) != 256 + len(merged):
        return slow
    fast = tiktoken.Encoding("json", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(x: str) -> np.ndarray:
        if len(x) >= LONG_RUN and _long_run.search(x):
            return slow(x)
        return fast.encode_to_numpy(x, allowed_special="all")

    return encode
