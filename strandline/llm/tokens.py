"""Token ids of texts with a public byte-level BPE vocabulary (never trained here)."""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Callable

import numpy as np

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str = TOKENIZER, special: bool = False) -> Callable[[str], np.ndarray]:
    """``text -> uint32 ids``, no special tokens added.  Where a text itself spells one, it is plain text, or
    with ``special`` the token's id, as the vocabulary file's tokenizer has it when used as it is.

    Where the vocabulary file has a rank file beside it (same name, ``.tiktoken``), ids come from
    it: the same vocabulary and splits, so the same ids, in about a quarter of the time (the tests
    compare both).  A text that the rank encoder refuses goes to the vocabulary file itself.
    """
    path = tokenizer_path(name)
    ranks_path = f"{os.path.splitext(path)[0]}.tiktoken"
    full: list = []

    def exact(text: str) -> np.ndarray:
        if not full:
            from tokenizers import Tokenizer

            full.append(Tokenizer.from_file(path))
            full[0].encode_special_tokens = not special
        return np.asarray(full[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

    if not path.endswith(".json") or not os.path.exists(ranks_path):
        return exact

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(path, encoding="utf-8") as f:
        added = {x["content"]: x for x in json.load(f)["added_tokens"]} if special else {}
    if any(x[k] for x in added.values() for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return exact
    quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={k: x["id"] for k, x in added.items()})

    def fast(text: str) -> np.ndarray:
        try:
            if any(x in text for x in added):
                return np.asarray(quick.encode(text, allowed_special="all"), dtype="<u4")
            return np.asarray(quick.encode_ordinary(text), dtype="<u4")
        except BaseException as e:
            if type(e).__name__ != "PanicException":  # its pattern engine gives up on very long runs of white space
                raise
            return exact(text)

    return fast
