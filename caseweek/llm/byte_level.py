"""Byte-level BPE tokenizer files: token bytes by id, and an encoder of plain text."""

from __future__ import annotations

import json
from collections.abc import Callable


def byte_of_character() -> dict[str, int]:
    """The bytes that byte-level vocabularies write as characters: printable Latin-1 ones as themselves, the
    others, in order, as those from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level_tokens(path: str) -> list[bytes]:
    """Token bytes by id of a byte-level BPE tokenizer file."""
    byte_of = byte_of_character()
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    entries = {i: bytes(byte_of[c] for c in token) for token, i in model["model"]["vocab"].items()
               if all(c in byte_of for c in token)}
    for added in model.get("added_tokens", ()):
        entries[added["id"]] = added["content"].encode()
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


def plain_encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text by a tokenizer file, the strings of added tokens being ordinary text.

    Where the file says no more than byte-level merges in the order of their ids, the same merges are done by
    the faster of the two public libraries; else the file's own library encodes.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    split, model = file.get("pre_tokenizer") or {}, file["model"]
    added = {t["id"] for t in file.get("added_tokens", ())}
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", ())]
    vocab = model["vocab"] if isinstance(model["vocab"], dict) else {}
    tokens = byte_level_tokens(path) if vocab else []
    ranks = {tokens[i]: i for i in vocab.values() if i not in added}
    if (split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and not file.get("normalizer")
            and [vocab.get(m) for m in joined] == list(range(256, 256 + len(joined))) and len(ranks) == 256 + len(joined)):
        return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
