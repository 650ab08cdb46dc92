"""Public tokenizer vocabularies, loaded once per Python worker. Paths are parameters."""

from __future__ import annotations

import base64
import json
from functools import lru_cache


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies print each byte as one visible character: printable
    Latin-1 bytes as themselves, the others as the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def byte_bpe(path: str):
    """The byte-level BPE in the JSON file at ``path`` as a fast encoder.

    Its merges are listed in the order of the ids they make, so ranks are ids. The file's
    added tokens are matched first wherever a text holds their strings, as its own library
    does; ``encode_whole`` asks for that.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        read = json.load(f)
    vocab, added = read["model"]["vocab"], {t["content"]: t["id"] for t in read["added_tokens"]}
    to_byte = _byte_of_char()
    ranks = {bytes(to_byte[c] for c in token): i for token, i in vocab.items() if all(c in to_byte for c in token)}
    for token in added:
        ranks.pop(token.encode(), None)
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def encode_whole(coder, text: str):
    """The ids of a text as a numpy array, added tokens included."""
    return coder.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=4)
def rank_bpe(path: str):
    """A byte-level BPE from a file of base64 tokens and ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("rank_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def piece_bpe(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)
