"""Subword vocabularies of public tokenizer files as tasks use them: encoders, token bytes, safe places to cut a text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import sentencepiece
import tiktoken

from tallybook.llm.bpe import byte_symbols

#: Fixed value: the splitting pattern that byte-level files with ``use_regex`` imply.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters after which a longer text is cut at the next safe place.
CHUNK = 1 << 18

_SAFE = re.compile(r"(?<=\S)(?= \S)")


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts of a text, each encoded like the part of the whole: cuts lie before a single space between two words.

    No token of the splitting pattern, and no piece of a vocabulary whose spaces only lead, spans such a place,
    unless the text holds U+2581 itself, which pieces take for a space. A text without such a place comes whole.
    """
    low = 0
    while len(text) - low > size and (found := _SAFE.search(text, low + size)):
        yield text[low : found.start()]
        low = found.start()
    yield text[low:] if low else text


@lru_cache(maxsize=2)
def byte_level(spec: str) -> tuple[tiktoken.Encoding, dict[int, bytes]]:
    """The encoder and the bytes of every id, from the text of a byte-level BPE file."""
    held = json.loads(spec)
    model, split = held["model"], held["pre_tokenizer"]
    plain = split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
    if model["type"] != "BPE" or held["normalizer"] or not plain or model.get("ignore_merges"):
        raise ValueError("not a plain byte-level BPE file")
    vocab, special = model["vocab"], {x["content"]: x["id"] for x in held["added_tokens"]}
    made = [vocab[a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    if made != sorted(set(made)):
        raise ValueError("ids are not in the order of the merges")
    value = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    ranks = {bytes(value[c] for c in token): i for token, i in vocab.items() if token not in special}
    coder = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return coder, {i: x for x, i in ranks.items()} | {i: x.encode() for x, i in special.items()}


@lru_cache(maxsize=2)
def pieces(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """The encoder and the bytes of every id, from the bytes of a piece model with byte fallback."""
    coder = sentencepiece.SentencePieceProcessor(model_proto=model)
    names = [coder.id_to_piece(i) for i in range(coder.get_piece_size())]
    if any("▁" in x.lstrip("▁") for x in names):
        raise ValueError("a piece holds a space between other characters")
    return coder, [bytes([int(x[3:5], 16)]) if coder.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
