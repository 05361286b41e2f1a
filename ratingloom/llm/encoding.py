"""Token ids of whole texts by the tokenizers library, with each distinct pre-token encoded once per
worker."""

from __future__ import annotations

import json
import re
import sys

import numpy as np
from pyspark import cloudpickle

from ratingloom.llm.shared import process_memo

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# In texts of code points up to U+017F, letters, numbers and white space can be listed, and so the
# pre-tokenizers' patterns can be written without Unicode properties. U+0130 changes its length in
# lower case. All other texts are encoded whole.
FOREIGN = re.compile("[^\x00-ſ]|İ")
LETTERS, NUMBERS, SPACE = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# Pre-tokens that keep a blank before them, and white space before a blank.
WITH_BLANKS = re.compile(f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACE}{LETTERS}{NUMBERS}]+"
                         f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Pre-tokens of lower-case text without its white space; numbers digit by digit.
WORDS_ONLY = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^{SPACE}{LETTERS}{NUMBERS}]+")
MEMO = 1_000_000


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a letter: itself if it is a visible Latin-1 character,
    else the next free one from U+0100."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(others)}


def scheme_of(tokenizer) -> str | None:
    """"bytes" or "words" for the two pre-tokenizers above, None for any other."""
    spec = json.loads(tokenizer.to_str())
    split, normal = spec["pre_tokenizer"] or {}, spec["normalizer"]
    if split.get("type") == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"] and not normal:
        return "bytes"
    parts = split.get("pretokenizers", [])
    if [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["pattern"].get("Regex") == \
            rf"{CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+" and not parts[1]["use_regex"] \
            and [n["type"] for n in (normal or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
        return "words"
    return None


class Encoder:
    """Ids as little-endian unsigned 32-bit integers. Made once per task; the pre-tokens it has
    encoded are kept for later tasks of the same worker, up to ``MEMO`` of them.

    A text is cut into pre-tokens as the vocabulary's pre-tokenizer does it, and new ones go through
    the library's model. Texts with special tokens or other scripts, and vocabularies with another
    pre-tokenizer, go through the library whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        memo = process_memo("encoder")
        if path not in memo:
            tokenizer = Tokenizer.from_file(path)
            special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            memo[path] = tokenizer, scheme_of(tokenizer), special, {}
        self.tokenizer, self.scheme, self.special, self.known = memo[path]
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def one(self, unit: str) -> bytes:
        letters = unit.encode().decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.scheme is None or any(s in text for s in self.special) or (
                not text.isascii() and FOREIGN.search(text)):
            return self.whole(text)
        units = WITH_BLANKS.findall(text) if self.scheme == "bytes" else WORDS_ONLY.findall(text.lower())
        known = self.known
        parts = list(map(known.get, units))
        if None in parts:
            if len(known) > MEMO:
                known.clear()
            for i, part in enumerate(parts):
                if part is None:
                    unit = units[i]
                    part = known.get(unit)
                    if part is None:
                        part = known[unit] = self.one(unit)
                    parts[i] = part
        return b"".join(parts)
