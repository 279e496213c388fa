"""Values of words with a bounded memo, and whole texts encoded word by word through it."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np

WORD_END = "</w>"
#: Texts of these characters: visible ASCII and the lower-case letters of Latin-1.
PLAIN = re.compile(r"[\x21-\x7eß-öø-ÿ]+")
#: How the known split pattern cuts such a word once it is in lower case.
PLAIN_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordMemo(dict):
    """Word to value, computed when first asked for.

    Two generations: `turn` starts a new one when it is full, and what then stays unused goes with the
    older one, so at most twice `words` values are held.
    """

    def __init__(self, value: Callable[[bytes], bytes], words: int = 700_000):
        super().__init__()
        self.value, self.words, self.old = value, words, {}

    def __missing__(self, word: bytes) -> bytes:
        value = self.old.get(word)
        if value is None:
            value = self.value(word)
        self[word] = value
        return value

    def turn(self) -> None:
        if len(self) > self.words:
            self.old = dict(self)
            self.clear()

    def joined(self, words: list[bytes]) -> bytes:
        return b"".join([self[w] for w in words])


class WordEncoder:
    """Texts to ids (little-endian uint32 bytes) exactly as `Tokenizer.encode(text, add_special_tokens=False)`.

    A tokenizer file that drops white space before a byte-level BPE with word ends has the same ids
    for a text as for its white-space separated words one after another, so every distinct word is
    encoded once. Any other tokenizer file encodes whole texts.
    """

    def __init__(self, path: str, words: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"].get("pretokenizers", [{}])[0]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.by_word = (
            spec["model"].get("end_of_word_suffix") == WORD_END
            and '"Lowercase"' in json.dumps(spec["normalizer"])
            and split.get("pattern") == {"Regex": PLAIN_SPLIT}
            and not any(t["normalized"] for t in spec["added_tokens"])
        )
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        #: Byte to the character that stands for it in a byte-level vocabulary.
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.memo = WordMemo(self._value, words)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._whole(t) for t in texts]
        self.memo.turn()
        return [self.memo.joined(self._words(t)) for t in texts]

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _words(self, text: str) -> list[bytes]:
        """Words between ASCII white space; lower case first where that maps character by character."""
        if not any(s in text for s in self.special) and "<|" not in text:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.encode().split()

    def _value(self, word: bytes) -> bytes:
        if word.islower():  # letters of ASCII alone, or before a mark, are most of what is new
            if word.isalpha():
                return array("I", [t.id for t in self.model.tokenize(word.decode())]).tobytes()
            if word[-1] in b".,|" and word[:-1].isalpha():
                return self.memo[word[:-1]] + self.memo[word[-1:]]
        text = word.decode()
        if not PLAIN.fullmatch(text) or text != text.lower() or "<|" in text:
            return self._whole(text)
        parts = PLAIN_PARTS.findall(text)
        if len(parts) > 1:
            return b"".join([self.memo[p.encode()] for p in parts])
        if not text.isascii():
            text = "".join(map(self.letters.__getitem__, word))
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for a worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
