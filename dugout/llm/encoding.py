"""Encoding whole texts with the ``tokenizers`` library, with each distinct word merged once.

``WordEncoder`` runs the tokenizer's own steps (normalizer, pre-tokenizer, model) on each distinct
blank-separated word and remembers the ids, instead of running them on every occurrence. That equals
encoding the text at once for tokenizers whose pieces never span a blank or line break (their pre-tokenizer
drops white space), such as BPE with word ends; tests compare the two. Texts with an added token's
string go through the full encoder. The memory for remembered words is bounded: it is emptied when full.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array

WORDS_HELD = 500_000            # about 200 bytes each, for as long as the worker lives
FOLDING = ["NFC", "Replace", "Lowercase"]
ENDS = ".,;:!?"


class WordEncoder:
    def __init__(self, path: str, words_held: int = WORDS_HELD) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Lowercase
        self.full = Tokenizer.from_file(path)
        self.vocab = self.full.get_vocab_size()
        steps = json.loads(self.full.to_str())["normalizer"] or {}
        # a normalizer of exactly these steps is applied to the whole text, so that words meet in one case
        self._folds = [n["type"] for n in steps.get("normalizers", [])] == FOLDING
        normalizer = Lowercase() if self._folds else self.full.normalizer
        self._normalize = normalizer.normalize_str if normalizer else (lambda s: s)
        self._split, self._merge = self.full.pre_tokenizer.pre_tokenize_str, self.full.model.tokenize
        self._added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self._held: dict[str, bytes] = {"": b""}
        self._words_held = words_held

    def _fold(self, text: str) -> str:
        """NFC, then lower case character by character (a capital sigma is left to the tokenizer)."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text if "\u03a3" in text else text.lower()

    def _word(self, word: str) -> bytes:
        base = word.rstrip(ENDS)
        if base != word and base.isalpha():       # letters and what follows them are always apart
            got = self._held.get(base)
            out = (self._word(base) if got is None else got) + self._pieces(word[len(base):])
        else:
            out = self._pieces(word)
        if len(word) <= 64:                       # longer words are rare and not worth holding
            if len(self._held) >= self._words_held:
                self._held.clear()
                self._held[""] = b""
            self._held[word] = out
        return out

    def _pieces(self, word: str) -> bytes:
        got = array("I")
        if word.isascii() and word.isalpha() and word.islower() and self._folds:   # a text with a capital sigma is not folded
            got.extend([t.id for t in self._merge(word)])      # one piece, its bytes are their own characters
        else:
            for piece, _ in self._split(self._normalize(word)):
                got.extend([t.id for t in self._merge(piece)])
        return got.tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text as native unsigned 32-bit integers, without special tokens."""
        if not text:
            return b""
        if any(t in text for t in self._added):
            return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()
        held, out = self._held, []
        for word in (self._fold(text) if self._folds else text).replace("\n", " ").split(" "):
            got = held.get(word)
            out.append(self._word(word) if got is None else got)
        return b"".join(out)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
