"""Fast encoding of many texts with a tokenizers-library model.

A text's ids are those of its white-space-separated pieces one after another
when white space is dropped by the tokenizer and no token spans it.  Then each
distinct piece is encoded once and remembered.  ``encoder`` checks that a
tokenizer is of this kind (pieces split out by a pattern that never matches
white space, no template around a text); others encode each text whole.

A worker remembers ``REMEMBERED`` pieces at most between texts, so its memory
does not grow with the corpus.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import cache

import numpy as np
from tokenizers import Tokenizer

REMEMBERED = 900_000

_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that byte-level models use for it: visible Latin-1
    characters stand for themselves, the rest follow from U+0100 on."""
    rest = (b for b in range(256) if b not in _VISIBLE)
    return {b: chr(b) for b in _VISIBLE} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Memory(dict):
    """piece -> bytes of its ids; a piece not met yet is learnt when looked up.
    Known pieces, nearly all of a text, cost one look-up each and no Python step."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.learn(piece)
        return ids

    def trim(self, most: int) -> None:
        """From ``most`` pieces on, forget the quarter met last: frequent pieces
        are met early, and a change of language still has that quarter's room."""
        if len(self) > most:
            for _ in range(len(self) - most * 3 // 4):
                self.popitem()


class _Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.low_specials = [t["content"].lower() for t in config.get("added_tokens", [])]
        self.by_piece = self._drops_space(config)
        self.letters = _byte_letters()
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.known = _Memory(self._learn)

    @staticmethod
    def _drops_space(config: dict) -> bool:
        """White space folded to one blank, lower case, and pieces cut out by a
        pattern of letter runs, single digits and other non-space runs."""
        steps = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
        first = ((config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        pattern = first.get("pattern", {}).get("Regex", "")
        return steps == ["NFC", "Replace", "Lowercase"] and first.get("invert") is True and first.get("behavior") == "Removed" \
            and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and not config.get("post_processor") \
            and not any(any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"] for t in config.get("added_tokens", []))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of ``dtype``."""
        if not self.by_piece:
            return self._whole(texts)
        out = []
        for t in texts:
            out.append(b"".join(map(self.known.__getitem__, self._pieces(t))))
            self.known.trim(REMEMBERED)
        return out

    def _pieces(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to split() alone
            return _SPACE.split(text.strip(" \t\n\r\x0b\x0c"))
        # Latin-1 letters lower-case one by one in any library; other texts keep
        # their case, and so do those that hold a special token's letters.
        if _latin(text):
            low = text.lower()
            if not any(s in low for s in self.low_specials):
                return low.split()
        return text.split()

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, piece: str) -> bytes:
        """Encode a piece not seen before.  A run of lower-case Latin-1 letters
        is one unit for the model, as normalising leaves it alone."""
        stem = piece if piece.isalpha() else piece.rstrip(".,!?;:*$%&#")
        if not (stem.islower() and stem.isalpha() and _latin(stem)):
            return self._whole([piece])[0]
        if len(stem) < len(piece):
            return self.known[stem] + self.known[piece[len(stem):]]
        units = stem if stem.isascii() else stem.encode().decode("latin-1").translate(self.letters)
        return array(self.kind, [t.id for t in self.model.tokenize(units)]).tobytes()


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@cache
def encoder(path: str) -> _Encoder:
    """The encoder of a file, made once a worker."""
    return _Encoder(path)
