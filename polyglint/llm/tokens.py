"""Token ids of a public byte-level BPE vocabulary, memoised by pre-token."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable

import numpy as np

#: The split rule of the vocabulary, for texts of plain letters, digits and signs.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SPLIT = re.compile(
    rf" ?[{_LETTERS}]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
)
#: Texts with other characters (rare digits, controls, other scripts) are split by the tokenizer.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6\xb7\xbb\xbf-ɏ‐-‧‰-⁞€]")
_KEPT = 1_000_000

_open: dict[str, Encoder] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids by the ``tokenizers`` library. Words are encoded once and remembered; the memory is
    dropped at ``_KEPT`` words, so it doesn't grow with the input."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._ids: dict[str, bytes] = {}  # little-endian uint32

    @staticmethod
    def of(path: str) -> Encoder:
        """One for each Python worker and vocabulary."""
        if path not in _open:
            _open[path] = Encoder(path)
        return _open[path]

    def _learn(self, words: Iterable[str]) -> None:
        words = list(words)
        found = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        self._ids.update(zip(words, (array("I", x.ids).tobytes() for x in found)))

    def encode(self, texts: list[str], end: int | None = None) -> list[np.ndarray]:
        """uint32 ids of each text, followed by ``end`` where it is given."""
        out = []
        tail = b"" if end is None else array("I", [end]).tobytes()
        for text in texts:
            if _OTHER.search(text):
                ids = self._tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.frombuffer(array("I", ids).tobytes() + tail, "<u4"))
                continue
            words = _SPLIT.findall(text)
            try:
                raw = b"".join(map(self._ids.__getitem__, words))
            except KeyError:
                unseen = set(words).difference(self._ids)
                if len(self._ids) + len(unseen) > _KEPT:
                    self._ids.clear()
                    unseen = set(words)
                self._learn(unseen)
                raw = b"".join(map(self._ids.__getitem__, words))
            out.append(np.frombuffer(raw + tail, "<u4"))
        return out

    def decode(self, ids: list[int]) -> str:
        return self._tokenizer.decode(ids, skip_special_tokens=False)
