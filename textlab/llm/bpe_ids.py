"""Token ids of whole texts under a byte-level BPE vocabulary of the ``tokenizers`` library.

Byte-level BPE cuts a text before its merges; a single blank between two characters that are not white space always
starts a new part.  So a text's ids are those of its blank-separated words put together, and words repeat: each worker
keeps the ids of words it has met (a bounded memo) and hands only new ones to the library's BPE model.  Where white
space touches a blank the rule does not hold, nor in a text that holds the string of an added token (``<|endoftext|>``):
such a whole text goes to the tokenizer.  Either way the ids are the tokenizer's own.
"""

from __future__ import annotations

import sys
from array import array

import regex
from tokenizers import Tokenizer

MEMO_WORDS = 1_200_000  # of about 250 bytes each

#: How byte-level BPE cuts a text before merging (fixed value).
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: visible Latin-1 ones for themselves, the others in order
    from code point 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in visible}
    hidden = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def _bytes(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class WordIds:
    """``ids(text)``: its little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, vocabulary: str, memo_words: int = MEMO_WORDS):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        #: Strings that the tokenizer cuts out of a text before all else and gives one id.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.memo: dict[str, bytes | None] = {}
        self.firsts: dict[str, bytes | None] = {}
        self.memo_words = memo_words

    def _word(self, word: str, lead: str) -> bytes | None:
        """Ids of ``lead + word``; None for a word that white space begins or ends."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        merge, ids = self.model.tokenize, []
        for part in _CUT.findall(lead + word):
            if part.isascii() and part.isprintable():
                part = part.replace(" ", _LETTERS[32])
            else:
                part = part.encode().decode("latin-1").translate(_LETTERS)
            ids += [token.id for token in merge(part)]
        return _bytes(ids)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(a in text for a in self.added):
            return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = text.split(" ")
        memo = self.memo
        found = list(map(memo.get, words))
        head = words[0]
        if head not in self.firsts:
            if len(self.firsts) >= self.memo_words // 8:
                self.firsts.clear()
            self.firsts[head] = self._word(head, "")
        found[0] = self.firsts[head]
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    ids = self._word(words[i], " ") if i else None
                    if ids is None:  # white space touches a blank, or begins or ends the text
                        return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
                    if len(memo) >= self.memo_words:
                        memo.clear()
                    found[i] = memo[words[i]] = ids
        return b"".join(found)


_WORKER: dict[int, WordIds] = {}


def worker_ids(vocabulary: str) -> WordIds:
    """The worker process's tokenizer for this vocabulary; made once."""
    key = hash(vocabulary)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = WordIds(vocabulary)
    return _WORKER[key]
