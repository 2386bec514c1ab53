"""Token ids of a word-wise BPE vocabulary, remembered by part of a word.

The vocabulary splits lower-case text at white space and into parts: runs of letters, single
digits and runs of other characters. Merges never cross a part, so a text's ids are those
of its parts, and the library only has to see parts that a worker has not met yet.

Words beyond Latin-1 may change under Unicode normalisation and words with ``<|`` may hold
a special token; the library sees those as they are.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from functools import lru_cache

#: What separates words, whatever the library makes of other characters.
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
#: Texts that normalisation only turns to lower case.
_PLAIN = re.compile(r"[\t-\r -~\xa1-\xff]*")

# Fixed value: how the vocabulary splits text, with the letters and numbers of Latin-1.
_PART = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^ \t-\ra-zªµºß-öø-ÿ0-9²³¹¼½¾]+"
)

#: Parts a worker remembers (about 150 MB); then it begins anew.
CACHE = 3 << 18
#: Longer parts are not remembered.
LONGEST = 64


class WordTokens:
    """``encode`` gives a text's ids as little-endian 32-bit bytes, without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self._plain(text)
        out, run = [], []
        for word in _WORD.findall(text):
            if "<|" not in word and _PLAIN.fullmatch(word):
                run.append(word)
                continue
            out += [self._plain(" ".join(run)), self._other(word)]
            run = []
        return b"".join([*out, self._plain(" ".join(run))])

    def _plain(self, text: str) -> bytes:
        parts = _PART.findall(text.lower())
        ids = list(map(self.known.get, parts))
        if None in ids:
            new = self._learn({p for p, x in zip(parts, ids, strict=True) if x is None})
            ids = [new[p] if x is None else x for p, x in zip(parts, ids, strict=True)]
        return b"".join(ids)

    def _learn(self, parts: set[str]) -> dict[str, bytes]:
        missing = list(parts)
        coded = self.bare.encode_batch_fast(missing, add_special_tokens=False)
        new = {p: _packed(x.ids) for p, x in zip(missing, coded, strict=True)}
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        self.known.update((p, x) for p, x in new.items() if len(p) <= LONGEST)
        return new

    def _other(self, word: str) -> bytes:
        return _packed(self.whole.encode(word, add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One for each worker, which keeps what it learned for the tasks that follow."""
    return WordTokens(path)
