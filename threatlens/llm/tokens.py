"""Token ids of whole texts by a public word BPE, with each distinct word encoded once."""

import re
import unicodedata
from array import array
from sys import byteorder

import numpy as np
from tokenizers import Tokenizer

#: How this vocabulary cuts a lower-cased text into words. No word holds
#: white space. (Here for plain texts only, where these classes are those of Unicode.)
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Characters whose case, form and class are the same in every version of Unicode.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-įĲ-ſ‐-‧]*")
#: Bounds of the caches, in words and characters of a word.
CACHED_WORDS = 300_000
CACHED_LENGTH = 48


class _Words(dict):
    """Word to its ids (little-endian unsigned 32-bit)."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenize = tokenizer.model.tokenize
        # Bytes as printable characters: those that are printable stay, others follow from 256.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __missing__(self, word: str) -> bytes:
        ids = array("I", [t.id for t in self.tokenize("".join(map(self.shown.__getitem__, word.encode())))])
        if byteorder == "big":
            ids.byteswap()
        made = ids.tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = made
        return made


class WordBpe(dict):
    """What stands between white space to its ids; texts repeat it more often than not."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.words = _Words(self.tokenizer)

    def __missing__(self, chunk: str) -> bytes:
        ids = b"".join(map(self.words.__getitem__, WORD.findall(chunk)))
        if len(chunk) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids the tokenizer gives to the text, without special tokens."""
        if PLAIN.fullmatch(text) and unicodedata.is_normalized("NFC", text):
            return b"".join(map(self.__getitem__, text.lower().split()))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
