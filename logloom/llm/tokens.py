"""Token ids of texts: what the tokenizer's plain call gives, word by word."""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
import struct
from collections.abc import Iterator

#: Words and parts of words of at most ``LONGEST`` bytes that a Python worker remembers: some
#: 150 bytes each. What is forgotten has to be merged again, at ten times the cost of a look-up.
CACHE_WORDS = 1_000_000
LONGEST = 64
#: Bytes of a text that are split into words at once.
SLAB = 1 << 20

# The tokenizer description for which words are encoded one by one,
# its pattern for the alphabet below, and the alphabet.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
#: Small letters between marks that are no part of an added token or of 's and the like.
_LETTERS = re.compile(r"([!-&(-/:;=-@\[-`{-~]*)([a-zß-öø-ÿ]+)([!-/:;=-@\[-`{-~]*)")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")


def _byte_letters() -> str:
    """The letters that stand for the bytes: itself if it prints, else the next one from 256."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in prints)
    by_byte = {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(others)}
    return "".join(by_byte[b] for b in range(256))


class _Remembered(dict):
    """Ids by word, made where they are missing.

    When half of the room is used the words become the older half; of these, only words met
    again stay.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, word):
        ids = self.older.pop(word, None)
        if ids is None:
            ids = self.make(word)
        if len(word) <= LONGEST:
            if len(self) >= CACHE_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """A function from a text's UTF-8 bytes to its ids.

    In the known kind of tokenizer no token holds white space, and a word is
    lower-cased and cut into parts that are merged on their own. So each
    different word is looked at once, and only parts not met before reach the
    tokenizer's model. Words with letters beyond the plain alphabet, or with what
    may be an added token, are encoded by the plain call; so are all texts when
    the tokenizer is of another kind.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    about = json.loads(tokenizer.to_str())
    added = [t["content"] for t in about["added_tokens"]]
    steps = [n["type"] for n in (about["normalizer"] or {}).get("normalizers", [])]
    cuts = [p.get("pattern", {}).get("Regex") for p in (about["pre_tokenizer"] or {}).get("pretokenizers", [])]

    def plain(text: str) -> bytes:
        return _packed(tokenizer.encode(text, add_special_tokens=False).ids)

    by_word = steps == _NORMALIZERS and cuts == [_SPLIT, None] and all(t.startswith("<|") for t in added)
    if not by_word:
        return lambda text: plain(text.decode())
    model, letters = tokenizer.model, _byte_letters()

    def of_part(part: bytes) -> bytes:
        text = codecs.charmap_decode(part, "strict", letters)[0]
        return _packed([t.id for t in model.tokenize(text)])

    def of_word(word: bytes) -> bytes:
        if word.isalpha() and word.islower():
            return of_part(word)
        text = word.decode()
        found = _LETTERS.fullmatch(text)
        if found:
            head, inner, tail = found.groups()
            if not head and not tail:
                return of_part(word)
            parts = [part for part in (head, inner, tail) if part]
        else:
            if "<|" in text or not _PLAIN.fullmatch(text):
                return plain(text)
            parts = _PARTS.findall(text.lower())
            if len(parts) == 1:
                return of_part(parts[0].encode())
        return b"".join([words[part.encode()] for part in parts])

    words = _Remembered(of_word)

    def of_slab(slab: bytes) -> bytes:
        if b"<|" not in slab:  # added tokens are told by their case; all else is lower-cased anyhow
            slab = slab.lower()
        return b"".join(map(words.__getitem__, slab.split()))

    return lambda text: b"".join(map(of_slab, _slabs(text)))


def _slabs(text: bytes) -> Iterator[bytes]:
    """The text in slices that end at white space."""
    start = 0
    while len(text) - start > SLAB:
        cut = text.find(b" ", start + SLAB)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def token_ids(text: str | None, path: str) -> bytes:
    """Ids without special tokens added, as little-endian unsigned 32-bit numbers."""
    return _encoder(path)((text or "").encode())
