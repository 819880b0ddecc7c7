"""Token ids of whole texts by a bounded table of words.

The tokenizer files of this kind compose characters, turn capitals into small letters,
split words by a pattern and drop white space. No rule of theirs, special strings
included, reaches across a blank, tab or line break, so the ids of a text are those of
its words, one after the other, and a word that comes again is looked up instead of
encoded again. Words are the stretches between these four characters; other white space
stays inside them and is the library's matter. Two more facts save distinct words:

- Capitals A to Z may be made small beforehand, unless a combining mark (U+0300 to
  U+036F) may join them or the text may hold a special string.
- Where a word ends in signs right after a Latin letter or a digit, its ids are those of
  the part before and of the signs (apostrophes, which begin endings like 's, excepted).

Texts and words are UTF-8 bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

#: words of a generation, bytes of a word that is kept, words of a text to encode
MAX_WORDS, MAX_WORD_BYTES, TOGETHER = 1 << 19, 64, 256
#: bytes of a text that are split into words at a time
STRETCH = 1 << 20
_BLANKS = bytes(32 if c in (9, 10, 13) else c for c in range(256))
_SMALL = bytes(c + 32 if 65 <= c <= 90 else b for c, b in enumerate(_BLANKS))
_SIGNS = b".,;:!?%$#&*()[]{}\"@+-=/~^_\\"
#: without U+0130, whose small form ends in a mark
_LETTER = re.compile(r"[0-9A-Za-zÀ-ÖØ-öø-įı-ȳ]\Z")


def load_tokenizer(name: str):
    """The tokenizer of a file of public_tokenizers, without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def stretches(text: bytes, size: int = STRETCH) -> Iterable[bytes]:
    """Cut a text at blanks into stretches of about ``size`` bytes; one without a blank
    is longer."""
    start = 0
    while len(text) - start > size:
        end = min((i for c in b" \n\t\r" if (i := text.find(c, start + size)) >= 0), default=-1)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


class WordTable:
    """Ids of words as little-endian 32-bit bytes, in two generations: words that come
    again move to the younger one; when that holds ``most`` words it becomes the older
    one, whose words are forgotten. The table lives as long as its Python worker."""

    def __init__(self, tokenizer, most: int = MAX_WORDS):
        self.tokenizer, self.most = tokenizer, most
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        marks = [(t.content, i) for i, t in tokenizer.get_added_tokens_decoder().items() if t.special]
        #: a special string between two words is a token of its own
        self.mark, self.mark_id = marks[-1] if marks else (None, None)
        self.strange = [m[:2].encode() for m, _ in marks]
        one, other = (tokenizer.encode(c, add_special_tokens=False).ids for c in "Aa")
        self.small = one == other

    def words_of(self, text: bytes) -> list[bytes]:
        small = self.small and not any(s in text for s in (*self.strange, b"\xcc", b"\xcd"))
        return text.translate(_SMALL if small else _BLANKS).split(b" ")

    def encode(self, words: list[bytes], apart: bool = False) -> list[bytes]:
        """The ids of each word. Many words are one text, with a special string between
        them; words that may hold such a string themselves are encoded ``apart``."""
        import numpy as np

        texts = [w.decode() for w in words]
        if self.mark is None or apart:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.asarray(e.ids, "<u4").tobytes() for e in found]
        out: list[bytes] = []
        joined = [self.mark.join(texts[i:i + TOGETHER]) for i in range(0, len(texts), TOGETHER)]
        for found in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.asarray(found.ids, "<u4")
            ends = (4 * np.flatnonzero(ids == self.mark_id)).tolist()
            whole = ids.tobytes()
            out += [whole[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(whole)])]
        return out

    def learn(self, words: set[bytes]) -> list[bytes]:
        """Put all words into the young generation; returns those too long to stay."""
        missing = words.difference(self.young)
        parts: dict[bytes, tuple[bytes, bytes]] = {}
        strange = []
        for word in list(missing):
            if word in self.old:
                self.young[word] = self.old[word]
                missing.discard(word)
            elif (b"<" in word or b"|" in word) and any(s in word for s in self.strange):
                strange.append(word)
                missing.discard(word)
            elif word[-1] in _SIGNS:
                stem = word.rstrip(_SIGNS)
                if stem and _LETTER.search(stem[-2:].decode(errors="replace")):
                    parts[word] = stem, word[len(stem):]
                    missing.discard(word)
        missing.update(p for both in parts.values() for p in both if p not in self.young)
        for some, apart in ((list(missing), False), (strange, True)):
            if some:
                self.young.update(zip(some, self.encode(some, apart)))
        for word, (stem, signs) in parts.items():
            self.young[word] = self.young[stem] + self.young[signs]
        added = (*missing, *strange, *parts)
        return [w for w in added if len(w) > MAX_WORD_BYTES]

    def look_up(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of texts that are given as words."""
        long = self.learn(set().union(*texts))
        out = [b"".join(map(self.young.__getitem__, words)) for words in texts]
        for word in long:
            self.young.pop(word, None)
        if len(self.young) > self.most:
            self.old, self.young = self.young, {b"": b""}
        return out

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text; a null one has none."""
        out: list[bytes] = []
        waiting: list[list[bytes]] = []
        size = 0
        for text in texts:
            if text and len(text) > STRETCH:
                out += self.look_up(waiting)
                out.append(b"".join(self.look_up([self.words_of(part)])[0] for part in stretches(text)))
                waiting, size = [], 0
                continue
            waiting.append(self.words_of(text) if text else [])
            size += len(text or b"")
            if size > STRETCH:
                out += self.look_up(waiting)
                waiting, size = [], 0
        return out + self.look_up(waiting)


_tables: dict[str, WordTable] = {}


def word_table(name: str) -> WordTable:
    """The table of this Python worker."""
    if name not in _tables:
        _tables[name] = WordTable(load_tokenizer(name))
    return _tables[name]
