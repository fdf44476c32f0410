"""Token ids of whole texts, with a bounded cache of words per Python worker."""

from __future__ import annotations

import re
import string
import struct

CACHED_WORDS = 250_000  # words of a generation, and those of one batch
KEPT_WORDS = 100_000  # words that a worker keeps between tasks
MARKS = string.punctuation.encode()
COMBINING = re.compile("[\u0300-\u036f]")  # marks that make one letter with an ASCII one
LATIN_END = "ɐ"  # letters before it are composed and lower-cased one by one

#: Byte-level tokenizers write a byte that is no visible Latin-1 character as another one.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _pack(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACKERS[n](*ids) if n < 32 else struct.pack(f"<{n}I", *ids)


class WordIds:
    """Ids by a byte-level tokenizer that drops white space and lower-cases.

    ``encode`` returns the ids of a text as little-endian unsigned 32-bit numbers. Words
    between ASCII white space are encoded once and remembered. Most words are a run of Latin
    letters within runs of ASCII punctuation; the tokenizer's rules split them there, so
    the letters go to its merge model by themselves. All other words take its whole way.
    ASCII capitals are lowered first, unless a combining mark could join them. Names of
    special tokens within a text are ordinary text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {b"": b""}

    def _whole(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode() for w in words]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_pack(x.ids) for x in found]

    def _letters(self, run: bytes) -> bytes | None:
        """Ids of a run of Latin letters; None if it is something else."""
        if run.isalpha():  # ASCII letters
            return _pack([t.id for t in self.model.tokenize(run.lower().decode())])
        text = run.decode()
        if not text.isalpha() or max(text) >= LATIN_END:
            return None
        low = text.lower()
        if len(low) != len(text):
            return None
        shown = low.encode().decode("latin-1").translate(_HIDDEN)
        return _pack([t.id for t in self.model.tokenize(shown)])

    def _around(self, run: bytes) -> bytes:
        ids = self.marks.get(run)
        if ids is None:
            ids = self._whole([run])[0]
            if len(self.marks) < CACHED_WORDS:
                self.marks[run] = ids
        return ids

    def learn(self, words: set[bytes]) -> None:
        if len(self.words) >= CACHED_WORDS:  # words not met since the last time are forgotten
            self.words, self.older = {}, self.words
        known, older, other = self.words, self.older, []
        for word in words:
            if word in known:
                continue
            ids = older.get(word)
            if ids is not None:
                known[word] = ids
                continue
            core = word.strip(MARKS)
            if len(core) < len(word):
                ids = known.get(core) or older.get(core)
            if ids is None and core:
                ids = self._letters(core)
            if ids is None:
                other.append(word)
            elif len(core) == len(word):
                known[word] = ids
            else:
                front, back = word.split(core, 1)
                if b"'" in front or not (core.isalpha() or core.decode().isalpha()):
                    other.append(word)  # 's and the like are runs of their own
                else:
                    known[core] = ids
                    known[word] = self._around(front) + ids + self._around(back)
        known.update(zip(other, self._whole(other)))

    def split(self, texts: list[str | None]) -> list[list[bytes]]:
        """The words of each text between ASCII white space, lowered where that is safe."""
        found = []
        for t in texts:
            raw = t.encode() if t else b""
            found.append((raw if t and COMBINING.search(t) else raw.lower()).split())
        return found

    def known(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of some words."""
        self.learn(words)
        learned = self.words
        return {word: learned[word] for word in words}

    def forget(self) -> None:
        """Let go of the words when a task ends, if they are many: workers go on to other steps."""
        if len(self.words) + len(self.older) > KEPT_WORDS:
            self.words, self.older = {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = self.split(texts)
        get = self.known(set().union(*split)).__getitem__
        return [b"".join(map(get, words)) for words in split]


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's encoder of a tokenizer file; kept between tasks, as are its words if they are few."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
