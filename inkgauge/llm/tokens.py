"""Token ids by a public tokenizer file, with a memory for words.

The byte-level pre-tokenizer never lets a token run across a space that stands
before a visible character, nor across a single line end between two of them, nor
from a letter or digit into the punctuation behind it. A text can thus be encoded
in such parts, and a part that was met before is looked up. A part of letters alone is
one piece for the pre-tokenizer, so a new one goes straight to the model, which
costs a third of a call of the whole tokenizer. Texts in which a space
is followed by white space are encoded whole. The memory has two generations: when
the younger is full it becomes the older, whose words are taken over as they come up
again.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

REMEMBERED = 500_000  # words in a generation of one worker's memory
CUT = 1 << 18  # code points handled at once
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # without the apostrophe, which begins contractions
# punctuation behind a letter or digit is looked up apart from the word; _CUT marks it
_CUT = "\x01"
_BEHIND = re.compile(r"([!\"#$%&()*+,.:;<=>?@\[\]^`{|}~])(?<=[^\W_].)")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
# the characters by which byte-level models write bytes that are not visible
_UNSEEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173)]
_WRITTEN = {b: 256 + i for i, b in enumerate(_UNSEEN)}


def _as_bytes(text: str) -> str:
    return text.encode().decode("latin-1").translate(_WRITTEN)


class Tokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model if self._one_piece(" aBcéÉ") and self._one_piece("aBcéÉ") else None
        self.words: dict[str, bytes] = {}  # ids of a space and the word
        self.older: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}  # ids of what no space precedes

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _one_piece(self, letters: str) -> bool:
        """Whether letters reach the model as one piece of byte-level characters."""
        cut, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        if self.tokenizer.normalizer is not None or cut is None or not all(t.special for t in added):
            return False
        return [piece for piece, _ in cut.pre_tokenize_str(letters)] == [_as_bytes(letters)]

    def _encode_parts(self, parts: list[str], before: str = "") -> list[bytes]:
        """Ids of each part behind ``before``, which is a space or nothing."""
        if self.model is None:
            return self._encode([before + p for p in parts])
        tokenize, first, out, rest = self.model.tokenize, _as_bytes(before), [], []
        for i, part in enumerate(parts):
            if part.isascii() and part.isalpha():
                found = tokenize(first + part)
            elif _LETTERS.fullmatch(part):
                found = tokenize(first + _as_bytes(part))
            else:
                found = ()
                rest.append(i)
            out.append(array("I", [t.id for t in found]).tobytes())
        if rest:
            for i, ids in zip(rest, self._encode([before + parts[i] for i in rest]), strict=True):
                out[i] = ids
        return out

    @staticmethod
    def _atoms(word: str) -> list[str]:
        """Parts of a word that are encoded alone; the first one follows the space."""
        lines = word.split("\n") if "\n" in word else [word]
        if len(lines) > 1 and any(line.split() != [line] for line in lines):
            return [word]
        out = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            core = line.rstrip(_MARKS)
            if core and len(core) < len(line) and core[-1].isalnum():
                out += (core, line[len(core) :])
            else:
                out.append(line)
        return out

    def _learn(self, words: set[str]) -> bool:
        """Remember the words; False if one of them must be encoded with what precedes it."""
        cut, marked, spaced, bare, known, older = {}, {}, set(), set(), self.words, self.older
        for word in words:
            if word in older:
                known[word] = older[word]
            elif word.isalnum():
                spaced.add(word)
            elif word.startswith(_CUT):
                marked[word] = atoms = self._atoms(word[1:])
                bare.update(atoms)
            elif not word or word[0].isspace():
                return False
            else:
                atoms = self._atoms(word)
                spaced.add(atoms[0])
                if len(atoms) > 1:
                    cut[word] = atoms
                    bare.update(atoms[1:])
        for word in spaced & older.keys():
            known[word] = older[word]
        fresh = list(spaced.difference(known))
        known.update(zip(fresh, self._encode_parts(fresh, " "), strict=True))
        self._learn_bare(bare)
        for word, atoms in cut.items():
            known[word] = known[atoms[0]] + b"".join([self.bare[a] for a in atoms[1:]])
        for word, atoms in marked.items():
            known[word] = b"".join([self.bare[a] for a in atoms])
        return True

    def _learn_bare(self, parts: set[str]) -> None:
        if len(self.bare) > REMEMBERED:
            self.bare.clear()
        fresh = [p for p in parts if p not in self.bare]
        self.bare.update(zip(fresh, self._encode_parts(fresh), strict=True))

    def _short(self, text: str) -> bytes:
        if len(self.words) > REMEMBERED:
            self.words, self.older = {}, self.words
        if _CUT in text:
            return self._encode([text])[0]
        head, *rest = _BEHIND.sub(f" {_CUT}\\1", text).split(" ")
        found = list(map(self.words.get, rest))
        try:
            tail = b"".join(found)
        except TypeError:  # a word is not known
            new = [i for i, ids in enumerate(found) if ids is None]
            if not self._learn({rest[i] for i in new}):
                return self._encode([text])[0]
            for i in new:
                found[i] = self.words[rest[i]]
            tail = b"".join(found)
        if not head:
            return tail
        return self._encode_parts([head])[0] + tail

    def ids(self, text: str | None) -> np.ndarray:
        """All ids of a text (null: none), as unsigned 32-bit numbers."""
        out, at, text = [], 0, text or ""
        while len(text) - at > CUT:
            cut = _SAFE.search(text, at + CUT)
            if not cut:
                break
            out.append(self._short(text[at : cut.start()]))
            at = cut.start()
        if at < len(text):
            out.append(self._short(text[at:]))
        return np.frombuffer(b"".join(out), np.uint32)


_KEPT: dict[str, Tokens] = {}


def tokens_of(path: str, kept: bool) -> Tokens:
    """A tokenizer of a file; a kept memory never changes the ids, but occupies some 200 MB of a worker."""
    if not kept:
        return Tokens(path)
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = Tokens(path)
    return _KEPT[path]
