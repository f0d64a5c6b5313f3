"""Pre-tokens: parts of a text that a tokenizer never joins, so each can be encoded on its own."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from typing import Any

#: White space of str.split() that tokenizers' patterns do not take for white space.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_WORD = re.compile("[^\t-\r \x85\xa0  -     　]+")


def space_words(text: str) -> list[str]:
    """Maximal runs without Unicode white space."""
    return _WORD.findall(text) if _NOT_SPACE.search(text) else text.split()


#: Latin letters, then ASCII punctuation other than the apostrophe: two pre-tokens at most.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_characters() -> dict[int, str]:
    """The character that byte-level tokenizers write for each byte: printable ones stand for themselves,
    the others are counted up from 256."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    table = {b: chr(b) for b in own}
    return table | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in table)}


class Memory(dict):
    """Bounded memory of two generations: when the young one is full it replaces the old one, and
    what is still in use comes back from there. ``make`` computes what neither holds."""

    #: Longer keys are computed each time, so that the memory stays bounded in bytes too.
    LONGEST = 64

    def __init__(self, make: Callable[[str], Any], size: int) -> None:
        super().__init__()
        self.make, self.size = make, size
        self.old: dict[str, Any] = {}

    def __missing__(self, key: str) -> Any:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class Pieces:
    """A tokenizer file, its pre-tokens and their ids, as the file's own library gives them.

    ``.model`` files: SentencePiece words with the space mark before them. ``.json`` files that drop
    white space: white-space-delimited words as they stand in the raw text (normalisation,
    special strings and the library's own split all happen inside them). Other ``.json`` files:
    the library's normaliser, special strings and pre-tokenizer are applied first.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path = path
        if path.endswith(".model"):
            import sentencepiece

            from .sentencepiece_codec import MergeCodec

            MergeCodec(path)  # raises for models whose words can't be told apart
            self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = self.sp.get_piece_size()
            mark = [self.sp.piece_to_id("▁")]  # what is left of a word that is only its space mark
            self.pretokens, self.ids = MergeCodec.words, lambda w: self.sp.encode(w) if w else mark
            return
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.size = self.tok.get_vocab_size()
        probe = self._whole
        if all(probe(f"a{c}b") == probe("a") + probe("b") and not probe(c) for c in (" ", "\n", "\t", " ", "　", "  ")):
            self.pretokens, self.ids = space_words, self._whole
            self.model, self.bytes = self.tok.model, {b: c for b, c in byte_characters().items()}
            self.parts = Memory(self._part, 300_000)
            # Where the model alone gives what the whole tokenizer gives, plain words take that way.
            if all(self._plain(w) == self._whole(w) for w in ("the", "Word,", "ÀÉÖßÿ...", "nts", "zzxq!?;", "straße)", "A")):
                self.ids = self._plain
        else:
            self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
            self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
            self.pretokens, self.ids = self._library_pretokens, self._library_ids

    def _whole(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _part(self, part: str) -> list[int]:
        return [t.id for t in self.model.tokenize("".join([self.bytes[b] for b in part.encode()]))]

    def _plain(self, word: str) -> list[int]:
        """A word's ids by the library's model, without its normaliser and split where these are plain."""
        m = _PLAIN.fullmatch(word)
        if not m:
            return self._whole(word)
        letters, rest = m.groups()
        return self.parts[letters.lower()] + self.parts[rest] if rest else self.parts[letters.lower()]

    def _library_pretokens(self, text: str) -> list[str]:
        out: list[str] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                if self.tok.normalizer:
                    part = self.tok.normalizer.normalize_str(part)
                out.extend("\0" + p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(part))
        return out

    def _library_ids(self, pretoken: str) -> list[int]:
        if pretoken in self.special:
            return [self.special[pretoken]]
        return [t.id for t in self.tok.model.tokenize(pretoken[1:])]


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


class Numbers(dict):
    """word -> number, in order of first sight."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n
