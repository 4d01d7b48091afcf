"""Texts to pieces for the public BPE tokenizer files, with a bounded cache of chunk ids.

Both public files split a text into pieces before any merge, and no piece (nor the rule that finds it) looks
across white space of certain kinds. So a text is cut there into chunks, and the ids of the text are those of
its chunks one after another. Chunks repeat, so their ids are kept in a dictionary of bounded size.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import regex

#: Entries of the chunk cache, and the longest chunk that it keeps; a full cache is emptied. Both bound memory only.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 48
#: Characters of text that are worked on at a time; bounds memory only.
PASS_SIZE = 1_000_000

#: Fixed patterns of the tokenizer files.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ODD_SPACE = re.compile("[\x85\xa0  -     　]")
_ASCII_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x00]")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_PLAIN_SPLIT = re.compile(r"(?= \S)")
_RUN = re.compile("[\t\n\x0b\x0c\r \x85\xa0  -     　]+")
#: WORD_PATTERN for the Latin blocks; its alternatives begin with different characters, so the commonest may stand first.
_LATIN = [chr(c) for c in range(0x250)]
_LETTERS = "".join(c for c in _LATIN if c.isalpha())
_NUMBERS = "".join(c for c in _LATIN if unicodedata.category(c)[0] == "N")
_find_latin = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+").findall
_WIDE = re.compile("[^\x00-ɏ]")


def byte_chars() -> list[str]:
    """The character that byte-level tokenizers show for each byte: printable ones themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class Pieces:
    """Pieces of texts by a tokenizer file: ``word`` (white space dropped, word ends) or ``byte`` (white space kept)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.spec, self.path = spec, path
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        pre = spec["pre_tokenizer"]
        if pre["type"] == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["normalizer"]:
            self.kind, pattern = "byte", BYTE_PATTERN
        elif self.suffix and pre["type"] == "Sequence" and pre["pretokenizers"][0]["pattern"]["Regex"] == WORD_PATTERN:
            self.kind, pattern = "word", WORD_PATTERN
        else:
            raise ValueError(f"{path}: neither of the two known shapes of tokenizer files")
        self._find = regex.compile(pattern).findall
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.byte_of = {c: b for b, c in enumerate(byte_chars())}

    def chunks(self, text: str) -> list[str]:
        """Strings whose pieces, one after another, are those of the text."""
        if self.kind == "word":
            return _RUN.split(text) if _SEPARATORS.search(text) else text.split()
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _ASCII_SPACE.search(text) \
                or not text.isascii() and _ODD_SPACE.search(text):
            return _PLAIN_SPLIT.split(text)
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def pieces(self, chunk: str) -> list[bytes | int]:
        """UTF-8 pieces of a chunk; an added token is its id."""
        if self._added and "<" in chunk and self._added.search(chunk):
            out: list[bytes | int] = []
            for part in self._added.split(chunk):
                out += [self.added[part]] if part in self.added else self._plain(part)
            return out
        return self._plain(chunk)

    def words(self, text: str) -> list[str] | None:
        """Pieces of a whole text of the Latin blocks without added tokens, by the word rules; None for other texts."""
        if not text.isascii() and _WIDE.search(text) or "<" in text and self._added and self._added.search(text):
            return None
        text = text.lower()  # a few lower-case letters leave the Latin blocks
        return (self._find if not text.isascii() and _WIDE.search(text) else _find_latin)(text)

    def _plain(self, chunk: str) -> list[bytes]:
        if not chunk.isascii() and _WIDE.search(chunk):  # beyond the Latin blocks the library's own rules decide
            if self.library.normalizer is not None:
                chunk = self.library.normalizer.normalize_str(chunk)
            return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        if self.kind == "word":  # in the Latin blocks every character is its own NFC
            chunk = chunk.lower()
        if chunk.isalpha() or chunk[:1] == " " and chunk[1:].isalpha():
            return [chunk.encode()]
        if chunk[:-1].isalpha() and chunk[-1] in ".,":
            return [chunk[:-1].encode(), chunk[-1].encode()]
        return [p.encode() for p in self._find(chunk)]


class ChunkEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    ``solve`` gets pieces (a list of bytes, each once) and returns all their ids in one array, and how many each has.
    """

    def __init__(self, pieces: Pieces, solve):
        self.pieces, self.solve = pieces, solve
        self.cache: dict[str, bytes] = {}   # by chunk
        self.known: dict[str, bytes] = {}   # by piece

    def _solved(self, chunks: set[str]) -> dict[str, bytes]:
        cut = {c: self.pieces.pieces(c) for c in chunks}
        wanted = list({p for ps in cut.values() for p in ps if p.__class__ is bytes})
        if wanted:
            flat, counts = self.solve(wanted)
            data, ends = flat.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
            ids = {p: data[a:b] for p, a, b in zip(wanted, [0, *ends], ends)}
        out = {}
        for c, ps in cut.items():
            if len(ps) == 1 and ps[0].__class__ is bytes:
                out[c] = ids[ps[0]]
            else:
                out[c] = b"".join(ids[p] if p.__class__ is bytes else p.to_bytes(4, "little") for p in ps)
        return out

    def _learnt(self, new: set[str]) -> dict[str, bytes]:
        """Ids of new pieces."""
        names = list(new)
        flat, counts = self.solve([w.encode() for w in names])
        data, ends = flat.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        return {w: data[a:b] for w, a, b in zip(names, [0, *ends], ends)}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Words are split off whole texts at once where the plain rules hold; other texts go by chunks."""
        if self.pieces.kind != "word":
            return self._by_chunks(texts)
        split = [self.pieces.words(t) for t in texts]
        other = [i for i, ws in enumerate(split) if ws is None]
        out = dict(zip(other, self._by_chunks([texts[i] for i in other]))) if other else {}
        if len(self.known) > CACHE_ENTRIES:
            self.known.clear()
        known, new = self.known, set()
        for ws in split:
            if ws:
                new.update(ws)
        new = new.difference(known)
        long = {}
        if new:
            made = self._learnt(new)
            long = {w: v for w, v in made.items() if len(w) > CACHE_CHARS}
            known.update(made)
        done = [out[i] if ws is None else b"".join(map(known.__getitem__, ws)) for i, ws in enumerate(split)]
        for w in long:
            del known[w]
        return done

    def _by_chunks(self, texts: list[str]) -> list[bytes]:
        chunks = [self.pieces.chunks(t) for t in texts]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        known = self.cache
        new = set().union(*chunks).difference(known) if chunks else set()
        if new:
            made = self._solved(new)
            long = {c: v for c, v in made.items() if len(c) > CACHE_CHARS}
            known.update(made if not long else {c: v for c, v in made.items() if c not in long})
            if long:
                get = lambda c: long[c] if c in long else known[c]
                return [b"".join(map(get, cs)) for cs in chunks]
        return [b"".join(map(known.__getitem__, cs)) for cs in chunks]


def in_passes(values: list, length=len) -> list[slice]:
    """Slices of consecutive values of about ``PASS_SIZE`` in all."""
    out, start, total = [], 0, 0
    for i, v in enumerate(values):
        total += length(v)
        if total >= PASS_SIZE:
            out.append(slice(start, i + 1))
            start, total = i + 1, 0
    return [*out, slice(start, len(values))] if start < len(values) else out


class WholeTexts:
    """Ids of whole texts by the compiled merge engine of tiktoken, from the tokenizer file itself.

    That engine merges any two neighbours whose bytes are a token, by the token's rank; the file lists pairs. Both
    agree on every text if each merged token, alone, is merged back to itself (a test holds both files to it). A word
    end is a zero byte here, joined to the last byte before any other merge. Texts that the plain rules don't
    cover (zero bytes, and for the word file added tokens and characters beyond the Latin blocks) go to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        self.pieces = p = Pieces(path)
        vocab, shown = p.spec["model"]["vocab"], byte_chars()
        ranks: dict[bytes, int] = {}
        ids: list[int] = []

        def add(token: bytes, name: str) -> None:
            if token in ranks:
                raise ValueError(f"{path}: two tokens of bytes {token!r}")
            ranks[token] = len(ids)
            ids.append(vocab[name])

        if p.kind == "word":
            for b, c in enumerate(shown):
                add(bytes([b, 0]), c + p.suffix)
        for b, c in enumerate(shown):
            add(bytes([b]), c)
        for m in p.spec["model"]["merges"]:
            name = "".join(m.split(" ") if isinstance(m, str) else m)
            end = b"\0" if p.suffix and name.endswith(p.suffix) else b""
            add(bytes(map(p.byte_of.__getitem__, name.removesuffix(p.suffix) if end else name)) + end, name)
        special = {} if p.kind == "word" else {t: len(ids) + i for i, t in enumerate(p.added)}
        self.ids = np.array(ids + [p.added[t] for t in special], "<u4")
        self.engine = tiktoken.Encoding("own", pat_str="[^\0]+\0" if p.kind == "word" else BYTE_PATTERN, mergeable_ranks=ranks,
                                        special_tokens=special)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit integers."""
        p = self.pieces
        if p.kind == "byte":
            return self.ids[self.engine.encode_to_numpy(text, allowed_special="all")].tobytes()
        if "\0" in text or not text.isascii() and _WIDE.search(text) or "<|" in text and p._added.search(text):
            return np.array(p.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        text = text.lower()  # a few lower-case letters leave the Latin blocks
        found = (p._find if not text.isascii() and _WIDE.search(text) else _find_latin)(text)
        if not found:
            return b""
        found.append("")
        return self.ids[self.engine.encode_to_numpy("\0".join(found))].tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        return [self.encode(t) for t in texts]


_ENCODERS: dict[str, WholeTexts] = {}


def whole_texts(path: str) -> WholeTexts:
    """One encoder a Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WholeTexts(path)
    return _ENCODERS[path]
