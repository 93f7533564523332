"""Token ids of whole texts by the tokenizers library, with remembered pieces.

A text is cut only where the tokenizer itself never looks across the cut, each
distinct piece is encoded once by the library, and the ids are joined.

* White space dropped by the tokenizer (``word``): any U+0020 or line feed
  separates pieces.
* A byte-level tokenizer that glues one space to what follows (``byte``): the
  text is cut before a space that has a non-space character on both sides.
* Anything else: whole texts go to the library.

Special strings inside texts are handled as the library does by default: they
hold no space, so they lie within one piece, and such pieces go to the library
whole, as do pieces with characters beyond Latin Extended-B.
"""

from __future__ import annotations

import array
import json
import os
import re
import unicodedata

from .common import held

# The split patterns of the two public tokenizer kinds, and the byte alphabet
# of byte-level BPE (printable Latin-1 stands for itself, the rest for U+0100 and up, in order).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

_BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")
_PLAIN = re.compile(r" ?[\n!-~¡-ɏ]+")


def byte_alphabet() -> dict[int, str]:
    """Byte -> its character in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


ALPHABET = byte_alphabet()


def kind_of(library) -> str:
    """``word``, ``byte`` or ``other``: how the tokenizer treats white space."""
    spec = json.loads(library.to_str())
    pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
    if model.get("type") != "BPE" or model.get("dropout"):
        return "other"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "byte"
    if pre.get("type") == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
        split, level = pre["pretokenizers"]
        steps = [n["type"] for n in (norm or {}).get("normalizers", [])]
        if (split["pattern"].get("Regex") == WORD_PATTERN and split["behavior"] == "Removed" and split["invert"]
                and not level["use_regex"] and not level["add_prefix_space"]
                and steps == ["NFC", "Replace", "Lowercase"]):
            return "word"
    return "other"


def open_library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return library


def _latin(pattern: str) -> re.Pattern:
    """A split pattern for texts of ``_PLAIN`` characters, or these in lower case, by plain classes."""
    plain = [chr(c) for c in range(ord("!"), ord("ɏ") + 1)]
    classes = {kind: "".join(re.escape(c) for c in sorted({x for c in plain for x in c + c.lower()})
                             if unicodedata.category(c)[0] == kind) for kind in "LN"}
    for kind, members in classes.items():
        bare = rf"\p{{{kind}}}"
        # inside a class the members alone, elsewhere a class of them
        pattern = re.sub(r"\[[^\]]*\]", lambda c: c[0].replace(bare, members), pattern).replace(bare, f"[{members}]")
    return re.compile(pattern)


class PieceEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers.

    ``limit`` bounds the remembered pieces and pre-tokens: beyond half of it they
    become the older ones, of which only those asked again are kept on.  Those
    over 64 characters are never remembered.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.library = open_library(path)
        self.model = self.library.model
        self.kind = kind_of(self.library)
        self.limit, self.known, self.older = limit, {}, {}
        self.lead = " " if self.kind == "byte" else ""  # what stands before each remembered piece
        self.split = _latin(WORD_PATTERN if self.kind == "word" else BYTE_PATTERN)
        self.hold = [t.content for t in self.library.get_added_tokens_decoder().values() if "<|" not in t.content]
        self.words = self.kind != "other" and not any(s.isalpha() for s in self.hold)

    def _tokens(self, part: str) -> bytes:
        """Ids of one pre-token by the library's model."""
        if not part.isascii() or "\n" in part:
            part = part.encode().decode("latin-1").translate(ALPHABET)
        elif part[0] == " ":
            part = ALPHABET[32] + part[1:]
        return array.array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token.  One without the lead is remembered under a space, which no piece has."""
        key = part if not self.lead else part[1:] if part[0] == " " else " " + part
        ids = self._recall(key)
        if ids is None:
            ids = self._tokens(part)
            self._keep(key, ids)
        return ids

    def _recall(self, key: str) -> bytes | None:
        ids = self.known.get(key)
        if ids is None:
            ids = self.older.get(key)
            if ids is not None:
                self._keep(key, ids)
        return ids

    def _keep(self, key: str, ids: bytes) -> None:
        if 0 < len(key) <= 64:
            if len(self.known) >= self.limit // 2:
                self.older, self.known = self.known, {}
            self.known[key] = ids

    def encode_piece(self, piece: str) -> bytes:
        if (self.kind == "other" or "<|" in piece or not _PLAIN.fullmatch(piece)
                or self.hold and any(s in piece for s in self.hold)):
            return array.array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        if self.kind == "word":
            piece = piece.lower()
        return b"".join(map(self._part, self.split.findall(piece)))

    def _remember(self, piece: str) -> bytes:
        ids = self._recall(piece)
        if ids is None:
            low = piece.lower() if self.kind == "word" else piece
            if self.words and low.isalpha() and (piece.isascii() or max(piece) <= "ɏ"):
                ids = self._tokens(self.lead + low) if low is piece else self._part(low)  # one pre-token
            else:
                ids = self.encode_piece(self.lead + piece)
            self._keep(piece, ids)
        return ids

    def _uneven(self, text: str) -> bytes:
        """A byte-level text with runs of white space."""
        return b"".join([self._remember(p[1:]) if p[0] == " " and len(p) > 1 and not (p[1].isspace() or p[-1].isspace())
                         else self.encode_piece(p) for p in _BEFORE_SPACE.split(text)])

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.kind == "other":
            return self.encode_piece(text)
        byte = self.kind == "byte"
        pieces = (text if byte else text.replace("\n", " ")).split(" ")
        out = list(map(self.known.get, pieces))
        if byte:
            first = pieces[0]
            if not first or first[0].isspace() or first[-1].isspace():
                return self._uneven(text)
            out[0] = self.encode_piece(first)
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    piece = pieces[k]
                    if byte and (not piece or piece[0].isspace() or piece[-1].isspace()):
                        return self._uneven(text)
                    out[k] = self._remember(piece) if piece else b""
        return b"".join(out)


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    return held(("encoder", path), lambda: PieceEncoder(path))
