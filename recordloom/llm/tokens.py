"""Token ids as the `tokenizers` library gives them, through a cache of pre-tokens.

The library spends most of its time on pieces that it has seen before. Here a
text is cut at white space where the tokenizer itself always cuts, and each
distinct cut is encoded once per worker, by the library. Cuts are only made
where they cannot change the result:

* word tokenizers (white space is dropped) at ASCII white space;
* byte-level tokenizers before the single space that precedes a word, and
  around white-space runs, as their own pattern does.

A text that holds the string of a special token, for lower-casing tokenizers in any case, or white space outside ASCII
for the byte-level kind, goes through the library whole.
"""

from __future__ import annotations

 
import json
import os
import re

import numpy as np

CACHE_ENTRIES = 5 << 18
_SPACES = b" \t\n\r\x0b\x0c"

_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　᠎​﻿]")
_BYTE_CUT = re.compile(rb" ?[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+")


class Encoder:
    """Encodes whole texts to numpy id arrays.

    The cache has two generations: when the young one is full it becomes the old
    one, and what is used again moves back, so that its size is bounded and
    frequent pieces stay.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.special_bytes = [s.encode("utf-8") for s in self.special]
        self.drops_space = _drops_space(spec)
        self.safe = self.drops_space or _byte_level(spec)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, text: str) -> list[int]:
        """The library's ids of a text, nothing added."""
        return self.library.encode(text, add_special_tokens=False).ids

    def pieces(self, text: str) -> list[bytes] | None:
        """Pre-tokens of a text, or None if it must be encoded whole."""
        if not self.safe or any(s in text for s in self.special):
            return None
        if self.drops_space:
            lowered = text.encode("utf-8").lower()
            # the library looks for special strings before it lower-cases
            if any(s in lowered for s in self.special_bytes):
                return None
            return lowered.split()
        if _ODD_SPACE.search(text):
            return None
        return _BYTE_CUT.findall(text.encode("utf-8"))

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, as bytes of the id type.

        Pre-tokens that begin where the tokenizer cuts anyway are encoded by one
        call on their concatenation; offsets tell which ids are whose.
        """
        glue = b" " if self.drops_space else b""
        joined = [i for i, p in enumerate(pieces) if glue or (len(p) > 1 and p[0] == 32 and p[1] not in _SPACES)]
        out: list[bytes] = [b""] * len(pieces)
        for at in range(0, len(joined), 256):
            some = joined[at : at + 256]
            texts = [pieces[i].decode("utf-8") for i in some]
            found = self.library.encode(glue.decode().join(texts), add_special_tokens=False)
            ids, starts = np.asarray(found.ids, self.dtype), [o[0] for o in found.offsets]
            cut = np.searchsorted(starts, np.cumsum([0] + [len(t) + len(glue) for t in texts])).tolist()
            for i, x, y in zip(some, cut[:-1], cut[1:], strict=True):
                out[i] = ids[x:y].tobytes()
        for i in set(range(len(pieces))).difference(joined):
            out[i] = np.asarray(self.whole(pieces[i].decode("utf-8")), self.dtype).tobytes()
        return out

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text; null is empty."""
        if not text:
            return np.empty(0, self.dtype)
        pieces = self.pieces(text)
        if pieces is None:
            return np.asarray(self.whole(text), self.dtype)
        found = list(map(self.young.get, pieces))
        if None in found:
            places = [i for i, x in enumerate(found) if x is None]
            new = {pieces[i]: self.old.get(pieces[i]) for i in places}
            missing = [p for p, x in new.items() if x is None]
            new.update(zip(missing, self.encode_pieces(missing), strict=True))
            for i in places:
                found[i] = new[pieces[i]]
            self.young.update(new)
            if len(self.young) >= CACHE_ENTRIES // 2:
                self.old, self.young = self.young, {}
        return np.frombuffer(b"".join(found), self.dtype)


def _drops_space(spec: dict) -> bool:
    """True for lower-casing word tokenizers that drop white space before anything else."""
    norm = json.dumps(spec.get("normalizer") or {})
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    first = pre[0] if pre else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return bool('"Lowercase"' in norm and first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and "^\\s" in pattern)


def _byte_level(spec: dict) -> bool:
    pre = spec.get("pre_tokenizer") or {}
    return spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")


_encoders: dict[str, Encoder] = {}


def forget() -> None:
    """Drop the worker's encoders and their caches."""
    _encoders.clear()


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
