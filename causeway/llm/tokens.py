"""Token ids of a public byte-level vocabulary, cached by space-separated piece.

Pieces between single spaces are tokenized on their own, since no token of the vocabulary's pattern
reaches across a space that follows and precedes a visible character. The ids equal those of the
``tokenizers`` file of the same vocabulary (tested); ``tiktoken`` reads its ranks and is faster.
Texts that contain an added token of that file are tokenized as a whole.
"""

from __future__ import annotations

import base64
import json
from struct import pack

import numpy as np

CACHE_LIMIT = 300_000  # pieces kept per task; the cache is emptied when full
LONGEST_CACHED = 40  # characters


class Coder:
    """Texts to little-endian unsigned 32-bit ids. One object per task.

    With ``added``, the file's added tokens are found in texts, as the ``tokenizers`` library does unless
    its ``encode_special_tokens`` is set; without, they are text like any other.
    """

    def __init__(self, ranks_path: str, json_path: str, pattern: str, added: bool = False):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._added = {}
        if added:
            with open(json_path, encoding="utf-8") as file:
                told = file.read()  # only this list is parsed: vocabulary and merges would take much memory
            told = told[told.index('"added_tokens"') + len('"added_tokens"'):].lstrip(" \t\r\n:")
            self._added = {t["content"]: t["id"] for t in json.JSONDecoder().raw_decode(told)[0]}
            del told
        self._fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self._added)
        self._json_path, self._slow, self._cache = json_path, None, {}

    def _ids(self, text: str, special: bool = False) -> bytes:
        """``special``: the text holds added tokens."""
        try:
            ids = self._fast.encode(text, allowed_special="all") if special else self._fast.encode_ordinary(text)
        except Exception:  # its pattern engine gives up on very long runs of one class; the other library doesn't
            if self._slow is None:
                from tokenizers import Tokenizer

                self._slow = Tokenizer.from_file(self._json_path)
                self._slow.encode_special_tokens = not self._added
            ids = self._slow.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids) if len(ids) < 64 else np.asarray(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self._added):
            return self._ids(text, True)
        pieces = text.split(" ")
        n, parts = len(pieces), list(map(self._cache.get, pieces))
        parts[0] = None  # no space before it
        missing = [i for i, ids in enumerate(parts) if ids is None]
        upto = 0  # pieces before this are done
        for i in missing:
            if i < upto:
                continue
            piece = pieces[i]
            if i and piece and not piece[0].isspace() and not piece[-1].isspace() and not _open(pieces[i - 1]):
                ids = self._ids(" " + piece)
                if len(piece) <= LONGEST_CACHED:
                    if len(self._cache) >= CACHE_LIMIT:
                        self._cache.clear()
                    self._cache[piece] = ids
                parts[i] = ids
                continue
            # white space stays with what is before it, and what follows a space at an end stays with that
            first, last = i, i + 1
            while first and (_open(pieces[first - 1]) or not pieces[first] or pieces[first][0].isspace()):
                first -= 1
            while last < n and (_open(pieces[last - 1]) or not pieces[last] or pieces[last][0].isspace()):
                last += 1
            parts[first:last] = [self._ids((" " if first else "") + " ".join(pieces[first:last])), *[b""] * (last - first - 1)]
            upto = last
        return b"".join(parts)


def _open(piece: str) -> bool:
    """Whether the space after a piece belongs to a run of white space."""
    return not piece or piece[-1].isspace()


def byte_bpe() -> tuple[str, str, str]:
    """Arguments of ``Coder`` for the installed 50k byte-level vocabulary."""
    import public_tokenizers

    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"),
            public_tokenizers.PATTERN)
