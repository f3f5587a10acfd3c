"""Token ids of whole texts by a public tokenizer, and a document's ids with the end id."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import islice

import numpy as np

#: Pieces that a worker remembers, some 150 bytes each; beyond them the older half is forgotten.
CACHED = 1_000_000
#: Longer pieces between blanks are not remembered.
CACHED_CHARS = 64
#: Characters of new pieces that are tokenized in one call.
CALL_CHARS = 1 << 16
#: The next blank or the end after a space: there the run of blanks has to be seen whole.
_RUN = re.compile(r" (?:\s|$)")
#: Between a Latin letter or a digit and the marks that end its piece; every vocabulary splits there.
#: It starts with the first mark, which a scan finds faster than a place without width.
_END = re.compile(r"([.,;:!?#$%&*])(?<=[A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F].)(?=[.,;:!?#$%&*]*(?:\s|$))")


class Encoder:
    """Ids as the tokenizers library gives them with ``add_special_tokens=False``.

    Pieces between spaces, without the marks at their end, are tokenized by themselves and remembered. That changes nothing: byte-level
    vocabularies split before a space that stands alone (``spaced``), the others drop blanks. The new
    pieces of some texts are tokenized in few calls, with a special token between them, as it splits a text
    before all else. A text with longer runs of blanks in the first case, or with the mark of a special
    token, is encoded whole.
    """

    def __init__(self, path: str, end_id: int, spaced: bool, cached: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced, self.cached = Tokenizer.from_file(path), spaced, cached
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [str(t.content) for t in added.values()]
        cuts = [(n, str(t.content)) for n, t in added.items() if t.special and not (t.normalized or t.lstrip or t.rstrip)]
        self.cut = cuts[0] if cuts else None
        #: ids of pieces, those after a space with it
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        if not text:
            return b""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of different pieces, none of which holds a special token."""
        if self.cut is None:
            return {p: self._whole(p) for p in pieces}
        found, (number, mark), first = {}, self.cut, 0
        while first < len(pieces):
            end, chars = first, 0
            while end < len(pieces) and (end == first or chars < CALL_CHARS):
                chars += len(pieces[end])
                end += 1
            part = pieces[first:end]
            (encoded,) = self.tokenizer.encode_batch_fast([mark.join(part)], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            cuts = np.flatnonzero(ids == number)
            if len(cuts) != len(part) - 1:
                raise ValueError("a piece holds a special token")
            width, raw = self.dtype.itemsize, ids.astype(self.dtype).tobytes()
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            found |= {p: raw[a * width : b * width] for p, a, b in zip(part, starts, ends, strict=True)}
            first = end
        return found

    def _pieces(self, text: str) -> list[str] | None:
        """The text cut before its single spaces, or at blanks that count for nothing, and before marks.

        None if it can't be.
        """
        if any(s in text for s in self.special) or (self.spaced and _RUN.search(text)):
            return None
        if "\0" in text:
            return None
        text = _END.sub("\0\\1", text)
        if self.spaced:
            return text.replace(" ", "\0 ").split("\0")
        return text.replace("\n", "\0").replace(" ", "\0").split("\0")

    def documents(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids and the end id."""
        cut = [self._pieces(text or "") for text in texts]
        known = self.known
        # each piece is looked up once; where it is new its ids are filled in below
        found = [None if pieces is None else list(map(known.get, pieces)) for pieces in cut]
        missing = [[k for k, ids in enumerate(got or ()) if ids is None] for got in found]
        new = list({pieces[k] for pieces, at in zip(cut, missing, strict=True) for k in at})
        learned = self._learn(new)
        known.update(learned)
        out = []
        for text, pieces, got, at in zip(texts, cut, found, missing, strict=True):
            for k in at:
                got[k] = learned[pieces[k]]
            out.append((self._whole(text) if got is None else b"".join(got)) + self.end)
        for piece in new:
            if len(piece) > CACHED_CHARS:
                del known[piece]
        if len(known) > (self.cached or CACHED):
            for piece in list(islice(known, len(known) // 2)):
                del known[piece]
        return out

    def document(self, text: str | None) -> bytes:
        return self.documents([text])[0]


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int, spaced: bool, cached: int | None = None) -> Encoder:
    """One per worker process."""
    return Encoder(path, end_id, spaced, cached)


def wide(ids: bytes, dtype: np.dtype) -> bytes:
    """As little-endian unsigned 32-bit ids."""
    return np.frombuffer(ids, dtype).astype("<u4").tobytes()
