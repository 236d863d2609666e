"""Encoding of texts through a bounded table of their pieces, for splitters that never join over a lone space or line end."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space (every character that any splitter takes for it) beside white space or at an end: such texts are cut more carefully.
_WHITE = r"[\x09-\x0D\x1C-\x1F\x{85}\p{Z}]"
_IRREGULAR = rf"{_WHITE}{_WHITE}|\A{_WHITE}|{_WHITE}\z"
#: Before a space that has no white space on either side.
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: Signs that are no letters, digits, white space or apostrophes.
_SIGNS = ".,;:!?*#$%&|"


class ChunkCache:
    """``encode`` maps pieces of text to id bytes; pieces are cut at spaces and line ends between two non-white characters.

    The splitter must let a space stand only at the start of a match or inside white space, make such a line end a match of its own,
    and part letters and digits from the signs behind them, as the byte-level patterns do. Then the ids of a text are those
    of its pieces in order, and those of a piece are those of its word and of its closing signs. Each distinct piece of a
    call is looked up once; Arrow finds them and numpy puts the ids of the texts together. Two tables of up to
    ``most`` pieces are held: what is not asked for while the younger one fills is forgotten with the older one.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 500_000):
        self.encode, self.most, self.young, self.old = encode, most, {}, {}

    def _pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Keys of all pieces, text by text, and where each text starts. A piece that follows a space is held without it, any
        other one behind a NUL."""
        regular = pc.invert(pc.match_substring_regex(pa.array(texts, pa.large_string()), _IRREGULAR)).to_pylist()
        plain = ["\0" + t.replace("\n", " \0\n \0") for t, r in zip(texts, regular, strict=True) if r]
        lists = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        careful = [["\0" + first, *(piece[1:] for piece in rest)] for t, r in zip(texts, regular, strict=True) if not r for first, *rest in [_CUT.split(t)]]
        sizes = np.empty(len(texts), np.int64)
        is_regular = np.array(regular, bool)
        sizes[is_regular], sizes[~is_regular] = np.diff(lists.offsets.to_numpy()), [len(c) for c in careful]
        # All regular texts come first, then the others; ``starts`` has the texts in their own order.
        order = np.concatenate([np.flatnonzero(is_regular), np.flatnonzero(~is_regular)])
        starts = np.empty(len(texts), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return pa.concat_arrays([lists.flatten(), pa.array([p for c in careful for p in c], pa.large_string())]), np.stack([starts, starts + sizes])

    def ids(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        mine = [i for i, t in enumerate(texts) if t and "\0" not in t]
        for i, t in enumerate(texts):
            if "\0" in t:  # a NUL marks pieces here
                out[i] = self.encode([t])[0]
        if not mine:
            return out
        pieces, bounds = self._pieces([texts[i] for i in mine])
        found = pieces.dictionary_encode()
        coded = self._look_up(found.dictionary.to_pylist())
        pool = np.frombuffer(b"".join(coded), "<u4")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        which = found.indices.to_numpy()
        counts = sizes[which]
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = (np.cumsum(sizes) - sizes)[which]
        flat = pool[np.arange(ends[-1]) + np.repeat(first - ends[:-1], counts)]
        for i, a, b in zip(mine, *ends[bounds].tolist(), strict=True):
            out[i] = flat[a:b].tobytes()
        return out

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        missing = [piece for piece in pieces if piece not in self.young]
        again = [piece for piece in missing if piece in self.old]
        self.young.update((piece, self.old[piece]) for piece in again)
        self._learn([piece for piece in missing if piece not in self.young])
        return [self.young[piece] for piece in pieces]

    def _learn(self, pieces: list[str]) -> None:
        parts: list[tuple[str, str, str]] = []
        fresh: set[str] = set()
        for piece in pieces:
            word = piece.rstrip(_SIGNS)
            if len(word) < len(piece) and word and word[-1].isalnum():
                signs = "\0" + piece[len(word) :]
                parts.append((piece, word, signs))
                fresh.add(word)
                fresh.add(signs)
            else:
                fresh.add(piece)
        todo = list(fresh - self.young.keys())
        coded = self.encode([piece[1:] if piece.startswith("\0") else " " + piece for piece in todo]) if todo else []
        self.young.update(zip(todo, coded, strict=True))
        for piece, word, signs in parts:
            self.young[piece] = self.young[word] + self.young[signs]
