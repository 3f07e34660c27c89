"""Token ids of texts by the tokenizers library, a word at a time from a cache.

Neither tokenizer here forms a token across a single space or line break between two characters that
aren't white space: one drops white space; the other puts a space at the head of the next token and makes
a line break one of its own. So a text cut at such places gives the same ids piece by piece. Texts with
other spacing, and those that hold an added token such as ``<|endoftext|>``, are encoded whole, with the
library's own settings.

The pieces of a batch are made distinct by Arrow, so a piece is looked up once per batch. Ids are kept in
a cache of two generations and bounded size per Python worker, which outlives its tasks. A new piece of
plain Latin letters goes to the library's BPE model directly, as no rule of its pre-tokenizer can cut it;
ASCII marks after it, other than apostrophes, are a token run of their own. All others take the library's full way.
Where letters are lower-cased and breaks dropped anyway, A-Z are lower-cased and breaks made spaces before pieces
are told apart, except in texts with combining marks: few of these have a composed form in one case only.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHE_PIECES = 200_000
LONGEST_KEPT = 64
ENDS_KEPT = 4096
BATCH_BYTES = 3 << 20

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = rf"^{_SPACE}|{_SPACE}$|{_SPACE}{_SPACE}"
_COMBINING = r"[\x{300}-\x{36f}]"
_PLAIN = re.compile(r"(\n?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter of each byte: itself if it is visible in Latin-1, else from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceEncoder:
    def __init__(self, path: str, kept: int = CACHE_PIECES):
        self.kept = kept
        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.space = _byte_letters()[32]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.line = self._whole(["a\nb"])[0][4:-4]  # what a line break becomes
        spaced = self._whole(["a b"])[0][4:]
        self.folds = spaced == self._whole(["b"])[0]  # white space is dropped and letters are lower-cased
        odd = [_ODD, *(f"(?i:{a})" for a in added)]  # case is folded where the tokenizer folds it
        self.odd = "|".join([*odd, _COMBINING] if self.folds else odd)
        self.ends = {"": b""}

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _word(self, word: str, spaced: bool) -> bytes:
        word = word.lower() if self.folds else " " + word if spaced else word
        if word.isascii():
            mapped = word.replace(" ", self.space, 1)
        else:
            mapped = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _end(self, marks: str) -> bytes | None:
        """The ids of marks after a letter; None if there is no room for more of them."""
        ids = self.ends.get(marks)
        if ids is None and len(marks) <= LONGEST_KEPT and len(self.ends) < ENDS_KEPT:
            ids = self.ends[marks] = self._whole(["a" + marks])[0][4:]
        return ids

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        found, hard = {}, []
        for piece in pieces:
            m = _PLAIN.fullmatch(piece)
            end = self._end(m[2]) if m else None
            if end is None:
                hard.append(piece)
                continue
            stem = m[1]
            ids = (found.get(stem) or self.young.get(stem) or self.old.get(stem)) if m[2] else None
            if ids is None:
                ids = found[stem] = self.line + self._word(stem[1:], False) if stem[0] == "\n" else self._word(stem, True)
            if m[2]:
                found[piece] = ids + end
        # a piece that begins with a line break stands after one, any other after a space
        texts = [p if p[:1] == "\n" else " " + p for p in hard]
        for at in range(0, len(hard), 4096):
            for piece, text, ids in zip(hard[at : at + 4096], texts[at : at + 4096], self._whole(texts[at : at + 4096]), strict=True):
                found[piece] = ids
        return found

    def _ids(self, pieces: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        known = list(map(young.get, pieces))
        missing = []
        for i in [i for i, ids in enumerate(known) if ids is None]:
            ids = old.get(pieces[i])
            if ids is None:
                missing.append(i)
            else:
                known[i] = young[pieces[i]] = ids
        if missing:
            new = self._learn([pieces[i] for i in missing])
            for i in missing:
                known[i] = new[pieces[i]]
            young.update((k, v) for k, v in new.items() if len(k) <= LONGEST_KEPT)
        if len(young) > self.kept:
            self.old, self.young = young, {}
        return known

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no nulls), and how many each text has."""
        odd = pc.match_substring_regex(column, self.odd).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(odd)
        special = self._whole(column.take(pa.array(at)).to_pylist()) if len(at) else []
        if len(at):
            column = pc.if_else(pa.array(odd), "", column)
        if self.folds:
            spaced = pc.replace_substring(pc.ascii_lower(column), "\n", " ")
        else:  # every piece follows a line break or a space; the break put before each text is taken off again
            lined = pc.replace_substring(pc.binary_join_element_wise("\n", column, ""), "\n", " \n")
            spaced = pc.utf8_slice_codeunits(lined, 1)
        split = pc.split_pattern(spaced, " ")
        coded = split.flatten().dictionary_encode()
        lists = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(lists), "<u4")
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        starts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        n = sizes[index]
        place = np.cumsum(n) - n
        ids = flat[np.repeat(starts[index] - place, n) + np.arange(n.sum())]
        offsets = split.offsets.to_numpy()
        counts = np.add.reduceat(n, offsets[:-1] - offsets[0]) if len(column) else np.zeros(0, np.int64)
        extra = 0 if self.folds else len(self.line) // 4
        if extra:
            first = np.cumsum(counts) - counts
            keep = np.ones(len(ids), bool)
            for k in range(extra):
                keep[first + k] = False
            ids, counts = ids[keep], counts - extra
        if len(at):
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, x in zip(at, special, strict=True):
                parts[i] = np.frombuffer(x, "<u4")
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, counts

    def encode_ended(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids with the end id after each text, as int32, and the offsets of the texts."""
        ids, counts = self.encode(column)
        offsets = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int32)
        out = np.full(offsets[-1], end_id, np.int32)
        inner = np.ones(len(out), bool)
        inner[offsets[1:] - 1] = False
        out[inner] = ids
        return out, offsets


@lru_cache(maxsize=2)
def encoder(path: str, kept: int = CACHE_PIECES) -> PieceEncoder:
    """One per worker process and vocabulary; ``kept`` pieces are a generation of its cache."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return PieceEncoder(path, kept)
