"""Token ids of whole texts with a public tokenizer file, exact and fast.

Byte-pair merges cross neither a space nor a line end between two visible
characters, nor the place where letters end and punctuation begins, so the ids of
a text are the ids of its pieces in order. Texts are cut together: each different
word of many texts is looked up once, and arrays lay out the ids. Each Python
worker keeps the ids of pieces it has met, up to a bound, and gives only new
pieces to the tokenizer: words of common letters straight to its merges, all
others in batches through all of its steps. White space that touches other white
space is not used as a cut: such pieces stay joined. A text that quotes a special
token, in any case, is encoded whole, so that it gets the ids the library gives
by default.
"""

from __future__ import annotations

import gc
import os
import re
import string
from array import array
from collections.abc import Callable, Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

MAX_PIECES = 800_000
LONGEST_PIECE = 40
# Texts are cut together until they pass this many characters, which bounds the arrays.
MAX_CHARACTERS = 1 << 23
_VISIBLE = frozenset(string.ascii_letters + string.digits + string.punctuation) | {
    c for c in map(chr, range(0xC0, 0x250)) if c.isalpha()}
# Words of these letters are one pre-token and equal to their normal form, whatever the Unicode version.
_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+").fullmatch
# Punctuation behind a word of common letters is a piece of its own; apostrophes may belong to either side.
_TAIL = "".join(c for c in string.punctuation if c != "'")
_PROBES = (" Then", " \u00c9t\u00e9", " fran\u00e7ais", " Gr\u00f6\u00dfe", " xq", " I")
_workers: dict[str, Pieces] = {}


class Pieces:
    """Ids of pieces as little-endian 32-bit bytes, remembered across the batches of a worker.

    New pieces are encoded as one text, parted by a special token, which the
    tokenizer sets apart before it looks at anything else.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        self.whole = Tokenizer.from_file(path)  # gives the library's own ids
        added = self.whole.get_added_tokens_decoder()
        self.mark, part = max(added.items())
        self.part = part.content
        self.quoted = re.compile("|".join(re.escape(t.content) for t in added.values()), re.IGNORECASE).search
        self.sign = os.path.commonprefix([t.content for t in added.values()])[:1]
        self.merges = self.whole.model
        self.merges._resize_cache(0)  # every piece is given once
        #: Ids of words that follow a space, and of those that start a line.
        self.known: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        #: Of punctuation behind a word of common letters, learned apart from it.
        self.tails: dict[str, bytes] = {"": b""}
        self.spelled = self._spelling()
        self.line_end = self._learn(["\n"])["\n"]

    def _spelling(self) -> tuple[Callable[[str], str], Callable[[str], str]] | None:
        """How a word after a space, and one without, is written for the merges alone, if a usual way gives the tokenizer's ids."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies leave as they are
        others = iter(range(256, 512))
        letters = {b: b if b in plain else next(others) for b in range(256)}

        def bytewise(w: str) -> str:
            return w if w.isascii() and w.isalpha() else w.encode().decode("latin-1").translate(letters)

        space = bytewise(" ")
        for ways in ((lambda w: space + bytewise(w), bytewise), (lambda w: bytewise(w.lower()),) * 2):
            if all([t.id for t in self.merges.tokenize(way(p[1:]))] == self.whole.encode(p[skip:], add_special_tokens=False).ids
                   for p in _PROBES for skip, way in enumerate(ways)):
                return ways
        return None

    def _learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        plain = list(pieces)
        learned = dict.fromkeys(plain, b"")  # in the given order
        for at in range(0, len(plain), 20_000):
            some = plain[at:at + 20_000]
            [found] = self.whole.encode_batch_fast([self.part.join(some)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
            content, start = ids.tobytes(), 0
            for p, end in zip(some, ends, strict=True):
                learned[p] = content[4 * start:4 * end]
                start = end + 1
        return learned

    def _remember(self, words: set[str], known: dict[str, bytes], bare: bool) -> None:
        """Learn words that follow a space, or start a line."""
        rest = words
        if self.spelled:
            merged, spell, rest = self.merges.tokenize, self.spelled[bare], []
            for w in words:
                if w.isascii() and w.isalpha() or _LETTERS(w):
                    known[w] = array("I", [t.id for t in merged(spell(w))]).tobytes()
                else:
                    rest.append(w)
        known.update(zip(rest, self._learn([w if bare else " " + w for w in rest]).values()))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text; a null text has none."""
        collects = gc.isenabled()
        gc.disable()  # nothing made here refers to itself, and a collection would go through all of it
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        out, marked, places, held = [b""] * len(texts), [], [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.sign in text and self.quoted(text):
                out[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            marked.append("\n\n" + text.replace("\n", " \n"))  # one cut finds all words and tells where they stand
            places.append(i)
            held += len(text)
            if held > MAX_CHARACTERS:
                self._encode_marked(texts, marked, places, out)
                marked, places, held = [], [], 0
        if marked:
            self._encode_marked(texts, marked, places, out)
        return out

    def _encode_marked(self, texts: list[str | None], marked: list[str], places: list[int], out: list[bytes]) -> None:
        """Put the ids of the texts at ``places`` into ``out``: those of the different words, laid out in the order of the words."""
        for held in (self.known, self.bare, self.tails):
            if len(held) > MAX_PIECES:  # common pieces are met early: the older half stays
                for w in list(islice(held, MAX_PIECES // 2, None)):
                    del held[w]
        known, bare, tails = self.known, self.bare, self.tails
        split = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(known.get, words))
        new, passing, odd = [], {}, []
        for k in [k for k, found in enumerate(ids) if found is None]:
            w = words[k]
            body = w.lstrip("\n")
            mark = len(w) - len(body)  # 0 after a space, 1 at the start of a line, 2 at the start of a text
            if not (w.isascii() and w.isalnum() or body and _visible(body[-1]) and (mark == 2 or _visible(body[0]))):
                odd.append(k)
            elif len(body) > LONGEST_PIECE:
                passing[k] = mark, body if mark else " " + w
            else:
                stem = body.rstrip(_TAIL) if body[-1] in _TAIL else body
                if not _LETTERS(stem):
                    stem = body
                new.append((k, mark, stem, body[len(stem):]))
        self._remember({stem for _, mark, stem, _ in new if not mark}.difference(known), known, bare=False)
        self._remember({stem for _, mark, stem, _ in new if mark}.difference(bare), bare, bare=True)
        tails.update(self._learn({tail for *_, tail in new}.difference(tails)))
        for k, mark, stem, tail in new:
            found = (bare if mark else known)[stem] + tails[tail]
            if tail and not mark:
                known[words[k]] = found
            ids[k] = self.line_end + found if mark == 1 else found
        learned = self._learn({piece for _, piece in passing.values()})  # not remembered
        for k, (mark, piece) in passing.items():
            ids[k] = self.line_end + learned[piece] if mark == 1 else learned[piece]
        for k in odd:
            ids[k] = b""

        at, bounds = coded.indices.to_numpy(), split.offsets.to_numpy()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = sizes[at]
        ends = np.cumsum(n)
        shift = (np.cumsum(sizes) - sizes)[at]
        shift -= ends
        shift += n
        taken = np.repeat(shift, n)
        taken += np.arange(len(taken))
        content = np.frombuffer(b"".join(ids), "<u4")[taken].tobytes()
        del n, shift, taken
        cuts = (4 * np.append(0, ends)[bounds]).tolist()
        for i, start, end in zip(places, cuts, cuts[1:]):
            out[i] = content[start:end]
        if odd:
            is_odd = np.zeros(len(words), bool)
            is_odd[odd] = True
            whole = {places[k]: _cut(texts[places[k]]) for k in np.flatnonzero(np.add.reduceat(is_odd[at], bounds[:-1])).tolist()}
            learned = self._learn({p for pieces in whole.values() for p in pieces if p[0] != " " or p[1:] not in known})
            for i, pieces in whole.items():
                out[i] = b"".join([learned[p] if p in learned else known[p[1:]] for p in pieces])


def _visible(c: str) -> bool:
    return c in _VISIBLE or c.isalpha()


def _cut(text: str) -> list[str]:
    """The text in pieces, each but the first with the space before it."""
    pieces = text.split(" ")
    out = [pieces[0]] if pieces[0] else []
    glue = not (pieces[0] and _visible(pieces[0][-1]))
    for p in pieces[1:]:
        if glue or not p or not _visible(p[0]):
            if out:
                out[-1] += " " + p
            else:
                out.append(" " + p)
        else:
            out.append(" " + p)
        glue = not (p and _visible(p[-1]))
    return out


def pieces_of(path: str) -> Pieces:
    """The worker's own memory for a tokenizer file."""
    if path not in _workers:
        _workers[path] = Pieces(path)
    return _workers[path]
