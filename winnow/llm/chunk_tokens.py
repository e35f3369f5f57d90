"""Tokenizer ids of whole texts, with every distinct chunk of text encoded once per worker.

A chunk is a run of blanks, tabs and line feeds with the text up to the next such run.  Neither of the
tokenizers used here joins bytes across the start of a chunk: the byte-level BPE begins a new
pre-token where white space follows other text, and no piece of the SentencePiece model holds such a
place (``load_pieces`` checks that).  Texts with other white space, whose cutting rules depend on
more context, count as one chunk.  So the ids equal those of the whole text.

Words that recur with other signs behind them are many: where the ids of a chunk are those of its letters and
those of the signs that end it (``Endings``), it is cut there.  Texts are cut on their bytes, many at a time, and Arrow
finds the distinct chunks among them, so that Python looks up each of these once.

The cache stays in the Python worker between tasks.  When it holds ``most`` chunks (``MOST_CHUNKS``) or
``MOST_CHARS`` characters it keeps the chunks that it met most often, at most half of that, so its size
does not depend on the data.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Sequence
from itertools import chain, compress

import numpy as np
import pyarrow as pa

from winnow.llm.bundles import ranges

MOST_CHUNKS = 500_000
MOST_OF_BYTES = 1_000_000  # where one tokenizer alone has a cache, some 180 bytes each
MOST_CHARS = 16_000_000
TOGETHER, IN_A_TEXT = 20_000, 200  # chunks that go to the model in one call, and as one text
# Other white space by any definition, and NUL, up to U+00FF and above.
_ODD = "\x00\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_WIDE = re.compile("[\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_SIGNS = r"!-&(-/:-@\[-`{-~"  # of ASCII, but the apostrophe, which contractions begin with
_BLANK, _LETTER, _SIGN = 1, 2, 3
# Tables over all bytes.
_KIND = bytes(
    _LETTER if re.match("[A-Za-z]", c) else _SIGN if re.match(f"[{_SIGNS}]", c) else _BLANK if c == " " else 0
    for c in map(chr, range(0x80))
) + bytes(0x80)
# Bytes that can belong to such white space: control characters, and what begins the others in UTF-8.
_MAYBE_ODD = bytes(b in {*(ord(c) for c in _ODD if c < " "), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF} for b in range(0x100))


def _narrow(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _odd(text: str) -> bool:
    """Does the text hold white space other than blank, tab and line feed?"""
    return any(c in text for c in _ODD) or not (text.isascii() or _narrow(text)) and bool(_WIDE.search(text))


def chunks(text: str) -> list[str]:
    """The chunks of a text; joined they are the text."""
    return cut_texts(pa.array([text]))[0].to_pylist()


class _Places(dict):
    """Chunk to place; unknown chunks get the next place and wait in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = place = len(self)
        self.new.append(chunk)
        return place


class Endings:
    """Tells where signs end a chunk that is one or no blank, letters and then signs.

    Tokenizers that never join letters and signs give the ids of both in a row, unless one of their ``added``
    tokens reaches across (``fits`` is false then).  With ``lower`` the letters of such chunks become small ones.
    """

    def __init__(self, added: Sequence[str], lower: bool = False):
        self.lower = lower
        self.fits = not any(re.fullmatch(f" ?[{_LETTERS}]*[{_SIGNS}]*", token) for token in added)

    def __call__(self, raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Places in front of such signs in ``raw`` (UTF-8, changed if ``lower``), whose chunks start where ``begins`` is true."""
        kind = np.frombuffer(bytearray(raw).translate(_KIND), np.uint8)  # writable
        lead = np.flatnonzero(raw >= 0xC2)  # of characters above U+007F
        if len(lead):
            lead = lead[lead < len(raw) - 1]
            first, second = raw[lead], raw[lead + 1]
            latin = (first == 0xC3) & (second & 0xC0 == 0x80) & (second != 0x97) & (second != 0xB7)
            lead = lead[latin | (first == 0xC2) & ((second == 0xAA) | (second == 0xB5) | (second == 0xBA))]
            kind[lead] = kind[lead + 1] = _LETTER
        inside = ~begins
        sign, letter, blank = kind == _SIGN, kind == _LETTER, kind == _BLANK
        wrong = (kind == 0) | blank & inside
        wrong[0] |= sign[0]
        after, inside = slice(1, None), inside[1:]
        wrong[after] |= letter[after] & sign[:-1] & inside | sign[after] & (~inside | blank[:-1])
        at = np.flatnonzero(begins)
        other = np.zeros(len(at), bool)
        other[np.searchsorted(at, np.flatnonzero(wrong), side="right") - 1] = True

        def fitting(places: np.ndarray) -> np.ndarray:
            return places[~other[np.searchsorted(at, places, side="right") - 1]]

        if self.lower:
            high = lead[(raw[lead] == 0xC3) & (raw[lead + 1] < 0x9F)] + 1
            raw[fitting(np.flatnonzero((raw >= 0x41) & (raw <= 0x5A)))] += 0x20
            raw[fitting(high)] += 0x20
        return fitting(np.flatnonzero(sign[after] & letter[:-1] & inside) + 1)


def cut_texts(texts: pa.Array, parts: Endings | None = None, words: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The chunks of all texts in a row and their number per text; NULL is empty.

    ``parts`` cuts them further.  With ``words`` the chunks are what stands between ASCII white space.
    """
    texts = texts.cast(pa.string()).fill_null("")
    data = texts.buffers()[2] if len(texts) else None
    if not data or not data.size:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    place = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[place[0] : place[-1]]
    place -= place[0]
    if not len(raw):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    starts = place[:-1][place[1:] > place[:-1]]
    begins = np.zeros(len(raw), bool)
    if words:
        space = (raw == 32) | (raw >= 9) & (raw <= 13)
        begins[1:] = space[:-1]
        begins[starts] = True
        begins &= ~space
    else:
        space = (raw == 32) | (raw == 9) | (raw == 10)
        begins[1:] = space[1:] & ~space[:-1]
        begins[starts] = True
        for k in _odd_texts(raw, place, texts):
            begins[place[k] + 1 : place[k + 1]] = False
    at = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(at, place))
    if words:
        raw, begins = raw[~space], begins[~space]
    if parts and len(raw):
        more = parts(raw, begins)
        if words:  # places without white space
            text = np.searchsorted(np.cumsum(counts), np.searchsorted(np.flatnonzero(begins), more, "right") - 1, "right")
        else:
            text = np.searchsorted(place, more, side="right") - 1
        counts = counts + np.bincount(text, minlength=len(counts))
        begins[more] = True
    ends = np.r_[np.flatnonzero(begins), len(raw)].astype(np.int32)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(raw)), counts


def _odd_texts(raw: np.ndarray, place: np.ndarray, texts: pa.Array) -> list[int]:
    """Numbers of the texts that hold white space other than blank, tab and line feed."""
    mark = np.flatnonzero(np.frombuffer(raw.tobytes().translate(_MAYBE_ODD), bool))
    some = np.unique(np.searchsorted(place, mark, side="right") - 1)
    return [k for k in some.tolist() if _odd(texts[k].as_py())]


class ChunkCache:
    """Ids of texts from one or more encoders, each a function from chunks to their ids in a row and
    the number of ids of each.

    ``exact`` tells for a chunk and its ids per encoder whether the tokens spell the chunk.  ``parts`` cuts some
    chunks in two, whose ids in a row are those of the chunk.  ``words``: chunks hold no ASCII white space.
    """

    def __init__(
        self, encoders: Sequence[Callable], exact: Callable | None = None, most: int | None = None,
        parts: Endings | None = None, words: bool = False,
    ):
        self.encoders, self.exact, self.most, self.parts, self.words = encoders, exact, most, parts, words
        self.places = _Places()
        self.chars = 0
        self.flat = [np.zeros(0, np.uint32) for _ in encoders]
        self.sizes = [np.zeros(0, np.int64) for _ in encoders]
        self.right = np.zeros(0, bool)
        self.hits = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Keep the chunks that were met at least twice, or more often if these are too many."""
        names, least, most = list(self.places), 2, self.most or MOST_CHUNKS
        length = np.fromiter(map(len, names), np.int64, len(names))
        while True:
            kept = np.flatnonzero(self.hits >= least)
            if 2 * len(kept) <= most and 2 * length[kept].sum() <= MOST_CHARS:
                break
            least *= 2
        self.places = _Places()
        for k in kept.tolist():
            self.places[names[k]] = len(self.places)
        for side, (flat, sizes) in enumerate(zip(self.flat, self.sizes, strict=True)):
            self.flat[side] = flat[ranges((np.cumsum(sizes) - sizes)[kept], sizes[kept])]
            self.sizes[side] = sizes[kept]
        self.right = self.right[kept] if self.exact else self.right
        self.hits = self.hits[kept] // 2
        self.chars = int(length[kept].sum())

    def _learn(self) -> None:
        new = self.places.new
        if not new:
            return
        found = [encode(new) for encode in self.encoders]
        for k, (flat, size) in enumerate(found):
            self.flat[k] = np.concatenate([self.flat[k], flat.astype(np.uint32)])
            self.sizes[k] = np.concatenate([self.sizes[k], size])
        if self.exact:
            self.right = np.concatenate([self.right, self.exact(new, *found)])
        self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
        self.chars += sum(map(len, new))
        new.clear()

    def encode(self, texts: Sequence[str] | pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Per encoder the ids of all texts in a row and their number per text; whether all spell it."""
        self._make_room()
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        found, counts = cut_texts(texts, self.parts, self.words)
        numbered = found.dictionary_encode()  # so that each chunk is looked up once here
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.places.__getitem__, distinct), np.int64, len(distinct))
        return self._spelled(place[numbered.indices.to_numpy()], counts)

    def _make_room(self) -> None:
        if len(self.places) > (self.most or MOST_CHUNKS) or self.chars > MOST_CHARS:
            self._shrink()

    def _spelled(self, place: np.ndarray, counts: Sequence[int]):
        self._learn()
        self.hits += np.bincount(place, minlength=len(self.hits))
        ends = np.r_[0, np.cumsum(np.array(counts, np.int64))]
        all_ids, per_text = [], []
        for flat, sizes in zip(self.flat, self.sizes, strict=True):
            size = sizes[place]
            first = (np.cumsum(sizes) - sizes)[place]
            all_ids.append(flat[ranges(first, size)])
            per_text.append(np.diff(np.r_[0, np.cumsum(size)][ends]))
        right = np.ones(len(counts), bool)
        if self.exact:
            wrong = np.r_[0, np.cumsum(~self.right[place])]
            right = np.diff(wrong[ends]) == 0
        return all_ids, per_text, right


_HELD: dict[tuple, object] = {}


def held(key: tuple, make: Callable):
    """What ``make`` builds, kept in this worker for later tasks with the same key."""
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def in_a_row(lists: Sequence[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array, and the length of each."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum())), size


def byte_level_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level BPE uses for bytes: printable bytes stand for themselves,
    the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def interleave(which: np.ndarray, one: tuple, two: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their numbers of all chunks: ``one`` has those where ``which`` is true, ``two`` the others."""
    size = np.empty(len(which), np.int64)
    size[which], size[~which] = one[1], two[1]
    ids, mine = np.empty(size.sum(), np.uint32), np.repeat(which, size)
    ids[mine], ids[~mine] = one[0], two[0]
    return ids, size


def added_in_letters(added: Iterable[str]) -> bool:
    """Does an added token stand in a chunk of letters?"""
    return any(re.fullmatch(f" ?[{_LETTERS}]*", token) for token in added)


class Letters:
    """Ids of chunks of Latin letters, each one pre-token of a byte-level tokenizer of the library.

    They go to its model, which does the merges, many at a time as one text that is cut at line feeds: its
    normalizer and its rule for pre-tokens, which cost more than the merges, have nothing to do here.
    """

    def __init__(self, tokenizer, blank: str = "", lower: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model, self.lower = Tokenizer(tokenizer.model), lower
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.is_plain = re.compile(f"{blank}[{_LETTERS}]+").fullmatch
        self.stands_for = np.zeros(256, np.uint16)
        for char, byte in byte_level_alphabet().items():
            self.stands_for[byte] = ord(char)
        self.stands_for[10] = 10
        closing = tokenizer.model.end_of_word_suffix
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.lengths[i] = len(piece.removesuffix(closing)) if closing else len(piece)

    def __call__(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self._together(new[at : at + TOGETHER]) for at in range(0, len(new), TOGETHER)]
        return np.concatenate([ids for ids, _ in found]), np.concatenate([size for _, size in found])

    def _together(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joint = "\n".join(new)
        raw = np.frombuffer((joint.lower() if self.lower else joint).encode(), np.uint8)
        text = self.stands_for[raw].astype("<u2").tobytes().decode("utf-16-le")
        breaks = np.flatnonzero(raw == 10)
        some = breaks[IN_A_TEXT - 1 :: IN_A_TEXT].tolist()
        texts = [text[a + 1 : b] for a, b in zip([-1, *some], [*some, len(text)], strict=True)]
        found = self.model.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(one.ids for one in found), np.uint32)
        # A chunk ends with the token that ends at its last byte.
        ends = np.r_[breaks, len(raw)] - np.arange(len(new))
        after = np.cumsum(self.lengths[ids])
        at = np.searchsorted(after, ends) + 1
        if at[-1] != len(ids) or not np.array_equal(after[at - 1], ends):
            raise ValueError("the tokens do not spell the letters")
        return ids, np.diff(np.r_[0, at])

    def agrees(self, ids_of: Callable, probes: list[str]) -> bool:
        """Are the ids of the probes those of the whole tokenizer?"""
        try:
            return all(self([p])[0].tolist() == ids_of([p])[0] for p in probes)
        except (ValueError, IndexError):
            return False


class ByteLevel:
    """A byte-level BPE file of the tokenizers library; without ``special`` control strings are plain text."""

    def __init__(self, path: str, special: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        byte_of = byte_level_alphabet()
        added = {i: token.content for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.tokens[i] = added[i].encode() if i in added else bytes(byte_of[c] for c in piece)
        self.lengths = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self.letters = Letters(self.tokenizer, " ?")
        letters = "".join(c for c in map(chr, range(0x100)) if c.isalpha())  # all bytes that can come
        probes = [" the", "The", " \u00e9t\u00e9", "Stra\u00dfe", " \u00aa\u00b5", "x", " thTHEREwhednd", letters, " " + letters]
        if added_in_letters(added.values()) or not self.letters.agrees(self._ids, probes):
            self.letters = None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks.  Those of one or no blank and Latin letters need no more than the merges."""
        plain = np.array([self.letters and self.letters.is_plain(chunk) for chunk in new], bool)
        one = self.letters(list(compress(new, plain))) if plain.any() else in_a_row([])
        two = self._mixed(list(compress(new, ~plain))) if not plain.all() else in_a_row([])
        return interleave(plain, one, two)

    def _mixed(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks.  Those that white space sets apart are encoded as one text, which costs less, and
        cut at the bytes where they end."""
        joint = [c[0] in " \n\t" and c[-1] not in " \n\t" for c in new]
        if _odd("".join(new)):
            joint = [j and not _odd(c) for c, j in zip(new, joint, strict=True)]
        together = [c for c, j in zip(new, joint, strict=True) if j]
        ends = np.cumsum(np.fromiter((len(c.encode("utf-8", "replace")) for c in together), np.int64, len(together)))
        ids = np.array(self._ids(["".join(together)])[0], np.uint32)
        after = np.cumsum(self.lengths[ids])
        at = np.searchsorted(after, ends) + 1
        if len(ends) and (at[-1] != len(ids) or not np.array_equal(after[at - 1], ends)):
            return in_a_row(self._ids(new))  # some token spells something else
        alone, alone_size = in_a_row(self._ids([c for c, j in zip(new, joint, strict=True) if not j]))
        return interleave(np.array(joint, bool), (ids, np.diff(np.r_[0, at])), (alone, alone_size))


def byte_cache(path: str) -> ChunkCache:
    """The cache of a byte-level tokenizer that reads control strings as such."""

    def make() -> ChunkCache:
        encoder = ByteLevel(path, True)
        cut = Endings([token.content for token in encoder.tokenizer.get_added_tokens_decoder().values()])
        # Letters and signs of a chunk are pre-tokens of their own by the usual rule; a file with another one is seen here.
        probes = [" the,", " The.", "word;--", " et\u00e9%%%", " x)", " a_", " it\"", " don$$$", " h**", " s!?"]
        fits = all(sum(encoder._ids(cut_texts(pa.array([p]), cut)[0].to_pylist()), []) == encoder._ids([p])[0] for p in probes)
        return ChunkCache([encoder], most=MOST_OF_BYTES, parts=cut if fits and cut.fits else None)

    return held(("bytes", path), make)
