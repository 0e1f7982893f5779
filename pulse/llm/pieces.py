"""Encoding of whole texts by pieces between safe cuts, each distinct piece once.

A pre-tokenizer of the usual pattern always begins a new match at a space that is followed
by something that is no white space, whatever stands before it; at a single newline and
behind it, if that is followed so; and at an ASCII sign behind a letter or digit. Texts may
thus be cut there and the pieces encoded on their own. The texts of a batch are cut together
by numpy, and Arrow numbers their distinct pieces, so Python looks at each piece once a
batch. Most have been seen before, so their ids come from bounded tables; the rest goes
through the tokenizer's own model. A piece of letters needs no pattern.

The file's added tokens are matched first, as the library does: a text is split at them,
longest first at each place, and what lies between is encoded as texts of their own.
"""

import codecs
import os
import re

import numpy as np
import pyarrow as pa

MAX_ENTRIES = 225_000  # pieces used of late, and as many used before; some 35 MB each
MAX_WORDS = 50_000  # pre-tokens of other pieces than words; a full table is filled anew
MAX_PIECE = 64  # longer pieces are encoded each time
SLICE = 4 << 20  # bytes of text that are cut at a time, bounds the arrays

_SURE, _ALNUM, _SIGN, _SPACE, _NEWLINE, _MAYBE, _LEAD, _TRAIL = (1 << i for i in range(8))
_WHITE = b" \t\n\v\f\r"


def _opens(piece):
    """Whether a piece begins with a character that is surely no white space."""
    if not piece:
        return False
    first = piece[0]
    if first < 0x80:
        return 0x20 < first < 0x7F
    return not piece[:4].decode("utf-8", "ignore")[:1].isspace()


def cut(text):
    """Pieces of a text (bytes). All but the first lack the space they begin with."""
    parts = text.split(b" ")
    if all(map(_opens, parts[1:])):
        return parts
    pieces = parts[:1]
    for part in parts[1:]:
        if _opens(part):
            pieces.append(part)
        else:
            pieces[-1] += b" " + part
    return pieces


def _byte_classes():
    """Bits of what each byte may be, as a table for ``bytes.translate``."""
    bits = bytearray(256)
    for b in range(256):
        visible = 0x20 < b < 0x7F
        alnum = b < 0x80 and chr(b).isalnum()
        maybe = b in (0xC2, 0xE1, 0xE2, 0xE3)  # some characters of these are white space
        lead = 0xC3 <= b <= 0xC9 or b in (0xD0, 0xD1)  # two bytes; letters but for two signs
        trail = 0x80 <= b < 0xC0 and b not in (0x97, 0xB7)
        bits[b] = (
            _SURE * (visible or (b >= 0xC3 and not maybe)) + _ALNUM * alnum
            + _SIGN * (visible and not alnum) + _SPACE * (b == 0x20) + _NEWLINE * (b == 0x0A)
            + _MAYBE * maybe + _LEAD * lead + _TRAIL * trail
        )
    return bytes(bits)


_CLASSES = _byte_classes()
_BLACK = bytes([b not in _WHITE for b in range(256)])
_LONG_CUT = re.compile(b" (?=[!-~])")


def _no_space(data, at):
    """Which characters that begin at ``at`` with a byte of ``_MAYBE`` are surely no white space."""
    last = len(data) - 1
    a, b, c = data[at], data[np.minimum(at + 1, last)], data[np.minimum(at + 2, last)]
    return np.select(
        [a == 0xC2, a == 0xE1, a == 0xE2],
        [(b != 0x85) & (b != 0xA0), b != 0x9A, np.where(b == 0x80, (c >= 0x90) & (c < 0xA8), b != 0x81)],
        (b != 0x80) | (c != 0x80),
    )


def _cuts(data, starts, ends, spaced):
    """Where the pieces of texts begin, which stand in ``data`` without a gap; none is empty."""
    kind = np.frombuffer(data.translate(_CLASSES), np.uint8)
    # a sign behind a letter or digit
    begins = np.zeros(len(kind), bool)
    begins[1:] = (kind[1:] & (kind[:-1] << 1) & _SIGN) != 0
    begins[2:] |= ((kind[2:] & _SIGN) != 0) & ((kind[1:-1] & _TRAIL) != 0) & ((kind[:-2] & _LEAD) != 0)
    if spaced:
        follows = np.zeros(len(kind), np.uint8)
        np.bitwise_and(kind[1:], _SURE, out=follows[:-1])
        maybe = 1 + np.flatnonzero((kind[1:] & _MAYBE) != 0)
        maybe = maybe[(kind[maybe - 1] & (_SPACE | _NEWLINE)) != 0]
        if len(maybe):
            follows[maybe - 1] = _no_space(np.frombuffer(data, np.uint8), maybe)
        follows[ends - 1] = 0
        white = kind & (follows * (_SPACE | _NEWLINE))
        begins |= white != 0
        begins[1:] |= white[:-1] == _NEWLINE
        begins[starts] = True
        return np.flatnonzero(begins)
    black = np.frombuffer(data.translate(_BLACK), bool)
    begins[1:] |= black[1:] & ~black[:-1]
    begins[starts] = True
    return np.flatnonzero(begins & black)


def _byte_letters():
    """The letter a byte-level vocabulary writes for each byte, byte by byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = {b: chr(256 + i) for i, b in enumerate(others)}
    return "".join([letters.get(b, chr(b)) for b in range(256)])


class PieceEncoder:
    """Ids of texts as packed little-endian integers, from a file of the tokenizers library.

    With ``spaced`` pieces keep the space they begin with (byte-level vocabularies); without,
    texts are cut at ASCII white space, which the tokenizer drops anyway. The result equals
    ``encode(text, add_special_tokens=False).ids`` of the library for every text. Without a
    ``dtype`` ids are as wide as the vocabulary asks for.
    """

    def __init__(self, path, dtype="<u4", spaced=True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if dtype is None:
            dtype = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.dtype, self.spaced = np.dtype(dtype), spaced
        self.letters = _byte_letters()
        self.packed = [np.array(i, self.dtype).tobytes() for i in range(self.vocabulary)]
        self.model = self.tokenizer.model
        self.normalizer = self.tokenizer.normalizer
        self.pre_tokenizer = self.tokenizer.pre_tokenizer
        self.pieces, self.older, self.words = {}, {}, {}
        self._added_tokens()

    def _added_tokens(self):
        """Pattern and ids of the added tokens, and the beginning they share."""
        self.added = {}
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.lstrip or token.rstrip or token.single_word or token.normalized:
                raise ValueError(f"added token {token.content!r} is not matched as it stands")
            self.added[token.content.encode()] = self.packed[i]
        longest = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")")
        self.shared = os.path.commonprefix(longest)

    def _tokens(self, word):
        """Ids of one pre-token by the tokenizer's model."""
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(word)])

    def _word(self, word):
        ids = self.words.get(word)
        if ids is None:
            ids = self._tokens(word)
            if len(word) <= MAX_PIECE:
                if len(self.words) >= MAX_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _texts(self, pieces):
        """Pieces as normalised texts."""
        texts = [piece.decode("utf-8") for piece in pieces]
        if self.normalizer is None:
            return texts
        normal, words = self.normalizer.normalize_str, []
        for i, text in enumerate(texts):
            if text.isascii():
                texts[i] = text.lower()
            elif text.isalpha():
                words.append(i)
            else:
                texts[i] = normal(text)
        # letters take no part in what stands beyond white space, so words go together
        for at in range(0, len(words), 100):
            some = words[at : at + 100]
            parts = normal("\n".join([texts[i] for i in some])).split(" ")
            if len(parts) != len(some):
                parts = [normal(texts[i]) for i in some]
            for i, part in zip(some, parts):
                texts[i] = part
        return texts

    def _piece(self, text):
        """Ids of one normalised piece. Plain words need no pattern; others the library splits."""
        lead = self.spaced and text[:1] == " "
        core = text[1:] if lead else text
        if core.isalpha():  # kept among the pieces, not as a word as well
            if core.isascii():
                return self._tokens("\u0120" + core if lead else core)
            return self._tokens(codecs.charmap_decode(text.encode(), "strict", self.letters)[0])
        split = self.pre_tokenizer.pre_tokenize_str(text)
        return b"".join([self._word(word) for word, _ in split])

    def _ids(self, pieces):
        """Packed ids of distinct pieces."""
        found = list(map(self.pieces.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            older, new = self.older, []
            for i in missing:
                ids = found[i] = older.get(pieces[i])
                if ids is None:
                    new.append(i)
            for i, text in zip(new, self._texts([pieces[i] for i in new])):
                found[i] = self._piece(text)
            known = self.pieces
            for i in missing:
                if len(pieces[i]) <= MAX_PIECE:
                    if len(known) >= MAX_ENTRIES:
                        self.older, known = known, {}
                    known[pieces[i]] = found[i]
            self.pieces = known
        return found

    def _stretches(self, texts):
        """Packed ids of texts without added tokens, none of them empty."""
        data = b"".join(texts)
        ends = np.cumsum([len(text) for text in texts])
        starts = np.concatenate([[0], ends[:-1]])
        cuts = _cuts(data, starts, ends, self.spaced)
        first = np.searchsorted(cuts, np.append(starts, len(data)))
        if not self.spaced:
            black = np.frombuffer(data.translate(_BLACK), bool)
            cuts = (np.cumsum(black, dtype=np.int32) - 1)[cuts]
            data = data.translate(None, _WHITE)
        offsets = np.append(cuts, len(data)).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        numbered = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), buffers).dictionary_encode()
        ids = self._ids(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        width = self.dtype.itemsize
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        number = numbered.indices.to_numpy()
        counts = sizes[number]
        after = np.concatenate([[0], np.cumsum(counts)])
        # an id's place among those of the distinct pieces
        place = np.repeat((np.cumsum(sizes) - sizes)[number] - after[:-1], counts)
        place += np.arange(len(place))
        packed = np.frombuffer(b"".join(ids), self.dtype)[place].tobytes()
        bounds = (after[first] * width).tolist()
        return [packed[a:b] for a, b in zip(bounds, bounds[1:])]

    def _split(self, text):
        """A text's stretches, each with the ids that stand before it: an added token's or none."""
        parts = [text]
        if self.added and self.shared in text:
            parts = self.at_added.split(text)  # every second one is an added token
        before = b""
        for i, part in enumerate(parts):
            if i % 2:
                before = self.added[part]
                continue
            at = 0
            while len(part) - at > SLICE and (cut := _LONG_CUT.search(part, at + SLICE)):
                yield before, part[at : cut.start()]
                before, at = b"", cut.start()
            yield before, part[at:]
            before = b""

    def texts(self, texts):
        """Packed ids of each text (bytes; None counts as empty)."""
        out = [[] for _ in texts]
        held, places, size = [], [], 0

        def encode():
            for (parts, i), ids in zip(places, self._stretches(held) if held else []):
                parts[i] = ids
            held.clear(), places.clear()

        for parts, text in zip(out, texts):
            for before, part in self._split(text or b""):
                parts += before, b""
                if part:
                    held.append(part), places.append((parts, len(parts) - 1))
                    size += len(part)
                    if size >= SLICE:
                        encode()
                        size = 0
        encode()
        return [b"".join(parts) for parts in out]

    def text(self, text):
        """Packed ids of one text (bytes; None counts as empty)."""
        return self.texts([text])[0]


_ENCODERS = {}


def piece_encoder(path, dtype="<u4", spaced=True):
    """A ``PieceEncoder``, one for each file in a worker process."""
    key = (path, dtype, spaced)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, dtype, spaced)
    return _ENCODERS[key]
