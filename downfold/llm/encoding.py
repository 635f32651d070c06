"""Token ids of whole texts with a public tokenizer file, quick for byte-level BPE.

Such a tokenizer splits a text into words before it merges, and no word has a space inside or
behind. So a text can be cut before every space that follows something visible, each piece
encoded alone, and the pieces' ids remembered.
"""

import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces remembered by a task's Python worker, about 100 MB.
PIECES_KEPT = 500_000
#: Bytes of text that are cut together, and words given to the model in one call.
CUT_BYTES = 4 << 20
WORDS_A_CALL = 512

_BLANK_RUN = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACED = re.compile(b" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:$%&*#|()]*)")


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(hidden)}


def _table(*parts: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(b"".join(parts))] = True
    return out


_VISIBLE = _table(bytes(range(0x21, 0x7F)))
_LETTERS = _table(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
#: First bytes of characters none of which is blank.
_LEADS = _table(bytes(range(0xC3, 0xE0)), bytes(range(0xE4, 0xF5)))
_MARKS = _table(b".,!?;:$%&*#|()")
#: Blanks of three bytes, and a few characters beside them.
_BLANKS = [(0xE1, 0x9A, 0x80, 0x80), (0xE1, 0xA0, 0x8E, 0x8E), (0xE2, 0x80, 0x80, 0x8F), (0xE2, 0x80, 0xA8, 0xAF), (0xE2, 0x81, 0x9F, 0x9F), (0xE3, 0x80, 0x80, 0x80)]


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of UTF-8 ``data`` where a word of the tokenizer ends whatever stands around; not all of them.

    These are a space behind something visible, both sides of a line break between visible
    characters, and a mark behind a letter.
    """
    if len(data) < 2:
        return np.empty(0, np.int64)
    before, here = data[:-1], data[1:]
    visible = np.r_[False, _VISIBLE[before]]
    letter = np.r_[False, _LETTERS[before]]
    # behind a character of several bytes: its first byte tells
    odd = np.flatnonzero(before >= 0x80) + 1
    odd = odd[data[odd] < 0x80]
    one, two = data[odd - 1], data[np.maximum(odd - 2, 0)]
    letter[odd] = (two == 0xC3) & (one != 0x97) & (one != 0xB7)
    three = data[np.maximum(odd - 3, 0)]
    blank = np.zeros(len(odd), bool)
    for first, second, low, high in _BLANKS:
        blank |= (three == first) & (two == second) & (one >= low) & (one <= high)
    visible[odd] = ((two >= 0xC3) & (two < 0xE0)) | ((two >= 0x80) & (two < 0xC0) & ~blank)
    at_space = (data == 0x20) & visible
    lines = np.flatnonzero((data[1:-1] == 0x0A) & visible[1:-1]) + 1
    after = data[lines + 1]
    lines = lines[_VISIBLE[after] | _LEADS[after]]
    found = at_space | (_MARKS[data] & letter)
    found[lines] = True
    found[lines + 1] = True
    return np.flatnonzero(found)


class _Remembered(dict):
    """What ``encode`` gives for a key."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, key: str) -> bytes:
        if len(self) >= PIECES_KEPT:
            self.clear()
        self[key] = ids = self.encode(key)
        return ids


class Encoder:
    """``ids(text)`` equals the tokenizer's own ids without special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.letter = "H" if self.size <= 1 << 16 else "I"
        before = form.get("pre_tokenizer") or {}
        self.by_pieces = (
            not form.get("normalizer")
            and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and form["model"]["type"] == "BPE"
        )
        self.added = [t["content"] for t in form.get("added_tokens", [])]
        self.tokenize = self.tokenizer.model.tokenize
        self.characters = _byte_characters()
        self.space = self.characters[0x20]
        #: Ids of a space and the key, of the key at the start of a line, and of marks behind a word.
        self.pieces = _Remembered(self._piece)
        self.heads = _Remembered(self._head)
        self.marks = _Remembered(self._word)

        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.at_once = self.by_pieces and self._no_word_over_a_space(form["model"])

    def _no_word_over_a_space(self, model: dict) -> bool:
        """Whether the model merges words that begin with a space alike alone and in a row."""
        plain = not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        vocab = model["vocab"]
        whole = all(c in vocab for c in self.characters.values())
        self.starts = np.zeros(self.size, bool)
        for token, i in vocab.items():
            self.starts[i] = token.startswith(self.space)
        used = {self.characters[b] for b in range(256) if _LETTERS[b] or b in (0x20, 0xC3) or 0x80 <= b < 0xC0}
        over = (token for token in vocab if self.space in token.lstrip(self.space))
        return plain and whole and not any(used.issuperset(token) for token in over)

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters behind a space, many in a call."""
        out = []
        for at in range(0, len(words), WORDS_A_CALL):
            part = words[at : at + WORDS_A_CALL]
            row = b"".join(part)
            shown = row.decode("ascii").replace(" ", self.space) if row.isascii() else row.decode("latin-1").translate(self.characters)
            ids = np.array([t.id for t in self.tokenize(shown)], self.dtype)
            first = np.flatnonzero(self.starts[ids])
            if len(first) != len(part):
                raise ValueError("words of the model run into each other")
            size, packed = self.dtype.itemsize, ids.tobytes()
            ends = [*(first[1:] * size).tolist(), len(packed)]
            out += [packed[a:b] for a, b in zip((first * size).tolist(), ends)]
        return out

    def _of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each of ``pieces``, which are distinct."""
        out = list(map(self.recent.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        spaced = []
        for i in missing:
            ids = self.older.get(pieces[i])
            if ids is None:
                if self.at_once and _SPACED.fullmatch(pieces[i]):
                    spaced.append(i)
                    continue
                ids = self._head(pieces[i].decode())
            out[i] = ids
        for i, ids in zip(spaced, self._words([pieces[i] for i in spaced])):
            out[i] = ids
        self.recent.update((pieces[i], out[i]) for i in missing)
        if len(self.recent) >= PIECES_KEPT // 2:
            self.older, self.recent = self.recent, {}
        return out

    def _together(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[low:high]
        ends = offsets[1:] - low
        edges = np.sort(np.r_[0, cuts(data), ends])
        edges = edges[np.r_[True, edges[1:] != edges[:-1]]]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
        named = pieces.dictionary_encode()
        ids = self._of_pieces(named.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(ids), self.dtype)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        code = named.indices.to_numpy()
        long = sizes[code]
        before = np.r_[0, np.cumsum(long)]
        out = flat[np.repeat(starts[code] - before[:-1], long) + np.arange(before[-1])]
        return out, before[np.searchsorted(edges, ends)]

    def column(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of ``texts`` (null: empty), some texts at a time: ids of all, and where each text's end."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_pieces:
            apart = np.ones(len(texts), bool)
        else:
            apart = np.zeros(len(texts), bool)
            for token in self.added:
                apart |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        held = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            if apart[at]:
                ids = np.frombuffer(self._whole(texts[at].as_py()), self.dtype)
                yield ids, np.array([len(ids)])
                at += 1
                continue
            end = int(np.searchsorted(held, (held[at - 1] if at else 0) + CUT_BYTES, side="right"))
            end = max(end, at + 1)
            stop = np.flatnonzero(apart[at:end])
            end = at + int(stop[0]) if len(stop) else end
            yield self._together(texts.slice(at, end - at))
            at = end

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str, before: str = "") -> bytes:
        """Ids of what the tokenizer takes as one word, with the character of a space before it or none."""
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.characters)
        return self._packed([t.id for t in self.tokenize(before + shown)])

    def _piece(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(" " + word)
        letters, marks = plain.groups()
        return self.pieces[letters] + self.marks[marks] if marks else self._word(letters, self.space)

    def _head(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(word) if word else b""
        letters, marks = plain.groups()
        return self._word(letters) + (self.marks[marks] if marks else b"")

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.dtype)
        if not self.by_pieces or any(t in text for t in self.added):
            packed = self._whole(text)
        elif _BLANK_RUN.search(text):
            first, *rest = _CUT.split(text)
            packed = self._whole(first) + b"".join([self.pieces[piece[1:]] for piece in rest])
        else:
            # all blanks stand alone, so a line break is a word of its own and starts the next line afresh
            lines = []
            for line in text.split("\n"):
                first, *words = line.split(" ")
                lines.append(self.heads[first] + b"".join(map(self.pieces.__getitem__, words)))
            packed = self.heads["\n"].join(lines)
        return np.frombuffer(packed, self.dtype)


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
