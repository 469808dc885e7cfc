"""Exact token ids and counts with public tokenizers, by words held in a bounded cache.

Both tokenizers cut a text at white space, the word tokenizer into words too, before they merge, so a text's
ids are those of its words or pieces in order; texts for which that does not hold go to the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
CACHE_WORDS, CACHE_CHARS, STEP = 800_000, 64, 64
TOGETHER, MARK = 1 << 22, 0xFFFFFFFF
"""Characters of texts (one text at least) whose words are looked up together; what ends a piece's ids, no id itself."""
# Fixed values of the word tokenizer: how its pre-tokenizer cuts lower-cased printable ASCII and Latin-1 letters,
# and what its file declares.
CUT = r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-zß-öø-ÿ0-9 \n\t\r]+|\n"
DECLARED = {
    "truncation": None,
    "padding": None,
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
UNUSUAL = re.compile(r"[^!-~À-ÖØ-öø-ÿ \n\t\r]").search


def file_digest(path: str) -> str:
    """Version of a tokenizer: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


class _Cached(dict):
    """piece -> value; whole batches of unknown pieces are encoded at once.  Long pieces stay for one batch only."""

    long: list[str] = []

    def encode(self, pieces: list[str]) -> list:
        raise NotImplementedError

    def learn(self, pieces: set[str]) -> None:
        for p in self.long:
            self.pop(p, None)
        new = [p for p in pieces if p not in self]
        if new and len(self) + len(new) > CACHE_WORDS // 2:
            self.clear()
            new = list(pieces)
        self.long = [p for p in new if len(p) > CACHE_CHARS]
        if new:
            self.update(zip(new, self.encode(new), strict=True))


def declared(file: dict) -> bool:
    """Whether a tokenizer's file declares what ``CUT`` and ``PLAIN`` stand for, and a model that sees words alone."""
    return DECLARED == {k: file.get(k) for k in DECLARED} and file["model"].get("type") == "BPE"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Generations(dict):
    """A bounded cache: key -> ``make(key)``.  When full, it becomes the old generation, from which keys in use return."""

    def __init__(self, make, most: int = CACHE_WORDS // 2):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > CACHE_CHARS:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds:
    """Ids as little-endian 32-bit bytes, for tokenizers whose pre-tokenizer drops white space.

    Texts of printable ASCII, Latin-1 letters and spaces, tabs and line ends, whose normal form is their
    lower case, are cut here and given to the library's model word by word, each piece between spaces once for
    all texts given together, if the tokenizer's file declares
    the normalizer and pre-tokenizer that ``CUT`` stands for.  Of texts with other characters, or that hold a
    special token, the pieces between white space that have neither are cut likewise, and the other pieces go
    through the whole library, as do whole texts if the file declares anything else.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cut = re.compile(CUT).findall
        self.letters = dict(enumerate(byte_letters()))
        self.packed = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]
        self.words = Generations(self.word)
        self.pieces = Generations(self.piece, CACHE_WORDS // 4)
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        with open(path, encoding="utf-8") as f:
            self.direct = declared(json.load(f))

    def library(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        if word == "\n":
            return MARK.to_bytes(4, "little")
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(word)])

    def by_words(self, text: str) -> str | None:
        """The lower-cased text; none if a character or a special token, in whatever case, asks for the library."""
        low = text.lower()
        return None if UNUSUAL(text) or self.special(low) else low

    def piece(self, piece: str) -> bytes:
        low = self.by_words(piece)
        return self.library(piece) if low is None else b"".join(map(self.words.__getitem__, self.cut(low)))

    def together(self, texts: list[str]) -> list[bytes]:
        """Ids of texts from :meth:`by_words` with spaces only: each distinct piece among them is cut once."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        found = split.values.dictionary_encode()
        once = pa.LargeListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int64()), found.dictionary)
        words = self.cut(pc.binary_join(once, pa.scalar("\n", pa.large_string()))[0].as_py() + "\n")
        ids = np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype="<u4")
        ends = np.flatnonzero(ids == MARK)
        starts = 4 * np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(starts), pa.py_buffer(ids[ids != MARK])])
        taken = pieces.take(found.indices)
        edges = np.frombuffer(taken.buffers()[1], dtype=np.int64)[np.asarray(split.offsets)].tolist()
        raw = memoryview(taken.buffers()[2] or b"")
        return [raw[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]

    def texts(self, texts: list[str | None]) -> list[bytes]:
        if not self.direct:
            return [self.library(t) if t else b"" for t in texts]
        out, held, at, size = [b""] * len(texts), [], [], 0
        for k, text in enumerate(texts):
            if not text:
                continue
            low = self.by_words(text)
            # a space, tab or line end is dropped wherever it stands, and no token or normal form spans it
            spaced = (text if low is None else low).replace("\n", " ").replace("\t", " ").replace("\r", " ")
            if low is None:
                out[k] = b"".join(map(self.pieces.__getitem__, spaced.split(" ")))
                continue
            held.append(spaced)
            at.append(k)
            size += len(spaced)
            if size >= TOGETHER:
                for j, ids in zip(at, self.together(held), strict=True):
                    out[j] = ids
                held, at, size = [], [], 0
        if held:
            for j, ids in zip(at, self.together(held), strict=True):
                out[j] = ids
        return out


class PieceCounts(_Cached):
    """Token counts of a sentencepiece model with a leading space mark and no piece across a space.

    A text "a b" is the pieces of "▁a" and "▁b", each of which the library makes of "a" and "b".
    Texts with an empty piece (two spaces together, a space at either end) are encoded whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.separable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, pieces: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(pieces, num_threads=1)]

    def texts(self, texts: list[str | None]) -> list[int]:
        split = [(t or "").split(" ") for t in texts]
        whole = [not self.separable or "" in pieces or "▁" in (t or "") for t, pieces in zip(texts, split, strict=True)]
        self.learn(set(chain.from_iterable(p for p, w in zip(split, whole, strict=True) if not w)))
        return [self.encode([t])[0] if w and t else 0 if w else sum(map(self.__getitem__, p)) for t, p, w in zip(texts, split, whole, strict=True)]


class IdCounts(WordIds):
    """Token counts by :class:`WordIds`."""

    def texts(self, texts: list[str | None]) -> list[int]:
        return [len(x) // 4 for x in super().texts(texts)]


@cache
def word_ids(path: str) -> WordIds:
    """The encoder of this process: tasks that follow one another in a worker share its bounded cache."""
    return WordIds(path)


@cache
def counter(path: str):
    """This process's counter for a .model (sentencepiece) or a .json file whose pre-tokenizer drops white space."""
    return PieceCounts(path) if path.endswith(".model") else IdCounts(path)


def in_steps(rows: list, do) -> list:
    return [x for k in range(0, len(rows), STEP) for x in do(rows[k : k + STEP])]
