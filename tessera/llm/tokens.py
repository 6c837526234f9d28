"""Encoding with the tokenizers library, with a bounded cache of short pieces.

Both vocabularies cut a text at single spaces before anything else can join its pieces, so a piece between spaces always has
the same ids, and a worker keeps those of the pieces that it meets most. Texts whose white space isn't that plain go to the
library whole. Both also cut between a letter and punctuation, so ASCII punctuation at a piece's end is a unit of its own, and
a word of Latin letters, in lower case where the tokenizer lowers it, is one unit of the library's BPE model, which takes it
without the tokenizer's other steps. That holds for the two layouts of LAYOUTS, which are looked for in the tokenizer's file;
texts go whole to a tokenizer of any other parts. Texts are cut into units by Arrow, and ids gathered by NumPy: only units that
the worker doesn't know yet are encoded one by one.
"""

import json
import os
import string
import zlib
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: Units that a worker keeps (some 200 bytes each); of a full cache the half stays that most calls had use for.
CACHE = 200_000
LONGEST_PIECE = 64
_TAIL = string.punctuation
#: White space but for blanks and line ends, two of these in a row, and the separator that pieces are cut with.
_UNSAFE = ("\0", "  ", " \n", "\n ", "\n\n", *(chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n"))
_UNSAFE_ASCII = tuple(x for x in _UNSAFE if x.isascii())
_made: dict[str, "Encoder"] = {}
#: Normalizer, pre-tokenizer and model settings of the layouts that are known. Where white space is dropped it
#: ends every word; else a space belongs to the word after it.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
LAYOUTS = {
    "drops": {
        "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}, _BYTES | {"use_regex": False}]},
        "model": _MODEL | {"end_of_word_suffix": "</w>"},
    },
    "keeps": {"normalizer": None, "pre_tokenizer": _BYTES, "model": _MODEL | {"end_of_word_suffix": None}},
}


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + k for k, b in enumerate(others)}


_LETTERS = byte_letters()


def layout(made: dict) -> str | None:
    """The layout of a tokenizer's file: its parts are those of one in LAYOUTS, and it adds no tokens but special ones."""
    parts = {k: made.get(k) for k in ("normalizer", "pre_tokenizer")} | {"model": {k: v for k, v in made["model"].items() if k not in ("vocab", "merges")}}
    plain = made.get("truncation") is None and made.get("padding") is None and all(t["special"] for t in made.get("added_tokens") or ())
    return next((name for name, want in LAYOUTS.items() if plain and parts == want), None)


def latin(core: str) -> bool:
    """Whether a word, with or without the blank before it, has letters below U+0250 only."""
    letters = core[1:] if core[:1] == " " else core
    return letters.isalpha() and max(letters) < "\u0250"


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of flat with these starts and sizes, one after another, and their bounds."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return flat[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])], ends


class Encoder:
    """Ids of texts by the tokenizer of one file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        with open(path, encoding="utf-8") as f:
            self.layout = layout(json.load(f))
        self.drops = self.layout == "drops"
        self.words = f"\\A ?[{''.join(filter(self.simple, map(chr, range(0x250))))}]+\\z"
        # Unit k has the ids flat[bounds[k] : bounds[k + 1]], and uses[k] calls had use for it.
        self.known: dict[str, int] = {}
        self.flat, self.bounds, self.uses = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def simple(self, letter: str) -> bool:
        """Whether this is a Latin letter that the normalizer and Arrow lower to the same one Latin letter."""
        return latin(letter) and (not self.drops or latin(x := self.normalizer.normalize_str(letter)) and x == pc.utf8_lower(letter).as_py())

    def plain(self, text: str) -> bool:
        if self.layout is None:
            return False
        return self.drops or not any(x in text for x in (_UNSAFE_ASCII if text.isascii() else _UNSAFE))

    def pieces(self, texts: list[str]) -> pa.ListArray:
        """The pieces of plain texts."""
        if self.drops:
            return pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.string()), " ")
        return pc.split_pattern(pa.array([t.replace("\n", "\0\n\0").replace(" ", "\0 ") for t in texts], pa.string()), "\0")

    def is_word(self, units: pa.Array) -> pa.Array:
        """Which units are words of Latin letters, with or without the blank before them.

        Latin letters only: there the library's idea of a letter and Python's are surely the same. What counts is the
        normalised letter, as the library cuts that one: U+0130 becomes an i and a mark, which is no letter."""
        return pc.and_(pc.match_substring_regex(units, self.words), pc.less_equal(pc.utf8_length(units), LONGEST_PIECE))

    def units(self, pieces: pa.StringArray) -> pa.Array:
        """Two units of each piece: a normalised word and the punctuation at its end, or all of the piece and nothing."""
        cores = pc.utf8_rtrim(pieces, _TAIL)
        word = self.is_word(cores).to_numpy(zero_copy_only=False)
        _, offsets, data = pieces.buffers()
        ends = np.frombuffer(offsets, np.int32, len(pieces) + 1, 4 * pieces.offset)
        at = np.empty(2 * len(pieces) + 1, np.int32)
        at[::2] = ends
        at[1::2] = np.where(word, ends[:-1] + pc.binary_length(cores).to_numpy(), ends[1:])
        both = pa.StringArray.from_buffers(2 * len(pieces), pa.py_buffer(at), data or pa.py_buffer(b""))
        return pc.if_else(pa.array(np.repeat(word, 2)), pc.utf8_lower(both), both) if self.drops else both

    def word(self, core: str) -> bytes:
        """A normalised word of Latin letters, with or without the blank before it, by the model alone."""
        units = core.replace(" ", "\u0120") if core.isascii() else core.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(units)]).tobytes()

    def learn(self, new: list[str]) -> range:
        """The places of units that aren't known, in their order. They are known from then on, but for long ones."""
        word = self.is_word(pa.array(new, pa.string())).to_numpy(zero_copy_only=False).tolist()
        rest = iter(self.whole([x for x, w in zip(new, word, strict=True) if not w]))
        ids = [self.word(x) if w else next(rest) for x, w in zip(new, word, strict=True)]
        short = [len(x) <= LONGEST_PIECE for x in new]
        places = range(len(self.uses), len(self.uses) + len(new))
        self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(ids), "<u4")))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) >> 2)))
        self.uses = np.concatenate((self.uses, np.where(short, 0, -2)))
        self.known |= {x: k for x, k, s in zip(new, places, short, strict=True) if s}
        return places

    def forget(self) -> None:
        """Where too many units or ids are held, only those units stay that most calls had use for; uses count half from then on."""
        if len(self.uses) <= CACHE and len(self.flat) <= 16 * CACHE:
            return
        stay = np.sort(np.argsort(-self.uses, kind="stable")[: CACHE // 2])
        stay = stay[self.uses[stay] > 0]
        place = np.full(len(self.uses), -1)
        place[stay] = np.arange(len(stay))
        at = place.tolist()
        self.known = {x: at[k] for x, k in self.known.items() if at[k] >= 0}
        self.flat, self.bounds = gathered(self.flat, self.bounds[stay], np.diff(self.bounds)[stay])
        self.uses = self.uses[stay] >> 1

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids by the library alone."""
        return [array("I", e.ids).tobytes() for k in range(0, len(texts), 4096) for e in self.tokenizer.encode_batch_fast(texts[k : k + 4096], add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        easy = [k for k, t in enumerate(texts) if self.plain(t)]
        out: list[bytes] = [b""] * len(texts)
        hard = sorted(set(range(len(texts))) - set(easy))
        for k, ids in zip(hard, self.whole([texts[k] for k in hard]), strict=True):
            out[k] = ids
        if easy:
            split = self.pieces([texts[k] for k in easy])
            pieces = split.flatten().dictionary_encode()
            units = self.units(pieces.dictionary).dictionary_encode()
            every = units.dictionary.to_numpy(zero_copy_only=False).tolist()
            places = np.fromiter(map(self.known.get, every, repeat(-1)), np.int64, len(every))
            if len(new := np.flatnonzero(places < 0)):
                places[new] = self.learn([every[k] for k in new.tolist()])
            self.uses[places] += 1
            at = places[units.indices.to_numpy()]
            flat, ends = gathered(self.flat, self.bounds[at], np.diff(self.bounds)[at])
            starts, at = ends[::2], pieces.indices.to_numpy()
            ids, ends = gathered(flat, starts[at], np.diff(starts)[at])
            bounds = ends[split.offsets.to_numpy()].tolist()
            for k, s, e in zip(easy, bounds, bounds[1:], strict=False):
                out[k] = ids[s:e].tobytes()
            self.forget()
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file."""
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def encode_all(path: str, texts: list[str | None], end: int, most: int = 1 << 20):
    """Ids of each text with the id `end` after them, encoding about `most` characters at a time."""
    of, tail = encoder(path), array("I", [end]).tobytes()
    k = 0
    while k < len(texts):
        some, size = [], 0
        while k < len(texts) and (not some or size + len(texts[k] or "") <= most):
            some.append(texts[k] or "")
            size += len(some[-1])
            k += 1
        for ids in of.encode(some):
            yield ids + tail


crc32 = zlib.crc32
