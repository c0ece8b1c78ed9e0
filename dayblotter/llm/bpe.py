"""Encoding and decoding by byte-pair merges found in a segment tree.

A text is normalised and split into pieces as its tokenizer's file says. A piece begins as one symbol
per byte; a segment tree over its adjacent pairs holds each pair's rank and place, so the root is the
leftmost pair of lowest rank. That pair is merged, the two pairs beside it and the one that is gone are
updated, each in a logarithmic number of steps, until no pair can be merged. Short pieces that are new
are merged many at a time, their trees being the rows of a matrix.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayblotter.llm.common import bounded_batches, table, without

KEPT_PIECES = 400_000  # pieces whose ids a task remembers at a time
KEPT_LENGTH = 64  # characters of the longest piece that is remembered
TOGETHER = (8, 16, 32)  # symbols of the longest pieces that are merged together, by size of their trees
PART = 1 << 20  # characters of a text whose pieces a task holds at once
_SHIFT = 24  # of the left symbol in a pair's key
_BITS = 40  # of a tree entry, for the place; the rank is above them
_PLACE = (1 << _BITS) - 1
_NONE = (1 << 62) - 1

_SPACE = regex.compile(r"\s")

# What a file's normaliser has to be for texts to be normalised here; others are left to its library.
_KNOWN_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {byte: chr(byte) for byte in plain}
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(256 + len(letters) - len(plain))
    return [letters[byte] for byte in range(256)]


class Merges:
    """Pairs of symbols by rank, for one pair at a time and for many at once."""

    def __init__(self, pairs: list[tuple[int, int, int]]) -> None:
        """`pairs` has (left, right, what they become) from the lowest rank on; a pair named again counts there."""
        self.rank = {left << _SHIFT | right: rank for rank, (left, right, _) in enumerate(pairs)}
        self.made = [made for _, _, made in pairs]
        self.keys = np.array(sorted(self.rank), dtype=np.int64)
        self.ranks = np.array([self.rank[key] for key in self.keys.tolist()], dtype=np.int64)
        self.made_array = np.array(self.made, dtype=np.int64)

    def entries(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Tree entries of pairs; a symbol below zero has none."""
        keys = left << _SHIFT | right
        if not len(self.keys):
            return np.full(keys.shape, _NONE)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at] << _BITS | place, _NONE)


class PairTree:
    """A segment tree over the adjacent pairs of a piece; the root, `tree[1]`, is its leftmost pair of lowest rank."""

    def __init__(self, entries: list[int]) -> None:
        self.size = 1 << max(len(entries) - 1, 0).bit_length()
        self.tree = array("q", [_NONE]) * (2 * self.size)
        self.tree[self.size : self.size + len(entries)] = array("q", entries)
        for node in range(self.size - 1, 0, -1):
            self.tree[node] = min(self.tree[2 * node], self.tree[2 * node + 1])

    def put(self, place: int, entry: int) -> None:
        tree, node = self.tree, place + self.size
        tree[node] = entry
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                return
            tree[node] = least


def merged(symbols: list[int], merges: Merges) -> list[int]:
    """The symbols of one piece after all merges."""
    count, rank, made = len(symbols), merges.rank, merges.made
    if count < 2:
        return symbols

    def entry(left: int, right: int) -> int:
        found = rank.get(symbols[left] << _SHIFT | symbols[right])
        return _NONE if found is None else found << _BITS | left

    pairs = PairTree([entry(place, place + 1) for place in range(count - 1)])
    tree = pairs.tree
    after, before = array("q", range(1, count + 1)), array("q", range(-1, count - 1))
    while (least := tree[1]) != _NONE:
        place = least & _PLACE
        gone = after[place]
        symbols[place] = made[least >> _BITS]
        symbols[gone] = -1
        following = after[place] = after[gone]
        if gone < count - 1:
            pairs.put(gone, _NONE)
        if following < count:
            before[following] = place
            pairs.put(place, entry(place, following))
        else:
            pairs.put(place, _NONE)
        if before[place] >= 0:
            pairs.put(before[place], entry(before[place], place))
    return [symbol for symbol in symbols if symbol >= 0]


def merged_together(pieces: list[list[int]], merges: Merges) -> list[bytes]:
    """The symbols of many short pieces after all merges, as little-endian 32-bit numbers.

    Their trees are rows of one matrix. In each step every piece that has a pair left merges the one at
    its root; the three entries this changes are put into all trees, level by level.
    """
    size = 1 << max(max(map(len, pieces)) - 2, 1).bit_length()
    many, width = len(pieces), size + 2
    symbols = np.full((many, width), -1, dtype=np.int64)
    lengths = np.array([len(piece) for piece in pieces])
    symbols[np.arange(width) < lengths[:, None]] = np.fromiter(chain.from_iterable(pieces), np.int64, lengths.sum())
    places = np.broadcast_to(np.arange(width), (many, width))
    tree = np.full((many, 2 * size + 2), _NONE)
    tree[:, size : 2 * size] = merges.entries(symbols[:, :size], symbols[:, 1 : size + 1], places[:, :size])
    half = size // 2
    while half:
        tree[:, half : 2 * half] = tree[:, 2 * half : 4 * half].reshape(many, half, 2).min(axis=2)
        half //= 2
    after, before = places + 1, places - 1
    rows = np.arange(many)
    while True:
        least = tree[rows, 1]
        going = least != _NONE
        rows, least = rows[going], least[going]
        if not len(rows):
            break
        place = least & _PLACE
        gone, prior = after[rows, place], before[rows, place]
        following = after[rows, gone]
        symbols[rows, place] = merges.made_array[least >> _BITS]
        symbols[rows, gone] = -1
        after[rows, place], before[rows, following] = following, place
        tree[rows, size + gone] = _NONE
        tree[rows, size + place] = merges.entries(symbols[rows, place], symbols[rows, following], place)
        inner = prior >= 0
        tree[rows[inner], size + prior[inner]] = merges.entries(
            symbols[rows[inner], prior[inner]], symbols[rows[inner], place[inner]], prior[inner]
        )
        changed = np.stack([np.minimum(gone, size - 1), place, np.maximum(prior, 0)]) + size
        while changed[0, 0] > 1:
            changed >>= 1
            tree[rows, changed] = np.minimum(tree[rows, 2 * changed], tree[rows, 2 * changed + 1])
    left = symbols >= 0
    ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
    flat = symbols[left].astype("<u4").tobytes()
    return [flat[first:last] for first, last in zip([0, *ends], ends)]


def _parts(text: str) -> Iterator[str]:
    """A long text in parts, cut at white space, which is in no piece."""
    first = 0
    while len(text) - first > PART:
        found = _SPACE.search(text, first + PART)
        if found is None:
            break
        yield text[first : found.start()]
        first = found.start()
    yield text[first:] if first else text


class _Remembered(dict):
    """Ids by piece. A full memory is begun anew; long pieces are not kept."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        if len(piece) <= KEPT_LENGTH:
            self.keep([piece], [ids])
        return ids

    def keep(self, pieces: list[str], ids: list[bytes]) -> None:
        if len(self) + len(pieces) > KEPT_PIECES:
            self.clear()
        self.update(zip(pieces, ids))


class Codec:
    """Encodes and decodes as the library `tokenizers` does with a file, special tokens not added.

    Only a file's vocabulary, merges and settings are used, and, for texts and normalisers that are not
    known here, the library's normaliser and splitter. A file with dropout, unknown tokens, byte
    fallback or added tokens that take their surroundings is refused.
    """

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as lines:
            held = json.load(lines)
        model = held["model"]
        odd = [name for name in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(name)]
        added = held.get("added_tokens") or []
        odd += [token["content"] for token in added if token["normalized"] or token["lstrip"] or token["rstrip"] or token["single_word"]]
        if model.get("type", "BPE") != "BPE" or odd:
            raise ValueError(f"{file} is not a plain byte-pair file: {odd}")
        self.file, self.vocabulary, self.suffix = file, model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        number = self.vocabulary
        self.merges = Merges([(number[left], number[right], number[left + right]) for left, right in pairs])
        self.added = {token["content"]: token["id"] for token in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        letters = byte_letters()
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.symbol = [self.vocabulary.get(letter) for letter in letters]
        self.last_symbol = [self.vocabulary.get(letter + self.suffix) for letter in letters]
        if None in self.symbol or None in self.last_symbol:
            raise ValueError(f"{file} lacks tokens of single bytes")
        self.pattern = self._own_pattern(held)
        self.library: Any = None
        self.plain, self.lettered = _Remembered(self._plain_piece), _Remembered(self._lettered_piece)
        self.tokens = {number: token for token, number in {**self.vocabulary, **self.added}.items()}
        decoder = held.get("decoder")
        if decoder is not None and decoder["type"] != "ByteLevel":
            raise ValueError(f"{file} has a decoder of type {decoder['type']}")
        self.to_bytes = decoder is not None

    @staticmethod
    def _own_pattern(held: dict) -> Any:
        """The pattern of a piece, if normaliser and splitter are of the kind that is known here."""
        normalizer, splitter = held.get("normalizer") or {}, held.get("pre_tokenizer") or {}
        steps = splitter.get("pretokenizers") or []
        if normalizer.get("normalizers") != _KNOWN_NORMALIZER or [step["type"] for step in steps] != ["Split", "ByteLevel"]:
            return None
        split, level = steps
        known = split["behavior"] == "Removed" and split["invert"] and not level["add_prefix_space"] and not level["use_regex"]
        return regex.compile(split["pattern"]["Regex"]) if known and "Regex" in split["pattern"] else None

    def _symbols(self, of_bytes: bytes) -> list[int]:
        symbols = [self.symbol[byte] for byte in of_bytes]
        symbols[-1] = self.last_symbol[of_bytes[-1]]
        return symbols

    def _ids(self, of_bytes: bytes) -> bytes:
        return np.array(merged(self._symbols(of_bytes), self.merges), dtype="<u4").tobytes()

    def _plain_piece(self, piece: str) -> bytes:
        return self._ids(piece.encode())

    def _lettered_piece(self, piece: str) -> bytes:
        """A piece whose bytes the library has written as letters."""
        return self._ids(bytes(map(self.byte_of.__getitem__, piece)))

    def _remember(self, pieces: set[str]) -> None:
        """Merge short pieces that are not known yet together, those of about one length at a time."""
        new = defaultdict(list)
        for piece in pieces:
            if len(piece) <= TOGETHER[-1] and piece not in self.plain:
                of_bytes = piece.encode()
                limit = next((limit for limit in TOGETHER if len(of_bytes) <= limit), None)
                if limit:
                    new[limit].append((piece, of_bytes))
        for found in new.values():
            self.plain.keep(
                [piece for piece, _ in found], merged_together([self._symbols(held) for _, held in found], self.merges)
            )

    def _normal(self, run: str) -> str | None:
        """A run without added tokens as its file normalises it, or None if the library has to.

        White space is in no piece, so it need not be made equal first. A capital sigma becomes a small
        one as if alone, unlike in `str.lower`. Characters that Python's tables do not know, which those
        of the library may, leave the run to the library.
        """
        if self.pattern is None:
            return None
        if run.isascii():
            return run.lower()
        if any(unicodedata.category(one) == "Cn" for one in set(run)):
            return None
        return unicodedata.normalize("NFC", run).replace("Σ", "σ").lower()

    def _encode_run(self, run: str, known: list[str] | None = None) -> bytes:
        if known is not None:
            return b"".join(map(self.plain.__getitem__, known))
        if (normal := self._normal(run)) is not None:
            out = []
            for part in _parts(normal):
                pieces = self.pattern.findall(part)
                self._remember(set(pieces))
                out.append(b"".join(map(self.plain.__getitem__, pieces)))
            return b"".join(out)
        if self.library is None:
            self.library = tokenizers.Tokenizer.from_file(self.file)
        if self.library.normalizer is not None:
            run = self.library.normalizer.normalize_str(run)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(run) if run else []
        return b"".join(self.lettered[piece] for piece, _ in pieces)

    def encode(self, text: str, known: list[str] | None = None) -> bytes:
        """Ids as unsigned little-endian 32-bit numbers."""
        if self.special is None or self.special.search(text) is None:
            return self._encode_run(text, known)
        out = []
        for place, run in enumerate(self.special.split(text)):
            out.append(self.added[run].to_bytes(4, "little") if place % 2 else self._encode_run(run))
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of texts. Pieces of all short ones that are new are merged together first."""
        known = [self._short_pieces(text) for text in texts]
        self._remember(set(chain.from_iterable(pieces for pieces in known if pieces)))
        return [self.encode(text, pieces) for text, pieces in zip(texts, known)]

    def _short_pieces(self, text: str) -> list[str] | None:
        if len(text) > PART // 16 or self.special is not None and self.special.search(text):
            return None
        normal = self._normal(text)
        return None if normal is None else self.pattern.findall(normal)

    def decode(self, ids: bytes) -> str:
        """The text of ids; ids that the file does not have are left out."""
        known = self.tokens
        tokens = [known[number] for number in np.frombuffer(ids, dtype="<u4").tolist() if number in known]
        if not self.to_bytes:
            return " ".join(tokens)
        byte = self.byte_of
        parts = [bytes(map(byte.__getitem__, token)) if all(one in byte for one in token) else token.encode() for token in tokens]
        return b"".join(parts).decode("utf-8", "replace")


@dataclass(frozen=True)
class BpeFile:
    """The place of a tokenizer's file, which every executor has to have."""

    file: str


def encoded(docs: DataFrame, tokenizer: BpeFile, text: str = "text") -> DataFrame:
    """The rows with `ids`: the text's token ids, a binary of unsigned little-endian 32-bit numbers.

    A null text counts as empty; an empty text, or one of white space alone, has no ids. Strings of
    special tokens within a text are those tokens. Texts are encoded whole, whatever their length.
    Repeated rows stay, an empty table stays empty, and an input column `ids` gives way.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(tokenizer.file)
        for texts in batches:
            yield pd.Series(codec.encode_all([one or "" for one in texts]), dtype=object)

    return without(docs, ["ids"]).withColumn("ids", ids_of(F.col(f"`{text}`")))


def decoded(frame: DataFrame, tokenizer: BpeFile, ids: str = "ids") -> DataFrame:
    """The rows with `decoded`: the text of a column of ids, special tokens included; null for null.

    Ids that the file does not have are left out. A binary that is no whole number of ids is an error.
    Repeated rows stay, an empty table stays empty, and an input column `decoded` gives way.
    """
    bounded_batches(frame.sparkSession)

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(tokenizer.file)
        for held in batches:
            yield pd.Series([None if one is None else codec.decode(one) for one in held], dtype=object)

    return without(frame, ["decoded"]).withColumn("decoded", text_of(F.col(f"`{ids}`")))


def word_tokenizer() -> BpeFile:
    import public_tokenizers

    return BpeFile(public_tokenizers.path("word_bpe_49k.json"))


def op13_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decoded(encoded(docs, word_tokenizer()).drop("text"), word_tokenizer())
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
