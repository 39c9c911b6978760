"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The symbols of many words lie in one flat array. Each round takes the smallest pair rank
of every word, merges its occurrences in all words at once, the leftmost first, and
compacts the array, until no word holds a pair that merges.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_chunks

SPACE = "▁"
#: Symbols without a piece are numbered by their code point from here.
LOOSE = 1 << 21
NEVER = np.iinfo(np.int32).max
#: Bytes that a task's store of encoded words takes at most; beyond it the store starts anew.
STORE_BYTES = 48 << 20
#: What a word of the store takes beside its bytes and ids.
WORD_BYTES = 150
#: Words that are merged at once.
MERGED = 8192
#: Bytes of texts whose words are looked up at once.
LOOKED_UP = 2 << 20


class Pieces:
    """A BPE model with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        ids = range(self.size)
        special = {
            i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        }
        self.bytes = {
            int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)
        }
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        pieces = {model.id_to_piece(i): i for i in ids if i not in special}
        self.text = {i: p.replace(SPACE, " ") for p, i in pieces.items()}
        scores = np.array([model.get_score(i) for i in ids])
        # Equal scores share a rank; such ranks merge one pair at a time
        levels, rank, sharing = np.unique(
            -scores[sorted(pieces.values())], return_inverse=True, return_counts=True
        )
        ranks = dict(zip(sorted(pieces.values()), rank.tolist(), strict=True))
        self.shared = sharing > 1
        symbol = lambda p: pieces.get(p, LOOSE + ord(p) if len(p) == 1 else None)
        pairs = {}
        for piece, i in pieces.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (ranks[i], i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.rank = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        self._hash()
        joined = {c for p in pieces if len(p) > 1 for c in p}
        inner = {c for p in pieces for c in p.lstrip(SPACE)}
        if SPACE in inner:
            raise ValueError("pieces that hold a space behind other characters")
        # White space that no longer piece holds ends a word, as a space does
        lone = self.lone = "".join(c for c in "\n\t\r" if c not in joined)
        self.words = re.compile(
            (f"[{lone}]|" if lone else "") + f"{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+"
        ).findall
        chars = {ord(p): i for p, i in pieces.items() if len(p) == 1}
        self.first = LOOSE + np.arange(max(chars) + 1, dtype=np.int64)
        self.first[list(chars)] = list(chars.values())
        self.byte_of = {i: b for b, i in self.bytes.items()}

    def split(self, text: str) -> list[str]:
        """The words of a text; no merge crosses their borders."""
        return self.words(SPACE + text.replace(" ", SPACE)) if text else []

    def _hash(self) -> None:
        """Tables from the hash of a pair to its place in `keys`: a slot holds one pair, and a
        mark if others fell on it; those are looked up by bisection."""
        self.bits = np.uint64(64 - max(12, 3 + len(self.keys).bit_length()))
        at = self._slots(self.keys)
        self.slot = np.full(1 << int(64 - self.bits), -1, np.int32)
        self.slot[at] = np.arange(len(self.keys))
        self.full = np.bincount(at, minlength=len(self.slot)) > 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.bits).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        slots = self._slots(key)
        at = self.slot[slots]
        if len(crowded := np.flatnonzero(self.full[slots])):
            at[crowded] = np.searchsorted(self.keys, key[crowded])
            at[at == len(self.keys)] = 0
        found = (self.keys[at] == key) & (at >= 0)
        return np.where(found, self.rank[at], NEVER), self.merged[at]

    def symbols(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of all words, flat, and the number of each word, from the code points of
        the words and how many each has."""
        known = codes < len(self.first)
        sym = np.where(known, self.first[np.where(known, codes, 0)], LOOSE + codes.astype(np.int64))
        word = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(sym), NEVER, np.int32)
        into = np.zeros(len(sym), np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], into[inner] = self._pairs(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(sym)])
            if (least == NEVER).any():
                over = np.repeat(least == NEVER, sizes)
                done.append((word[over], sym[over]))
                sym, word, rank, into = sym[~over], word[~over], rank[~over], into[~over]
                sizes, least = sizes[least != NEVER], least[least != NEVER]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, sizes))
            # In a run of overlapping pairs every second one, from the left
            order = np.arange(len(hit))
            begins = np.r_[True, (np.diff(hit) != 1) | (word[hit[1:]] != word[hit[:-1]])]
            hit = hit[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
            alone = self.shared[rank[hit]]
            if alone.any():
                hit = hit[~alone | np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
            sym[hit] = into[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            at = np.cumsum(stay)[hit] - 1
            sym, word, rank, into = sym[stay], word[stay], rank[stay], into[stay]
            near = np.zeros(len(sym), bool)
            near[at] = near[np.maximum(at - 1, 0)] = True
            touched = np.flatnonzero(near)
            last = np.r_[word[1:] != word[:-1], True][touched]
            rank[touched[last]] = NEVER
            touched = touched[~last]
            rank[touched], into[touched] = self._pairs(sym[touched], sym[touched + 1])
        if not done:
            return sym, np.zeros(len(sizes), np.int64)
        word, sym = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(sizes))

    def ids(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and the number of each word; a character without a piece is its
        bytes."""
        sym, counts = self.symbols(codes, sizes)
        if not (loose := sym >= LOOSE).any():
            return sym, counts
        each = np.ones(len(sym), np.int64)
        raw = {x: chr(x - LOOSE).encode("utf-8", "replace") for x in np.unique(sym[loose]).tolist()}
        for x, line in raw.items():
            each[sym == x] = len(line)
        begins = np.cumsum(each) - each
        out = np.repeat(sym, each)
        for x, line in raw.items():
            at = begins[sym == x]
            for i, b in enumerate(line):
                out[at + i] = self.bytes[b]
        word = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(word, each, len(counts)).astype(np.int64)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        flat, counts = self.ids(codes, np.array([len(w) for w in words], np.int64))
        ends = np.cumsum(counts)
        return [x.tolist() for x in np.split(flat, ends[:-1])] if words else []

    def encode(self, text: str) -> list[int]:
        return [i for word in self.encode_words(self.split(text)) for i in word]

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of ids; bytes that make no character become U+FFFD, one for each."""
        out: list[str] = []
        run = bytearray()

        def flush() -> None:
            if run:
                out.append(_characters(bytes(run)))
                run.clear()

        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                run.append(b)
            else:
                flush()
                out.append(self.text.get(i, ""))
        flush()
        text = "".join(out)
        return text[1:] if first and text.startswith(" ") and ids[0] not in self.byte_of else text


def _characters(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode("utf-8"))
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@cache
def load(path: str) -> Pieces:
    """One model a Python worker."""
    return Pieces(path)


class _Store:
    """Ids of words, made for all new words of a chunk at once and kept in one flat array."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.lone = np.zeros(256, bool)
        self.lone[[ord(c) for c in pieces.lone]] = True
        self.dots = SPACE.encode()
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.counts = np.zeros(1 << 14, np.int64)
        self.begins = np.zeros(1 << 14, np.int64)
        self.used = self.size = 0

    def _words(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The words of the texts, as `Pieces.split` has them but with spaces, and how many words
        begin before the end of each text."""
        # The space in front is the dummy prefix
        lines = [b" " + t if t else b"" for t in texts]
        data = b"".join(lines)
        if self.dots in data:
            lines = [x.replace(self.dots, b" ") for x in lines]
            data = b"".join(lines)
        raw = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(x) for x in lines])
        space, lone = raw == 32, self.lone[raw]
        start = space | lone
        start[1:] &= ~space[:-1] | lone[1:]
        start[1:] |= lone[:-1]
        start[ends[:-1][ends[:-1] < len(raw)]] = True
        start[:1] = True
        begins = np.flatnonzero(start)
        offsets = np.r_[begins, len(raw)].astype(np.int32)
        words = pa.Array.from_buffers(
            pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        )
        return words, np.searchsorted(begins, ends)

    def _add(self, words: list[bytes]) -> None:
        for a in range(0, len(words), MERGED):
            part = words[a : a + MERGED]
            text = b"".join(part).decode().replace(" ", SPACE)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            lead = np.frombuffer(b"".join(part), np.uint8) & 0xC0 != 0x80
            ends = np.cumsum([len(w) for w in part])
            chars = np.r_[0, np.cumsum(lead)][ends]
            ids, counts = self.pieces.ids(codes, np.diff(chars, prepend=0))
            n = len(self.place)
            self.flat = _room(self.flat, self.used + len(ids))
            self.counts, self.begins = (_room(x, n + len(part)) for x in (self.counts, self.begins))
            self.flat[self.used : self.used + len(ids)] = ids
            self.counts[n : n + len(part)] = counts
            self.begins[n : n + len(part)] = self.used + np.cumsum(counts) - counts
            self.place.update(zip(part, range(n, n + len(part)), strict=True))
            self.used += len(ids)
            self.size += int(ends[-1]) + 4 * len(ids) + WORD_BYTES * len(part)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and where those of each text end."""
        words, at = self._words(texts)
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        if self.size > STORE_BYTES:
            self._clear()
        coded = words.dictionary_encode()
        _, borders, data = coded.dictionary.buffers()
        data = data.to_pybytes()
        borders = np.frombuffer(borders, np.int32, len(coded.dictionary) + 1).tolist()
        own = [data[a:b] for a, b in itertools.pairwise(borders)]
        known = list(map(self.place.get, own))
        if new := [w for w, k in zip(own, known, strict=True) if k is None]:
            self._add(new)
            known = list(map(self.place.__getitem__, own))
        places = np.array(known)[coded.indices.to_numpy()]
        counts = self.counts[places]
        ends = np.cumsum(counts)
        # The ids of a word stand side by side in the store
        flat = np.repeat(self.begins[places] - (ends - counts), counts) + np.arange(ends[-1])
        return self.flat[flat], np.r_[0, ends][at]


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The same array, or a copy of at least twice its size."""
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


def _raw(batch: pa.RecordBatch) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


class _Lines:
    """Ids as bytes: in decimals, and the text that they decode to."""

    def __init__(self, pieces: Pieces, n: int):
        self.number = [str(i).encode() for i in range(n)]
        self.text = [pieces.text.get(i, "").encode() for i in range(n)]
        for i, b in pieces.byte_of.items():
            self.text[i] = bytes([b])

    def decoded(self, ids: list[int]) -> bytes:
        # The first word carries the dummy prefix, which decoding drops again
        return b"".join(map(self.text.__getitem__, ids))[1:]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) and decoded (text) of every row of `docs`.

    Null counts as empty and has no ids; repeated rows and null doc_ids stay as they are,
    further columns are left out, an empty table gives no rows. A task keeps the ids of up to
    STORE_BYTES of words beside one chunk of texts; a word of any length is encoded whole.
    """

    def start():
        pieces = load(path)
        store, lines = _Store(pieces), _Lines(pieces, pieces.size)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, ends = store.encode(_raw(batch))
            offsets = np.r_[0, ends]
            decoded = [
                lines.decoded(ids[a:b].tolist()) for a, b in itertools.pairwise(offsets.tolist())
            ]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.ListArray.from_arrays(offsets.astype(np.int32), ids),
                    pa.array(decoded, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

        return each

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_chunks(
        rows, "text", start, "doc_id long, n_tokens long, ids array<int>, decoded string", LOOKED_UP
    )


def packed(docs: DataFrame, path: str, width: int = 2) -> DataFrame:
    """As `encode`, with the ids as bytes (`width` for each, little end first) and no decoded
    text: doc_id, ids (binary)."""

    def start():
        pieces = load(path)
        if pieces.size > 1 << 8 * width:
            raise ValueError(f"the model has ids that {width} bytes don't hold")
        store = _Store(pieces)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, ends = store.encode(_raw(batch))
            offsets = (np.r_[0, ends] * width).astype(np.int32)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(f"<u{width}"))]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.Array.from_buffers(pa.binary(), len(ends), buffers)],
                ["doc_id", "ids"],
            )

        return each

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_chunks(rows, "text", start, "doc_id long, ids binary", LOOKED_UP)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """As `encode`, with digests in place of ids and text: doc_id, n_tokens, ids_sha256,
    decoded_sha256."""

    def start():
        pieces = load(path)
        store, lines = _Store(pieces), _Lines(pieces, pieces.size)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, ends = store.encode(_raw(batch))
            offsets = np.r_[0, ends]
            numbers, texts = [], []
            for a, b in itertools.pairwise(offsets.tolist()):
                own = ids[a:b].tolist()
                line = b",".join(map(lines.number.__getitem__, own))
                numbers.append(hashlib.sha256(line).hexdigest())
                texts.append(hashlib.sha256(lines.decoded(own)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(numbers, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return each

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_chunks(rows, "text", start, schema, LOOKED_UP)
