"""Fill-in-the-middle examples by block rotation in place.

A text is cut into prefix, middle and suffix. Its bytes go into one bytearray with a mark in
front of each part, in the order of the text; two neighbouring blocks then change places by
three reversals (each block, then both together), which needs no second copy. The same
rotations, undone in the opposite order, give the text back, byte by byte:

    <P>prefix <M>middle <S>suffix     as laid out
    <P>prefix <S>suffix <M>middle     psm: middle and suffix exchanged
    <S>suffix <P>prefix <M>middle     spm: then prefix and suffix, too

Cuts fall between units, `[A-Za-z]+|[^A-Za-z]` over code points. All choices come from a digest
of seed and doc_id, so a row that is computed again, or read in another order, comes out
the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.common import map_chunks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
MARK = 3
#: Per cent of the texts that stay plain whatever they hold, and of the others in spm order.
PLAIN, SPM = 10, 20
RESTORED = T.StructField("restored", T.StringType())

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def swap(line: np.ndarray, begin: int, border: int, end: int) -> None:
    """Exchange the blocks begin:border and border:end in place: each is reversed, then the
    whole."""
    for a, b in ((begin, border), (border, end), (begin, end)):
        half = (b - a) // 2
        front, back = line[a : a + half], line[b - half : b][::-1]
        kept = front.copy()
        front[:] = back
        back[:] = kept


def choices(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits for a document; a null id counts as an empty one."""
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def units(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where units begin in the UTF-8 bytes of several texts, one behind the other, that begin at
    `begins`. No unit reaches over two texts."""
    letter = _LETTER[raw]
    # A byte that goes on with a character or with a run of letters begins nothing
    inner = (raw & 0xC0) == 0x80
    inner[1:] |= letter[1:] & letter[:-1]
    inner[begins[begins < len(raw)]] = False
    return np.flatnonzero(~inner)


def arrange(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The bytes of a text, cut at two places, in the order of `form`."""
    out = bytearray(text)
    if form == "plain":
        return out
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        out[at:at] = mark
    line = np.frombuffer(out, np.uint8)
    border = MARK + first
    swap(line, border, 2 * MARK + second, len(line))
    if form == "spm":
        swap(line, 0, border, border + MARK + len(text) - second)
    return out


def rebuild(output: bytes, form: str) -> bytes:
    """The text that `arrange` has arranged: the rotations undone, the last one first."""
    if form == "plain":
        return output
    out = bytearray(output)
    line = np.frombuffer(out, np.uint8)
    middle = output.index(MIDDLE)
    if form == "spm":
        swap(line, 0, output.index(PREFIX), middle)
    suffix = out.index(SUFFIX)
    swap(line, suffix, middle, len(line))
    del line
    middle = suffix
    suffix = out.index(SUFFIX, middle)
    for at in (suffix, middle, 0):
        del out[at : at + MARK]
    return bytes(out)


def _laid(batch: pa.RecordBatch, column: str) -> tuple[memoryview, np.ndarray]:
    """The bytes of a column of texts and where each begins; null as empty."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    texts = pa.concat_arrays([texts])
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    raw = memoryview(data if data is not None else b"")[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def _strings(values: list) -> pa.Array:
    """Texts from their bytes, without decoding them."""
    sizes = [0 if v is None else len(v) for v in values]
    ends = np.cumsum([0, *sizes])
    if ends[-1] > np.iinfo(np.int32).max:
        return pa.array([bytes(v) for v in values], pa.large_binary()).cast(pa.large_string())
    return pa.StringArray.from_buffers(
        len(values), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(values))
    )


def _count(raw: np.ndarray, begin: int, end: int) -> int:
    """Code points between two places."""
    return int(np.count_nonzero((raw[begin:end] & 0xC0) != 0x80))


def transform(
    docs: DataFrame, seed: int = 1, plain: int = PLAIN, spm: int = SPM, column: str = "text"
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points; null
    if plain) and output of every row of `docs`.

    A text that is empty, or holds one of the marks, stays plain, and so do `plain` per cent of
    the others; `spm` per cent of the rest are in spm order. Null counts as empty; rows
    without a doc_id share the choices of an empty one; repeated rows come out alike, each as a
    row. Further columns are left out, an empty table gives no rows. Work and memory are
    linear in the text, a few copies of the longest one; there is no shuffle, so no key can be
    hot, and a task that is run again gives the same rows.
    """

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = _laid(batch, column)
            raw = np.frombuffer(data, np.uint8)
            starts = units(raw, offsets[:-1])
            # Units of each text: those that begin in it
            at = np.searchsorted(starts, offsets)
            out: dict[str, list] = {c: [] for c in ("form", "prefix", "middle", "output")}
            for i, name in enumerate(batch.column("doc_id").to_pylist()):
                begin, end = int(offsets[i]), int(offsets[i + 1])
                text, n = bytes(data[begin:end]), int(at[i + 1] - at[i])
                h1, h2, h3, h4 = choices(seed, name)
                marked = not text or any(m in text for m in MARKS)
                form = "plain" if marked or h3 % 100 >= 100 - plain else "spm" if h4 % 100 < spm else "psm"
                out["form"].append(form)
                if form == "plain":
                    out["prefix"].append(None)
                    out["middle"].append(None)
                    out["output"].append(text)
                    continue
                cuts = [
                    int(starts[at[i] + k]) if k < n else end
                    for k in sorted((h1 % (n + 1), h2 % (n + 1)))
                ]
                out["prefix"].append(_count(raw, begin, cuts[0]))
                out["middle"].append(_count(raw, *cuts))
                out["output"].append(arrange(text, cuts[0] - begin, cuts[1] - begin, form))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(at), pa.int64()),
                    pa.array(out["form"], pa.string()),
                    pa.array(out["prefix"], pa.int64()),
                    pa.array(out["middle"], pa.int64()),
                    _strings(out["output"]),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

        return each

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), column)
    return map_chunks(
        rows,
        column,
        start,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restore(formed: DataFrame) -> DataFrame:
    """Rows of `transform` with a further column `restored`, the text that `output` was made
    of, from output and form alone. Nulls count as empty; an empty table gives no rows."""

    def start():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            data, offsets = _laid(batch, "output")
            texts = [
                rebuild(bytes(data[offsets[i] : offsets[i + 1]]), form)
                for i, form in enumerate(batch.column("form").to_pylist())
            ]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, _strings(texts)], [*batch.schema.names, "restored"]
            )

        return each

    return map_chunks(formed, "output", start, T.StructType([*formed.schema, RESTORED]))
