"""Document fingerprints by SpotSigs.

A signature is an anchor and the chain of content words that follow it. Anchors are common
words; so that lists, tables and other languages have some too, one content word in sixteen,
told by its hash, starts a chain as well. The fingerprint is the set of signatures, written
as sorted hashes of eight hex digits; two sets are compared by pruned Jaccard likeness.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import WordStore, chunks, kept_table, map_chunks, texts_of, tidy
from tallyforge.llm.components import components

#: Common words of English, French, German and Spanish.
ANCHORS = frozenset(
    b.encode()
    for b in (
        "a an and are as at be by for from in is it of on or that the this to was were with"
        " au aux ce dans des du elle en est et la le les par pas pour que qui sur un une"
        " auf das dem den der des die ein eine im ist mit nicht sich und von zu"
        " al como con de del el es las lo los no para por se su una y"
    ).split()
)
CHAIN = 2
DISTANCE = 1
#: Bytes that end a word: ASCII other than letters and digits.
SPLIT = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)


def _code(word: bytes) -> int:
    """The hash of a word, with two marks in the low bits: 1 common, 2 starts a chain."""
    import xxhash

    h = xxhash.xxh64_intdigest(word)
    common = word in ANCHORS
    starts = common or (h >> 32) % 16 == 0
    return h & ~3 | common | starts << 1


def _codes() -> WordStore:
    return WordStore(_code)


def signatures(text: str, codes: dict[bytes, int]) -> np.ndarray:
    """The sorted signatures of a text. A text without any has one, of all its words, or
    of itself if it has no word."""
    import xxhash

    tokens = text.lower().encode().translate(SPLIT).split()
    code = np.fromiter(map(codes.__getitem__, tokens), np.uint64, len(tokens))
    content = np.flatnonzero(code & np.uint64(1) == 0)
    anchors = np.flatnonzero(code & np.uint64(2))
    first = np.searchsorted(content, anchors, side="right")
    whole = first + (CHAIN - 1) * DISTANCE < len(content)
    h, first = code[anchors[whole]], first[whole]
    for k in range(CHAIN):
        h = (h ^ (h >> np.uint64(29))) * MIX + code[content[first + k * DISTANCE]]
    found = ((h ^ (h >> np.uint64(32))) * MIX) >> np.uint64(32)
    if not len(found):
        rest = b" ".join(tokens) or text.encode()
        found = np.array([xxhash.xxh64_intdigest(rest) >> 32], np.uint64)
    return np.unique(found.astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 as soon as it can't reach `least`: the sizes
    bound it first, then the range that both sets share."""
    small, large = sorted((len(a), len(b)))
    if small < least * large:
        return 0.0
    low, high = max(a[0], b[0]), min(a[-1], b[-1])
    a_in = a[np.searchsorted(a, low) : np.searchsorted(a, high, "right")]
    b_in = b[np.searchsorted(b, low) : np.searchsorted(b, high, "right")]
    bound = min(len(a_in), len(b_in))
    if bound < least * (len(a) + len(b) - bound):
        return 0.0
    both = len(np.intersect1d(a_in, b_in, assume_unique=True))
    like = both / (len(a) + len(b) - both)
    return like if like >= least else 0.0


def written(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, n_signatures, one row for each of `docs`; null texts count as
    empty."""

    def start():
        codes = _codes()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [signatures(t, codes) for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([written(x) for x in found], pa.string()),
                    pa.array([len(x) for x in found], pa.int32()),
                ],
                ["doc_id", "fingerprint", "n_signatures"],
            )

        return each

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_chunks(rows, "text", start, "doc_id long, fingerprint string, n_signatures int")


def near_documents(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, component_id (smallest doc_id reachable over links), n_links (links of its
    fingerprint) for documents whose fingerprints' likeness is `least` or more.

    Equal fingerprints are one class. Sets are partitioned by length, so that a set meets
    those of its own and the next shorter range only; within a partition they meet over the
    rarest signatures, of which two like sets must share one, and sizes and likeness are
    checked inside the join. Null doc_ids keep their rows.
    """
    prints = kept_table(fingerprints(docs), "prints")
    classes = prints.groupBy("fingerprint").agg(
        F.min("doc_id").alias("first"), F.max("n_signatures").alias("n")
    )
    # No two classes share the first 16 digits of a digest of the whole fingerprint
    key = F.conv(F.substring(F.sha2("fingerprint", 256), 1, 15), 16, 10).cast("long")
    classes = kept_table(classes.withColumn("node", key), "classes")
    at = F.sequence(F.lit(0), F.col("n") - 1)
    each = classes.select(
        "node", "n", F.explode(F.transform(at, lambda i: F.substr("fingerprint", i * 8 + 1, F.lit(8)))).alias("s")
    )
    often = each.groupBy("s").count()
    ordered = kept_table(
        each.join(kept_table(often, "often"), "s")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("count", "s"))).getField("s").alias("sigs")),
        "ordered",
    )
    step = math.log(1 / least)
    ordered = ordered.withColumn("range", F.floor(F.log("n") / step + 1e-9)).withColumn(
        "prefix", F.slice("sigs", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))
    )
    ask = ordered.select(
        F.explode("prefix").alias("s"), "range", F.struct("node", "n", "sigs", "prefix").alias("a")
    ).select("s", F.explode(F.array(F.col("range"), F.col("range") - 1)).alias("range"), "a")
    held = ordered.select(
        F.explode("prefix").alias("s"), "range", F.struct("node", "n", "sigs", "prefix").alias("b")
    )
    both = F.size(F.array_intersect("a.sigs", "b.sigs"))
    larger = (F.col("a.n") > F.col("b.n")) | (
        (F.col("a.n") == F.col("b.n")) & (F.col("a.node") > F.col("b.node"))
    )
    links = kept_table(
        ask.join(
            held,
            (ask.s == held.s)
            & (ask.range == held.range)
            & larger
            & (F.col("b.n") >= F.col("a.n") * least)
            # Found over the first signature that both prefixes hold, and so once
            & (F.get(F.array_intersect("a.prefix", "b.prefix"), F.lit(0)) == ask.s)
            & (both >= (F.col("a.n") + F.col("b.n") - both) * least),
        ).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")),
        "near",
    )
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    roots = components(links)
    rooted = kept_table(
        classes.join(roots, "node", "left")
        .join(ends, "node", "left")
        .select(
            "fingerprint", "first", F.coalesce("root", "node").alias("root"),
            F.coalesce("count", F.lit(0)).alias("n_links"),
        ),
        "rooted",
    )
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = kept_table(rooted.join(least_id, "root").drop("root", "first"), "named")
    return prints.join(named, "fingerprint").select("doc_id", "component_id", "n_links")


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """Rows of doc_id and text in `parts` ranges of descending doc_id. The first document
    of the next range (of the first range, for the last) comes too, with `after` true."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)] or [F.lit(0.5)])
    found = rows.agg(
        F.percentile_approx("doc_id", shares, 100_000).alias("cuts"), F.max("doc_id").alias("top")
    ).first()
    # Cuts are ids that occur; each is the first of its range
    cuts = np.unique(np.array([c for c in found.cuts or [] if c < found.top], np.int64))
    top, count = found.top, len(cuts)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = np.full(len(ids), count, np.int32)
        out[known] = count - np.searchsorted(cuts, ids[known].astype(np.int64), "left")
        return pd.Series(out)

    @F.pandas_udf("boolean")
    def leads(ids: pd.Series) -> pd.Series:
        return ids.isin(cuts)

    first = F.lit(True) if top is None else F.col("doc_id") == top
    named = rows.select("doc_id", "text", place("doc_id").alias("p"), leads("doc_id").alias("l"))
    where = F.array(
        F.struct(F.col("p").alias("part"), F.lit(False).alias("after")),
        F.when(F.col("l"), F.struct((F.col("p") - 1).alias("part"), F.lit(True).alias("after"))),
        F.when(first, F.struct(F.lit(count).alias("part"), F.lit(True).alias("after"))),
    )
    dealt = named.select("doc_id", "text", F.explode(where).alias("w")).where("w is not null")
    return (
        dealt.select("w.part", "w.after", "doc_id", "text")
        .repartitionById(parts, "part")
        .sortWithinPartitions("part", "after", F.desc_nulls_last("doc_id"), "text")
    )


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half (floor) of code
    points is replaced by as many first ones of the next document, or all it has; the next
    one by descending doc_id, null last, equal ids by text, and after the last the first.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next (likeness of the fingerprint to the edited text's and the next document's).
    Each text is shuffled once, into ranges of ids, one task each; neighbours meet within a range.
    Null texts count as empty, repeated rows stay, further columns are left out, an empty table gives
    no rows; a text may be of any length. All rows of one id, and all without, are one range: a
    table with very many of them makes a long task.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _codes()
        waiting = None
        for batch in batches:
            for piece in chunks(batch, "text"):
                out = []
                for part, after, doc_id, text in zip(
                    *(piece.column(c).to_pylist() for c in ("part", "after", "doc_id", "text")),
                    strict=True,
                ):
                    if waiting is None and after:
                        continue
                    found = signatures(text, codes)
                    if waiting is not None and waiting[0] == part:
                        out.append(compared(*waiting[1:], text, found, codes))
                        waiting = None
                    if not after:
                        waiting = (part, doc_id, text, found)
                if out:
                    yield pa.RecordBatch.from_pylist(out, SCHEMA)

    return _dealt(docs, parts).mapInArrow(
        tidy(run),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def compared(doc_id, text: str, found: np.ndarray, following: str, next_found: np.ndarray, codes) -> dict:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    edited_found = found if edited == text else signatures(edited, codes)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": written(found),
        "edited_fingerprint": written(edited_found),
        "near_edited": likeness(found, edited_found),
        "near_next": likeness(found, next_found),
    }
