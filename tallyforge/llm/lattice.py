"""Subword lattice language model: a text's probability over all segmentations.

The pieces of an existing vocabulary are the units of a unigram model. Their first weights
come from the vocabulary's own scores; three rounds of expectation counts over the words of
the training documents make them probabilities. Each different word counts once there, as
the pieces are for words that are rare or new. The forward recursion, in log space, adds
up all ways to cut a word into pieces. In the lattice of a word seen in training, the word
as a whole is one more unit, with its discounted count; the discounts are the weight of the
pieces. A text is its words and one end.

Each language of the training documents has a model of its own, as pieces differ much; a
text's probability is the sum over the languages, whatever its own label says.

Words repeat, so the recursion runs once for each different word of the corpus. The most
frequent words are then known to every task; rarer ones are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import chunks, kept_table, map_chunks, texts_of

SPACE = "▁"
#: Different words that a task counts before it hands the counts on.
COUNTED_WORDS = 400_000
#: The most frequent words, sent to every task: about 20 MB there.
KNOWN_WORDS = 200_000
#: Words of one length in one step of the recursion.
BATCH = 16_384
#: Longer words, in code points, go one by one, in stretches of so many places.
LONG, STRETCH = 256, 1 << 15
#: Rows and bytes of words that a task takes at once: cut by model and length, the few of one
#: Arrow batch would leave numpy only short arrays.
GATHERED_WORDS, GATHERED_BYTES = 1 << 17, 8 << 20
ROUNDS = 3
SLOTS = 20
#: Expected counts and log probabilities are summed as whole numbers, so that sums don't
#: depend on the order of the rows.
UNIT = 1 << 20
DIGITS = 10**9
FACTOR, SPREAD = np.uint64(0x9E3779B97F4A7C15), (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F))


def words(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at ASCII white space: bytes know ASCII alone."""
    return text.encode().lower().split()


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def coded(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The `words` of all texts of a batch, one after the other, as places in an array of the
    different ones; that array; and how many words there are up to the end of each text."""
    texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
    raw = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    blank = _BLANK[raw]
    begins = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    offsets = np.r_[0, np.cumsum(ends - begins)].astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(raw[~blank])]
    found = pa.Array.from_buffers(pa.binary(), len(begins), buffers).dictionary_encode()
    borders = np.cumsum([len(t) + 1 for t in texts])
    at = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return at, found.dictionary, np.searchsorted(begins, borders)


def vocabulary(path: str) -> tuple[list[str], list[float]]:
    """Pieces of a SentencePiece model and first log weights. Scores that are ranks, as in
    BPE models, count as such: a piece's weight falls as one over its rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    scores = np.array([model.get_score(i) for i in ids])
    ranks = np.empty(len(ids))
    ranks[np.argsort(-scores, kind="stable")] = np.arange(len(ids))
    return [model.id_to_piece(i) for i in ids], (-np.log(ranks + 10)).tolist()


class Lattice:
    """Pieces with natural log probabilities, one row of weights for each model; the last
    weight is that of a UTF-8 byte of a character that is no piece."""

    def __init__(self, pieces: list[str], weights: np.ndarray):
        self.weights = weights
        self.longest = max(map(len, pieces))
        self.powers = np.cumprod(np.r_[np.uint64(1), np.full(self.longest, FACTOR)])
        self.hashes = np.zeros(len(pieces) + 1, np.uint64)
        for size in range(1, self.longest + 1):
            at = [i for i, p in enumerate(pieces) if len(p) == size]
            if at:
                codes = np.array([[ord(c) for c in pieces[i]] for i in at], np.uint64)
                h = np.zeros(len(at), np.uint64)
                for k in range(size):
                    h = h * FACTOR + codes[:, k] + np.uint64(1)
                self.hashes[at] = h
        # Two tables of slots: the second holds what finds the first taken
        self.slots = []
        size = STRETCH + self.longest
        inverse = np.uint64(pow(int(FACTOR), -1, 1 << 64))
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, FACTOR)])
        self.down = np.cumprod(np.full(size, inverse))
        rest = np.arange(len(pieces))
        for spread in SPREAD:
            slot = np.full(1 << SLOTS, len(pieces), np.int32)
            place = self._slot(self.hashes[rest], spread)
            slot[place] = rest
            self.slots.append(slot)
            rest = rest[slot[place] != rest]
        if len(rest):
            raise ValueError("the vocabulary is too large for its tables")

    @staticmethod
    def _slot(hashes: np.ndarray, spread: np.uint64) -> np.ndarray:
        return ((hashes * spread) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        none = len(self.hashes) - 1
        at = self.slots[0][self._slot(hashes, SPREAD[0])]
        other = np.flatnonzero((at != none) & (self.hashes[at] != hashes))
        if len(other):
            second = self.slots[1][self._slot(hashes[other], SPREAD[1])]
            at[other] = np.where(self.hashes[second] == hashes[other], second, none)
        return at

    def _edges(self, codes: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Begin, end, rows, pieces and numbers (of bytes) of all edges, ends ascending."""
        out = []
        none = len(self.hashes) - 1
        sums = [np.zeros(len(codes), np.uint64)]
        for k in range(codes.shape[1]):
            sums.append(sums[-1] * FACTOR + codes[:, k] + np.uint64(1))
            for size in range(1, min(k + 1, self.longest) + 1):
                at = self._find(sums[-1] - sums[-1 - size] * self.powers[size])
                rows = np.flatnonzero(at != none)
                if len(rows):
                    out.append((k + 1 - size, k + 1, rows, at[rows], np.int64(1)))
                if size == 1 and len(rows) < len(at):
                    rows = np.flatnonzero(at == none)
                    c = codes[rows, k]
                    n = 1 + (c > 0x7F).astype(int) + (c > 0x7FF) + (c > 0xFFFF)
                    out.append((k, k + 1, rows, at[rows], n))
        return out

    def batches(self, tokens: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and code points of words of one length, the space mark in front; not of long
        ones."""
        sizes = np.array([len(t) + 1 for t in tokens], int)
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] <= LONG]
        cuts = np.flatnonzero(np.diff(sizes[order])) + 1
        for same in np.split(order, cuts) if len(order) else []:
            for i in range(0, len(same), BATCH):
                part = same[i : i + BATCH]
                line = "".join([SPACE + tokens[k] for k in part.tolist()])
                codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
                yield part, codes.reshape(len(part), -1).astype(np.uint64)

    def _forward(self, codes: np.ndarray, edges, weights: np.ndarray) -> list[np.ndarray]:
        alpha = [np.zeros(len(codes))]
        alpha += [np.full(len(codes), -np.inf) for _ in range(codes.shape[1])]
        for begin, end, rows, at, n in edges:
            way = alpha[begin][rows] + weights[at] * n
            alpha[end][rows] = np.logaddexp(alpha[end][rows], way)
        return alpha

    def long_words(self, tokens: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """Places and code points of the long words."""
        for i, token in enumerate(tokens):
            if len(token) >= LONG:
                yield i, np.frombuffer((SPACE + token).encode("utf-32-le"), np.uint32).astype(np.uint64)

    def _stretch(self, codes: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
        """Begins, ends, pieces and numbers of the edges of one word that end behind `low` and not
        behind `high`, ends ascending."""
        none = len(self.hashes) - 1
        a = max(0, low - self.longest)
        part = codes[a:high]
        m = len(part)
        # Hashes of all beginnings at once: each place's share is its own factor
        sums = np.r_[np.uint64(0), np.cumsum((part + np.uint64(1)) * self.down[:m])] * self.up[: m + 1]
        found = []
        for size in range(1, min(self.longest, m) + 1):
            at = self._find(sums[size:] - sums[:-size] * self.powers[size])
            rows = np.flatnonzero(at != none)
            found.append((rows, rows + size, at[rows], np.ones(len(rows), np.int64)))
            if size == 1:
                rows = np.flatnonzero(at == none)
                c = part[rows]
                n = 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
                found.append((rows, rows + 1, at[rows], n))
        begin, end, at, n = (np.concatenate(x) for x in zip(*found, strict=True))
        keep = np.flatnonzero(end + a > low)
        keep = keep[np.argsort(end[keep], kind="stable")]
        return begin[keep] + a, end[keep] + a, at[keep], n[keep]

    def _long_forward(self, codes: np.ndarray, weights: np.ndarray) -> list[float]:
        """As `_forward`, for one word."""
        alpha = [0.0] + [-math.inf] * len(codes)
        for low in range(0, len(codes), STRETCH):
            begin, end, at, n = self._stretch(codes, low, min(low + STRETCH, len(codes)))
            for b, e, way in zip(begin.tolist(), end.tolist(), (weights[at] * n).tolist(), strict=True):
                alpha[e] = _log_add(alpha[e], alpha[b] + way)
        return alpha

    def _long_expected(self, codes: np.ndarray, weights: np.ndarray, total: np.ndarray, times: float) -> None:
        """As `expected`, for one word and model."""
        alpha = self._long_forward(codes, weights)
        beta = [-math.inf] * len(codes) + [0.0]
        forward = np.array(alpha)
        for low in reversed(range(0, len(codes), STRETCH)):
            begin, end, at, n = self._stretch(codes, low, min(low + STRETCH, len(codes)))
            ways = weights[at] * n
            for b, e, way in zip(
                reversed(begin.tolist()), reversed(end.tolist()), reversed(ways.tolist()), strict=True
            ):
                beta[b] = _log_add(beta[b], beta[e] + way)
            behind = np.array(beta[low : low + STRETCH + 1])[end - low]
            share = np.exp(forward[begin] + ways + behind - alpha[-1]) * times * n
            total += np.bincount(at, share, len(total))

    def log_probability(self, tokens: list[str]) -> np.ndarray:
        """One row a word, one column a model."""
        out = np.zeros((len(tokens), len(self.weights)))
        for part, codes in self.batches(tokens):
            edges = self._edges(codes)
            for k, weights in enumerate(self.weights):
                out[part, k] = self._forward(codes, edges, weights)[-1]
        for i, codes in self.long_words(tokens):
            for k, weights in enumerate(self.weights):
                out[i, k] = self._long_forward(codes, weights)[-1]
        return out

    def expected(self, tokens: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of times each piece (and last, a byte) stands in the words, for
        each model; `counts` has one column a model."""
        total = np.zeros(self.weights.shape)
        for k, weights in enumerate(self.weights):
            # Most words belong to one model: the others have nothing to count
            own = np.flatnonzero(counts[:, k])
            for part, codes in self.batches([tokens[i] for i in own.tolist()]):
                edges = self._edges(codes)
                alpha = self._forward(codes, edges, weights)
                beta = [np.full(len(codes), -np.inf) for _ in range(codes.shape[1])]
                beta.append(np.zeros(len(codes)))
                n = counts[own[part], k]
                for begin, end, rows, at, size in reversed(edges):
                    behind = beta[end][rows] + weights[at] * size
                    beta[begin][rows] = np.logaddexp(beta[begin][rows], behind)
                    share = np.exp(alpha[begin][rows] + behind - alpha[-1][rows])
                    share *= n[rows] * size
                    total[k] += np.bincount(at, share, total.shape[1])
            for i, codes in self.long_words([tokens[j] for j in own.tolist()]):
                self._long_expected(codes, weights, total[k], counts[own[i], k])
        return total


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def trains(doc_id: Column) -> Column:
    """Documents whose crc32 of the doc_id as text leaves no 2 by 7; without doc_id, as if
    its text were empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 != 2


def languages(docs: DataFrame) -> list[str]:
    """Languages of a hundredth or more of the training documents; the others share ''."""
    names = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    counts = docs.where("train").groupBy(names.alias("lang")).count()
    whole = counts.agg(F.sum("count")).first()[0] or 0
    found = counts.where(F.col("count") * 100 >= whole).select("lang").collect()
    return sorted({r.lang for r in found} | {""})


def word_counts(docs: DataFrame, names: list[str]) -> DataFrame:
    """word, cs: every word of `docs` and how often it stands in the training documents of
    each language."""
    place = {name: k for k, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in names]
        for batch in batches:
            for part in chunks(batch, "text"):
                at, kinds, ends = coded(part)
                model = [place.get(lang, place[""]) for lang in part.column("lang").to_pylist()]
                # Held-out words count nothing, but are there
                model = np.where(part.column("train").to_numpy(zero_copy_only=False), model, len(names))
                model = np.repeat(model.astype(np.int64), np.diff(np.r_[0, ends]))
                pairs, n = np.unique(at * (len(names) + 1) + model, return_counts=True)
                own = kinds.to_pylist()
                for pair, count in zip(pairs.tolist(), n.tolist(), strict=True):
                    word, k = divmod(pair, len(names) + 1)
                    if k < len(names):
                        seen[k][own[word]] += count
                    else:
                        seen[0][own[word]] += 0
                if sum(map(len, seen)) > COUNTED_WORDS:
                    yield from counted(seen)
                    seen = [Counter() for _ in names]
        yield from counted(seen)

    def counted(seen: list[Counter]) -> Iterator[pa.RecordBatch]:
        for k, counts in enumerate(seen):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.binary()).cast(pa.string()),
                    pa.array(np.full(len(counts), k, np.int32)),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["word", "k", "n"],
            )

    rows = docs.select("text", "train", "lang").mapInArrow(run, "word string, k int, n long")
    sums = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)) for k in range(len(names))]
    return rows.groupBy("word").agg(F.array(*sums).alias("cs"))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together, until they hold GATHERED_WORDS rows or GATHERED_BYTES."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.get_total_buffer_size()
        if rows >= GATHERED_WORDS or size >= GATHERED_BYTES:
            yield pa.concat_batches(held)
            held, rows, size = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), width) if len(flat) else np.zeros((0, width))


def first_weights(path: str) -> np.ndarray:
    """Log probabilities of the pieces and a byte by the vocabulary's own scores alone."""
    pieces, first = vocabulary(path)
    weights = np.array([*first, -math.log(len(pieces))])
    return weights - np.logaddexp.reduce(weights)


def learn(counts: DataFrame, models: int, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces and a byte, one row a model, from the training
    counts of all words. The driver gets one sum for each model and piece."""
    pieces, _ = vocabulary(path)
    weights = np.tile(first_weights(path), (models, 1))
    seen = counts.where(F.exists("cs", lambda c: c > 0))
    for _ in range(rounds):

        def run(batches, weights=weights):
            lattice = Lattice(pieces, weights)
            total = np.zeros(weights.shape)
            for batch in gathered(batches):
                n = (_matrix(batch.column("cs"), models) > 0).astype(float)
                total += lattice.expected(batch.column("word").to_pylist(), n)
            k, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(k, pa.int32()),
                    pa.array(at, pa.int32()),
                    pa.array(np.rint(total[k, at] * UNIT).astype(np.int64)),
                ],
                ["k", "piece", "n"],
            )

        sums = seen.mapInArrow(run, "k int, piece int, n long").groupBy("k", "piece")
        total = np.full(weights.shape, 0.01)
        for row in sums.agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect():
            total[row.k, row.piece] += float(row.n) / UNIT
        weights = np.log(total / total.sum(1, keepdims=True))
        # A byte's share is cut into the 256 bytes there are
        weights[:, -1] -= math.log(256)
    return weights


def score(docs: DataFrame, path: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, vocabulary_score; one
    row for each of `docs`. Null texts have the end alone; repeated rows are repeated in counts
    and out, null ids stay, further columns are left out, an empty table gives no rows. Time is
    linear in a word, too, however long it is.

    base_score adds log10((c + 1) / (N + V + 1)) over the tokens, with the training counts c
    of words and ends, their sum N and number V. score is the log10 of the sum over the
    languages k of share_k times the product of ((c_k - D) + D V_k lattice_k(word)) / N_k
    over the words and ends_k / N_k for the end. vocabulary_score adds the log10 of the sum over all
    segmentations of each word under the vocabulary's own weights, with nothing learnt from the
    documents.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit("")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(lang.cast("string"), F.lit("")).alias("lang"),
        trains(F.col("doc_id")).alias("train"),
    )
    names = languages(rows)
    models = len(names)
    pooled = F.when(F.col("lang").isin(names), F.col("lang")).otherwise(F.lit(""))
    by = dict(rows.where("train").groupBy(pooled.alias("lang")).count().collect())
    ends = np.array([by.get(name, 0) for name in names], float)
    counts = kept_table(word_counts(rows, names), "counts")
    c = F.aggregate("cs", F.lit(0).cast("long"), lambda a, b: a + b)
    each = [F.col("cs")[k] for k in range(models)]
    some = lambda x: F.coalesce(F.sum(x.cast("long")), F.lit(0))
    size = counts.agg(
        some(c).alias("n"),
        some(c > 0).alias("v"),
        some(c == 1).alias("once"),
        some(c == 2).alias("twice"),
        *(some(x).alias(f"n{k}") for k, x in enumerate(each)),
        *(some(x > 0).alias(f"v{k}") for k, x in enumerate(each)),
    ).first()
    n, v = int(size.n + ends.sum()), size.v + int(ends.sum() > 0)
    whole = math.log10(n + v + 1)
    discount = size.once / (size.once + 2 * size.twice) if size.once and size.twice else 0.5
    # A language without training words has the lattice alone
    sums = np.array([size[f"n{k}"] for k in range(models)], float) + ends + 1
    kinds = np.array([size[f"v{k}"] for k in range(models)], float) * discount + 0.5
    weights = learn(counts, models, path)
    pieces, _ = vocabulary(path)
    log_share = np.log10((ends + 0.01) / (ends.sum() + 0.01 * models))
    log_end = np.log10((ends + 0.5) / sums)

    # One model more: the vocabulary as it comes
    weights = np.concatenate([weights, first_weights(path)[None]])
    columns = models + 1

    def scored(batches):
        lattice = Lattice(pieces, weights)
        for batch in gathered(batches):
            seen = _matrix(batch.column("cs"), models)
            cut = lattice.log_probability(batch.column("word").to_pylist())
            with np.errstate(divide="ignore"):
                kept = np.log(np.maximum(seen - discount, 0))
            own = np.logaddexp(kept, cut[:, :models] + np.log(kinds)) - np.log(sums)
            lp = np.c_[own, cut[:, models]] / math.log(10)
            width = np.arange(len(seen) + 1, dtype=np.int32) * columns
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    pa.array(seen.sum(1).astype(np.int64)),
                    pa.ListArray.from_arrays(width, lp.ravel()),
                ],
                ["word", "c", "lp"],
            )

    table = kept_table(counts.mapInArrow(scored, "word string, c long, lp array<double>"), "scored")
    top = table.orderBy(F.desc("c"), "word").limit(known_words).toArrow().combine_chunks()
    known = docs.sparkSession.sparkContext.broadcast(top)

    def start():
        top = known.value
        cs = np.array(top.column("c").to_pylist(), np.int64)
        lps = np.array(top.column("lp").to_pylist(), float).reshape(-1, columns)
        # For each known word: whether training has it, its base, its columns; zeros for others
        values = np.zeros((len(cs) + 1, 2 + columns))
        values[:-1] = np.c_[cs > 0, np.log10(cs + 1) - whole, lps]
        here = {w.encode(): i for i, w in enumerate(top.column("word").to_pylist())}
        always = np.r_[
            float(ends.sum() > 0), math.log10(ends.sum() + 1) - whole, log_share + log_end, 0.0
        ]

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, kinds, borders = coded(batch)
            place = np.array([here.get(w, -1) for w in kinds.to_pylist()], np.int64)
            n = np.diff(np.r_[0, borders])
            text = np.repeat(np.arange(len(n)), n)
            # Different words of each text, with their counts
            pairs, times = np.unique(text * max(len(kinds), 1) + at, return_counts=True)
            text, at = np.divmod(pairs, max(len(kinds), 1))
            sums = np.tile(always, (len(n), 1))
            parts = values[place[at]] * times[:, None] if len(at) else np.zeros((0, 2 + columns))
            for k in range(2 + columns):
                sums[:, k] += np.bincount(text, parts[:, k], len(n))
            rare = np.flatnonzero(place[at] < 0) if len(at) else np.zeros(0, np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(text[rare], minlength=len(n)))].astype(np.int32))
            lists = np.arange(len(n) + 1, dtype=np.int32) * columns
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    pa.array([not t for t in batch.column("train").to_pylist()]),
                    pa.array(n + 1, pa.int64()),
                    pa.array(np.rint(sums[:, 0]).astype(np.int64)),
                    pa.array(sums[:, 1]),
                    pa.ListArray.from_arrays(lists, sums[:, 2:].ravel()),
                    pa.ListArray.from_arrays(offsets, kinds.take(pa.array(at[rare])).cast(pa.string())),
                    pa.ListArray.from_arrays(offsets, times[rare].astype(np.int32)),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "old", "base", "lp", "rare", "times"],
            )

        return each

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    shape = (
        "row long, doc_id long, held_out boolean, n_tokens long, old long, base double,"
        " lp array<double>, rare array<string>, times array<int>"
    )
    # Written out, the row numbers hold for both uses below
    marked = kept_table(map_chunks(numbered, "text", start, shape), "marked")
    tail = marked.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("k")
    )
    exact = lambda x: F.sum(F.round(x * DIGITS).cast("long"))
    rest = (
        tail.join(table, "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("more"),
            exact(F.col("k") * (F.log10(F.col("c") + 1) - whole)).alias("base_more"),
            *(exact(F.col("k") * F.col("lp")[k]).alias(f"lp{k}") for k in range(columns)),
        )
    )
    added = lambda a, b: a + F.coalesce(F.col(b) / DIGITS, F.lit(0.0))
    ways = [added(F.col("lp")[k], f"lp{k}") for k in range(models)]
    best = F.greatest(*ways) if models > 1 else ways[0]
    total = sum((F.pow(F.lit(10.0), w - F.col("best")) for w in ways), F.lit(0.0))
    return (
        marked.drop("rare", "times")
        .join(rest, "row", "left")
        .withColumn("best", best)
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("old") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"),
            added(F.col("base"), "base_more").alias("base_score"),
            (F.col("best") + F.log10(total)).alias("score"),
            added(F.col("lp")[models], f"lp{models}").alias("vocabulary_score"),
        )
    )
