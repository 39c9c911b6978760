"""Operators over documents, against plain Python on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import decontaminate, lattice, order, pieces, simhash, spotsigs, suffixes
from tallyforge.llm.queries import QUERIES, tokenizer

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one"),
    (4, "one"),
    (None, "no id here"),
    (None, None),
    (5, "é中\U0001f600 ▁ \x00 <s>"),
    (6, "word " * 3000),
    (7, "a" * 5000),
]


def invented(seed, n, copies=4):
    choose = random.Random(seed)
    parts = ["the", "of", "and", "la", "der", "in", *(f"w{i}é" for i in range(300))]
    line = " ".join(choose.choice(parts) for _ in range(60))
    out = []
    for i in range(n):
        words = [choose.choice(parts) for _ in range(choose.randint(1, 120))]
        if i % 3 == 0:
            words.insert(choose.randrange(len(words) + 1), line)
        out.append(" ".join(words))
    for _ in range(copies):
        out.append(choose.choice(out))
        edited = choose.choice(out).split(" ")
        edited[choose.randrange(len(edited))] = "changed"
        out.append(" ".join(edited))
    choose.shuffle(out)
    return list(enumerate(out, 10))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# SimHash


def plain_fingerprint(text):
    import xxhash

    line = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, distance=3):
    """Smallest id reachable, for (id, fingerprint) pairs without null ids."""
    groups = []
    for value in sorted({f for _, f in prints}):
        near = [g for g in groups if any((value ^ x).bit_count() <= distance for x in g)]
        groups = [g for g in groups if g not in near] + [[value, *(x for g in near for x in g)]]
    root = {f: min(i for i, x in prints if x in g) for g in groups for f in g}
    return {(i, f): root[f] for i, f in prints}


def test_simhash_matches_plain_python(docs):
    pairs = invented(1, 150, 12)
    found = simhash.near_duplicates(docs(pairs)).collect()
    prints = [(i, plain_fingerprint(t)) for i, t in pairs]
    want = plain_components(prints)
    assert {(r.doc_id, r.fp % 2**64): r.component_id for r in found} == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_are_all_pairs_within_the_distance(spark, distance):
    choose = random.Random(distance)
    values = {0, 2**64 - 1}
    for _ in range(25):
        x = choose.getrandbits(64)
        values.add(x)
        for _ in range(4):
            y = x
            for bit in choose.sample(range(64), choose.randint(1, 6)):
                y ^= 1 << bit
            values.add(y)
    signed = [v - (v >> 63 << 64) for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {frozenset((r.a, r.b)) for r in simhash.links(df, distance).collect()}
    want = {
        frozenset((a, b))
        for a in signed
        for b in signed
        if a < b and ((a ^ b) % 2**64).bit_count() <= distance
    }
    assert got == want


def test_simhash_odd_rows(docs):
    found = simhash.near_duplicates(docs(ODD)).collect()
    assert len(found) == len(ODD)
    by = {(r.doc_id, r.fp): r.component_id for r in found}
    # Null, empty and blank texts all have fingerprint 0
    assert {by[(i, 0)] for i in (1, 2, 3, None)} == {1}
    assert Counter(r.doc_id for r in found)[4] == 2


def test_simhash_of_nothing(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_first(docs([])).count() == 0


def test_keep_first_keeps_one_row_of_each_group(docs):
    kept = simhash.keep_first(docs([(3, "x y z"), (2, "x y z"), (2, "x y z"), (None, "x y z"), (None, "q")]))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [(2, "x y z")]
    assert kept.count() == 2
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_columns_of_other_names_stay(docs):
    odd = docs(invented(2, 20)).selectExpr("*", "1 as row", "2 as found", "3 as component_id")
    assert simhash.keep_first(odd).columns == odd.columns
    bench = odd.selectExpr("doc_id as item_id", "text").limit(1)
    assert decontaminate.clean(odd, bench).columns == odd.columns


def test_keep_first_when_splits_change_between_the_passes(docs, conf):
    pairs = invented(40, 120, 30)
    df = docs([*pairs, *((i + 1000, t) for i, t in pairs)], 8)
    conf(spark__sql__files__openCostInBytes="0")
    one = simhash.keep_first(df)
    conf(spark__sql__files__openCostInBytes="4194304")
    got = sorted(r.doc_id for r in one.collect())
    prints = [(i, plain_fingerprint(t)) for i, t in pairs]
    assert got == sorted(set(plain_components(prints).values()))


# Training order


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000, 4097])
def test_permutation_is_one(n):
    slots = order.permute(np.arange(n), n, 99)
    assert sorted(slots.tolist()) == list(range(n))
    assert order.permute(slots, n, 99, back=True).tolist() == list(range(n))


def test_permutation_depends_on_the_key():
    assert order.permute(np.arange(500), 500, 1).tolist() != order.permute(np.arange(500), 500, 2).tolist()


def test_shards_hold_every_document(docs, tmp_path):
    pairs = [*invented(3, 80), *ODD]
    df = docs(pairs, 3)
    where, shards, n = order.write_shards(df, str(tmp_path), length=64, per_shard=50)
    rows = where.collect()
    assert len(rows) == len(pairs)
    read = list(order.read_slots(str(tmp_path), 0, n, 64, 50))
    assert len(read) == n == sum(r.n_slots for r in shards.collect())
    got = []
    for r in rows:
        k = -(-(r.place + r.n_ids) // 64)
        ids = np.arange(r.sequence, r.sequence + k)
        line = b"".join(x.tobytes() for x in order.read_sequences(str(tmp_path), ids, n, length=64, per_shard=50))
        got.append((r.doc_id, line[r.place : r.place + r.n_ids]))
        assert (r.slot, r.shard) == (order.permute([r.sequence], n, 20_240)[0], r.slot // 50)
        data = (tmp_path / order.name(r.shard)).read_bytes()
        assert data[r.offset : r.offset + 1] == line[r.place : r.place + 1]
    want = [(i, (t or "").encode() + b"\xfe") for i, t in pairs]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # A reader that stopped goes on where it was
    later = list(order.read_slots(str(tmp_path), 70, n, 64, 50))
    assert all((a == b).all() for a, b in zip(later, read[70:], strict=True))


def sharded(rows, folder, n, width):
    """(doc_id, ids with the end mark) as the shards hold them."""
    out = []
    for r in rows:
        k = -(-(r.place + r.n_ids) // 64)
        ids = np.arange(r.sequence, r.sequence + k)
        line = np.concatenate(list(order.read_sequences(str(folder), ids, n, length=64, per_shard=50, width=width)))
        data = (folder / order.name(r.shard)).read_bytes()
        assert int.from_bytes(data[r.offset : r.offset + width], "little") == line[r.place]
        out.append((r.doc_id, line[r.place : r.place + r.n_ids].tolist()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [2, 4])
def test_shards_hold_the_ids_of_a_tokenizer(spark, docs, tmp_path, monkeypatch, width):
    import corpus_pipeline
    import sentencepiece
    from tallyforge.llm.common import kept_table

    monkeypatch.setattr(order, "CHUNK_IDS", 100)
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    pairs = [*invented(3, 80), *ODD]
    encoded = kept_table(corpus_pipeline.encoded(spark, docs(pairs, 3), ""), "encoded")
    where, shards, n = order.write_shards(
        encoded, str(tmp_path), length=64, per_shard=50, column="ids", width=width
    )
    assert sum(r.n_bytes for r in shards.collect()) == n * 64 * width
    want = [(i, [*model.encode(t or ""), 2 ** (8 * width) - 2]) for i, t in pairs]
    assert sharded(where.collect(), tmp_path, n, width) == sorted(want, key=repr)
    again = kept_table(pieces.packed(docs(pairs, 3), tokenizer(), width), "packed")
    where, _, n = order.write_shards(
        again, str(tmp_path / "packed"), length=64, per_shard=50, column="ids", width=width
    )
    assert sharded(where.collect(), tmp_path / "packed", n, width) == sorted(want, key=repr)


def test_order_counts_the_ids_of_a_tokenizer(spark, docs, tmp_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    pairs = [*invented(3, 40), *ODD]
    docs(pairs).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.doc_id, r.n_ids) for r in QUERIES["op2_order"](spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((i, len(model.encode(t or "")) + 1) for i, t in pairs), key=repr)


@pytest.mark.parametrize("ids", [[1, 65534], [-1], [3, None]])
def test_ids_that_do_not_fit_are_an_error(frame, tmp_path, ids):
    df = frame([(1, ids)], "doc_id long, ids array<int>", tmp_path / "t")
    with pytest.raises(Exception, match="must be 0 to 65533"):
        order.write_shards(df, str(tmp_path / "shards"), length=64, column="ids", width=2)


def test_ids_of_nothing(frame, tmp_path):
    df = frame([(1, None), (2, [])], "doc_id long, ids array<int>", tmp_path / "t")
    where, _, _ = order.write_shards(df, str(tmp_path / "s"), 64, column="ids", width=2)
    assert sorted((r.doc_id, r.n_ids) for r in where.collect()) == [(1, 1), (2, 1)]


def test_shards_of_nothing(docs, tmp_path):
    where, shards, n = order.write_shards(docs([]), str(tmp_path))
    assert (where.count(), shards.count(), n) == (0, 0, 0)


def test_splits_may_change_between_passes(spark, docs, tmp_path, monkeypatch):
    pairs = [*invented(4, 60), *ODD]
    df = docs(pairs, 1)
    real, passes = order.kept_table, []

    def other_splits(frame, *names):
        # From now on each file is read in several parts, dealt out in another order
        kept = real(frame, *names)
        passes.append(names[0])
        return kept.repartition(7, "doc_id").sortWithinPartitions(F.desc("at")) if names[0] == "placed" else kept

    where, shards, n = order.write_shards(df, str(tmp_path / "a"), 64, 50)
    monkeypatch.setattr(order, "kept_table", other_splits)
    again, others, m = order.write_shards(df, str(tmp_path / "b"), 64, 50)
    assert passes == ["placed", "shards"] and n == m
    assert rows_of(where) == rows_of(again) and rows_of(shards) == rows_of(others)
    for file in (tmp_path / "a").iterdir():
        assert file.read_bytes() == (tmp_path / "b" / file.name).read_bytes()


def test_attempts_at_a_shard_do_not_meet(docs, tmp_path):
    df = docs(invented(5, 30), 2)
    one = rows_of(order.write_shards(df, str(tmp_path / "s"), 64, 50)[1])
    # What an attempt that was lost has left behind is in nobody's way
    for file in list((tmp_path / "s").iterdir()):
        (tmp_path / "s" / f".{file.name}-lost").write_bytes(b"half")
    assert rows_of(order.write_shards(df, str(tmp_path / "s"), 64, 50)[1]) == one
    whole = sorted(f.name for f in (tmp_path / "s").iterdir() if not f.name.startswith("."))
    assert whole == [order.name(r[0]) for r in one]


def test_notes_that_are_not_there_are_an_error(docs, tmp_path, monkeypatch):
    line = "passage " * 20
    df = docs([(i, f"{i} {line}") for i in range(6)], 2)
    real = suffixes._write_notes
    monkeypatch.setattr(suffixes, "_write_notes", lambda *a: real(*a) + "-elsewhere")
    with pytest.raises(Exception, match="can't be reached"):
        suffixes.digests(df).collect()


def test_folders_without_a_scheme_are_those_of_the_session(spark, docs, tmp_path):
    from tallyforge import storage
    from tallyforge.llm.common import located, opened

    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    (tmp_path / "there").mkdir()
    line = " ".join(f"w{i}" for i in range(60))
    df = docs([(i, f"{i} {line}") for i in range(6)], 2)
    want = rows_of(suffixes.digests(df))
    try:
        conf.set("fs.viewfs.mounttable.store.link./tmp", "file:///tmp")
        conf.set("fs.defaultFS", "viewfs://store/")
        assert located(spark, "/tmp/x") == "viewfs://store/tmp/x"
        assert storage.exists(spark, "/tmp")
        # pyarrow doesn't know this store: an error, and no notes that count as empty
        with pytest.raises(Exception, match="viewfs|scheme|FileSystem"):
            suffixes.digests(df).collect()
    finally:
        conf.set("fs.defaultFS", before)
    assert sum(r[2] > 0 for r in want) == 5 and rows_of(suffixes.digests(df)) == want
    assert opened("file:/a/b")[1] == opened("/a/b")[1] == "/a/b"


# SpotSigs


def test_edited_texts_and_likeness(docs):
    pairs = [(i, t) for i, t in [*invented(5, 60), *ODD] if i != 4]
    rows = sorted(pairs, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    got = {}
    for r in spotsigs.compare_edited(docs(pairs, 3)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = next(r for r in got[i] if r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text))
        sets = [set(re.findall(".{8}", x)) for x in (r.fingerprint, r.edited_fingerprint)]
        assert r.near_edited == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]))
        assert 0 <= r.near_next <= 1


def test_spotsigs_of_one_and_none(docs):
    only = spotsigs.compare_edited(docs([(1, "The one and only text here")])).collect()
    assert len(only) == 1 and only[0].near_next == 1
    assert spotsigs.compare_edited(docs([])).count() == 0


def test_repeated_ids_do_not_get_lost(docs):
    assert spotsigs.compare_edited(docs(ODD)).count() == len(ODD)


def test_pruned_likeness_is_exact_above_the_bound():
    choose = random.Random(6)
    for _ in range(300):
        a, b = (np.unique([choose.randrange(30) for _ in range(choose.randint(1, 25))]).astype(np.uint32) for _ in "ab")
        like = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert spotsigs.likeness(a, b) == like
        assert spotsigs.likeness(a, b, 0.5) == (like if like >= 0.5 else 0)


def test_near_documents_find_all_links(docs):
    pairs = invented(7, 90, 15)
    codes = spotsigs._codes()
    found = {i: spotsigs.signatures(t, codes) for i, t in pairs}
    group = {i: {i} for i in found}
    for a in found:
        for b in found:
            if a < b and spotsigs.likeness(found[a], found[b], 0.6) > 0:
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    got = {r.doc_id: r.component_id for r in spotsigs.near_documents(docs(pairs), 0.6).collect()}
    assert got == {i: min(g) for i, g in group.items()}


# Lattice


def test_forward_recursion_adds_all_segmentations():
    names = ["▁", "a", "b", "ab", "▁a", "ba", "bab", "▁ab"]
    weights = np.log(np.array([[0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.2, 0.1 / 256]]))
    model = lattice.Lattice(names, weights)
    p = dict(zip(names, np.exp(weights[0, :-1]), strict=True))

    def plain(text):
        if not text:
            return 1.0
        total = sum(p[x] * plain(text[len(x) :]) for x in names if text.startswith(x))
        if text[0] not in p:
            total += math.exp(weights[0, -1]) ** len(text[0].encode()) * plain(text[1:])
        return total

    words = ["ab", "abba", "babab", "", "é", "aéb", "x中"]
    got = model.log_probability(words)[:, 0]
    assert got == pytest.approx([math.log(plain("▁" + w)) for w in words])
    # Expected counts: the slope of the log probability by each log weight
    for k in range(len(names)):
        up = weights.copy()
        up[0, k] += 1e-6
        slope = (lattice.Lattice(names, up).log_probability(words) - model.log_probability(words)).sum() / 1e-6
        assert model.expected(words, np.ones((len(words), 1)))[0, k] == pytest.approx(slope, abs=1e-4)


def test_gathered_batches_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(lattice, "GATHERED_WORDS", 5)
    cuts = ((0, 2), (2, 2), (2, 9), (9, 10))
    parts = [pa.record_batch({"word": pa.array([f"w{k}" for k in range(a, b)], pa.string())}) for a, b in cuts]
    got = list(lattice.gathered(iter(parts)))
    assert [b.num_rows for b in got] == [9, 1]
    assert [w for b in got for w in b.column("word").to_pylist()] == [f"w{k}" for k in range(10)]
    monkeypatch.setattr(lattice, "GATHERED_BYTES", 1)
    assert sum(b.num_rows for b in lattice.gathered(iter(parts))) == 10
    assert list(lattice.gathered(iter([]))) == []


@pytest.mark.parametrize("known", [5, 100_000])
def test_scores(docs, known):
    pairs = [*invented(8, 120), *ODD]
    got = lattice.score(docs(pairs, 3), tokenizer(), known).collect()
    train = [(i, t) for i, t in pairs if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    counts = Counter(w for _, t in train for w in (t or "").encode().lower().split())
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    want = []
    for i, t in pairs:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [len(train), *(counts[w] for w in words)])
        known_words = 1 + sum(counts[w] > 0 for w in words)
        held = zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
        want.append((i, held, len(words) + 1, known_words, n, round(base, 5)))
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_scores_do_not_depend_on_what_is_joined(docs):
    df = docs(invented(9, 60))
    few, all_ = (rows_of(lattice.score(df, tokenizer(), k).select("doc_id", "score")) for k in (3, 10**6))
    assert [x[1] for x in few] == pytest.approx([x[1] for x in all_], abs=1e-5)


def test_scores_of_nothing(docs):
    assert lattice.score(docs([]), tokenizer()).count() == 0


def test_held_out_texts_are_likelier_than_under_words_alone(spark):
    found = QUERIES["op5_lattice"](spark, "/root/testdata/sf0.1").where("held_out")
    r = found.selectExpr("sum(score) as own", "sum(base_score) as base").first()
    assert r.own > r.base


# Decontamination


def plain_hits(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, names = cut(text), set(), set()
    for i, item in items:
        run = cut(item)
        n = min(window, len(run))
        lines = {tuple(run[k : k + n]) for k in range(len(run) - n + 1)} if run else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in lines:
                hit |= set(range(k, k + n))
                names.add(i)
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block", [25, 200_000])
def test_hits_match_plain_python(spark, docs, block):
    choose = random.Random(10)
    some = lambda n: " ".join(choose.choice("abcde") for _ in range(n))
    items = [(i, some(choose.randint(1, 30))) for i in range(12)] + [(98, None), (99, "--"), (0, "a b c"), (97, "Ab-C é d")]
    texts = [some(choose.randint(0, 60)) for _ in range(60)] + [items[k][1].upper() for k in range(8)] + ["x ab.c É é d y"]
    pairs = [*enumerate(texts, 20), *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, name = decontaminate.mark(docs(pairs), bench, 10, block)
    got = [(r.doc_id, r[name].n_words, sum(s.end - s.begin for s in r[name].spans), r[name]["items"]) for r in rows.collect()]
    assert sorted(got, key=repr) == sorted([(i, *plain_hits(t, items)) for i, t in pairs], key=repr)


@pytest.mark.parametrize("block", [5, 200_000])
def test_items_without_an_id_hit_as_in_the_sql(spark, docs, tmp_path, monkeypatch, block):
    import duckdb
    from tallyforge.llm.queries import SQL

    line = lambda k: " ".join(f"{k}{c}" for c in "abcdefghijkl")
    items = [(None, line("x")), (None, line("y")), (None, "q r s"), (3, line("z")), (4, line("x")), (5, None)]
    texts = [line("x"), f"own {line('y')} {line('x')} own", "o q r s o", line("z"), f"{line('y')} {line('z')}", "own"]
    docs([*enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    monkeypatch.setattr(decontaminate.mark, "__defaults__", (10, block))
    got = rows_of(QUERIES["op6_decontaminate"](spark, str(tmp_path)))
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert got == sorted(db.execute(SQL["op6_decontaminate"]).fetchall(), key=repr)
    assert [r[5] for r in got] == [True] * 5 + [False]
    assert [r.doc_id for r in decontaminate.clean(docs([(1, texts[2]), (2, line("y"))]), bench).collect()] == [1]


def test_clean_cuts_passages_and_leaves_the_rest(spark, docs):
    item = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    own = "Own words stand here, more of them than of the other."
    pairs = [(1, f"{own} {item.title()}! {own}"), (2, own), (3, item), (4, None), (5, "")]
    got = {r.doc_id: r for r in decontaminate.clean(docs(pairs), bench).collect()}
    assert got[1].text == f"{own} ! {own}" and got[1].n_chars == len(got[1].text)
    assert got[2].text == own and got[4].text is None and got[5].text == ""
    assert 3 not in got


def test_no_benchmark_hits_nothing(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(docs(ODD), bench).count() == len(ODD)
    assert decontaminate.contamination(docs([]), bench).count() == 0


# SentencePiece


def test_encoding_is_that_of_the_library(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    choose = random.Random(11)
    alphabet = " ▁ab\n\té\U0001f600中a  the in on er\x00"
    pairs = [*ODD, *enumerate(("".join(choose.choice(alphabet) for _ in range(choose.randint(0, 80))) for _ in range(400)), 100)]
    pairs += [(900, " " * 50), (901, "ab" * 700), (902, "�"), (903, "<s></s><unk><0x41>")]
    got = [(r.doc_id, r.ids, r.decoded, r.n_tokens) for r in pieces.encode(docs(pairs), tokenizer()).collect()]
    want = [(i, ids, model.decode(ids), len(ids)) for i, t in pairs for ids in [model.encode(t or "")]]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    short = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digests(docs(pairs), tokenizer()).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert short == {(i, n, sha(",".join(map(str, ids))), sha(text)) for i, ids, text, n in want}


def test_decoding_any_ids_is_that_of_the_library():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer())
    own, choose = pieces.load(tokenizer()), random.Random(12)
    for _ in range(500):
        ids = [choose.choice([choose.randint(0, 258), choose.randint(259, 31999)]) for _ in range(9)]
        if not set(ids) & {0, 1, 2}:
            assert own.decode(ids) == model.decode(ids)


# Suffix arrays


def plain_repeats(pairs):
    seen, gone = set(), []
    for i, t in sorted(pairs, key=lambda x: (x[0] is None, x[0] or 0)):
        data = (t or "").encode()
        out = np.zeros(len(data), bool)
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                out[p : p + 100] = True
            seen.add(data[p : p + 100])
        left = bytes(b for b, g in zip(data, out, strict=True) if not g)
        spans = int((np.diff(np.r_[False, out].astype(int)) == 1).sum())
        gone.append((i, len(data), int(out.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(gone, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_match_plain_python(docs, seed):
    choose = random.Random(seed)
    pairs = invented(20 + seed, 60, 10)
    base = "".join(choose.choice("abcdefgh é") for _ in range(400))
    for k in range(40):
        a = choose.randrange(250)
        part = base[a : a + choose.choice([90, 99, 100, 101, 107, 150])]
        pairs.append((1000 + k, "".join(choose.choice("xyz") for _ in range(choose.randrange(60))) + part))
    pairs += [(2000, "ab" * 400), (2001, "ab" * 100 + "c" * 300), (2002, "q" * 100), (2003, "q" * 99), (2004, None)]
    got = rows_of(suffixes.digests(docs(pairs, 3)))
    assert got == plain_repeats(pairs)


def test_hot_regions_match_plain_python(docs, monkeypatch):
    """A line in all documents, between words of their own: every key at its edges is hot."""
    choose = random.Random(30)
    line = "".join(choose.choice("abcdefghij ") for _ in range(220))
    own = lambda: "".join(choose.choice("klmnop ") for _ in range(80))
    pairs = [(i, own() + line + own()) for i in range(90)]
    assert rows_of(suffixes.digests(docs(pairs, 1))) == plain_repeats(pairs)
    assert rows_of(suffixes.digests(docs(pairs, 4))) == plain_repeats(pairs)


def test_long_texts_are_cut_in_overlapping_parts(docs, monkeypatch):
    choose = random.Random(31)
    text = "".join(choose.choice("abcdefgh ") for _ in range(300_000))
    pairs = [(1, text), (2, text[1000:200_000]), (3, text[-150:])]
    got = {r.doc_id: r.n_removed for r in suffixes.digests(docs(pairs, 1)).collect()}
    assert got == {1: 0, 2: 199_000, 3: 150}


def test_repeats_odd_rows_and_nothing(docs):
    assert suffixes.digests(docs(ODD)).count() == len(ODD)
    assert suffixes.digests(docs([])).count() == 0
    assert suffixes.cut(docs([])).count() == 0


def test_repeats_when_splits_change_between_the_passes(docs, conf):
    pairs = invented(41, 80, 10)
    df = docs(pairs, 8)
    conf(spark__sql__files__openCostInBytes="0")
    one, other = suffixes.digests(df), suffixes.cut(df)
    conf(spark__sql__files__openCostInBytes="4194304")
    assert rows_of(one) == plain_repeats(pairs)
    left = {r[0]: r[4] for r in plain_repeats(pairs)}
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in other.collect()}.items() <= left.items()


def test_cut_leaves_text_and_drops_empty_rest(docs):
    long = "é" * 7 + "".join(random.Random(32).choices("abcdef é", k=300))
    got = {r.doc_id: r for r in suffixes.cut(docs([(1, long), (2, long), (3, "own " + long + " own"), (4, None), (5, "")])).collect()}
    assert got[1].text == long and 2 not in got
    assert got[3].text == "own  own" and got[3].n_chars == 8
    assert got[4].text is None and got[5].text == ""


def test_levels_know_what_was_there():
    choose, levels, seen = random.Random(33), suffixes.Levels(), set()
    for _ in range(60):
        batch = np.array([choose.randrange(900) for _ in range(choose.randint(1, 40))], np.uint64)
        want = []
        for x in batch.tolist():
            want.append(x in seen)
            seen.add(x)
        assert levels.add(batch).tolist() == want
        sizes = [len(x) for x in levels.levels]
        assert all(2 * b <= a for a, b in zip(sizes, sizes[1:], strict=False))
