"""The training-data operators against brute force, with the edge cases that their docstrings define."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dispatchlake.llm import (
    chat,
    components,
    cosine,
    encoding,
    jaccard,
    mixing,
    neighbours,
    packing,
    queries,
    secrets,
    shingles,
    tokencounts,
    tokenfiles,
    toxicity,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, slot long"


def documents(spark, rows):
    """Rows (doc_id, text[, source]) with extra columns whose names the operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 0.5, 7, 1) for r in rows]
    return spark.createDataFrame(full, DOC)


def words(rnd, n, size=400):
    return " ".join(f"w{rnd.randrange(size)}" for _ in range(n))


# 1 ---------------------------------------------------------------------------
def test_neighbours_reach_brute_force_and_keep_ties(spark):
    rnd = np.random.default_rng(1)
    x = rnd.standard_normal((900, 16)).round(3)
    x[300:340] = x[100]  # copies: ties by id
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2100, [1.0, None], 1)]
    rows += [(None, x[0].tolist(), 1), (100, x[100].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = total = 0
    for q in range(0, 900, 100):
        gap = np.sqrt(((x - x[q]) ** 2).sum(1))
        gap[q] = np.inf
        best = np.lexsort((np.arange(900), gap))[:10]
        mine = [got[q][k] for k in range(1, 11)]
        assert all(abs(gap[i] - s) < 1e-12 for i, s in mine)
        hit, total = hit + len({i for i, _ in mine} & set(best.tolist())), total + 10
    assert set(got) == set(range(0, 900, 100)) and hit / total >= 0.9
    assert [got[100][k][0] for k in range(1, 11)] == list(range(300, 310))


def test_neighbours_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0, 1.0])], schema)
    assert [(r.query_id, r.vec_id) for r in neighbours.nearest(few, F.col("vec_id") == 0).collect()] == [(0, 1)]
    assert neighbours.nearest(few.limit(0), F.lit(True)).count() == 0


# 2 ---------------------------------------------------------------------------
def word_set(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, linked):
    least = [r for r in range(len(rows))]

    def find(a):
        while least[a] != a:
            a = least[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(rows))]


def corpus(seed=3):
    rnd = random.Random(seed)
    base = [words(rnd, rnd.choice([3, 5, 20, 80, 200])) for _ in range(25)]
    passage = words(rnd, 40)
    texts = list(base)
    for t in base:
        for _ in range(rnd.randrange(4)):
            w = t.split()
            for _ in range(rnd.randrange(3)):
                w[rnd.randrange(len(w))] = f"x{rnd.randrange(99)}"
            texts.append(" ".join(w))
    texts += [t.upper() for t in base[:4]] + [words(rnd, 60) + " " + passage for _ in range(12)]
    near = words(rnd, 120).split()
    for i in range(150):  # a list longer than FULL_LIST
        w = list(near)
        for _ in range(rnd.randrange(6)):
            w[rnd.randrange(len(w))] = f"y{rnd.randrange(999)}"
        texts.append(" ".join(w))
    return texts + ["", None, "  \n\t", "one", "one", words(rnd, 20_000)]


def test_bucket_ranks_equal_those_of_the_whole_table(spark):
    rnd = random.Random(8)
    for rows in ([], [(1, words(rnd, 300))], [(i, words(rnd, 20_000, 10_000)) for i in range(120)]):
        named = documents(spark, rows).repartition(5).selectExpr("doc_id", "text", "1L mark").mapInArrow(jaccard._namer(5), jaccard.NAMED_SQL)
        counts = np.zeros(jaccard.BUCKETS)
        for _, text in rows:
            (found,) = shingles.shingle_sets([text])
            np.add.at(counts, jaccard._bucket(found), 1)
        middle = np.median(counts)
        assert (middle > 0) == (len(rows) > 100)
        chance = max(middle, 1.0) ** 0.5
        steps = np.clip(np.round(4 * (counts - middle) / chance) + jaccard.HOT // 3, 0, jaccard.HOT - 1)
        bound = middle + jaccard.HOT / 6 * chance
        over = jaccard.HOT + np.floor(8 * np.log2(np.maximum(counts / bound, 1.0)))
        assert (jaccard.levels(named) == np.minimum(np.where(counts > bound, over, steps), 255)).all()


def test_jaccard_finds_every_component(spark):
    texts = corpus()
    rows = list(enumerate(texts))
    sets = [word_set(t) for t in texts]
    linked = lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    want = {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, brute_components(rows, linked)))}
    df = documents(spark, rows).union(documents(spark, [(None, texts[0]), (0, texts[0])])).repartition(5)
    got = [tuple(r) for r in jaccard.similar_documents(df).collect()]
    assert len(got) == len(rows) + 2 and (None, len(sets[0]), None) in got
    assert {i: (n, c) for i, n, c in got if i is not None} == want
    kept = {r.doc_id for r in jaccard.without_copies(df).collect()}
    assert kept == {i for i, (_, c) in want.items() if c == i} | {None}


def test_jaccard_links_single_variants_of_spread_shingles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT_FROM", 1)
    rnd = random.Random(11)
    texts = []
    for g in range(6):
        base = words(rnd, 80, 4000)
        texts += [base] * 200 + [f"v{g} " + base.split(" ", 1)[1]]
    sets = [word_set(t) for t in texts]
    rows = list(enumerate(texts))
    same = {t: i for i, t in reversed(rows)}  # of exact copies only the first is compared
    firsts = sorted(same.values())
    linked = lambda i, j: 100 * len(sets[firsts[i]] & sets[firsts[j]]) >= 80 * len(sets[firsts[i]] | sets[firsts[j]])
    roots = dict(zip(firsts, (firsts[r] for r in brute_components(firsts, linked))))
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(documents(spark, rows).repartition(5)).collect()}
    assert got == {i: roots[same[t]] for i, t in rows} and len(set(got.values())) == 6


def test_jaccard_count_tables_are_narrow():
    size = jaccard.BUCKETS // jaccard.COUNT_CHUNKS
    rnd = np.random.default_rng(3)
    for most, share, bound in ((3, 1.0, size), (255, 0.5, size), (256, 0.5, 2 * size), (3, 0.001, 1000), (2**40, 1.0, 8 * size)):
        counts = np.where(rnd.random(size) < share, rnd.integers(1, most, size, endpoint=True), 0)
        counts[rnd.integers(size)] = most
        raw = jaccard._pack_counts(counts)
        held, found = jaccard._held_counts(raw)
        assert held.tolist() == np.flatnonzero(counts).tolist() and found.tolist() == counts[held].tolist()
        assert len(raw) <= 5 + bound


def named_sets(spark, rows):
    named = documents(spark, rows).selectExpr("doc_id", "text", "1L mark").mapInArrow(jaccard._namer(5), jaccard.NAMED_SQL)
    return named.filter("chunk is null").selectExpr("key", "doc_id doc", "n", "shape")


def test_jaccard_shapes_tell_long_unrelated_sets_apart(spark):
    rnd = random.Random(21)
    rows = [(i, words(rnd, 5000 + 100 * i, 5000)) for i in range(4)]
    w = rows[0][1].split()
    w[::100] = [f"z{i}" for i in range(50)]  # 250 of some 5000 shingles differ
    rows.append((4, " ".join(w)))
    sets = named_sets(spark, rows)
    keys = {r.doc: r.key for r in sets.collect()}
    pairs = [tuple(sorted((keys[i], keys[j]))) for i in keys for j in keys if i < j]
    near = jaccard._near(spark.createDataFrame(pairs, "a long, b long"), sets, 80)
    assert [(r.a, r.b) for r in near.collect()] == [tuple(sorted((keys[0], keys[4])))]


def test_jaccard_shapes_never_exceed_the_difference():
    rnd = np.random.default_rng(5)
    for n, m, both in ((1, 1, 0), (30, 25, 24), (250, 300, 240), (500, 520, 450), (3000, 2600, 2500), (70_000, 140_000, 65_000)):
        drawn = np.unique(rnd.integers(0, 1 << 63, n + m - both, dtype=np.uint64))
        a, b = drawn[:n], drawn[n - both :]
        found = jaccard._differing(*(jaccard._shapes([jaccard._shape(x)]) for x in (a, b)))
        assert 0 < found[0] <= len(np.setxor1d(a, b)) and (found[0] - len(np.setxor1d(a, b))) % 2 == 0


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_jaccard_sends_sets_once_for_each_lot(spark, monkeypatch, broadcast):
    settled = {}
    keep = jaccard.settle
    monkeypatch.setattr(jaccard, "settle", lambda df, label: settled.setdefault(label, keep(df, label)))
    monkeypatch.setattr(jaccard, "LOT", 4, raising=False)
    monkeypatch.setattr(jaccard, "BROADCAST_SENDS", broadcast, raising=False)
    rnd = random.Random(22)
    base = words(rnd, 300, 3000).split()
    texts = [" ".join(base)]
    for i in range(30):
        w = list(base)
        for k in rnd.sample(range(300), 2 + i // 2):
            w[k] = f"x{rnd.randrange(9999)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(3, texts[3]), (4, "another text of the same id")]
    docs = documents(spark, rows).select("doc_id", "text").repartition(3)
    sets = named_sets(spark, rows[: len(texts)])
    of = {r.key: word_set(texts[r.doc]) for r in sets.collect()}
    hub = next(r.key for r in sets.collect() if r.doc == 0)
    pairs = [(hub, k, len(of[hub]), len(of[k])) for k in of if k != hub]
    near = spark.createDataFrame(pairs, "a long, b long, n_a long, n_b long")
    got = {(r.a, r.b) for r in jaccard._overlapping(near, sets, docs, 5, 80).collect()}
    assert got == {(a, b) for a, b, *_ in pairs if 100 * len(of[a] & of[b]) >= 80 * len(of[a] | of[b])} and 0 < len(got) < 30
    assert not any("hashes" in df.columns for df in settled.values())  # no copy of the sets in the shared folder
    to = [(r.key, p.first, p.lot) for r in settled["jaccard-sends"].collect() for p in r.to]
    assert len(to) == len(set(to)) <= len(pairs) + -(-len(pairs) // 4)
    assert [p for p in to if p[0] != hub and p[1] != hub] == [] and len({p for p in to if p[0] == hub}) > 1


def test_jaccard_fragments_leave_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(jaccard, "SEND_BYTES", 1, raising=False)
    text = words(random.Random(23), 500)
    (found,) = shingles.shingle_sets([text])
    key = jaccard.set_key(found)
    places = [{"first": i, "lot": 0} for i in range(5)]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("lot", pa.int32())]))
    rows = [pa.array([1, 1]), pa.array([text, "not the wanted set"]), pa.array([key, key]), pa.array([places, places], kind)]
    batches = list(jaccard._segmenter(5)(iter([pa.RecordBatch.from_arrays(rows, names=["doc_id", "text", "key", "to"])])))
    assert len(batches) == 5
    for batch in batches:
        assert batch.column(4).to_pylist() == [len(found)] * batch.num_rows
        assert np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).tolist() == found.tolist()


def test_jaccard_of_nothing(spark):
    assert jaccard.similar_documents(documents(spark, []).limit(0)).count() == 0


def test_shingle_sets_count_distinct_shingles():
    texts = corpus(5)
    assert [len(s) for s in shingles.shingle_sets(texts)] == [len(word_set(t)) for t in texts]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 300), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 300: 200}


# 3, 4 ------------------------------------------------------------------------
ODD_TEXTS = ["", None, "a", "a  b", " lead", "trail ", "x\n\ny \n z", "tab\there", "<|endoftext|> x", "é中😀 ½²", "no" * 900]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark, folder, library):
    rnd = random.Random(4)
    rows = [(i * 3, t) for i, t in enumerate([*ODD_TEXTS, *(words(rnd, 300, 5000) for _ in range(80))])]
    path = folder("tokens")
    tokenfiles.write_tokens(documents(spark, rows).repartition(4), path)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenfiles.read_digests(spark, path).collect()}
    start, want = 0, {}
    for doc, text in rows:
        ids = ids_of(library, text)
        want[doc] = (start, len(ids), crc(ids))
        start += len(ids)
    assert got == want
    assert tokenfiles.read_document(spark, path, 30) == [ids_of(library, rows[10][1])]


def test_encoder_cuts_change_no_ids(library):
    rnd = random.Random(8)
    signs = [*" \n\t\r\x1c\x85\xa0,.'-_`<|~[", " ", " ", "\u1680", "\u2003", "\u2028", "\u3000", "\u200b", "“", "。", "\u0301", "\0"]
    pieces = [*signs, "'s", "'LL", "the", "É", "à", "×", "÷", "ß", "7", "½", "中", "ا", "😀", "ǅ", "<|endoftext|>", "<|end"]
    encode = encoding.Encoder()
    for k in range(400):
        texts = [None if rnd.random() < 0.1 else "".join(rnd.choices(pieces, k=rnd.randrange(14))) for _ in range(k % 9)]
        column = pa.array(["zz", *texts], pa.string()).slice(1)
        want = [np.array(ids_of(library, t)[:-1], "<u4").tobytes() for t in texts]
        assert list(encode.encode(column)) == list(encode.encode(texts)) == want


def test_encoder_keeps_letters_and_signs_apart():
    """A word is learnt once, whatever signs follow it, and a batch is looked up by its distinct parts."""
    encode = encoding.Encoder()
    assert len(list(encode.encode(pa.array(["été, été. été\nfoo's", None, " été; été"])))) == 3
    assert set(encode.young) == {p.encode() for p in ("été", " été", ",", ".", ";", "\n", "foo's")}


def test_token_files_of_nothing(spark, folder):
    tokenfiles.write_tokens(documents(spark, []).limit(0), folder("none"))
    assert tokenfiles.read_digests(spark, folder("none")).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 32])
def test_bit_packing_has_random_access(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint32)
    packed = tokenfiles.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    for first, count in ((0, 1001), (7, 100), (1000, 1), (500, 0)):
        assert tokenfiles.unpack(packed, bits, first, count).tolist() == ids[first : first + count].tolist()


def test_packing_places_every_piece(spark, library):
    rnd = random.Random(6)
    rows = [(i, t) for i, t in enumerate([*ODD_TEXTS, *(words(rnd, rnd.randrange(1, 900)) for _ in range(60))])]
    rows += [(7, rows[7][1]), (None, "x")]
    got = packing.pack_documents(documents(spark, rows).repartition(3)).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= packing.CAPACITY
    pieces = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got)
    want = []
    for doc, text in rows:
        ids = ids_of(library, text)
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        want += [(str(doc), k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))]
    assert pieces == sorted(want)
    counts = [0] * 1025
    for r in got:
        counts[r.length] += 1
    assert len(sequences) <= packing.lower_bound(counts, 1024) + 1
    assert packing.pack_documents(documents(spark, []).limit(0)).count() == 0


def fewest(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in {b for b in bins if b >= items[i]}:
            rest = list(bins)
            rest[rest.index(room)] -= items[i]
            place(i + 1, rest)
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_is_optimal_on_small_cases(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 30, 50])
    items = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(0, 11))), reverse=True)
    counts = [items.count(s) for s in range(capacity + 1)]
    plan = packing.bin_completion(counts, capacity)
    assert all(sum(s * k for s, k in f) <= capacity for _, f in plan)
    assert [sum(m * dict(f).get(s, 0) for m, f in plan) for s in range(capacity + 1)] == counts
    assert sum(m for m, _ in plan) == fewest(items, capacity)


def test_bin_completion_equals_an_exact_search():
    """10,000 cases of up to 14 pieces; a plan that meets the lower bound needs no second search."""
    rnd = random.Random(14)
    for _ in range(10_000):
        capacity, n = rnd.choice([20, 30, 50, 64]), rnd.randint(7, 14)
        items = [rnd.randint(max(1, capacity // 9), capacity // 2) for _ in range(n)]
        counts = [items.count(s) for s in range(capacity + 1)]
        found = sum(m for m, _ in packing.bin_completion(counts, capacity))
        if found > packing.lower_bound(counts, capacity):
            assert found == fewest(sorted(items, reverse=True), capacity), (items, capacity)
    items = [21, 21, 21, 18, 17, 15, 14, 14, 14, 12, 10, 9, 8, 6]
    plan = packing.bin_completion([items.count(s) for s in range(51)], 50)
    assert sum(m for m, _ in plan) == 4


@pytest.mark.parametrize("seed", range(40))
def test_fillings_are_the_undominated_ones(seed):
    rnd = random.Random(seed)
    room = rnd.randint(5, 30)
    left = [0] * (room + 1)
    for _ in range(rnd.randint(0, 8)):
        left[rnd.randint(1, room)] += 1
    items = [s for s, c in enumerate(left) for _ in range(c)]
    every = {()}
    for size in items:
        every |= {tuple(sorted((*f, size))) for f in every}
    fits = [f for f in every if sum(f) <= room and all(f.count(s) <= left[s] for s in f)]

    def grouped(small, big):
        """Whether the pieces of ``small`` go into bins as large as the pieces of ``big``."""
        if not small:
            return True
        return any(
            b >= small[-1] and grouped(small[:-1], (*big[:i], b - small[-1], *big[i + 1 :])) for i, b in enumerate(big)
        )

    undominated = {f for f in fits if not any(g != f and grouped(f, g) for g in fits)}
    got = [f for f in packing.fillings(left, room, lambda: room) if f is not None]
    assert {tuple(sorted(s for s, k in f for _ in range(k))) for f in got} == undominated
    wastes = [room - sum(s * k for s, k in f) for f in got]
    assert wastes == sorted(wastes) and len(set(got)) == len(got)


# 5 ---------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(10))
def test_schedule_deviates_less_than_one_block(seed):
    rnd = random.Random(seed)
    weights = [rnd.randint(1, 9) for _ in range(rnd.randint(1, 7))]
    order = mixing.period(weights)
    assert [order.count(s) for s in range(len(weights))] == weights
    assert all(abs(lag) < 1 for row in mixing.lags(order, weights) for lag in row)
    blocks = [rnd.randint(0, 40) for _ in weights]
    schedule, slots = mixing.Schedule(weights, blocks), []
    for s, n in enumerate(blocks):
        _, slot, release, due = schedule.place(s, np.arange(n))
        assert (release <= slot).all() and (slot < due).all()
        slots += slot.tolist()
    assert sorted(slots) == list(range(sum(blocks)))


def earliest_deadline_first(weights, blocks):
    """Every slot looks at every source: the released block with the earliest deadline goes out."""
    out, done = [], [0] * len(weights)
    while sum(done) < sum(blocks):
        now = [s for s in range(len(weights)) if done[s] < blocks[s]]
        now = [s for s in now if weights[s]] or now
        w = {s: weights[s] or 1 for s in now}
        total, sent, t = sum(w.values()), dict.fromkeys(now, 0), 0
        while all(done[s] < blocks[s] for s in now):
            ready = [s for s in now if Fraction(sent[s] * total, w[s]) < t + 1]
            s = min(ready, key=lambda s: (-(-(sent[s] + 1) * total // w[s]), s))
            sent[s], done[s], t = sent[s] + 1, done[s] + 1, t + 1
            out.append(s)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_schedule_is_earliest_deadline_first(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 8)
    weights, blocks = [rnd.randint(0, 9) for _ in range(n)], [rnd.randint(0, 40) for _ in range(n)]
    schedule, slots = mixing.Schedule(weights, blocks), {}
    for s in range(n):
        slots |= dict.fromkeys(schedule.place(s, np.arange(blocks[s]))[1].tolist(), s)
    assert [slots[t] for t in range(sum(blocks))] == earliest_deadline_first(weights, blocks)


def test_shares_follow_the_targets():
    assert mixing.shares([10, 10], [0.5, None]) == [0.5, 0.5]
    assert mixing.shares([1, 1, 9], [0.6, None, None]) == pytest.approx([0.6, 0.1, 0.3])
    assert mixing.shares([1, 1], [3, None]) == [3, 0]
    assert mixing.shares([1, 4], [None, None]) == pytest.approx([1 / 3, 2 / 3])
    assert mixing.shares([1, 4], [0.2, None], other=0.1) == [0.2, 0.1]
    for parts in ([0.9, 0.0999, 0.0001], [1, 1, 1], [0.7, 0.2999, 0.0001 / 3]):
        weights = mixing.whole_weights(parts)
        assert [w / sum(weights) for w in weights] == pytest.approx([p / sum(parts) for p in parts], rel=0.25)
    assert mixing.whole_weights([0.9, 0.0999, 0.0001]) == [90_000, 9_990, 10]
    for wrong in (-1, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            mixing.shares([1], [wrong])


@pytest.mark.parametrize("fan", [3, 7, 100])
def test_levels_keep_every_block_and_the_shares(fan):
    rnd = random.Random(fan)
    parts, blocks = [rnd.choice([1, 2, 5, 40]) for _ in range(60)], [200] * 60
    levels, slots = mixing.Levels(parts, blocks, fan), {}
    for s, n in enumerate(blocks):
        slots |= dict.fromkeys(levels.place(s, np.arange(n))[1].tolist(), s)
    assert sorted(slots) == list(range(sum(blocks)))
    depth = {3: 4, 7: 3, 100: 1}[fan]
    first_end = 200 * sum(parts) // 40  # until then all sources are there
    sent = [0] * 60
    for t in range(first_end // 2):
        sent[slots[t]] += 1
        assert all(abs(n - (t + 1) * p / sum(parts)) < depth * 1.1 for n, p in zip(sent, parts))


def test_half_of_the_mix_is_a_half(spark):
    rnd = random.Random(4)
    df = documents(spark, [(i, words(rnd, 40), "ab"[i % 2]) for i in range(600)])
    got = mixing.mix(df, targets={"a": 0.5, "nowhere": 0.5}, block_bytes=256).collect()
    first = {r.slot: r.source for r in got if r.slot < 100}
    assert abs(list(first.values()).count("a") - len(first) / 2) <= 3
    nothing_left = mixing.mix(df, targets={"a": 1.0}, block_bytes=256).collect()
    assert max(r.slot for r in nothing_left if r.source == "a") < min(r.slot for r in nothing_left if r.source == "b")


def test_mix_places_documents_as_a_stream(spark):
    rnd = random.Random(8)
    rows = [(i, words(rnd, rnd.randrange(60)), rnd.choice(["a", "a", "a", "b", None])) for i in range(300)]
    rows += [(300, None, "b"), (301, "", "c"), (0, rows[0][1], rows[0][2]), (None, "q", "a")]
    df = documents(spark, rows)
    got = mixing.mix(df, targets={"a": 0.5, "b": 0.25}, other=0.25, block_bytes=500).collect()
    assert len(got) == len(rows)
    size = lambda t: max(1, len((t or "").encode()))
    for source in ("a", "b", "c", None):
        mine = sorted((r.block * 500 + r.within for r in got if r.source == source))
        total = sum(size(t) for _, t, s in rows if s == source)
        assert mine[0] == 0 and mine[-1] < total and len(mine) == sum(s == source for *_, s in rows)
    owners = {}
    for r in got:
        assert owners.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    kept = mixing.mixed(df)
    assert kept.columns == df.columns and sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert mixing.mix(df.limit(0)).count() == 0


# 6 ---------------------------------------------------------------------------
def test_counts_are_those_of_the_unigram_tokenizer(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = tokencounts.read_pieces()
    vocabulary = [("<unk>", 0.0), *pieces, *((f"<0x{i:02X}>", 0.0) for i in range(256))]
    exact = Tokenizer(models.Unigram(vocabulary, 0, True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab  \n中é.thein😀the") for _ in range(rnd.randint(1, 60))).lstrip() for _ in range(400)]
    texts += [words(rnd, 5000)]
    df = documents(spark, [*enumerate(texts), (-1, None), (-2, ""), (None, "a"), (0, texts[0])])
    got = {r.doc_id: r.n_tokens for r in tokencounts.token_counts(df).collect()}
    want = {i: len(exact.encode(t).ids) for i, t in enumerate(texts) if t}
    assert {i: got[i] for i in want} == want and got[-1] == got[-2] == 0
    assert tokencounts.token_counts(df.limit(0)).count() == 0


def test_viterbi_takes_the_longest_piece_among_equals():
    count = tokencounts.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("c", -3.0), ("bc", -4.0)])
    assert count.viterbi("ab") == 1 and count.viterbi("abc") == 2 and count.viterbi("é") == 2


# 7 ---------------------------------------------------------------------------
def test_chat_links_calls_and_results(spark):
    call = '{"tool_calls":[{"id":"c1","name":"add","arguments":{"b":2,"a":1}},{"id":"c2","name":"none","arguments":{}}]}'
    rows = [
        (1, 0, "user", 'say "hi"\n'),
        (1, 1, "tool", '{"tool_call_id":"c1","content":"3"}'),
        (1, 2, "assistant", call),
        (1, 3, "tool", '{"tool_call_id":"zz","content":"?"}'),
        (1, 4, "assistant", '{"tool_calls":[{"id":"c1","name":"add","arguments":{"a":"x"}}],"content":"again"}'),
        (2, 0, None, None),
        (2, 1, "assistant", "{broken"),
        (2, 1, "assistant", "{broken"),
        (None, None, "user", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    tools = spark.createDataFrame([("add", ["a", "b"], {"a": "integer", "b": "number"})], chat.TOOLS)
    got = chat.format_chat(df.withColumn("calls", F.lit(1)), tools).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 0].message == '{"content":"say \\"hi\\"\\n","role":"user"}'
    assert (by[1, 1].place_turn, by[1, 1].place_depth, by[1, 1].linked) == (2, 1, True)
    assert (by[1, 2].n_calls, by[1, 2].n_valid) == (2, 1)
    assert by[1, 2].message == (
        '{"content":null,"role":"assistant","tool_calls":[{"arguments":{"a":1,"b":2},"id":"c1","name":"add","valid":true},'
        '{"arguments":{},"id":"c2","name":"none","valid":false}]}'
    )
    assert by[1, 3].linked is False and by[1, 4].n_valid == 0
    assert by[2, 0].message == '{"content":null}' and by[2, 1].message == '{"content":"{broken","role":"assistant"}'
    assert by[None, None].message == '{"content":"","role":"user"}'
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_checks_calls_against_what_their_conversation_states(spark, folder):
    add = '{"name":"add","parameters":{"properties":{"a":{"type":"integer"},"b":{"type":["string","null"]}},"required":["a"]}}'
    now = '{"type":"function","function":{"name":"now"}}'
    other = '{"name":"add","parameters":{"properties":{"a":{"type":"string"}}}}'
    calls = ['{"id":"1","name":"add","arguments":{"a":1,"b":"x"}}', '{"id":"2","name":"add","arguments":{"a":"x"}}']
    calls += ['{"id":"3","name":"add","arguments":{"b":1}}', '{"id":"4","name":"now","arguments":{}}']
    calls += ['{"id":"5","name":"now","arguments":{"c":1}}', '{"id":"6","name":"neg","arguments":{"a":1}}']
    call = '{"tool_calls":[' + ",".join(calls) + "]}"
    rows = [
        (1, 0, "system", f'{{"tools":[{add},{now},{add}]}}'),
        (2, 0, "system", f'{{"tools":[{other}]}}'),
        (3, 0, "system", f'{{"tools":[{other}]}}'),
        (3, 1, "system", f'{{"tools":[{add},{{"name":null}},7]}}'),
        (4, 0, "user", f'{{"tools":[{add}]}}'),
        (5, 0, "system", '{"tools":"none"}'),
        (None, 0, "system", f'{{"tools":[{add}]}}'),
        *((conv, 9, "assistant", call) for conv in (1, 2, 3, 4, 5, None)),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def valid(got):
        ids = lambda m: re.findall(r'"id":"(.)"[^{}]*"valid":true', m)
        assert got.count() == len(rows)
        return {r.conv_id: ids(r.message) for r in got.filter("turn = 9").collect()}

    assert valid(chat.format_chat(df)) == {1: ["1", "4"], 2: ["2"], 3: [], 4: [], 5: [], None: []}
    given = spark.createDataFrame([("add", ["b"], {"b": "integer"}), ("neg", None, {"a": "integer"})], chat.TOOLS)
    assert valid(chat.format_chat(df, given)) == {1: ["1", "4", "6"], 2: ["2", "6"], 3: ["6"], 4: ["3", "6"], 5: ["3", "6"], None: ["3", "6"]}
    path = folder("chats")
    df.write.parquet(f"{path}/conversations.parquet")
    assert queries.QUERIES["op7_chat_format"](spark, path).agg(F.sum("n_valid")).first()[0] == 3


# 8 ---------------------------------------------------------------------------
def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_agrees_with_the_edit_distance():
    rnd = random.Random(1)
    terms = ["".join(rnd.choice("abc") for _ in range(rnd.randint(5, 7))) for _ in range(12)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(600):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 8)))
        for k in (1, 2):
            assert lexicon.near(word, k) == {t for t in terms if edits(word, t) <= k}
        assert lexicon.may_be_near(word) or not lexicon.near(word)


def test_context_tells_quotation_from_abuse():
    lexicon = toxicity.Lexicon(["scoundrel", "blarg*"])
    assert lexicon.hits("You are a scoundrel") == (1, 0, 0, 1)
    assert lexicon.hits("a scoundrl, blargish") == (1, 1, 0, 0)
    assert lexicon.hits('the "scoundrel" of the play') == (0, 0, 1, 0)
    assert lexicon.hits("") == (0, 0, 0, 0)


def test_unquoted_words_are_those_that_the_hits_count():
    rnd = random.Random(4)
    for _ in range(300):
        parts = [rnd.choice(["vile", "vile", "plain", "said", '"', "”", "x", "y", "z", "you", "."]) for _ in range(rnd.randrange(30))]
        text = " ".join(parts)
        exact, _, quoted, _ = toxicity.Lexicon(["vile"]).hits(text)
        assert ("vile" in toxicity.unquoted(text)) == (exact > 0) and exact + quoted == parts.count("vile")


def test_toxicity_spares_words_and_not_terms(spark):
    rnd = random.Random(14)
    rows, labels = [], []
    for i in range(1200):
        toxic, text = i % 6 == 0, words(rnd, 40).split()
        if toxic:
            misspelt = chr(97 + rnd.randrange(26)) + "ilestuff"
            text[rnd.randrange(40)] = rnd.choice(["grumbol", "grumbol", "vilestuff", "vilestuff", misspelt])
        elif i % 6 == 1:
            text[rnd.randrange(40)] = "grumbel"  # a plain word one edit from a term
        elif i % 6 == 2:
            at = rnd.randrange(5, 35)
            text[at : at + 1] = ['"', "vilestuff", '"']  # a term that clean documents quote
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    around = words(rnd, 9)
    probes = ["grumbol", "grumbool", "grombol", "vilestuff", "vilestuf", "grumbel", '" vilestuff "', "plain"]
    rows += [(5000 + i, f"{around} {p} {around}") for i, p in enumerate(probes)]
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    by = {r.doc_id: r for r in toxicity.score_documents(documents(spark, rows), label).collect()}
    assert [by[5000 + i].predicted for i in range(len(probes))] == [1, 1, 1, 1, 1, 0, 0, 0]
    assert all(by[i].predicted == t for i, _, t in labels)


def test_toxicity_is_learned_and_held_out(spark):
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        text = words(rnd, 40).split()
        if toxic:
            text[rnd.randrange(40)] = rnd.choice(["vilestuff", "nastyword"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "vilestuff"), (5002, "vilestuf " + words(rnd, 9)), (0, rows[0][1])]
    label = spark.createDataFrame([*labels, (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    df = documents(spark, rows)
    got = toxicity.score_documents(df, label).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(900))
    assert all(by[i].predicted == t for i, _, t in labels)
    assert by[None].predicted == 1 and by[5000].predicted == by[5001].predicted == 0
    kept = toxicity.without_toxic(df, label)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted == 0 for r in got)
    flipped = label.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r.doc_id, r.score) for r in toxicity.score_documents(df, flipped).collect()} == {(r.doc_id, r.score) for r in got}
    assert toxicity.score_documents(df.limit(0), label.limit(0)).count() == 0


# 9 ---------------------------------------------------------------------------
def test_base_spans_follow_the_patterns():
    pattern = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    rnd = random.Random(3)
    parts = ["password", "Token", '"', " ", "=", ": ", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "x", "é", "api_key", "0" * 15]
    for _ in range(500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        want = [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[2]) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        assert [s[:3] for s in secrets.base_spans(text)] == sorted(want)


def test_ownership_separates_examples_from_live_secrets(spark):
    own, copied = "Zq8Rt5Lm2Vx9Kc4Wb7Np", "Yh3Df6Gs1Jk8Lz5Xc2Vb"
    rows = [(1, f"é {own} end", "a"), (2, f"see {copied}", "a"), (3, f"see {copied}", "b"), (4, f"x {own}", "a")]
    rows += [(5, None, "a"), (6, "", None), (None, "token=abcdefghijklmnop", None), (2, f"see {copied}", "a")]
    df = documents(spark, rows)
    got = {r.doc_id: r for r in secrets.scan_secrets(df).withColumn("spans", secrets.span_text()).collect()}
    assert got[1].spans == "owned:2:22" and got[4].spans == "owned:2:22" and got[2].spans == got[3].spans == ""
    assert got[5].base_sha256 == got[6].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None].n_assign == 1 and got[None].spans == "assign:0:22"
    assert secrets.scan_secrets(df).count() == len(rows) and secrets.scan_secrets(df.limit(0)).count() == 0
    masked = {r.doc_id: r.text for r in secrets.masked(df).collect()}
    assert masked[1] == "é [SECRET] end" and masked[2] == f"see {copied}" and masked[None] == "[SECRET]" and masked[5] is None
    assert secrets.masked(df).columns == df.columns and secrets.masked(df).count() == len(rows)


def test_ownership_of_secrets_equals_counting(spark):
    rnd = random.Random(6)
    alphabet = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789"
    pool = ["".join(rnd.choices(alphabet, k=24)) + "7" for _ in range(30)]
    often = pool[0]
    rows = []
    for i in range(160):
        source = rnd.randrange(6)  # neighbours share a value
        held = [often] if i < 40 else rnd.sample(pool[1 + 4 * source : 6 + 4 * source], rnd.randrange(4))
        text = " ".join(["w", *(v if rnd.random() < 0.7 else f"token={v}" for v in held), "end"])
        rows.append((i if i % 9 else None, text, "hot" if i < 40 else f"s{source}"))
    rows += [(500, "x " * 40_000 + pool[3], "s9"), (501, None, None), (501, "", "s1")]
    spans = [secrets.base_spans(t or "") for _, t, _ in rows]
    tokens = [secrets.random_tokens(t or "", b) for (_, t, _), b in zip(rows, spans)]
    owners, repositories = {}, {}
    for (i, _, source), base, own in zip(rows, spans, tokens):
        for *_, value in base + own:
            owners.setdefault(value, set()).add(source)
            repositories.setdefault(value, set()).add((source, i))
    live = {v for v in owners if len(owners[v]) < 2 and len(repositories[v]) < secrets.COPIED_REPOSITORIES}
    assert often not in live and len(owners[often]) == 1 and 5 < len(live) < 29
    want = sorted(
        (str(i), secrets.written(sorted(base + [t for t in own if t[3] in live])), sum(t[3] in live for t in base + own))
        for (i, _, _), base, own in zip(rows, spans, tokens)
    )
    df = documents(spark, rows)
    got = secrets.scan_secrets(df).select("doc_id", secrets.span_text().alias("spans"), "n_live").collect()
    assert sorted((str(r.doc_id), r.spans, r.n_live) for r in got) == want
    masked = []
    for (i, text, _), base, own in zip(rows, spans, tokens):
        for a, b in reversed(secrets._merged([(a, b) for a, _, b, v in base + [t for t in own if t[3] in live]])):
            text = text[:a] + secrets.MASK + text[b:]
        masked.append((str(i), str(text)))
    assert sorted((str(r.doc_id), str(r.text)) for r in secrets.masked(df).collect()) == sorted(masked)



# 10 --------------------------------------------------------------------------
def test_cosine_components_match_brute_force(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.standard_normal((12, 24))
    x = centres[rnd.integers(0, 12, 500)] + 0.12 * rnd.standard_normal((500, 24)) * rnd.choice([0, 0.5, 1.0], (500, 1))
    x[50:90] = x[10]
    labels = rnd.integers(0, 3, 500)
    unit = x / np.sqrt((x**2).sum(1))[:, None]
    close = (unit @ unit.T >= 0.98) & (labels[:, None] == labels)
    np.fill_diagonal(close, False)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, labels))]
    odd = [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("inf")] * 24, 1), (903, x[0].tolist(), None), (904, [], 1)]
    df = spark.createDataFrame([*rows, *odd, (905, [1.0, 2.0], 0)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cosine.near_duplicates(df, tile_rows=64).collect()}
    want = brute_components(rows, lambda i, j: close[i, j])
    assert {i: got[i] for i in range(500)} == {i: (close[i].sum(), want[i], want[i] == i) for i in range(500)}
    assert all(got[i] == (0, i, True) for i in (900, 901, 902, 903, 904, 905))
    assert cosine.near_duplicates(df.limit(0)).count() == 0
    assert cosine.near_duplicates(df.union(df)).count() == 2 * df.count()


def test_bounds_do_not_drop_pairs():
    rnd = np.random.default_rng(7)
    x = rnd.standard_normal((60, 40))
    x[30:] = x[:30] + 0.05 * rnd.standard_normal((30, 40))
    unit = x / np.sqrt((x**2).sum(1))[:, None]
    for threshold in (0.1, 0.5, 0.98):
        i, j = cosine.linked_pairs(x, x, cosine.axes(unit), threshold, True)
        want = {(a, b) for a in range(60) for b in range(a + 1, 60) if unit[a] @ unit[b] >= threshold}
        assert set(zip(i.tolist(), j.tolist())) == want
    assert math.isclose(neighbours.collision_threshold(64, 1.5, 0.97), 50, abs_tol=6)
