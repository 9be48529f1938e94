"""The pipeline's stages against brute-force versions, each on what its predecessor kept."""

import re

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from test_operators import crc, ids_of, word_set

from dispatchlake.llm import mixing, packing, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """The given documents and what each stage made of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    near = docs.filter("doc_id % 10 = 0").select((F.col("doc_id") + 100_000).alias("doc_id"), "text", "lang", "source", "n_chars")
    secret = near.limit(5).select(
        (F.col("doc_id") + 100_000).alias("doc_id"),
        F.concat(F.lit("q "), F.col("doc_id"), F.lit(" password=abcdef0123456789 k Zq8Rt5Lm2Vx9Kc4Wb7Np")).alias("text"),
        "lang", "source", "n_chars",
    )
    docs = docs.unionByName(near).unionByName(secret)
    made = [docs.collect()]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        made.append((docs.columns, docs.collect()))
    return made


def by_id(rows):
    return {r.doc_id: r for r in rows}


def test_stages_keep_the_columns_of_documents(stages):
    assert all(columns == list(pipeline.COLUMNS) for columns, _ in stages[1:-1])


def test_toxicity_rejects_by_score_alone(spark, sf_dir, stages):
    docs = spark.createDataFrame(stages[0])
    scored = toxicity.score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {r.doc_id for r in scored.filter("score < 0.7").collect()}
    assert set(by_id(stages[1][1])) == want and len(want) > 0.8 * len(stages[0])


def test_one_document_of_each_group_of_copies_stays(stages):
    before, after = stages[1][1], set(by_id(stages[2][1]))
    sets = {r.doc_id: word_set(r.text) for r in before}
    least = {d: d for d in sets}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= (least[a], least[b]) != (low, low)
            least[a] = least[b] = low
    assert after == {d for d in sets if least[d] == d} and len(after) < len(sets)


def test_secrets_are_masked_and_nothing_else(stages):
    before, after = by_id(stages[2][1]), by_id(stages[3][1])
    assert set(before) == set(after)
    masks = 0
    for doc, row in after.items():
        parts = [re.escape(p) for p in row.text.split("[SECRET]")]
        assert re.fullmatch("(?s)" + "(.+?)".join(parts), before[doc].text) and row.n_chars in (len(row.text), before[doc].n_chars)
        masks += len(parts) - 1
        assert not re.search("AKIA[A-Z0-9]{14}|[0-9a-f]{16}", row.text)
    assert masks >= 2


def test_mix_keeps_all_documents_in_schedule_order(spark, stages):
    before, after = stages[3][1], stages[4][1]
    assert sorted(map(str, before)) == sorted(map(str, after))
    placed = {r.doc_id: (r.slot, r.block, r.within) for r in mixing.mix(spark.createDataFrame(before)).collect()}
    assert sorted(placed.values()) == sorted(placed[r.doc_id] for r in after) and len(placed) == len(after)


def test_sequences_follow_the_mix(spark, tmp_path):
    rows = [(i, f"w{i} " * (1 + i * 7 % 90), "en", "abc"[i % 3 if i % 2 else 0], 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    placed = mixing.mix(docs, targets={"a": 0.6, "b": 0.3, "c": 0.1}, block_bytes=256).collect()
    order = [r.doc_id for r in sorted(placed, key=lambda r: (r.slot, r.block, r.within))]
    path = str(tmp_path / "mixed")
    mixed = mixing.mixed(docs, targets={"a": 0.6, "b": 0.3, "c": 0.1}, block_bytes=256)
    mixed.write.option("maxRecordsPerFile", 23).parquet(path)
    got = packing.pack_in_order(spark.read.parquet(path), capacity=128, window=50).collect()
    held, filled = {}, {}
    for r in got:
        held.setdefault(r.sequence_id, set()).add(order.index(r.doc_id) // 50)
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(held) == list(range(len(held))) and all(len(w) == 1 for w in held.values())
    windows = [min(held[s]) for s in sorted(held)]
    assert windows == sorted(windows) and set(windows) == set(range(8))
    for places in filled.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 128
    assert {r.doc_id for r in got} == set(order)
    plain = packing.pack_in_order(docs, capacity=128, window=50)  # without files: the order of the partitions
    first = {r.doc_id for r in plain.filter("sequence_id = 0").collect()}
    assert first and first <= set(range(50))
    assert packing.pack_in_order(spark.read.parquet(path).limit(0)).count() == 0


def test_the_mix_governs_the_pipelines_sequences(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "pack_in_order", lambda docs, f=packing.pack_in_order: f(docs, window=100))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = dict(pipeline.STAGES)
    path = str(tmp_path / "mixed")
    steps["mixing"](spark, docs, sf_dir).write.parquet(path)
    got = steps["packing"](spark, spark.read.parquet(path), sf_dir).select("doc_id", "sequence_id").collect()
    slots = sorted((r.slot, r.block, r.within, r.doc_id) for r in mixing.mix(docs, targets=pipeline.TARGETS).collect())
    window = {r[3]: i // 100 for i, r in enumerate(slots)}
    seen = [window[r.doc_id] for r in sorted(got, key=lambda r: r.sequence_id)]
    assert seen == sorted(seen) and len(set(seen)) > 1


def test_packing_covers_every_document(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts, pieces = by_id(stages[4][1]), {}
    for r in stages[5][1]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, rows in pieces.items():
        ids = ids_of(library, texts[doc].text)
        rows.sort(key=lambda r: r.piece)
        assert [r.start for r in rows] == [sum(x.length for x in rows[:k]) for k in range(len(rows))]
        assert all(r.ids_crc32 == crc(ids[r.start : r.start + r.length]) for r in rows)
        assert sum(r.length for r in rows) == len(ids)
