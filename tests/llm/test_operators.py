"""The training-data operators against plain versions of themselves, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from sluice.llm import chat, decontaminate, neardup, packing, quality, queries, secrets, shards, tokenfiles, tokens, toxicity, urls
from sluice.llm.components import components

QUERIES, ORACLE = queries.queries(), queries.oracle_sql()

#: Ids that are null or repeat, texts that are null, empty, alike or long, and other columns with names used inside.
ODD = [
    (1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (None, "token = abcdefghijklmnop"),
    (4, "Öl " * 3000 + "end"), (5, "one two three four five SIX"), (6, "x"), (7, "x"), (None, None), (1, "quite another text here"),
]
NAMES = ["words", "n", "kind", "first", "row", "key", "at", "size", "bucket", "judged_row", "dropped_id", "masked_row", "spans", "doc", "node", "of", "id", "settled", "lost", "rest", "digest"]
CLASH = "doc_id bigint, text string, " + ", ".join(f"{n} {'long' if n == 'n' else 'string'}" for n in NAMES)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, *(1 if n == "n" else "k" for n in NAMES)) for i, t in ODD], CLASH)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = 99")


def texts_of(spark, folder):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, medium, name):
    assert differences(QUERIES[name](spark, medium), connect(medium), ORACLE[name]) == []


def real_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_toxicity_on_the_held_out_fold(spark, medium):
    rows = by_id(QUERIES["op1_toxicity"](spark, medium))
    assert len(rows) == len(texts_of(spark, medium))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for i, r in rows.items())
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    held = [(rows[i]["score"], y) for i, y in labels.items() if rows[i]["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.8


def test_toxicity_learns_once_from_repeated_rows(spark):
    docs = spark.createDataFrame([(k, f"word{k % 7} {'bad' if k % 2 else 'good'} text {k}") for k in range(200)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    plain = {r["doc_id"]: r["score"] for r in toxicity.contract(docs, labels).collect()}
    hot = docs.where("doc_id = 3").selectExpr("*", "explode(sequence(1, 500)) as copy").drop("copy")
    again = labels.where("doc_id = 3").selectExpr("*", "explode(sequence(1, 500)) as copy").drop("copy")
    repeated = toxicity.contract(docs.unionByName(hot), labels.unionByName(again)).collect()
    assert len(repeated) == 700 and {r["doc_id"]: r["score"] for r in repeated} == plain
    assert min(v for k, v in plain.items() if k % 2) > max(v for k, v in plain.items() if k % 2 == 0)


def plain_rounds(spark, docs, labels):
    """The mean of all learners' whole states, round by round."""
    import pyarrow as pa

    known = labels.join(docs, "doc_id").where(~toxicity.held_out())
    dealt = known.select("toxic", "text", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(toxicity.LEARNERS)).alias("learner"), F.xxhash64("doc_id", F.lit(13)).alias("turn"))
    rows = sorted(dealt.collect(), key=lambda r: r["turn"])
    ids = [np.append(x, toxicity.DIMENSIONS) for x in toxicity.features(pa.array([r["text"] for r in rows]))]
    z, n = np.zeros(toxicity.DIMENSIONS + 1), np.zeros(toxicity.DIMENSIONS + 1)
    for _ in range(toxicity.ROUNDS):
        ends = []
        for k in range(toxicity.LEARNERS):
            state = toxicity.Ftrl(z.astype(np.float32), n.astype(np.float32))
            for _ in range(toxicity.EPOCHS):
                for at, r in zip(ids, rows, strict=True):
                    if r["learner"] == k:
                        state.learn(at, float(r["toxic"]))
            ends.append(state)
        z, n = (np.mean([getattr(s, name).astype(float) for s in ends], axis=0) for name in "zn")
    return toxicity.Ftrl(z, n).weights(np.arange(toxicity.DIMENSIONS + 1))


def test_toxicity_adds_up_below_the_penalty(spark):
    """Words that are too rare for a weight in one round, and words of one learner alone, have one after all rounds."""
    docs = spark.createDataFrame([(k, f"word{k % 7} {f'bad{k % 12}' if k % 3 == 0 else 'good'} text {k}") for k in range(240)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic")
    used, weights, intercept = toxicity.train(docs, labels)
    want = plain_rounds(spark, docs, labels)
    got = np.zeros_like(want)
    got[used], got[-1] = weights, intercept
    assert np.allclose(got, want, atol=1e-3) and set(used) == set(np.flatnonzero(np.abs(want[:-1])))


def test_toxicity_coordinates_as_steps():
    for codes in ([], [0], [toxicity.FAR], [3, 4, 65538, 65539, 200_000, toxicity.DIMENSIONS - 1]):
        assert toxicity.read_ids(toxicity.stored_ids(np.array(codes, np.int32))).tolist() == codes


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.sql("select * from values (1, 1), (2, 0), (2, null), (null, 1), (4, 0) t(doc_id, toxic)")
    scores = toxicity.contract(odd, labels).collect()
    assert len(scores) == len(ODD) and len({r["score"] for r in scores if r["doc_id"] in (2, 3)}) == 1
    assert toxicity.contract(none, labels).count() == 0
    assert {round(r["score"], 9) for r in toxicity.contract(odd, labels.where("false")).collect()} == {round(1 / 11, 9)}


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = {k + j for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def plain_quality(text, model):
    n_words, _, _, _, repeated = plain_counts(text)
    failed = n_words < 20 or 100 * repeated > 30 * n_words
    ids = model.encode(text)
    n, byte = len(ids), sum(model.is_byte(i) and model.id_to_piece(i) not in ("<0x09>", "<0x0A>", "<0x0B>", "<0x0C>", "<0x0D>", "<0x20>") for i in ids)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values()) if n else 0
    low, high, most, least = quality.BANDS["latin"]
    strange = n >= quality.MIN_TOKENS and not (low <= len(text) / n <= high and byte / n <= most and entropy >= least * math.log2(min(max(n, 2), 1024)))
    return failed, not failed and not strange


def test_quality_equals_plain_rules(spark, medium):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=quality.vocabulary_path())
    texts, rows = texts_of(spark, medium), by_id(QUERIES["op2_quality"](spark, medium))
    for i, text in texts.items():
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(text)
        assert (r["base_failed"], r["kept"]) == plain_quality(text, model)


def test_quality_pieces_and_odd_rows(odd, none):
    text = "ab  cd\n ef gh " * 50 + "ü x"
    model = quality.fertility(quality.vocabulary_path())._model
    assert [i for p in quality.pieces(text, 40) for i in model.encode(p)] == model.encode(text)
    assert quality.contract(odd).count() == len(ODD) and quality.contract(none).count() == 0
    assert quality.keep(odd).columns == odd.columns and quality.keep(odd).count() == 0  # all short or repeating


def test_packing_round_trip(spark, medium, odd, none):
    texts = texts_of(spark, medium)
    rows = QUERIES["op3_packing"](spark, medium).collect()
    ids = dict(zip(texts, real_ids(list(texts.values())), strict=True))
    got = {(r["doc_id"], r["piece"]): r for r in rows}
    for i, own in ids.items():
        own = [*own, 0]
        for k in range(-(-len(own) // 2048)):
            r = got.pop((i, k))
            part = own[2048 * k : 2048 * k + 2048]
            assert (r["start"], r["length"], r["ids_crc32"]) == (2048 * k, len(part), crc(part))
    assert not got
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    assert len(places) <= 1.01 * -(-sum(r["length"] for r in rows) // 2048) + 1
    assert packing.contract(odd).where("piece = 0").count() == len(ODD) and packing.contract(none).count() == 0


@pytest.mark.parametrize("partitions", [1, 16, 200])
def test_packing_wastes_little_on_any_number_of_partitions(spark, medium, partitions):
    rows = packing.pack(spark.read.parquet(f"{medium}/documents.parquet").repartition(partitions)).drop("ids").collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    assert len(places) <= 1.01 * -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_holds_few_bins_and_gives_out_closed_ones(spark, small, monkeypatch):
    monkeypatch.setattr(packing, "GATHERED", 5000)
    monkeypatch.setattr(packing, "BATCH", 7)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    few, many = (packing.pack(docs, bins=n).collect() for n in (3, 1024))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in few) == Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in many)
    for rows in (few, many):
        ends = {}
        for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == ends.get(r["sequence_id"], 0)
            ends[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(ends.values()) <= 2048


def test_bounded_bins_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 9, 3, 4)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6), (3, 0)]
    assert bins.free == {2: 1, 3: 6} and bins.used == 4


def test_encoder_equals_the_library():
    import pyarrow as pa

    odd = ["", "a  b\t\n c", "don't we'll 's x's,'t a.'re", "<|endoftext|> X<|startoftext|>y A<|ENDOFTEXT|>", "É é ́a İx ΑΣ ς", "日本 語12345 ½", "...'''..."]
    got = []
    for ids, at in tokens.encoder(tokens.vocabulary_path()).chunks(pa.array([*odd, None])):
        got += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == real_ids([*odd, ""])


def encoded(encoder, texts):
    import pyarrow as pa

    return [ids[a:b].tolist() for ids, at in encoder.chunks(pa.array(texts)) for a, b in zip(at[:-1], at[1:], strict=True)]


def test_encoder_sends_plain_words_to_the_merges_alone():
    class Whole:
        """The whole tokenizer, for parts that are not words of letters alone."""

        def encode_batch_fast(self, parts, **options):
            assert not [x for x in parts if x.isalpha()]
            return library.encode_batch_fast(parts, **options)

    encoder = tokens.Encoder(tokens.vocabulary_path())
    library, encoder._tokenizer = encoder._tokenizer, Whole()
    letters = "".join(map(chr, encoder._symbols))
    assert {*"azßéñσςжё"} <= {*letters} and not {*"É×÷İΣ\u0301½"} & {*letters}
    texts = ["Plain Words, größe niño слово λόγος", *letters, *(f"a{x}{x}a {x}e" for x in letters)]
    assert encoded(encoder, texts) == real_ids(texts)


def test_encoder_keeps_words_that_it_meets_again(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 8)
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 1)
    encoder, learned = tokens.Encoder(tokens.vocabulary_path()), []
    learn = encoder._learned
    monkeypatch.setattr(encoder, "_learned", lambda parts: (learned.extend(parts.to_pylist()), learn(parts))[1])
    rare = ["".join(chr(97 + int(d)) for d in str(k)) for k in range(100, 140)]
    texts = [f"often {word} often, größe" for word in rare]
    assert encoded(encoder, texts) == real_ids(texts)
    assert len(learned) == len(rare) + 4 and len(encoder._place) <= 8
    # More different words than the table holds, and more words that are met again.
    texts = [" ".join(rare[:12]), "", *(" ".join(rare[k : k + 7]) for k in range(30)), *(" ".join(rare[:7]) for _ in range(3)), "often ÉÉ 1a"]
    assert encoded(encoder, texts) == real_ids(texts)


def test_token_files_round_trip(spark, medium, odd, none, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "SHARD_BYTES", 500_000)
    monkeypatch.setattr(tokenfiles, "READ_ROWS", 7)
    texts = dict(sorted(texts_of(spark, medium).items()))
    rows, before = by_id(QUERIES["op5_token_files"](spark, medium)), 0
    for i, own in zip(texts, real_ids(list(texts.values())), strict=True):
        own = [*own, 1]
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (before, len(own), crc(own))
        before += len(own)
    folder = str(tmp_path / "odd")
    tokenfiles.write(odd, folder)
    index = tokenfiles.Index(folder)
    assert len(index.ids(1)) == 3 and len(index.ids(None)) == 2 and index.ids(99) == []
    assert tokenfiles.read_all(spark, folder, odd).count() == len(ODD)
    assert tokenfiles.contract(none).count() == 0


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 5000):
        keys = [f"key {k}" for k in range(n)]
        assert sorted(tokenfiles.PerfectHash.build(keys).slots(keys).tolist()) == list(range(n))


def test_shards(spark, medium, odd, none):
    texts, rows = texts_of(spark, medium), QUERIES["op9_shards"](spark, medium).collect()
    per = {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        per.setdefault(r["shard"], []).append(r["slot"])
    assert len(rows) == len(texts) and set(per) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in per.values()) and max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert Counter((r["doc_id"], r["text_crc32"]) for r in shards.contract(odd).collect()) == Counter((i, zlib.crc32((t or "").encode())) for i, t in ODD)
    assert shards.contract(none).count() == 0


def plain_classes(rows, size):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_with_large_groups(spark, monkeypatch):
    """A text with many copies that are alike to it, but not always to each other, and texts near the threshold."""
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):
        own = list(base)
        for k in rng.choice(120, rng.integers(1, 14), replace=False):
            own[k] = f"v{rng.integers(0, 40)}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(neardup, "SMALL_BUCKET", 6)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 50)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.classes(df, size=2).collect()}
    assert got == plain_classes(rows, 2)


def test_near_duplicates_of_odd_rows(odd, none):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.contract(odd).collect())
    assert got[(1, 5, 1, True)] == 2 and got[(5, 5, 1, False)] == 1 and got[(7, 1, 6, False)] == 1
    assert got[(2, 0, 2, True)] == 1 and got[(None, 4, None, True)] + got[(None, 3, None, True)] + got[(None, 2, None, True)] == 1
    kept = neardup.keep(odd)
    assert kept.columns == odd.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 4, 6, None, None])
    assert neardup.contract(none).count() == 0 and neardup.keep(none).count() == 0


@pytest.mark.parametrize("order", [1, -1])
def test_near_duplicates_link_all_texts_of_an_id(spark, order):
    """Id 5 has a text of document 3 and one that is nearly that of document 8, so all three are one group."""
    a = " ".join(f"a{k}" for k in range(40))
    b = [f"b{k}" for k in range(40)]
    rows = [(3, a), (5, a), (5, " ".join(b)), (8, " ".join([*b[:39], "other"])), (9, "quite alone"), (None, a), (5, None), (5, "")]
    docs = spark.createDataFrame(rows[::order], "doc_id long, text string").coalesce(1)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.contract(docs).collect())
    assert got == Counter([(3, 39, 3, True), (5, 39, 3, False), (5, 39, 3, False), (8, 39, 3, False), (9, 1, 9, True), (None, 39, None, True), (5, 0, 3, False), (5, 0, 3, False)])


def test_near_duplicates_of_repeated_ids_equal_plain_classes(spark):
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(12):
        base = [f"w{rng.integers(0, 500)}" for _ in range(60)]
        for _ in range(6):
            own = list(base)
            for k in rng.choice(60, rng.integers(0, 5), replace=False):
                own[k] = f"v{rng.integers(0, 90)}"
            texts.append(" ".join(own))
    rows = [(int(rng.integers(0, 40)), t) for t in texts]
    # Each text is a node of its own in the plain version, and texts of an id are linked by a text that both hold.
    plain = plain_classes([(k, t) for k, (_, t) in enumerate(rows)], 2)
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    of = {}
    for k, (i, _) in enumerate(rows):
        of.setdefault(plain[k][1], []).append(i)
    for ids in of.values():
        for i in ids:
            x, y = sorted((find(ids[0]), find(i)))
            top[y] = x
    got = Counter((r["doc_id"], r["component_id"]) for r in neardup.contract(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert got == Counter((i, find(i)) for i, _ in rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (200, 199)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 199: 199, 200: 199}


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.sql("select * from values ('a', 'One two'), ('b', 'X'), ('c', null), (null, 'text HERE'), ('d', 'öl öl end') t(item_id, text)")
    got = {(r["doc_id"], r["n_hit"], tuple(r["items"])) for r in decontaminate.contaminated(odd, items).collect()}
    assert {(1, 2, ("a",)), (5, 2, ("a",)), (6, 1, ("b",)), (7, 1, ("b",)), (1, 2, ("",)), (2, 0, ()), (3, 0, ()), (4, 0, ())} <= got
    assert decontaminate.contaminated(odd, items).count() == len(ODD)
    assert decontaminate.contract(none, items).count() == 0 and decontaminate.contract(odd, items.where("false")).where("contaminated").count() == 0
    assert decontaminate.keep(odd, items).columns == odd.columns


def test_decontamination_without_broadcasts(spark, medium, odd, monkeypatch):
    """Benchmarks that are too large to send are joined by a shuffle, with the same result."""
    docs, items = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "benchmark"))
    odd_items = spark.sql("select * from values ('a', 'One two'), (null, 'text HERE'), ('d', 'öl öl end') t(item_id, text)")
    want = [Counter(map(tuple, decontaminate.contract(d, i).collect())) for d, i in ((docs, items), (odd, odd_items))]
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    assert [Counter(map(tuple, decontaminate.contract(d, i).collect())) for d, i in ((docs, items), (odd, odd_items))] == want


def test_decontamination_keeps_clean_rows_of_null_and_repeated_ids(spark):
    items = spark.sql("select * from values ('a', 'one two') t(item_id, text)")
    rows = [(None, "one two"), (None, "clean"), (None, None), (1, "one two"), (1, "clean as well"), (1, "One Two"), (2, "other"), (2, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r["doc_id"], r["text"]) for r in decontaminate.keep(docs, items).collect())
    assert kept == Counter({(None, "clean"): 1, (None, None): 1, (1, "clean as well"): 1, (2, "other"): 2})


def test_near_duplicates_keep_clean_texts_of_repeated_ids(spark):
    text, other, third = "one two three four five six", "quite another text of seven words here", "a third text that is like none before"
    rows = [(3, text), (5, text), (5, other), (5, other), (5, None), (6, third), (6, third.upper()), (7, other), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [(r["doc_id"], (r["text"] or "").lower()) for r in neardup.keep(docs, one_per_id=False).collect()]
    assert Counter(kept) == Counter({(3, text): 1, (5, other): 1, (5, ""): 1, (6, third): 1, (None, text): 2})
    one = [(r["doc_id"], r["text"]) for r in neardup.keep(docs).collect()]
    assert Counter(i for i, _ in one) == Counter({3: 1, 5: 1, 6: 1, None: 2}) and (5, text) not in one


def test_secrets_of_odd_rows(odd, none):
    rows = secrets.contract(odd).collect()
    assert len(rows) == len(ODD) and [r["spans"] for r in rows if r["n_assign"]] == ["assign:0:24"]
    masked = secrets.mask(odd)
    assert masked.columns == odd.columns and Counter(r["text"] for r in masked.where("doc_id is null").collect()) == Counter([secrets.MASK, None])
    assert secrets.contract(none).count() == 0 and secrets.mask(none).count() == 0


def test_entropy_is_that_of_the_windows(spark):
    texts = ["abcdefghijklmnopqrst", "aaaaaaaaaaaaaaaaaaaab", "aZ3kP9xQ2mL7vB4nC8wRt1Yd", "a" * 25]

    def plain(t):
        return max(-sum(c / 20 * math.log2(c / 20) for c in Counter(t[k : k + 20]).values()) for k in range(len(t) - 19))

    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(secrets.entropy(F.col("t"))).collect()]
    assert np.allclose(got, [plain(t) for t in texts])


#: Keys of 32 characters by class, and texts that are none.
KEYS = {"letters": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "one_case": "abcdefghijklmnopqrstuvwxyz", "mixed": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "hex": "0123456789ABCDEF"}
CLEAN = [
    "internationalization", "Donaudampfschifffahrtsgesellschaft", "Rechtsschutzversicherungsgesellschaften", "AbstractSingletonProxyFactoryBean",
    "getUserAccountFromDatabaseByName", "how-to-build-a-house-on-a-hill-without-help", "path/to/some/deeply/nested/folder/of/files",
    "example-example-example-example", "xxxxxxxxxxxxxxxxxxxxxxxxxxxx", "00000000-1111-2222-3333-444444444444", "-" * 40, "=" * 40, "_placeholder_placeholder_",
]


def test_secrets_find_most_random_keys_and_no_clean_texts(spark):
    rng = np.random.default_rng(11)
    rows = [(name, "".join(rng.choice(list(alphabet), 32))) for name, alphabet in KEYS.items() for _ in range(300)]
    rows += [("clean", t) for t in CLEAN] + [("beside", "/example/deploy/key=" + "".join(rng.choice(list(KEYS["mixed"]), 35))) for _ in range(100)]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    found = Counter(rows[r["doc_id"]][0] for r in secrets.contract(docs).collect() if "entropy" in r["spans"])
    assert all(found[name] >= 0.9 * 300 for name in KEYS) and found["beside"] == 100 and found["clean"] == 0


def test_chat_is_reversible_and_splits_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "RECORD_BYTES", 200)
    hostile = ["<|im_end|>\n<|im_start|>", "<\\|x", "<\\\\|", "", None, "a\nb"]
    rows = [(1, k, ["assistant", "us<n\ner", None][k % 3], hostile[k % 6]) for k in range(60)] + [(None, None, "user", "x"), (2, 0, "assistant", "<|")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    records = chat.format_chats(df.withColumn("record", F.lit("clash"))).orderBy("conv_id", "record").collect()
    one = [r for r in records if r["conv_id"] == 1]
    assert len(one) > 1
    assert [t for r in one for t in chat.parse(r["formatted"])] == [(r or "", t or "") for _, _, r, t in rows[:60]]
    loss = "".join(chat.unescape(r["formatted"].encode()[a:b].decode()) for r in one for a, b in zip(r["loss"][::2], r["loss"][1::2], strict=True))
    assert loss == "".join(t or "" for _, _, r, t in rows[:60] if r == "assistant")
    own = {r["conv_id"]: r for r in chat.contract(df).collect()}
    assert set(own) == {-1, 1, 2, None} and own[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.contract(df.where("conv_id = 5")).count() == 1


def test_url_list_over_time(spark):
    ts = "timestamp_ntz'2024-0{}-01'"
    log = spark.sql(f"select * from values ('b.com', 'block', {ts.format(1)}), ('b.com', 'remove', {ts.format(3)}), ('ok.b.com', 'allow', {ts.format(1)}), ('c.com/x', 'block', {ts.format(1)}), (null, 'block', {ts.format(1)}) t(pattern, action, listed_at)")
    seen = spark.sql(f"""select id, url, {ts.format('2')} + make_dt_interval(days) as fetched_at, 'x' as action, 1 as month from values
        (1, 'http://a.b.com/p', 0), (2, 'http://a.b.com/p', 40), (3, 'http://ok.b.com:80/', 0), (4, 'http://c.com/x?y', 0), (5, 'http://c.com/y', 0), (6, null, 0), (7, 'no url', 0), (1, 'http://a.b.com/p', 0), (8, 'http://b.com', null) t(id, url, days)""")
    got = Counter((r["id"], r["matched"], r["kept"]) for r in urls.judge(seen, log, ["id"]).collect())
    assert got == Counter({(1, "b.com", False): 2, (2, None, True): 1, (3, "ok.b.com", True): 1, (4, "c.com/x", False): 1, (5, None, True): 1, (6, None, True): 1, (7, None, True): 1, (8, None, True): 1})
    assert urls.judge(seen.where("false"), log, ["id"]).count() == 0 and urls.judge(seen, log.where("false"), ["id"]).where("kept").count() == 9


def test_pipeline_stages_of_odd_rows(spark, odd, none, small):
    """Clashing names, nulls and repeated rows go through every stage, and an empty table too."""
    import corpus_pipeline

    long = F.when(F.col("text").isNull(), None).otherwise(F.concat(F.lit("some words that are no one else's for id "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(" and make it long enough to be judged by the rules of quality: "), "text"))
    for docs, left in ((odd.withColumn("text", long), True), (odd, False), (none, False)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, small)
            assert k == 4 or docs.columns == odd.columns
        assert docs.isEmpty() != left


def test_pipeline_of_an_empty_table(spark, none, small, tmp_path):
    import shutil

    import corpus_pipeline

    none.write.parquet(str(tmp_path / "documents.parquet"))
    shutil.copy(f"{small}/benchmark.parquet", tmp_path / "benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_equals_plain_stages(spark, small):
    import sentencepiece

    import corpus_pipeline

    model = sentencepiece.SentencePieceProcessor(model_file=quality.vocabulary_path())
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows, now = {r["doc_id"]: r for r in docs.collect()}, docs
    want = {i: r["text"] for i, r in rows.items() if plain_quality(r["text"] or "", model)[1]}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, small).cache()
        if k == 1:
            classes = plain_classes(list(want.items()), 5)
            want = {i: t for i, t in want.items() if classes[i][1] == i}
        if k == 2:
            hit = {r["doc_id"] for r in decontaminate.contract(docs, spark.read.parquet(f"{small}/benchmark.parquet")).where("contaminated").collect()}
            want = {i: t for i, t in want.items() if i not in hit}
        if k == 3:
            assert now.columns == docs.columns
            for r in now.collect():
                spans = [tuple(map(int, s.split(":")[1:])) for s in secrets.contract(docs.where(F.col("doc_id") == r["doc_id"])).first()["spans"].split(",") if s] if r["text"] != want[r["doc_id"]] else []
                text = want[r["doc_id"]]
                for a, b in reversed(_merged(spans)):
                    text = text[:a] + secrets.MASK + text[b:]
                assert r["text"] == text and r["n_chars"] == len(text)
        assert {r["doc_id"] for r in now.select("doc_id").collect()} == set(want)


def _merged(spans):
    out = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def test_secrets_of_very_long_candidates_and_many_matches(spark):
    """A long slug of many parts is no secret; dashes before a digit do not make the scan go back over them."""
    slug, dashes = "ab-cdefgh_ij/klmnopqr-stuvwxyz-" * 2000, "qwrtzpsdfgkhlmxvbnc" + "-" * 60 + "tuvw1"
    many = " ".join(f"token={k:012d}x kept" for k in range(2000))
    docs = spark.createDataFrame([(1, slug), (2, dashes), (3, many)], "doc_id long, text string")
    got = by_id(secrets.contract(docs))
    assert got[1]["spans"] == "" and got[2]["spans"] == "entropy:0:84"
    assert got[3]["n_assign"] == 2000 and got[3]["spans"].split(",")[1] == "assign:25:44"
    masked = by_id(secrets.mask(docs))
    assert masked[1]["text"] == slug and masked[2]["text"] == secrets.MASK
    assert masked[3]["text"] == " ".join([f"{secrets.MASK} kept"] * 2000)
