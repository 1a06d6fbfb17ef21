"""Line dedup, phrases and periodic runs against plain versions of themselves, and on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import collocations, lines, periodic, queries

QUERIES = queries.queries()
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows, documents, keep_first=False):
    """``rows``: (id, text). Lines, dropped lines and what is left of each."""
    split = [(t or "").split("\n") for _, t in rows]
    keys = [[x.strip(SPACE).translate(LOWER) for x in own] for own in split]
    often = {k for k, n in Counter(k for own in keys for k in set(own)).items() if k and n >= documents}
    first = {k: min(i for (i, _), own in zip(rows, keys, strict=True) if k in own) for k in often} if keep_first else {}
    out = []
    for (i, t), own, key in zip(rows, split, keys, strict=True):
        stays = [k not in often or (keep_first and first[k] == i and key.index(k) == at) for at, k in enumerate(key)]
        left = "\n".join(x for x, s in zip(own, stays, strict=True) if s)
        out.append((i, len(own), stays.count(False), None if t is None else left))
    return Counter(out)


def made_up_lines(n, seed):
    rng = np.random.default_rng(seed)
    common = ["Copyright  Someone", " all rights\treserved ", "ÄÖ line", "x", "-" * 500]
    out = []
    for i in range(n):
        own = [f"line {rng.integers(0, 3 * n)}" for _ in range(rng.integers(0, 6))]
        own += [common[k] if rng.random() < 0.7 else common[k].upper() for k in rng.choice(5, rng.integers(0, 4))]
        rng.shuffle(own)
        out.append((i, "\n".join(own) + ("\n" if rng.random() < 0.2 else "")))
    return [*out, (n, None), (n + 1, ""), (n + 2, "\n\n"), (n + 3, "\n x \r\n"), (n + 4, "many\n" * 5000)]


def got_lines(df):
    return Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in df.collect())


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("limits", [{}, {"BROADCAST_KEYS": 0}, {"MAX_BITS": 4}, {"MAX_BITS": 4, "BROADCAST_KEYS": 0}, {"MIN_BITS": 64, "BITS_PER_LINE": 1, "PIECE_BITS": 64}])
def test_lines_equal_plain_ones(spark, monkeypatch, limits, keep_first):
    """Also where keys are too many to send, lines too many for a filter, and a filter is nearly full."""
    for name, value in limits.items():
        monkeypatch.setattr(lines, name, value)
    rows = made_up_lines(120, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got_lines(lines.counted(docs, documents=4, keep_first=keep_first)) == plain_lines(rows, 4, keep_first)


def test_lines_of_odd_rows(spark):
    rows = [(None, "a\nb", "r"), (None, "A \nc", "r"), (1, " a", "r"), (1, " a", "r"), (2, None, "r"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").selectExpr("*", "key as rest", "key as kept", "1 as n", "key as row", "key as lost")
    for few in (0, 500_000):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lines, "BROADCAST_KEYS", few)
            cleaned = lines.clean(docs, documents=4)
            assert cleaned.columns == docs.columns
            assert Counter((r["doc_id"], r["text"], r["rest"], r["n"]) for r in cleaned.collect()) == Counter([(None, "b", "r", 1), (None, "c", "r", 1), (1, "", "r", 1), (1, "", "r", 1), (2, None, "r", 1), (3, "", None, 1)])
            assert lines.counted(docs.where("doc_id = 9")).count() == 0 and lines.clean(docs.where("doc_id = 9")).count() == 0
    shared = lines.shared(docs, documents=4, keep_first=True).collect()
    assert [(bytes(r["digest"]), r["n"], r["first"]) for r in shared] == [(hashlib.sha256(b"a").digest(), 4, 1)]


def test_few_lines_are_suspected(spark, medium):
    """The second filter holds every repeated key and few others."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    twice = lines._filter(docs, "text")
    seen = Counter(k for r in docs.collect() for k in {x.strip(SPACE).translate(LOWER) for x in (r["text"] or "").split("\n")} if k)
    own = lines.Lines(pa.array(list(seen)))
    met = dict(zip(seen, lines.has(twice, lines.positions(own.hash, 8 * len(twice))).all(axis=0).tolist(), strict=True))
    assert all(met[k] for k, n in seen.items() if n > 1)
    single = [met[k] for k, n in seen.items() if n == 1]
    assert sum(single) < 0.05 * len(single)


def plain_phrases(rows, least, best, percent=80, longest=4):
    out, counts, totals = [], {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for size in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            covered = any(100 * b >= percent * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not covered:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def made_up_pieces(seed, n, words):
    rng = np.random.default_rng(seed)
    names = [f"w{k}" if k % 5 else f"Wört{k}" for k in range(words)]
    fixed = ["alpha beta gamma delta epsilon zeta", "New York", "one two three, one two", "to be or not to be"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.integers(0, 12)):
            parts.append(fixed[rng.integers(0, 4)] if rng.random() < 0.4 else " ".join(names[int(k) % words] for k in rng.zipf(1.5, rng.integers(0, 9))))
            parts.append(rng.choice([" ", ", ", ".\n", "  \t", "!", ";:"]))
        out.append((rng.choice(["en", "de", None, "en"]), "".join(parts)))
    return [*out, ("fr", None), ("fr", ""), (None, "..."), ("es", "a a a a a a a a")]


@pytest.mark.parametrize("chunk", [200, 2 << 20])
@pytest.mark.parametrize("least, best", [(3, 2000), (12, 7)])
def test_phrases_equal_plain_ones(spark, monkeypatch, chunk, least, best):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rows = made_up_pieces(5, 150, 40)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in collocations.phrases(docs, least=least, best=best).collect())
    assert got == plain_phrases(rows, least, best) and len(got) > 5


def test_phrases_with_a_full_bitset_and_of_other_lengths(spark, monkeypatch):
    """Rare words that are taken for frequent ones change nothing."""
    monkeypatch.setattr(collocations, "BUCKETS", 64)
    rows = made_up_pieces(6, 80, 200)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as n", "'x' as phrase", "'y' as size")
    for longest in (2, 3, 5):
        got = sorted(tuple(r) for r in collocations.phrases(docs, least=4, longest=longest).collect())
        assert got == plain_phrases(rows, 4, 2000, longest=longest)
    assert collocations.contract(docs.where("lang = 'xx'")).count() == 0 and collocations.contract(docs.where("lang = 'fr'")).count() == 0


def test_paths_are_compact():
    """Copies of a text become one path, and every edge is in one."""
    text = "a b c d e f g h, x b c d e y"
    corpus = collocations.Corpus(pa.array([text] * 5 + ["c d e f"]), pa.array(["en"] * 6))
    graph = collocations.Graph(corpus, collocations.Frequent(64), 4)
    begin, size, weight = graph.paths()
    word = [corpus.low[a:b].tobytes().decode() for a, b in zip(corpus.starts, corpus.ends, strict=True)]
    paths = Counter({" ".join(word[graph.word[i]] for i in range(b, b + n)): int(w) for b, n, w in zip(begin, size, weight, strict=True)})
    assert paths == Counter({"a b c d": 5, "b c d e": 10, "c d e f": 6, "d e f g h": 5, "x b c d": 5, "c d e y": 5})
    endings = {" ".join(word[graph.word[i]] for i in range(b, b + n)): int(w) for b, n, w in zip(*graph.endings(), strict=True)}
    assert endings == {"f g h": 5, "g h": 5, "h": 5, "d e y": 5, "e y": 5, "y": 5, "d e f": 1, "e f": 1, "f": 1}


def test_exact_scores_of_huge_counts(spark):
    big = 4 * 10**13
    counts = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, 2 * big + 5)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    assert [r["score"] for r in collocations._scored(counts, totals).collect()] == [2_000_000 * big // (3 * big + 6)]


def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if n >= max(6, 4 * q) and not any(q % d == 0 and w[i : j + q - d] == w[i + d : j + q] for d in range(1, q)):
                out.append((i, n, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_contract(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if i is not None:
        h = zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = plain_runs(w)
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    s, size, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    left = " ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(runs), s, size, q, 1000 * size // q if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_runs_equal_plain_ones(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 30_000]
    got = QUERIES["op13_periodic_runs"](spark, small).collect()
    want = {i: plain_contract(i, t) for i, t in rows}
    assert len(got) == docs.count() and len(want) > 190
    assert [tuple(r[c] for c in COLUMNS) for r in got if r["doc_id"] in want] == [want[r["doc_id"]] for r in got if r["doc_id"] in want]


def test_periodic_runs_of_odd_rows(spark):
    rows = [(None, "x " * 40), (None, None), (1, ""), (1, "a b " * 7 + "a"), (2, "x x x x x"), (2, "\t\n "), (3, "é É " * 50 + "é é é é é é é"), (4, "A a " * 3000)]
    rows += [(k, f"w{k} x y z v " * 9) for k in range(10, 60)] + [(5, " ".join(f"u{k}" for k in range(3000)) + " p q r" * 900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' as runs", "1 as n", "'c' as collapsed", "2 as g", "'w' as w")
    got = Counter(tuple(r[c] for c in COLUMNS) for r in periodic.contract(docs).collect())
    assert got == Counter(plain_contract(i, t) for i, t in rows)
    assert periodic.contract(docs.where("doc_id = 99")).count() == 0


def test_runs_of_random_texts():
    rng = np.random.default_rng(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(0, 250))
            w = rng.integers(0, rng.integers(1, 5) if rng.random() < 0.5 else 50, n)
            if n and rng.random() < 0.7:
                a = int(rng.integers(0, n))
                w = np.concatenate([w[:a], w[a + np.arange(n - a) % (1 + (n - a) // rng.integers(3, 11))]])
            texts.append(w)
        first = np.append(0, np.cumsum([len(t) for t in texts]))
        got = periodic.find(np.concatenate(texts), first)
        assert got.tolist() == [[k, *r] for k, w in enumerate(texts) for r in plain_runs(w.tolist())]


def test_extensions_equal_comparisons():
    rng = np.random.default_rng(2)
    for n, k in ((1, 1), (40, 2), (700, 2), (3000, 1), (2000, 3)):
        codes = np.append(rng.integers(0, k, n), k + 7)
        codes[: n // 3] = codes[n // 3 : 2 * (n // 3)] if n > 3 else codes[: n // 3]
        i, j = rng.integers(0, n + 1, (2, 300))
        i, j = i[i != j], j[i != j]
        if not len(i):
            continue
        want = [next(d for d in range(n + 2) if max(a, b) + d > n or codes[a + d] != codes[b + d]) for a, b in zip(i, j, strict=True)]
        assert periodic.Extension(codes).common(i, j).tolist() == want


def test_the_cover_has_every_difference():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def test_planted_periods_are_those_of_the_contract(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    changed = 0
    for r in periodic.with_periods(docs).collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 10:
            assert r["text"] == texts[r["doc_id"]]
        else:
            changed += 1
    assert changed and docs.where(F.crc32(F.col("doc_id").cast("string")) % 10 == 0).count() == changed
