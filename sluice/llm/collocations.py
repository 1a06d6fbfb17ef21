"""Phrases of words that occur together, from a weighted de Bruijn graph.

A node is a phrase of ``LONGEST`` - 1 words, an edge one of ``LONGEST`` words, from its first words to its last; an edge's
weight is how often the phrase occurs. A graph holds no shorter phrases: how often one occurs is the weight that flows out
of the nodes that begin with it, plus the pieces that end with it.

1. Words, pairs and triples of neighbours are counted by hash, each in a pass that leaves out what the one before has found
   to be rare. A phrase with ``least`` occurrences holds no word, pair or triple with fewer. So rare words and pairs cut
   pieces, like punctuation does, and a phrase reaches no further than to a rare triple. Counts are kept in
   ``BUCKETS`` buckets, whatever the corpus, and leave a task compressed, about a byte for each different phrase; what is
   frequent goes to all tasks as a bitset of 8 MB. Where buckets are shared something rare stays in, which changes no
   result.
2. Each task builds the graph of some megabytes of text at a time, with the weights added up, and compacts it: edges that
   follow one another over nodes with one edge in and one out, of the same weight, become one path, written as its words.
   Copies of a text thus leave the task as one path with their number as its weight. Phrases that end short of an edge, at
   the end of a piece or before a rare triple, are added up likewise.
3. Paths are opened to edges again, which are added up over all tasks. Then the flow out of nodes, with the phrases that
   end there, gives the counts of phrases one word shorter, these those of the next, down to single words. What a step has
   below ``least`` goes on in the sums of its beginnings only. Every sum is added up before the shuffle, so a frequent
   phrase, word or language is a row for each task.
4. Frequent phrases are scored by their worst cut, dropped where a longer one has most of their occurrences, and each
   language's best are taken, cut to their number before the shuffle.

Products are taken as decimals of 38 digits. Edge cases: a null or empty text has no words; a null language is ``und``.
Rows that repeat an id are documents each; no id is read. A language without phrases gives no rows, an empty table none.
Texts are whole; a very long one is a graph of its own. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm import words, worker
from sluice.session import scratch_folder, through_table

LONGEST = 4
LEAST = 30
KEEP_PERCENT = 80
BEST = 2000
SCALE = 2_000_000
NO_LANGUAGE = "und"
CHUNK_BYTES = 2 << 20
#: Buckets of counts and bits of a bitset, and those of a piece of it.
BUCKETS, PIECE = 1 << 26, 1 << 16
#: Counted buckets that a task holds before it gives them out.
HELD = 2 << 20

#: Bytes that end a piece, and those in words.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~ENDS
WORD[[0x20, 0x09]] = False

WIDE = "decimal(38,0)"


class Corpus:
    """Words of a column of texts: hashes that tell languages apart, and whether a piece begins with each."""

    def __init__(self, texts: pa.Array, languages: pa.Array):
        data, at = words.buffer(texts)
        self.low = words.LOWER[data]
        self.starts, self.ends, first = words.spans(self.low, at, WORD)
        self.text = words.of_text(first)
        coded = pc.fill_null(languages, NO_LANGUAGE).dictionary_encode()
        salts = [int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in coded.dictionary.to_pylist()]
        salt = np.array(salts, np.uint64)[coded.indices.to_numpy()] if salts else np.zeros(0, np.uint64)
        self.languages = coded
        self.hash = words.mixed(words.hashes(self.low, self.starts, self.ends) ^ salt[self.text])
        ends = np.append(0, np.cumsum(ENDS[data]))
        self.begins = np.ones(len(self.starts), bool)
        self.begins[1:] = (self.text[1:] != self.text[:-1]) | (ends[self.starts[1:]] > ends[self.ends[:-1]])


def _corpora(batches: Iterator[pa.RecordBatch]) -> Iterator[Corpus]:
    for batch in batches:
        done = 0
        for part in words.slices(batch.column(1), CHUNK_BYTES):
            yield Corpus(part, batch.column(0).slice(done, len(part)))
            done += len(part)


class Frequent:
    """The bitsets of what is frequent: words, pairs and triples, as far as they are counted yet."""

    def __init__(self, buckets: int, *bits: np.ndarray):
        self.buckets, self.bits = buckets, bits

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes % np.uint64(self.buckets)).astype(np.int64)

    def has(self, size: int, hashes: np.ndarray) -> np.ndarray:
        """Which phrases of a size are frequent."""
        at = self.bucket(_neighbours(hashes, size))
        return (self.bits[size - 1][at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def words(self, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the frequent words, and whether each begins a piece: at the begin of one, or after something rare."""
        if not self.bits:
            return np.arange(len(corpus.hash)), corpus.begins
        stays = self.has(1, corpus.hash)
        piece = np.cumsum(corpus.begins | ~stays | np.append(False, ~stays[:-1]))
        word = np.flatnonzero(stays)
        begins = np.append(True, piece[word][1:] != piece[word][:-1])[: len(word)]
        if len(self.bits) > 1:
            begins[1:] |= ~self.has(2, corpus.hash[word])
        return word, begins

    def next(self, corpus: Corpus) -> np.ndarray:
        """Buckets of all phrases of one word more than are counted, inside pieces."""
        word, begins = self.words(corpus)
        size = len(self.bits) + 1
        if len(word) < size:
            return np.zeros(0, np.int64)
        inside = np.ones(len(word) - size + 1, bool)
        for k in range(1, size):
            inside &= ~begins[k : k + len(inside)]
        return self.bucket(_neighbours(corpus.hash[word], size)[inside])


def _neighbours(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(len(hashes) - size + 1, 0)
    return words.joined(*(hashes[k : k + n] for k in range(size)))


def _count_rows(buckets: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of buckets, in order, as a row for each piece of them: steps from bucket to bucket, and counts, compressed."""
    piece = buckets // PIECE
    cuts = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), len(piece)] if len(piece) else []
    for a, b in pairwise(cuts):
        steps = np.diff(buckets[a:b] % PIECE, prepend=0).astype("<u2")
        rows = [[int(piece[a])], [zlib.compress(steps.tobytes(), 1)], [zlib.compress(np.minimum(counts[a:b], 1 << 31).astype("<u4").tobytes(), 1)]]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["piece", "steps", "counts"])


def _added(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in order with their counts added up."""
    buckets, place = np.unique(np.concatenate([b for b, _ in counted]), return_inverse=True)
    return buckets, np.bincount(place, np.concatenate([n for _, n in counted]), len(buckets)).astype(np.int64)


def _frequent(rows: DataFrame, least: int, known) -> np.ndarray:
    """The bitset of phrases of one word more than those of ``known`` (a broadcast ``Frequent``)."""

    @worker.tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for c in _corpora(batches):
            held.append(np.unique(known.value.next(c), return_counts=True))
            n += len(held[-1][0])
            if n > HELD:
                yield from _count_rows(*_added(held))
                held, n = [], 0
        if held:
            yield from _count_rows(*_added(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in order of pieces, so one piece at a time is held.
        piece, total = None, np.zeros(PIECE, np.int64)

        def ended() -> pa.RecordBatch:
            bits = np.packbits(total >= least, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([bits], pa.binary())], ["piece", "bits"])

        for batch in batches:
            for k, steps, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != piece:
                    if piece is not None:
                        yield ended()
                    piece = k
                    total[:] = 0
                at = np.cumsum(np.frombuffer(zlib.decompress(steps), "<u2").astype(np.int64))
                total[at] += np.frombuffer(zlib.decompress(counts), "<u4")
        if piece is not None:
            yield ended()

    counted = rows.mapInArrow(count, "piece int, steps binary, counts binary").repartition("piece").sortWithinPartitions("piece")
    out = np.zeros((-(-known.value.buckets // PIECE), PIECE // 8), np.uint8)
    for row in counted.mapInArrow(merge, "piece int, bits binary").collect():
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


class Graph:
    """The de Bruijn graph of some texts: numbers of the words that stay, and of their phrases of each size up to
    ``longest``, equal for equal phrases."""

    def __init__(self, corpus: Corpus, frequent: Frequent, longest: int):
        self.word, begins = frequent.words(corpus)
        self.longest, n = longest, len(begins)
        last = np.append(np.flatnonzero(begins[1:]), n - 1)[:n]
        left = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(n) + 1
        #: Words of the longest phrase that begins with each word, in its piece and up to a rare triple.
        self.reach = np.minimum(left, longest)
        if len(frequent.bits) > 2 and n > 2:
            rare = np.flatnonzero(~frequent.has(3, corpus.hash[self.word]))
            following = np.append(rare, 2 * n)[np.searchsorted(rare, np.arange(n))]
            self.reach = np.minimum(self.reach, following - np.arange(n) + 2)
        ids = np.unique(corpus.hash[self.word], return_inverse=True)[1]
        size = int(ids.max(initial=0)) + 2
        self.phrase = [ids]
        for k in range(1, longest):
            longer = np.full(n, -1)
            whole = np.flatnonzero(self.reach > k)
            longer[whole] = np.unique(self.phrase[-1][whole] * size + ids[whole + k], return_inverse=True)[1]
            self.phrase.append(longer)

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words, and weight of each path; words as numbers of those that stay."""
        node, edge = self.phrase[-2], self.phrase[-1]
        every = np.flatnonzero(edge >= 0)
        _, first, weight = np.unique(edge[every], return_index=True, return_counts=True)
        first = every[first]
        order = np.argsort(first)
        first, weight = first[order], weight[order]
        if not len(first):
            return first, first, weight
        nodes = int(node.max()) + 1
        comes, goes = np.bincount(node[first + 1], minlength=nodes), np.bincount(node[first], minlength=nodes)
        inner = (comes[node[first[1:]]] == 1) & (goes[node[first[1:]]] == 1)
        joined = inner & (first[1:] == first[:-1] + 1) & (weight[1:] == weight[:-1])
        begin = np.flatnonzero(np.append(True, ~joined))
        return first[begin], np.diff(np.append(begin, len(first))) + self.longest - 1, weight[begin]

    def endings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that end short of an edge, in the same form."""
        out = []
        for k in range(1, self.longest):
            at = np.flatnonzero(self.reach == k)
            _, first, n = np.unique(self.phrase[k - 1][at], return_index=True, return_counts=True)
            out.append((at[first], np.full(len(first), k), n))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _graphs(rows: DataFrame, longest: int, frequent) -> DataFrame:
    """``lang``, ``path`` (words), ``weight`` and whether it is an ``ending``; with a null path the number of all
    words."""

    @worker.tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _corpora(batches):
            graph = Graph(c, frequent.value, longest)
            for (begin, size, weight), ending in ((graph.paths(), False), (graph.endings(), True)):
                first = np.append(0, np.cumsum(size))
                inside = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(begin, size)
                texts = words.joined_texts(c.low, c.starts, c.ends, graph.word[inside], first)
                languages = c.languages.take(pa.array(c.text[graph.word[begin]])).dictionary_decode()
                yield pa.RecordBatch.from_arrays([languages, texts, pa.array(weight), pa.array(np.full(len(begin), ending))], ["lang", "path", "weight", "ending"])
            n = np.bincount(c.languages.indices.to_numpy()[c.text], minlength=len(c.languages.dictionary))
            yield pa.RecordBatch.from_arrays([c.languages.dictionary, pa.nulls(len(n), pa.string()), pa.array(n), pa.array(np.zeros(len(n), bool))], ["lang", "path", "weight", "ending"])

    return rows.mapInArrow(build, "lang string, path string, weight long, ending boolean")


def _begin(phrase: Column, size: int) -> Column:
    return F.substring_index(phrase, " ", size)


def _words_in(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def _counts(graphs: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang``, ``phrase``, ``size`` and ``f`` of all phrases of up to ``longest`` words with ``least`` occurrences."""
    paths = graphs.where("path is not null and not ending").select("lang", F.split("path", " ").alias("w"), F.col("weight").alias("f"))
    edges = F.transform(F.sequence(F.lit(1), F.size("w") - longest + 1), lambda k: F.array_join(F.slice("w", k, longest), " "))
    opened = paths.select("lang", F.explode(edges).alias("phrase"), F.lit(longest).alias("size"), "f")
    ends = graphs.where("path is not null and ending").select("lang", F.col("path").alias("phrase"), F.col("weight").alias("f")).withColumn("size", _words_in(F.col("phrase")))
    now = opened.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    for size in range(longest - 1, 0, -1):
        # Of a phrase: itself where it counts, and its beginning where it is the longest so far.
        own = F.when(F.col("f") >= least, F.struct("phrase", "size"))
        shorter = F.when(F.col("size") == size + 1, F.struct(_begin(F.col("phrase"), size).alias("phrase"), F.lit(size).alias("size")))
        flow = now.select("lang", "f", F.explode(F.array(own, shorter)).alias("p")).where("p is not null").select("lang", "p.phrase", "p.size", "f")
        now = flow.unionByName(ends.where(F.col("size") == size).select("lang", "phrase", "size", "f")).groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return now.where(F.col("f") >= least)


def _scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words and more with the parts' counts of their worst cut."""
    long = counts.where("size > 1")
    cuts = long.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - size)")})
    parts = counts.select("lang", F.col("phrase").alias("part"), "f")
    for side, name in (("left", "l"), ("right", "r")):
        named = parts.select(F.col("lang").alias("of"), "part", F.col("f").alias(name))
        cuts = cuts.join(named, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part")
    score = F.expr(f"(cast({SCALE} as {WIDE}) * cast(a as {WIDE})) div (cast(l as {WIDE}) + cast(r as {WIDE}))").cast("long")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    return worst.select("lang", "phrase", "size", "a", "w.l", "w.r", "w.score").join(totals, "lang")


def _covered(counts: DataFrame, percent: int) -> DataFrame:
    """Phrases that a longer one has most occurrences of."""
    inside = F.expr(
        """flatten(transform(sequence(2, size - 1), n -> transform(sequence(0, size - n),
            k -> substring_index(substring_index(phrase, ' ', k + n), ' ', -n))))"""
    )
    held = counts.where("size > 2").select("lang", F.explode(inside).alias("phrase"), F.col("f").alias("longer"))
    most = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    both = most.join(counts.where("size > 1").select("lang", "phrase", "f"), ["lang", "phrase"])
    return both.where(F.expr(f"100 * cast(longer as {WIDE}) >= {percent} * cast(f as {WIDE})")).select("lang", "phrase")


def phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, best: int = BEST, percent: int = KEEP_PERCENT, longest: int = LONGEST
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's best phrases."""
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        return through_table(df, scratch_folder(spark, label))

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    known = spark.sparkContext.broadcast(Frequent(BUCKETS))
    for _ in range(min(longest - 1, 3)):
        known = spark.sparkContext.broadcast(Frequent(BUCKETS, *known.value.bits, _frequent(rows, least, known)))
    graphs = stored(_graphs(rows, longest, known), "graphs")
    totals = graphs.where("path is null").groupBy("lang").agg(F.sum("weight").alias("n"))
    counts = stored(_counts(graphs, longest, least), "phrases")
    left = _scored(counts, totals).join(_covered(counts, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: the best phrases of every language."""
    return phrases(docs)


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1])) FROM pieces
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda p: w[p] || ' ' || w[p + 1] || ' ' || w[p + 2])) FROM pieces
    UNION ALL SELECT lang, 4, unnest(list_transform(range(1, len(w) - 2), lambda p: w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3])) FROM pieces
), f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT c.lang, c.phrase, c.size, c.f AS a, k, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * c.f) // (l.f + r.f) AS BIGINT) AS score
    FROM f c, generate_series(1, 3) g(k)
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1 : k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1 :], ' ')
    WHERE c.size > 1 AND k < c.size
), worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
    SELECT lang, array_to_string(string_split(phrase, ' ')[p : p + n - 1], ' ') AS phrase, max(f) AS longer
    FROM f, generate_series(2, 3) s(n), generate_series(1, 3) g(p) WHERE n < size AND p + n - 1 <= size GROUP BY ALL
), good AS (
    SELECT worst.*, totals.n FROM worst JOIN totals USING (lang) LEFT JOIN held USING (lang, phrase) WHERE held.longer IS NULL OR 100 * held.longer < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM good) WHERE rank <= 2000
"""
