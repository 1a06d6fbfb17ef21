"""Near-duplicates by MinHash with banding, signature verification, exact confirmation and connected components.

1. Each text becomes the set of its word shingles, and that a signature of ``BANDS`` x ``ROWS`` universal-hash minima.
   Texts with equal sets form a class; from here on each class is its smallest id.
2. Classes whose minima agree in a whole band share a bucket. All members of a bucket are compared with its smallest one.
   Pairs that sizes or signatures rule out go; the others are confirmed on the full sets. What is confirmed gives first
   components. This settles most buckets, whatever their size, with a row per member.
3. What is left: pairs in a bucket that are still in different components. Small buckets give these pairs. Large ones are
   first joined to groups, and each group's members outside its largest component are compared with all its members,
   in blocks of bounded size on full sets; a task reports one link per component and block at most. So no pair of a
   bucket stays unjudged, and no group, however large, is written out as pairs.
4. The links found join the first components to the final ones.

A pair at the threshold misses all buckets with a chance of 5 in a million. Only ids, sizes, bands and signatures are
shuffled for all documents; texts are shuffled once, to give the full sets of those that share a bucket.

Edge cases: a null or empty text has no shingle and is linked with nothing; a text of fewer words than a shingle has its
whole sequence as one. Rows without an id are no node: no component, and kept. Rows that repeat an id are one
node, whatever their texts: each text is compared by itself, and what is linked to one of them is linked to all. Other
columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import words, worker
from sluice.llm.components import components
from sluice.session import scratch_folder, through_table

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 40, 6
SEED = 20_240_131
#: Members up to which a bucket is searched by pairs.
SMALL_BUCKET = 32
#: Members and bytes of full sets on each side of a block.
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20
#: How many standard errors below the threshold an estimate may lie.
SLACK = 5


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


_A, _B = _functions()


def least_agreement(percent: int = PERCENT) -> int:
    """Equal minima that a pair at the threshold has, but for a chance of one in millions."""
    share, n = percent / 100, BANDS * ROWS
    return int(n * share - SLACK * (n * share * (1 - share)) ** 0.5)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of each text, in order, and where each text's begin."""
    data, at = words.buffer(texts)
    data = words.LOWER[data]
    starts, ends, first = words.spans(data, at, words.NOT_SPACE)
    word, count = words.hashes(data, starts, ends), np.diff(first)
    runs, run_at = words.windows(word, first, size)
    keys, text = [runs], [words.of_text(first)[run_at]]
    for n in range(1, size):
        few = np.flatnonzero(count == n)
        if len(few):
            whole = words.joined(np.full(len(few), n, np.uint64), *(word[first[few] + k] for k in range(n)))
            keys.append(whole)
            text.append(few)
    return words.distinct_per_text(np.concatenate(keys), np.concatenate(text), len(at) - 1)


def minima(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The least value of each hash function over each text's shingles; texts without one are left out."""
    filled = np.flatnonzero(np.diff(begin))
    out = np.empty((BANDS * ROWS, len(filled)), np.uint32)
    # So many shingles at once that they stay in the processor's cache.
    for lo, hi in _groups(begin, filled):
        own = keys[begin[filled[lo]] : begin[filled[hi - 1] + 1]]
        edge = begin[filled[lo:hi]] - begin[filled[lo]]
        value = np.empty_like(own)
        for k in range(len(_A)):
            np.multiply(own, _A[k], out=value)
            value += _B[k]
            out[k, lo:hi] = np.minimum.reduceat(value, edge) >> np.uint64(32)
    return out


def _groups(begin: np.ndarray, filled: np.ndarray, most: int = 1 << 15) -> Iterator[tuple[int, int]]:
    ends, lo = begin[filled + 1], 0
    while lo < len(filled):
        hi = max(lo + 1, int(np.searchsorted(ends, begin[filled[lo]] + most, "right")))
        yield lo, hi
        lo = hi


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return (total[begin[1:]] - total[begin[:-1]]).view(np.int64)


def signatures(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id``, ``n`` (shingles), ``x`` and ``y`` (two checksums of the set), ``bands`` and ``minima`` of each row."""
    kind = docs.schema[key].dataType.simpleString()

    @worker.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(1)):
                keys, begin = shingle_sets(part, size)
                filled = np.diff(begin) > 0
                least = minima(keys, begin)
                bands = np.stack([words.joined(np.full(least.shape[1], b, np.uint64), *least[b * ROWS : (b + 1) * ROWS].astype(np.uint64)) for b in range(BANDS)], axis=1)
                sizes = np.where(filled, BANDS, 0)
                bounds = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
                short = (least.T.astype("<u2")).tobytes()
                cut = np.append(0, np.cumsum(np.where(filled, 2 * BANDS * ROWS, 0))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(done, len(part)),
                        pa.array(np.diff(begin)),
                        pa.array(_sums(words.mixed(keys), begin)),
                        pa.array(_sums(words.mixed(keys ^ np.uint64(words.LAST)), begin)),
                        pa.ListArray.from_arrays(bounds, pa.array(bands.ravel().view(np.int64))),
                        pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(cut), pa.py_buffer(short)]),
                    ],
                    ["id", "n", "x", "y", "bands", "minima"],
                )
                done += len(part)

    return docs.select(key, text).mapInArrow(run, f"id {kind}, n long, x long, y long, bands array<bigint>, minima binary")


def _full_sets(docs: DataFrame, members: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id`` and ``shingles`` (their hashes as bytes, in order) of the members' rows."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(members, "id", "left_semi")
    kind = docs.schema[key].dataType.simpleString()

    @worker.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(1)):
                keys, begin = shingle_sets(part, size)
                parts = [keys[begin[k] : begin[k + 1]].tobytes() for k in range(len(part))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.array(parts, pa.binary())], ["id", "shingles"])
                done += len(part)

    return rows.mapInArrow(run, f"id {kind}, shingles binary")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = _shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint64)


def _confirmed(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a``, ``b`` those that are links: first by their signatures, then on the full sets."""
    least, kind = least_agreement(percent), pairs.schema["a"].dataType.simpleString()

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                left, right = (np.frombuffer(b"".join(b.column(k).to_pylist()), "<u2").reshape(b.num_rows, -1) for k in (2, 3))
                yield b.filter(pa.array((left == right).sum(axis=1) >= least)).select(["a", "b"])

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = b.column(2).to_pylist(), b.column(3).to_pylist()
            good = [_linked(_numbers(x), _numbers(y), percent) for x, y in zip(left, right, strict=True)]
            yield b.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        one, two = (table.select(F.col("id").alias(f"{s}_id"), F.col(column).alias(f"{s}_{column}")) for s in "ab")
        both = pairs.join(one, F.col("a") == F.col("a_id")).join(two, F.col("b") == F.col("b_id"))
        return both.select("a", "b", f"a_{column}", f"b_{column}")

    near = through_table(with_both(pairs, reps, "minima").mapInArrow(alike, f"a {kind}, b {kind}"), scratch_folder(pairs.sparkSession, "alike"))
    return with_both(near, sets, "shingles").mapInArrow(same, f"a {kind}, b {kind}")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id`` and ``kept``."""
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        return through_table(df, scratch_folder(spark, label))

    signed = stored(signatures(docs, key, text, size), "signatures")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("n", "x") for f in (F.min, F.max)]
    if not signed.where("id is not null").groupBy("id").agg(*ends).where("min_n <> max_n or min_x <> max_x").isEmpty():
        return _of_texts(docs, key, text, size, percent)
    nodes = signed.where("id is not null and n > 0")
    reps = stored(nodes.groupBy("n", "x", "y").agg(F.min("id").alias("id"), F.any_value("bands").alias("bands"), F.any_value("minima").alias("minima")), "classes")
    banded = reps.select("id", "n", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.min_by(F.struct("id", "n"), "id").alias("hub"), F.count("*").alias("members")).where("members > 1")
    buckets = stored(banded.join(hubs, "bucket").select("bucket", "id", "n", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), "members"), "buckets")
    # Rows of an id have equal sets here.
    sets = stored(_full_sets(docs, buckets.select("id").distinct(), key, text, size).dropDuplicates(["id"]), "sets")

    def sizes_allow(a: str, b: str):
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    stars = buckets.where((F.col("id") != F.col("hub")) & sizes_allow("n", "hub_n")).select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(_confirmed(stars, reps, sets, percent), "links")
    first = stored(components(links), "components")

    left = stored(
        buckets.join(first, F.col("id") == F.col("node"), "left").select("bucket", "id", "n", "hub", "members", F.coalesce("component", "id").alias("component")),
        "left",
    )
    open_buckets = left.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
    left = left.join(open_buckets, "bucket", "left_semi")
    few = left.where(F.col("members") <= SMALL_BUCKET)
    other = few.select("bucket", *(F.col(c).alias(f"other_{c}") for c in ("id", "n", "component")))
    pairs = (
        few.join(other, "bucket")
        .where((F.col("id") > F.col("other_id")) & (F.col("other_id") != F.col("hub")) & (F.col("component") != F.col("other_component")) & sizes_allow("n", "other_n"))
        .select(F.col("id").alias("a"), F.col("other_id").alias("b")).distinct()
    )
    more = stored(_confirmed(pairs, reps, sets, percent), "links")
    many = _large_groups(left.where(F.col("members") > SMALL_BUCKET), reps, sets, percent)
    joined = more.unionByName(many)
    names = first.select(F.col("node"), F.col("component"))
    lifted = joined
    for side in ("a", "b"):
        lifted = lifted.join(names.select(F.col("node").alias("node"), F.col("component").alias("of")), F.col(side) == F.col("node"), "left").withColumn(side, F.coalesce("of", side)).drop("node", "of")
    second = stored(components(lifted.select("a", "b")), "components")

    of_class = (
        reps.select("n", "x", "y", "id")
        .join(first, F.col("id") == F.col("node"), "left").select("n", "x", "y", F.coalesce("component", "id").alias("at"))
        .join(second, F.col("at") == F.col("node"), "left").select("n", "x", "y", F.coalesce("component", "at").alias("component_id"))
    )
    rows = signed.select("id", "n", "x", "y")
    found = rows.join(of_class, ["n", "x", "y"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _nodes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``of`` (hash of the text) and ``node`` of every different text of an id. Numbers are in the order of ids, as
    partitions are in order as well."""
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("of")).where("id is not null")
    ordered = texts.distinct().orderBy("id", "of").select("id", "of", F.monotonically_increasing_id().alias("node"))
    return through_table(ordered, scratch_folder(docs.sparkSession, "nodes"))


def _of_texts(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """``classes`` where ids have several texts: each text is a node of its own, and the nodes of an id are linked."""
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        return through_table(df, scratch_folder(spark, label))

    nodes = _nodes(docs, key, text)
    known = nodes.select(F.col("id").alias("known"), "of", "node")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.join(known, (F.col("id") == F.col("known")) & (F.xxhash64("text") == F.col("of")), "left")
    found = stored(classes(stored(rows.select("node", "text"), "numbered"), "node", "text", size, percent), "texts")
    least = nodes.groupBy("id").agg(F.min("node").alias("least"), F.count("*").alias("texts")).where("texts > 1")
    alike = found.where("component_id <> node").select(F.col("node").alias("a"), F.col("component_id").alias("b"))
    joined = stored(components(alike.unionByName(nodes.join(least, "id").select(F.col("node").alias("a"), F.col("least").alias("b")))), "joined")
    of_node = joined.select(F.col("node").alias("of"), "component")
    roots = nodes.select(F.col("node").alias("root"), F.col("id").alias("component_id"))
    own = nodes.select(F.col("node").alias("own"), "id")
    out = (
        found.select("node", "n_shingles")
        .join(own, F.col("node") == F.col("own"), "left")
        .join(of_node, F.col("node") == F.col("of"), "left")
        .join(roots, F.coalesce("component", "node") == F.col("root"), "left")
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return out.select(F.col("id").alias(key), "n_shingles", "component_id", kept.alias("kept"))


def _large_groups(left: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of open large buckets."""
    spark, kind = left.sparkSession, left.schema["id"].dataType.simpleString()

    def stored(df: DataFrame, label: str) -> DataFrame:
        return through_table(df, scratch_folder(spark, label))

    groups = components(left.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    member = left.select("id", "component").distinct().join(groups.select("node", F.col("component").alias("grp")), F.col("id") == F.col("node")).select("id", "component", "grp")
    by_component = member.groupBy("grp", "component").agg(F.count("*").alias("k"))
    largest = by_component.groupBy("grp").agg(F.max_by("component", F.struct("k", "component")).alias("main"))
    full = member.join(sets, "id").select("grp", "component", "id", "shingles").join(largest, "grp").join(reps.select("id", "minima"), "id")
    full = stored(full.withColumn("bytes", F.octet_length("shingles") + F.octet_length("minima")), "groups")
    outside = F.col("component") != F.col("main")
    total = full.groupBy("grp").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("all_blocks"),
        F.greatest(F.ceil(F.sum(outside.cast("int")) / BLOCK_ROWS), F.ceil(F.sum(F.when(outside, F.col("bytes")).otherwise(0)) / BLOCK_BYTES)).cast("int").alias("out_blocks"),
    )
    placed = full.join(total, "grp").withColumn("own", F.xxhash64("id"))
    row = ["grp", "component", "id", "shingles", "minima"]
    out_side = placed.where(outside).select(*row, F.lit(0).alias("side"), F.pmod("own", "out_blocks").cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("j"))
    all_side = placed.where("out_blocks > 0").select(*row, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)).alias("i"), F.pmod("own", "all_blocks").cast("int").alias("j"))
    least = least_agreement(percent)

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        a, b = block[block["side"] == 0], block[block["side"] == 1]
        links: list[tuple] = []
        if len(a) and len(b):
            signed_a, signed_b = (np.frombuffer(b"".join(s["minima"]), "<u2").reshape(len(s), -1) for s in (a, b))
            sets_b = [_numbers(x) for x in b["shingles"]]
            ids_b, component_b = b["id"].to_numpy(), b["component"].to_numpy()
            size_b = np.array([len(x) for x in sets_b])
            for k in range(len(a)):
                own, component = _numbers(a["shingles"].iloc[k]), a["component"].iloc[k]
                able = (100 * np.minimum(size_b, len(own)) >= percent * np.maximum(size_b, len(own))) & (component_b != component)
                near = np.flatnonzero(able & ((signed_b == signed_a[k]).sum(axis=1) >= least))
                done: set = set()
                for m in near:
                    if component_b[m] not in done and _linked(own, sets_b[m], percent):
                        done.add(component_b[m])
                        links.append((a["id"].iloc[k], ids_b[m]))
        return pd.DataFrame(links, columns=["a", "b"])

    blocks = out_side.unionByName(all_side)
    return stored(blocks.groupBy("grp", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}"), "links")


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, one_per_id: bool = True) -> DataFrame:
    """One document of each class and component, with its own columns: the one with the smallest id. Rows without an id all
    stay, and of rows with the same id and text one does. Different texts of one id are judged each by itself, in the order
    of their hashes; of those that are no duplicates ``one_per_id`` keeps the first, otherwise all stay."""
    spark, columns = docs.sparkSession, [F.col(f"d.`{c}`") for c in docs.columns]
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(text).alias("of"))
    counted = texts.groupBy("id", "of").agg(F.count("*").alias("rows")).groupBy("id").agg(F.count("*").alias("texts"), F.sum("rows").alias("rows"))
    twice = through_table(counted.where("rows > 1"), scratch_folder(spark, "repeated"))
    nested = docs.alias("d").select(F.struct(*columns).alias("doc"))
    if twice.isEmpty():
        dropped = classes(docs, key, text, size, percent).where("not kept").select(F.col(key).alias("dropped_id")).distinct()
        return nested.join(dropped, F.col(f"doc.`{key}`") == F.col("dropped_id"), "left_anti").select("doc.*")
    own_id, own_text = F.col(f"doc.`{key}`"), F.col(f"doc.`{text}`")
    rows = nested.join(_nodes(docs, key, text), (own_id == F.col("id")) & (F.xxhash64(own_text) == F.col("of")), "left")
    rows = rows.select("doc", "node", "id", own_text.alias("text"))
    rows = through_table(rows, scratch_folder(spark, "numbered"))
    dropped = classes(rows.select("node", "text"), "node", "text", size, percent).where("not kept").select(F.col("node").alias("dropped")).distinct()
    rest = rows.join(dropped, F.col("node") == F.col("dropped"), "left_anti")
    if one_per_id:
        first = rest.groupBy("id").agg(F.min("node").alias("first")).select("first")
        rest = rest.where("node is null").unionByName(rest.join(first, F.col("node") == F.col("first"), "left_semi"))
    return rest.where("node is null").unionByName(rest.where("node is not null").dropDuplicates(["node"])).select("doc.*")


def contract(docs: DataFrame) -> DataFrame:
    """The registered query: sets of two-word shingles, linked at 80 in 100."""
    return classes(docs, size=2, percent=80)


ORACLE = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
    SELECT DISTINCT doc_id, array_to_string(w[p : p + 1], ' ') AS s FROM d, generate_series(1, greatest(len(w) - 1, 1)) g(p) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
sets AS (SELECT min(doc_id) AS rep, n, h FROM (SELECT doc_id, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY s)) AS h FROM sh GROUP BY doc_id) GROUP BY n, h),
r AS (SELECT sh.doc_id, s, sets.n FROM sh JOIN sets ON sh.doc_id = sets.rep),
-- Two sets that are alike share one of the first n - 0.8 n + 1 shingles in any fixed order; rare ones first make few pairs.
f AS (SELECT s, count(*) AS c FROM r GROUP BY s),
p AS (SELECT doc_id, s, n FROM (SELECT r.*, row_number() OVER (PARTITION BY doc_id ORDER BY f.c, r.s) AS k FROM r JOIN f USING (s)) WHERE k <= n - ceil(0.8 * n) + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.s = b.s AND a.doc_id > b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS (
    SELECT c.a, c.b FROM c JOIN r x ON x.doc_id = c.a JOIN r y ON y.doc_id = c.b AND x.s = y.s
    GROUP BY c.a, c.b, c.na, c.nb HAVING 100 * count(*) >= 80 * (c.na + c.nb - count(*))
), e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
walk(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, walk.root FROM walk JOIN e ON walk.node = e.a WHERE e.b > walk.root),
top AS (SELECT node, min(root) AS component FROM walk GROUP BY node),
class AS (SELECT doc_id, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY s)) AS h FROM sh GROUP BY doc_id),
named AS (SELECT class.doc_id, coalesce(top.component, sets.rep) AS component FROM class JOIN sets USING (n, h) LEFT JOIN top ON top.node = sets.rep)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id, coalesce(component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN named USING (doc_id)
"""
