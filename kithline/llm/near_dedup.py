"""Operator 5: near-duplicates by improved consistent weighted sampling over TF-IDF word shingles.

A text's shingles are its runs of five words (all its words, if it has fewer); a shingle weighs its
count times an inverse document frequency: 1 in all texts, 2 in RARE of them or fewer, by the logarithm
of the share between. The share is estimated from 2**IDF_BITS hashed buckets, counted over all texts by
a grouped sum: what its bucket holds beyond the mean bucket. The mean depends on the length of texts
(under RARE up to 2,600 shingles a text), not on their number, so a shingle's weight is the same at every
size of a corpus; a rare shingle that falls into a common one's bucket takes the weight of that one.

1. Equal texts are one text from here on; they share a class without any comparison.
2. Each text gets BANDS * ROWS samples by improved consistent weighted sampling (Ioffe, 2010): two
   texts agree in one with the probability of their weighted Jaccard similarity. ROWS samples are a
   band's key. At similarity 0.8 a pair meets in no band with probability (1 - 0.8**5)**20 < 4e-4. The
   last two bytes of all samples are a text's sketch.
3. Texts of one band bucket form a group. Within a group the share of equal sketch entries estimates a
   pair's similarity; a pair whose estimate is more than DEVIATIONS standard deviations under the
   threshold (0.6 at 0.8) is no candidate.
4. Candidates are compared by the weighted Jaccard similarity of their whole texts. Pairs at or over the
   threshold are links; connected components are classes. Links are sought in rounds, each of which
   leaves fewer classes that meet:
   - each group sends the pairs of a spanning forest that prefers high estimates, about n pairs for n
     near copies. A bucket of more than MANY texts is dealt to groups by hash here;
   - of such a bucket, one leader of each class; the same again;
   - buckets in which classes still meet get their members' texts and compare all candidates of
     different classes at once, one text against many; only links between classes leave the group. A
     bucket of more than MANY is divided by pairs of blocks, but for pairs of blocks of its largest
     class: m texts, of which o are outside that class, make about m * o / MANY rows.
   So no pair inside a class is listed, every pair of a bucket whose texts end in different classes has
   been compared, and a group is bounded.

Result: one row per input row with key and class_id (the least key of the class). Nulls and empty texts
have no shingles: they are copies of each other and of nothing else. Repeated rows are copies. A row
with a null key is compared like any other and takes the least key of its class that isn't null.
Texts and classes of more than a thousandth of all rows get their names by broadcast (spread_join).
Further columns are not carried. Texts are told apart by their MD5, and numbered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, arrow, chunks, grams, identity, mix, shelve, text_bytes, unshelve, words, worker

SHINGLE, THRESHOLD = 5, 0.8
IDF_BITS, RARE = 18, 0.01
BANDS, ROWS = 20, 5
MANY, DEVIATIONS = 1_500, 5
HOT = 1_000
_TABLE_BITS = 16


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text's row, hash, count), by row."""
    w = words(data, offsets)
    size = np.diff(w.first)
    h = grams(w.hash, SHINGLE)
    full = np.repeat(w.first[1:], size)[: len(h)] >= np.arange(len(h)) + SHINGLE
    at = np.flatnonzero(full)
    row = np.repeat(np.arange(len(size)), size)[at]
    found = h[at]
    few = np.flatnonzero((size > 0) & (size < SHINGLE))
    if len(few):
        short = np.array([mix(np.array([np.bitwise_xor.reduce(mix(w.hash[w.first[i] : w.first[i + 1]] + np.arange(size[i], dtype=U64)))]))[0] for i in few], U64)
        row, found = np.concatenate([row, few]), np.concatenate([found, short])
    key = np.sort(row.astype(U64) << U64(48) | found >> U64(16))  # a batch has fewer than 2**16 texts
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return (key[head] >> U64(48)).astype(np.int64), mix(key[head] & U64((1 << 48) - 1)), np.diff(np.append(head, len(key)))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - IDF_BITS)).astype(np.int64)


@worker("near_dedup")
def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: in how many texts each bucket has a shingle."""
    n = np.zeros(1 << IDF_BITS, np.int64)
    for part in chunks(batches):
        row, h, _ = shingles(*text_bytes(part.column(0)))
        n += np.bincount(np.unique(row << IDF_BITS | _bucket(h)) & ((1 << IDF_BITS) - 1), minlength=len(n))
    some = np.flatnonzero(n)
    for at in range(0, len(some), 50_000):
        yield arrow(["bucket", "n"], [some[at : at + 50_000].astype(np.int32), n[some[at : at + 50_000]]])


@lru_cache(maxsize=1)
def _randoms() -> tuple[np.ndarray, ...]:
    """For each table entry: r, 1 / r, ln c and beta of the sampling, with r and c from Gamma(2, 1)."""
    rng = np.random.Generator(np.random.PCG64(20260101))
    n = 1 << _TABLE_BITS
    r, c = rng.gamma(2, 1, n), rng.gamma(2, 1, n)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, np.log(c), rng.random(n)))


def samples(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n_rows: int, n: int) -> np.ndarray:
    """n consistent weighted samples of each row's weighted shingles (0 where a row has none).

    A sample is the smallest ln a, as a float moved into the positive, followed by bits of its shingle;
    ln a tells the sampled level, so equal samples are equal (shingle, level) pairs.
    """
    out = np.zeros((n_rows, n), U64)
    if not len(row):
        return out
    head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    r, inverse_r, log_c, beta = _randoms()
    log_w = np.log(weight).astype(np.float32)
    rng = np.random.Generator(np.random.PCG64(7))
    for j in range(n):
        g = h * U64(int(rng.integers(1 << 62)) * 2 + 1)
        g ^= g >> U64(29)
        g *= U64(0xBF58476D1CE4E5B9)
        p = (g >> U64(64 - _TABLE_BITS)).view(np.int64)
        b = beta[p]
        t = log_w * inverse_r[p]
        t += b
        np.floor(t, out=t)
        t -= b
        t += np.float32(1)
        t *= r[p]
        log_a = log_c[p]
        log_a -= t
        log_a += np.float32(256)
        key = log_a.view(np.uint32).astype(U64)
        key <<= U64(32)
        key |= g & U64(0xFFFFFFFF)
        out[row[head], j] = np.minimum.reduceat(key, head)
    return out


def _sign(idf: np.ndarray):
    @worker("near_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, limit=1 << 20):
            row, h, count = shingles(*text_bytes(part.column(2)))
            s = samples(row, h, count * idf[_bucket(h)], part.num_rows, BANDS * ROWS)
            some = np.flatnonzero(s.any(axis=1))
            keys = np.zeros((len(some), BANDS), U64)
            for r in range(ROWS):
                keys = mix(keys + s[some].reshape(len(some), BANDS, ROWS)[:, :, r] + np.arange(BANDS, dtype=U64))
            sketch = s[some].astype("<u2").tobytes()
            width = 2 * BANDS * ROWS
            yield arrow(["uid", "copy", "sketch", "bands"], [part.column(0).take(pa.array(some)), part.column(1).take(pa.array(some)), pa.array([sketch[i * width : (i + 1) * width] for i in range(len(some))], pa.binary()), pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * BANDS, keys.view(np.int64).ravel())])

    return run


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted (hash, weight) sets."""
    h = np.concatenate([a[0], b[0]])
    if not len(h):
        return 0.0
    w = np.concatenate([a[1], b[1]])
    order = np.argsort(h, kind="stable")
    h, w = h[order], w[order]
    same = np.flatnonzero(h[1:] == h[:-1])
    low = float(np.minimum(w[same], w[same + 1]).sum())
    return low / (float(w.sum()) - low)


def _compare(idf: np.ndarray):
    """Rows a, b, text_a, text_b to a, b and the similarity of the two texts."""

    def sets(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        row, h, count = shingles(*text_bytes(col))
        weight = count * idf[_bucket(h)]
        cut = np.searchsorted(row, np.arange(len(col) + 1))
        return [(h[i:j], weight[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]

    @worker("near_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text_a", 1 << 20):
            col_b = part.column(3)
            if isinstance(col_b, pa.ChunkedArray):
                col_b = col_b.combine_chunks()
            coded = col_b.dictionary_encode()  # the same leader in many rows
            leaders = sets(coded.dictionary)
            which = coded.indices.to_numpy(zero_copy_only=False)
            s = [similarity(x, leaders[k]) for x, k in zip(sets(part.column(2)), which, strict=True)]
            yield arrow(["a", "b", "similarity"], [part.column(0), part.column(1), np.array(s, np.float64)])

    return run


def group_pairs(comp: np.ndarray, sketch: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, share of equal sketch entries) of the candidates of one group, from different classes, by i."""
    n = len(comp)
    found, share = [], []
    step = max(1, 4_000_000 // (n * sketch.shape[1]))
    for at in range(0, n, step):
        same = (sketch[at : at + step, None, :] == sketch[None, at + 1 :, :]).mean(axis=2)
        i, j = np.nonzero(same >= least)
        keep = (j + 1 > i) & (comp[i + at] != comp[j + at + 1])
        found.append(np.stack([i[keep] + at, j[keep] + at + 1]))
        share.append(same[i[keep], j[keep]])
    i, j = np.concatenate(found, axis=1)
    return i, j, np.concatenate(share)


def forest(comp: np.ndarray, i: np.ndarray, j: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a spanning forest of the classes that prefers high shares."""
    root = {c: c for c in comp.tolist()}
    taken = []
    for k in np.argsort(-share, kind="stable").tolist():
        x, y = int(comp[i[k]]), int(comp[j[k]])
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[x] = y
            taken.append(k)
    return i[taken], j[taken]


def one_to_many(texts: pa.Array, idf: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the texts at i and j (by i)."""
    row, h, count = shingles(*text_bytes(texts))
    weight = (count * idf[_bucket(h)]).astype(np.float64)
    at = np.searchsorted(row, np.arange(len(texts) + 1))
    _, code = np.unique(h, return_inverse=True)
    total = np.add.reduceat(np.append(weight, 0.0), np.minimum(at[:-1], len(weight))) * (np.diff(at) > 0)
    mine, out = np.zeros(int(code.max()) + 1 if len(code) else 1), np.zeros(len(i))
    for k in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1):
        if not len(k):
            continue
        x = int(i[k[0]])
        mine[code[at[x] : at[x + 1]]] = weight[at[x] : at[x + 1]]
        size = at[j[k] + 1] - at[j[k]]
        head = np.concatenate([[0], np.cumsum(size)])
        place = np.arange(head[-1]) + np.repeat(at[j[k]] - head[:-1], size)
        both = np.concatenate([[0.0], np.cumsum(np.minimum(weight[place], mine[code[place]]))])
        low = both[head[1:]] - both[head[:-1]]
        out[k] = low / np.maximum(total[x] + total[j[k]] - low, 1e-12)
        mine[code[at[x] : at[x + 1]]] = 0
    return out


def _candidates(least: float, threshold: float, idf: np.ndarray | None):
    """Rows group, uid, comp, sketch (and text), sorted by group: without texts to the pairs (a > b) of a forest, with them to links between classes."""

    @worker("near_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:

        def emit(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
            uid, comp = table["uid"].to_numpy(), table["comp"].to_numpy()
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), "<u2").reshape(len(uid), -1)
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for x, y in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
                if y - x > 1:
                    i, j, share = group_pairs(comp[x:y], sketch[x:y], least)
                    if idf is not None and len(i):
                        share = one_to_many(table["text"].slice(x, y - x), idf, i, j)
                        linked = share >= threshold
                        i, j, share = i[linked], j[linked], share[linked]
                    if len(i):
                        i, j = forest(comp[x:y], i, j, share)
                        a.append(uid[x + i])
                        b.append(uid[x + j])
            a, b = np.concatenate(a), np.concatenate(b)
            return arrow(["a", "b"], [np.maximum(a, b), np.minimum(a, b)])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            group = table["group"].to_numpy()
            ends = np.flatnonzero(group[1:] != group[:-1]) + 1
            if len(ends):
                yield emit(table.slice(0, int(ends[-1])), ends)
                table = table.slice(int(ends[-1]))
            rest = table
        if rest is not None and rest.num_rows:
            yield emit(rest, np.array([rest.num_rows]))

    return run


def buckets_of(signed: DataFrame) -> DataFrame:
    """(group, uid, m): the band buckets with two texts at least, and their sizes."""
    return _sized(signed.select("uid", F.explode("bands").alias("group")).distinct())


def _sized(members: DataFrame) -> DataFrame:
    return members.join(members.groupBy("group").agg(F.count("*").alias("m")).where("m > 1"), "group").select("group", "uid", "m")


def blocks_of(buckets: DataFrame) -> DataFrame:
    """(group, uid): the buckets, those of more than MANY dealt to blocks by hash."""
    block = F.pmod(F.xxhash64("uid"), F.ceil(F.col("m") / (MANY // 2)))
    return buckets.select(F.when(F.col("m") > MANY, F.xxhash64("group", block)).otherwise(F.col("group")).alias("group"), "uid")


def leaders_of(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """(group, uid): of each bucket of more than MANY, one text of each class."""
    first = buckets.where(F.col("m") > MANY).join(comp, "uid").groupBy("group", "comp").agg(F.min("uid").alias("uid"))
    return blocks_of(_sized(first.select("group", "uid")))


def tiles_of(buckets: DataFrame, comp: DataFrame) -> DataFrame:
    """(group, uid): of buckets of three or more in which classes meet, groups that hold each pair of different classes together."""
    placed = buckets.where("m > 2").join(comp, "uid")
    sizes = placed.groupBy("group", "comp").agg(F.count("*").alias("n")).groupBy("group").agg(F.max(F.struct("n", "comp")).alias("main"), F.count("*").alias("classes")).where("classes > 1")
    met = placed.join(sizes, "group").withColumn("is_main", F.col("comp") == F.col("main.comp"))
    half = MANY // 2
    others, mains = F.ceil((F.col("m") - F.col("main.n")) / half), F.ceil(F.col("main.n") / half)
    own = F.pmod(F.xxhash64("uid"), F.when(F.col("is_main"), mains).otherwise(others)) + F.when(F.col("is_main"), others).otherwise(0)
    beside = F.sequence(F.lit(0).cast("bigint"), F.when(F.col("is_main"), others).otherwise(others + mains) - 1)
    small = met.where(F.col("m") <= MANY).select("group", "uid")
    large = met.where(F.col("m") > MANY).select("group", "uid", own.alias("own"), F.explode(beside).alias("beside"))
    return small.unionByName(large.select(F.xxhash64("group", F.least("own", "beside"), F.greatest("own", "beside")).alias("group"), "uid"))


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """1 + ln(share) / ln(RARE), with shares from RARE to 1, of each of the 2**IDF_BITS buckets: a table of fixed size (1 MB).

    Between 1 and 2, so that one large group of copies cannot push the texts near to it apart.
    """
    n = texts.count()
    df = np.zeros(1 << IDF_BITS)
    for r in texts.select("text").mapInArrow(_frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():
        df[r.column(0).to_numpy()] = r.column(1).to_numpy()
    share = np.clip((df - df.mean()) / max(n, 1), RARE, 1)
    return (1 + np.log(share) / np.log(RARE)).astype(np.float32)


def components(links: DataFrame, vertices: DataFrame) -> DataFrame:
    """(uid, comp): the least uid that each vertex reaches over links (a, b). Labels spread and are short-cut until none changes."""
    edges = shelve(links.select("a", "b").union(links.select("b", "a")).distinct())
    step = labels = shelve(edges.groupBy(F.col("a").alias("uid")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        offered = edges.join(labels.withColumnRenamed("uid", "b"), "b").groupBy(F.col("a").alias("uid")).agg(F.min("comp").alias("near"))
        near = labels.join(offered, "uid").select("uid", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        hop = labels.select(F.col("uid").alias("comp"), F.col("comp").alias("beyond"))
        before, step = step, shelve(near.join(hop, "comp", "left").select("uid", "was", F.least("comp", F.coalesce("beyond", "comp")).alias("comp")))
        unshelve(before)
        labels = step.select("uid", "comp")
        if step.where("comp < was").isEmpty():
            break
    return vertices.join(labels, "uid", "left").select("uid", F.coalesce("comp", "uid").alias("comp"))


def compare_pairs(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """pairs (a, b) with the similarity of their texts (uid, text). A leader's text meets its pairs last, so it is not copied in a shuffle."""
    with_a = pairs.join(texts.withColumnsRenamed({"uid": "a", "text": "text_a"}), "a")
    both = with_a.join(texts.withColumnsRenamed({"uid": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_compare(idf), "a bigint, b bigint, similarity double").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def spread_join(rows: DataFrame, of_key: DataFrame, on: str) -> DataFrame:
    """rows with what of_key says of their key, n being its number of rows. Keys of more than 1 / HOT of all rows, fewer than HOT, are broadcast, so that no task gets all rows of one."""
    hot = F.col("n") > rows.count() / HOT
    often = of_key.where(hot).drop("n")
    rest = rows.join(F.broadcast(often.select(on)), on, "left_anti").join(of_key.where(~hot).drop("n"), on)
    return rows.join(F.broadcast(often), on).unionByName(rest)


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and class_id of every row."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("copy", F.md5("text")).withColumn("uid", identity(rows, ["key"])[0])
    member = shelve(rows.select("key", "copy", "uid", (F.col("text") == "").alias("blank")))
    # one row a text: uid and copy find it among the rows, number stands for it from here on
    first = shelve(member.groupBy("copy").agg(F.min("uid").alias("uid"), F.first("blank").alias("blank"), F.min("key").alias("least"), F.count("*").alias("n")).withColumn("number", F.monotonically_increasing_id()))
    of_text = first.where("not blank").select("uid", "copy", "number")
    texts = rows.select("uid", "copy", "text").join(of_text, ["uid", "copy"]).select(F.col("number").alias("uid"), "text")
    idf = inverse_frequencies(rows.select("text"))
    signed = rows.select("uid", "copy", "text").mapInArrow(_sign(idf), "uid bigint, copy string, sketch binary, bands array<bigint>")
    signed = shelve(signed.join(of_text, ["uid", "copy"]).select(F.col("number").alias("uid"), "sketch", "bands").groupBy("uid").agg(F.first("sketch").alias("sketch"), F.first("bands").alias("bands"), F.count("*").alias("rows")))
    if not signed.where("rows > 1").isEmpty():  # rows with equal keys and texts, of which each pair would meet
        texts = texts.dropDuplicates(["uid"])
    buckets = shelve(buckets_of(signed))
    every = first.select(F.col("number").alias("uid"))
    least = threshold - DEVIATIONS * (threshold * (1 - threshold) / (BANDS * ROWS)) ** 0.5

    def of_groups(groups: DataFrame, comp: DataFrame, texts: DataFrame | None) -> DataFrame:
        seen = groups.distinct().join(comp, "uid").join(signed.select("uid", "sketch"), "uid")
        seen = seen if texts is None else seen.join(texts, "uid")
        seen = seen.select("group", "uid", "comp", "sketch", *([] if texts is None else ["text"])).repartition("group").sortWithinPartitions("group")
        return seen.mapInArrow(_candidates(least, threshold, None if texts is None else idf), "a bigint, b bigint").distinct()

    def linked(groups: DataFrame, comp: DataFrame) -> DataFrame:
        return compare_pairs(of_groups(groups, comp, None), texts, idf).where(F.col("similarity") >= threshold).select("a", "b")

    links = shelve(linked(blocks_of(buckets), every.select("uid", F.col("uid").alias("comp"))))
    comp = shelve(components(links, every))
    if not buckets.where(F.col("m") > MANY).isEmpty():
        links = shelve(links.unionByName(linked(leaders_of(buckets, comp), comp)).distinct())
        comp = shelve(components(links, every))
    more = shelve(of_groups(tiles_of(buckets, comp), comp, texts))
    if not more.isEmpty():
        comp = shelve(components(links.unionByName(more).distinct(), every))
    unshelve(signed, buckets, links, more)
    of_copy = shelve(first.select("copy", F.col("number").alias("uid"), "least", "n").join(comp, "uid").select("copy", "comp", "least", "n"))
    unshelve(first, comp)
    name = shelve(of_copy.groupBy("comp").agg(F.min("least").alias("class_id"), F.count("*").alias("n")))
    named = shelve(spread_join(of_copy.select("comp", "copy", F.col("n").alias("n_rows")), name, "comp").select("copy", "class_id", F.col("n_rows").alias("n")))
    unshelve(of_copy, name)
    return spread_join(member.select("key", "copy"), named, "copy").select(F.col("key").alias(key), "class_id")
