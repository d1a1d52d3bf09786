"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups its links make.

Documents with equal shingle sets form a class, of which one row is joined.  All tasks order
shingles alike: by how often a count sketch of the whole corpus saw them, then by hash.  With an
overlap of at least o, two linked sets of n shingles share at least l of their first n - o + l
shingles, for every l.  Each document picks the l at which the estimated cost of its postings
and of its candidates is least; a pair becomes a candidate once it shares the smaller l of its
two documents at places that the overlap needed for their two sizes allows.  Candidates are
verified on whole sets.

Only groups are wanted, so first each document is verified against one leader: of the
documents that come first at one of its shingles, the one that does so most often.  That
merges groups of near copies along a linear number of pairs.  Then all candidates between
different groups are verified.  Whole sets are made and moved only for pairs that bitmaps of their
sets, a bit and a half to three for a shingle, leave possible.  Shingles that many documents list are aggregated before they move,
what comes of them is broadcast, and candidates meet there by band of sizes, too.  No pair within a group is needed, and no link between groups is
lost.

Defined results: null texts and texts without words have an empty set and link with nothing;
texts with fewer words than a shingle have one shingle; repeated rows are one class, each row
keeping its own result; an empty table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lectern.llm.common import ASCII_LOWER, WordHashes, bloom_filter, bloom_keys, components, cut, drop_table, hot_lookup, in_bloom, mix64, slices, texts_of, tidy

#: Counters of the sketch, and the blocks in which tasks hand them on.
SKETCH, SKETCH_BLOCKS = 1 << 21, 64
#: Longest multiple match that a document may ask for.
MOST_MATCHES = 8
#: The most tokens that are treated as hot, and the fewest documents of one.
MOST_HOT, LEAST_HOT = 100_000, 1_000
#: Cost of verifying a candidate, in postings.
VERIFY_COST = 8.0

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
_BLOCK = SKETCH // SKETCH_BLOCKS


def shingle_hashes(words: list[bytes], size: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a word sequence."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    h = memo.of(words)
    if n < size:
        out = np.array([n], np.uint64)
        for i in range(n):
            out = mix64(out * _FACTORS[-1] + h[i : i + 1])
        return out
    total = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        total += mix64(h[i : n - size + 1 + i] * _FACTORS[i % len(_FACTORS)] + np.uint64(i + 1))
    return np.unique(mix64(total))


def word_list(text: bytes) -> list[bytes]:
    return text.translate(ASCII_LOWER).split()


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 21)).astype(np.int64)


def _scan(size):
    """Rows of documents (kind 0: id, set size, set signature) and of sketch blocks (kind 1)."""

    def rows(batches):
        memo, counts = WordHashes(), np.zeros(SKETCH, np.uint32)
        held, waiting = [], 0
        names = ["kind", "id", "n", "sig", "counts"]
        for batch in slices(batches, 1):
            sizes, sigs = [], []
            for text in texts_of(batch.column(1)):
                h = shingle_hashes(word_list(text), size, memo)
                held.append(h)
                waiting += len(h)
                if waiting > SKETCH // 4:
                    counts += np.bincount(_bucket(np.concatenate(held)), minlength=SKETCH).astype(np.uint32)
                    held, waiting = [], 0
                sizes.append(len(h))
                x = np.arange(1, len(h) + 1, dtype=np.uint64) * _FACTORS[0]
                sigs.append(None if not len(h) else int(np.bitwise_xor.reduce(mix64(h + x))).to_bytes(8, "little") + int(mix64(h ^ x).sum(dtype=np.uint64)).to_bytes(8, "little"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.nulls(n, pa.binary())], names)
        if held:
            counts += np.bincount(_bucket(np.concatenate(held)), minlength=SKETCH).astype(np.uint32)
        blocks = [k for k in range(SKETCH_BLOCKS) if counts[k * _BLOCK : (k + 1) * _BLOCK].any()]
        data = [zlib.compress(counts[k * _BLOCK : (k + 1) * _BLOCK].tobytes(), 1) for k in blocks]
        m = len(blocks)
        yield pa.RecordBatch.from_arrays([pa.array([1] * m, pa.int32()), pa.array(blocks, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(data, pa.binary())], names)

    return tidy(rows)


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.ceil(4 * np.log2(1.0 + counts))).astype(np.uint8)


def _add_blocks(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(data), np.uint32)
            total[k] = total.get(k, 0) + part.astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([_levels(x.astype(float)).tobytes() for x in total.values()], pa.binary())], ["id", "levels"])


def _sketch(scanned: DataFrame) -> np.ndarray:
    """Level of each counter, log-scaled to a byte: SKETCH bytes at every corpus size."""
    out = np.zeros(SKETCH, np.uint8)
    for r in scanned.where("kind = 1").select("id", "counts").repartition("id").mapInArrow(_add_blocks, "id long, levels binary").toLocalIterator():
        out[r["id"] * _BLOCK : (r["id"] + 1) * _BLOCK] = np.frombuffer(r["levels"], np.uint8)
    return out


def prefix(h: np.ndarray, levels: np.ndarray, noise: float, per: int, of: int) -> tuple[np.ndarray, int]:
    """The document's prefix shingles and the matches l that it asks for.

    The cost of an l is what other documents list at the places open to a partner of equal
    size, and the share of them that l matches are expected to leave for verification.
    """
    n = len(h)
    level = levels[_bucket(h)]
    order = np.lexsort((h, level))
    overlap = -(-per * n // of)
    most = min(MOST_MATCHES, overlap)
    first = order[: n - overlap + most]
    others = np.cumsum(np.maximum(0.0, 2.0 ** (level[first] / 4.0) - 1.0 - noise))
    steps = np.arange(1, most + 1)
    like = n - -(-2 * per * n // (per + of)) + steps - 1  # last place that a partner of equal size could share
    matches = int(np.argmin(others[like] + VERIFY_COST * others[like] / steps + steps)) + 1
    return h[first[: n - overlap + matches]], matches


def bitmap(h: np.ndarray) -> bytes:
    """A bit for each value that the low bits of a hash take; over 1.5 bits a hash, 64 at least."""
    size = 1 << max(6, (3 * len(h) // 2).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(h & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_common(n: int, a: bytes, m: int, b: bytes) -> int:
    """At least as many hashes as sets of n and m with these bitmaps can share.

    A bit that only one bitmap has stands for a hash that only its set has; the longer bitmap is
    folded to the length of the shorter.
    """
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    i, j = len(a) * 8, len(b) * 8
    while i > j:
        i //= 2
        x = x >> i | x & (1 << i) - 1
    while j > i:
        j //= 2
        y = y >> j | y & (1 << j) - 1
    return min(n - (x & ~y).bit_count(), m - (y & ~x).bit_count())


def _possible(per, of):
    """Of rows (u, v, n, a, m, b) the pairs (u, v) whose bitmaps allow a link."""

    def rows(batches):
        for batch in batches:
            keep = [of * (c := most_common(n, a, m, b)) >= per * (n + m - c) for n, a, m, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return tidy(rows)


def _maybe(batches, some):
    """The rows whose id may be wanted."""
    for batch in batches:
        if batch.column(0).null_count:
            batch = batch.filter(pc.is_valid(batch.column(0)))
        yield from slices([batch.filter(pa.array(in_bloom(some.value, bloom_keys(batch.column(0)))))], 1)


def _postings(size, levels, some, noise, per, of, limit):
    """Rows of the prefixes (kind 0), tokens that may be listed limit times in all (kind 1, n is how often here), and bitmaps of sets (kind 2).

    The sketch never counts a token too seldom, so those that it saw fewer times need no count.
    """
    least = np.floor(4 * np.log2(1.0 + limit))
    names = ["kind", "token", "id", "n", "want", "at", "bits"]

    def often(tokens: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(tokens) if tokens else np.zeros(0, np.int64), return_counts=True)
        many = levels.value[_bucket(token.view(np.uint64))] >= least
        token, n = token[many], n[many]
        none = [pa.nulls(len(token), t) for t in (pa.int64(), pa.int8(), pa.int32(), pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(token), np.int8)), pa.array(token), none[0], pa.array(n.astype(np.int32)), *none[1:]], names)

    def rows(batches):
        memo, seen, waiting = WordHashes(), [], 0
        for batch in _maybe(batches, some):
            ids, tokens, sizes, wants, places, maps = [], [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                h = shingle_hashes(word_list(text), size, memo)
                if not len(h):
                    continue
                maps.append((key, len(h), bitmap(h)))
                first, want = prefix(h, levels.value, noise, per, of)
                tokens.append(first.view(np.int64))
                ids.append(np.full(len(first), key, np.int64))
                sizes.append(np.full(len(first), len(h), np.int32))
                wants.append(np.full(len(first), want, np.int8))
                places.append(np.arange(len(first), dtype=np.int32))
            cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
            token = cat(tokens, np.int64)
            seen.append(token)
            waiting += len(token)
            if waiting > 2_000_000:
                yield often(seen)
                seen, waiting = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(token), np.int8)), pa.array(token), pa.array(cat(ids, np.int64)), pa.array(cat(sizes, np.int32)), pa.array(cat(wants, np.int8)), pa.array(cat(places, np.int32)), pa.nulls(len(token), pa.binary())], names)
            m = len(maps)
            of_maps = [pa.array([x[i] for x in maps], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, 2, np.int8)), pa.nulls(m, pa.int64()), of_maps[0], of_maps[1], pa.nulls(m, pa.int8()), pa.nulls(m, pa.int32()), of_maps[2]], names)
        yield often(seen)

    return tidy(rows)


def _over_token(rows: DataFrame, hot: DataFrame, columns: dict) -> DataFrame:
    """rows with aggregates over each token: one task for each token, but hot ones are aggregated before they move."""
    first = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), "token", "left")
    cold = first.where("__hot is null").drop("__hot")
    for name, value in columns.items():
        cold = cold.withColumn(name, value.over(W.partitionBy("token")))
    some = first.where("__hot").drop("__hot")
    sums = some.groupBy("token").agg(*(value.alias(name) for name, value in columns.items()))
    return cold.unionByName(some.join(F.broadcast(sums), "token"))  # at most MOST_HOT rows


def _sets(size, some):
    def rows(batches):
        memo = WordHashes()
        for batch in _maybe(batches, some):
            sets = [shingle_hashes(word_list(t), size, memo).view(np.int64) for t in texts_of(batch.column(1))]
            offsets = np.cumsum([0, *map(len, sets)])
            flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), flat).cast(pa.list_(pa.int64()))], ["id", "set"])

    return tidy(rows)


def _linked(pairs: DataFrame, maps: DataFrame, texts: DataFrame, size: int, per: int, of: int) -> DataFrame:
    """The pairs (u, v) whose whole sets link, as a table.  Sets are made for pairs that the bitmaps (id, n, bits) leave."""
    sides = pairs.join(maps.select(F.col("id").alias("v"), F.col("n").alias("m"), F.col("bits").alias("b")), "v").join(maps.select(F.col("id").alias("u"), "n", F.col("bits").alias("a")), "u")
    left = cut(sides.select("u", "v", "n", "a", "m", "b").mapInArrow(_possible(per, of), "u long, v long").distinct(), "jaccard-possible")
    wanted = texts.sparkSession.sparkContext.broadcast(bloom_filter(left.select("u").union(left.select("v")).distinct()))
    sets = cut(texts.mapInArrow(_sets(size, wanted), "id long, set array<long>"), "jaccard-sets")
    wanted.destroy()
    both = left.join(sets.select(F.col("id").alias("v"), F.col("set").alias("b")), "v").join(sets.select(F.col("id").alias("u"), F.col("set").alias("a")), "u")
    common = F.size(F.array_intersect("a", "b"))
    links = both.select("u", "v", common.alias("c"), (F.size("a") + F.size("b") - common).alias("d")).where(F.col("c") * of >= F.col("d") * per).select("u", "v")
    links = cut(links, "jaccard-links")
    drop_table(sets)
    drop_table(left)
    return links


def group(docs: DataFrame, size: int = 4, per: int = 85, of: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, class_id (smallest id with an equal set).

    Sets link where of * intersection >= per * union.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scanned = cut(texts.mapInArrow(_scan(size), "kind int, id long, n long, sig binary, counts binary"), "jaccard-scan")
    rows = scanned.where("kind = 0").select("id", "n", "sig")
    classes = cut(rows.where("n > 0 and id is not null").groupBy("sig").agg(F.min("id").alias("class_id"), F.count("*").alias("copies")), "jaccard-classes")
    levels = _sketch(scanned)
    noise = float(2.0 ** (np.median(levels) / 4.0) - 1.0) * 1.5
    sc = docs.sparkSession.sparkContext
    told, some = sc.broadcast(levels), sc.broadcast(bloom_filter(classes.select("class_id")))
    limit = max(LEAST_HOT, (rows.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)  # so there are at most MOST_HOT hot tokens
    postings = cut(texts.mapInArrow(_postings(size, told, some, noise, per, of, limit), "kind byte, token long, id long, n int, want byte, at int, bits binary"), "jaccard-postings")
    told.destroy()
    some.destroy()
    often = postings.where("kind = 1").groupBy("token").agg(F.sum("n").alias("n"))
    hot = cut(often.where(F.col("n") >= limit).select("token"), "jaccard-hot")
    listed, maps = postings.where("kind = 0").drop("kind", "bits"), postings.where("kind = 2").select("id", "n", "bits")
    shared = _over_token(listed, hot, {"low": F.min("id"), "high": F.max("id"), "head": F.min(F.struct("at", "id", "n", "want"))}).where("low < high")
    shared = cut(shared.drop("low", "high"), "jaccard-shared")

    def may_link(n1, at1, n2, at2, want):
        """Whether a common shingle at these places can be among the first `want` of a linked pair."""
        need = F.ceil((F.col(n1) + F.col(n2)) * per / (per + of))
        return (F.col(at1) - F.col(want) < F.col(n1) - need) & (F.col(at2) - F.col(want) < F.col(n2) - need) & (F.col(n1) * of >= F.col(n2) * per) & (F.col(n2) * of >= F.col(n1) * per)

    told_of = shared.where(F.col("id") != F.col("head.id")).select("id", "n", "at", F.col("head.id").alias("u"), F.col("head.n").alias("n1"), F.col("head.at").alias("at1"), F.least("want", F.col("head.want")).alias("w"))
    votes = told_of.where(may_link("n1", "at1", "n", "at", "w")).groupBy("id", "u").count()
    star = votes.groupBy("id").agg(F.max(F.struct("count", "u")).alias("best")).select(F.col("best.u").alias("u"), F.col("id").alias("v"))
    links = _linked(cut(star, "jaccard-star"), maps, texts, size, per, of)
    groups = cut(components(links).toDF("id", "g"), "jaccard-groups")
    left = shared.join(groups, "id", "left").select("token", "id", "n", "want", "at", F.coalesce("g", "id").alias("g"))
    left = _over_token(left, hot, {"least": F.min("g"), "most": F.max("g")}).where("least < most").drop("least", "most")
    band = F.floor(F.log(F.col("n").cast("double")) / (1.000001 * math.log(of / per))).cast("int")  # sizes of linked sets lie in one band or the next
    left = left.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "token", "left")  # only hot shingles need bands
    left = cut(left.withColumn("band", F.when(F.col("hot"), band).otherwise(0)), "jaccard-open")
    other = left.select("token", "band", *(F.col(c).alias(f"{c}2") for c in ("id", "n", "want", "at", "g")))
    near = left.withColumn("band", F.explode(F.when(F.col("hot"), F.array("band", F.col("band") + 1)).otherwise(F.array("band")))).drop("hot")
    pairs = near.join(other, ["token", "band"]).where("g <> g2 and (n < n2 or n = n2 and id < id2)").withColumn("w", F.least("want", "want2")).where(may_link("n", "at", "n2", "at2", "w"))
    ready = pairs.groupBy(F.col("id").alias("u"), F.col("id2").alias("v")).agg(F.count("*").alias("c"), F.first("w").alias("w")).where("c >= w")
    ready = cut(ready.select("u", "v"), "jaccard-pairs")
    if not ready.isEmpty():
        more = _linked(ready, maps, texts, size, per, of)
        groups = cut(components(links.union(more)).toDF("id", "g"), "jaccard-groups")
    groups = groups.toDF("node", "component")
    for table in (postings, hot, shared, left):
        drop_table(table)
    named = classes.join(groups.withColumnRenamed("node", "class_id"), "class_id", "left").select("sig", "class_id", F.coalesce("component", "class_id").alias("component_id"), "copies")
    named = cut(named.where("copies > 1 or component_id <> class_id"), "jaccard-named")  # all others are named by themselves
    out = hot_lookup(rows, named, ["sig"], "copies")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"), F.coalesce("class_id", "id").alias("class_id"))
