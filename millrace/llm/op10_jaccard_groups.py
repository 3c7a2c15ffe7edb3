"""Exact Jaccard join of word shingle sets with grouped prefixes, down to connected classes.

A set is ordered by (frequency, hash), rare shingles first; two sets that are similar enough share a
shingle among their first ones (their prefixes). Steps:

1. Profile: every document's set is reduced to a signature, and frequencies are counted in a table of
   fixed size. Documents with equal sets are one *set* from here on.
2. Sets with one prefix and size form a group. Prefix shingles go to buckets with their group; a bucket
   keeps the lists of shingles that several groups hold, and in a list the groups for which the shingle can be the
   first that they share with another one of it.
   Shingles with one and the same list count as one list.
3. Group pairs that pass the size and place filters are expanded to sets and verified exactly. First
   each group only with the neighbour in its lists that it shares most shingles with, and the sets of a
   group with one of them; then, in lists that still hold several components, each set with its
   neighbour in an order by least hash, in which similar sets mostly stand side by side. A turn is linear;
   turns go on, each by another hash, until one finds no link. Before any set is fetched, parity
   sketches exclude pairs that surely differ too much.
4. Components so far are contracted. All other candidate pairs whose sets are in different components
   are verified, in lists of a shingle that can be the first they share; pairs inside one could not change
   the result. A cluster of any number of near copies so needs no quadratic number of pairs, and no
   link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from millrace.llm.blocks import read_block, read_extra, store_blocks, with_replies
from millrace.llm.columns import bound_batches, col, id_and_text, ids_to_arrow, let_go, mix, pack, partitions, table, unpack
from millrace.llm.components import rooted, stars
from millrace.llm.repeats import slices
from millrace.llm.words import ngram_hashes, words_of
from millrace.plans.scratch import freed, stored

WORDS = 4
PERCENT = 85
# Counters of the frequency table. Its size is fixed; counts only order shingles, so
# counters shared by several shingles cost speed and never a result.
COUNTERS = 1 << 20
# Least hashes kept for each set; the turns in which sets try one neighbour per list order by them in rotation.
_ORDERS = 4
# Neighbours that a set tries in each list and turn, and the entries a link may cost for the next turn to be worthwhile.
_NEIGHBOURS = 4
_WORTHWHILE = 50
_PARTS = 16
# 64-bit words of the parity sketch that is carried with every list entry, however long its document: at most
# these, and at most a cell per item. What passes it meets the whole sketch next.
_CARRIED = 64


def shingle_sets(data: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(document, ascending distinct shingle hashes) for every document of a block with at least one word."""
    for begin, end in slices(bounds):
        own = data[bounds[begin] : bounds[end]].tobytes()
        cuts = bounds[begin : end + 1] - bounds[begin]
        *_, hashes, words = words_of([own[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], lower=True)
        grams = ngram_hashes(hashes, n)
        for i, (a, b) in enumerate(zip(words[:-1].tolist(), words[1:].tolist())):
            if b - a >= n:
                yield begin + i, np.unique(grams[a : b - n + 1])
            elif b > a:
                yield begin + i, mix(ngram_hashes(hashes[a:b], b - a) + np.uint64(b - a))


def signature(items: np.ndarray) -> int:
    """A signed 64-bit hash of a set (ascending), also of a sequence."""
    place = mix(np.arange(1, items.size + 1, dtype=np.uint64))
    return int(mix(np.array([np.bitwise_xor.reduce(mix(items ^ place))]) + np.uint64(items.size))[0].view(np.int64))


def parity_sketch(items: np.ndarray, most: int | None = None) -> np.ndarray:
    """A bit per cell: whether an odd number of the set's hashes falls there; 2 to 4 cells per item, 64 or more.

    Two sets differ in at least as many items as their sketches differ in bits. A sketch of half the
    length is the exclusive or of both halves, down to ``most`` words if given.
    """
    cells = 64 << max(0, (2 * items.size - 1) // 64).bit_length()
    odd = (np.bincount((items & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view("<i8")
    while most and words.size > most:
        words = words[: words.size // 2] ^ words[words.size // 2 :]
    return words


def carried_sketch(items: np.ndarray) -> np.ndarray:
    """The sketch that goes with every list entry: at most a cell per item, and at most _CARRIED words."""
    return parity_sketch(items, min(_CARRIED, max(1, items.size // 64)))


def least_hashes(items: np.ndarray) -> list[int]:
    """Under each of several hashes the least of the set's; two sets agree in one as often as they are similar."""
    return [int(mix(items ^ np.uint64(seed)).min().view(np.int64)) for seed in range(1, _ORDERS + 1)]


def _profiles(blocks: DataFrame, n: int) -> DataFrame:
    """(block, doc_id, doc, sig, n) rows for documents and (part, counts) rows for the frequency table."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        names = ["block", "doc_id", "doc", "sig", "n", "part", "counts"]
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("texts").to_pylist()):
                ids, bounds, data = read_block(blob)
                sig, size = np.zeros(ids.size, np.int64), np.zeros(ids.size, np.int64)
                held: list[np.ndarray] = []
                waiting = 0
                for i, items in shingle_sets(data, bounds, n):
                    sig[i], size[i] = signature(items), items.size
                    held.append(items)
                    waiting += items.size
                    if waiting > 1 << 20:
                        counts += np.bincount(np.concatenate(held).astype(np.int64) & (COUNTERS - 1), minlength=COUNTERS).astype(np.uint32)
                        held, waiting = [], 0
                if held:
                    counts += np.bincount(np.concatenate(held).astype(np.int64) & (COUNTERS - 1), minlength=COUNTERS).astype(np.uint32)
                empty = pa.nulls(ids.size, pa.int32()), pa.nulls(ids.size, pa.binary())
                yield pa.record_batch([pa.array(np.full(ids.size, block)), ids_to_arrow(ids), pa.array(np.arange(ids.size), pa.int32()), pa.array(sig, mask=size == 0), pa.array(size), *empty], names)
        parts = [pack(x) for x in np.split(counts, _PARTS)] if counts.any() else []
        none = pa.nulls(len(parts), pa.int64())
        yield pa.record_batch([none, none, pa.nulls(len(parts), pa.int32()), none, none, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], names)

    return blocks.select("block", "texts").mapInArrow(profile, "block bigint, doc_id bigint, doc int, sig bigint, n bigint, part int, counts binary")


def _frequencies(profiles: DataFrame) -> np.ndarray:
    """The frequency table, one 16-bit class per counter: of fixed size, however large the corpus.

    Tasks' tables are added in two levels, so that no group holds a part from every task.
    """
    spark = profiles.sparkSession

    def total(group: pa.Table) -> np.ndarray:
        out = np.zeros(COUNTERS // _PARTS, np.uint64)
        for chunk in group.column("counts").chunks:
            for blob in chunk:
                out += unpack(blob.as_py())[0]
        return out

    def add(group: pa.Table) -> pa.Table:
        return pa.table({"part": group.column("part")[:1].cast(pa.int32()), "counts": pa.array([pack(total(group))], pa.binary())})

    def rank(group: pa.Table) -> pa.Table:
        # Scaled, not clipped: eighth-of-an-octave classes keep the order of any counts.
        ranks = np.round(np.log2(total(group).astype(np.float64) + 1) * 1000).astype(np.uint16)
        return pa.table({"part": group.column("part")[:1].cast(pa.int32()), "ranks": pa.array([ranks.tobytes()], pa.binary())})

    share = F.pmod(F.xxhash64("counts"), F.lit(partitions(spark))).alias("share")
    tables = profiles.where("part IS NOT NULL").select("part", share, "counts")
    sums = tables.groupBy("part", "share").applyInArrow(add, "part int, counts binary")
    rows = sums.groupBy("part").applyInArrow(rank, "part int, ranks binary").collect()
    out = np.zeros(COUNTERS, np.uint16)
    for row in rows:
        size = COUNTERS // _PARTS
        out[row.part * size : (row.part + 1) * size] = np.frombuffer(row.ranks, np.uint16)
    return out


def _may_lead(token: np.ndarray, sizes: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Entries whose shingle can be the first that they share with another entry of its list (see ``_first_shared``).

    Entries ascend by shingle and size. An entry at (n, place) needs another one in its list of a size from
    percent * n / 100 to what the items behind its place leave room for. An entry of a pair that is similar
    enough stays in the list of the first shingle the pair shares, as each of the two is what the other needs.
    If it stays in a list it does so in that of every earlier shingle with the same list.
    """
    lists = np.cumsum(np.concatenate([[False], token[1:] != token[:-1]]))
    span = int(sizes.max(initial=0)) + 2
    low = -(-percent * sizes // 100)
    high = np.clip(np.minimum(100 * sizes // percent, (100 + percent) * (sizes - place) // percent - sizes), 0, span - 1)
    stay = np.arange(token.size)
    for _ in range(2):  # again without those that went
        held = lists[stay] * span + sizes[stay]
        found = np.searchsorted(held, lists[stay] * span + high[stay], "right") - np.searchsorted(held, lists[stay] * span + low[stay], "left")
        stay = stay[found > (sizes[stay] <= high[stay])]
    out = np.zeros(token.size, bool)
    out[stay] = True
    return out


def _prefix_lists(blocks: DataFrame, ranks: np.ndarray, n: int, percent: int) -> DataFrame:
    """Shared prefix shingles: (token, grp, n, place, before, before_n, before_place, whole) and (grp, sig) rows.

    ``before`` is the neighbour in the shingle's list, by size and group; ``whole`` is a hash of the list.
    Rows with a sig list a group's sets.
    """
    spark = blocks.sparkSession
    buckets = partitions(spark)
    shared = spark.sparkContext.broadcast(ranks)
    sent = "bucket int, blob binary"

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            for blob in batch.column("texts").to_pylist():
                _, bounds, data = read_block(blob)
                tokens, owners, places, seen, groups = [], [], [], set(), {}
                for _, items in shingle_sets(data, bounds, n):
                    sig, size = signature(items), items.size
                    if (sig, size) in seen:
                        continue
                    seen.add((sig, size))
                    length = size - -(-percent * size // 100) + 1
                    order = np.argsort(rank[items.astype(np.int64) & (COUNTERS - 1)], kind="stable")[:length]
                    group = signature(np.concatenate([items[order], np.array([size], np.uint64)]))
                    if group in groups:
                        groups[group][1].append(sig)
                        continue
                    groups[group] = (size, [sig])
                    tokens.append(items[order])
                    owners.append(np.full(length, len(groups) - 1))
                    places.append(np.arange(length, dtype=np.int32))
                if not groups:
                    continue
                token, owner, place = (np.concatenate(x) for x in (tokens, owners, places))
                ids = np.array(list(groups), np.int64)
                sizes = np.array([g[0] for g in groups.values()], np.int32)
                bucket = (token % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                out = []
                for b in np.flatnonzero(np.diff(cuts)):
                    at = order[cuts[b] : cuts[b + 1]]
                    who, back = np.unique(owner[at], return_inverse=True)
                    out.append((int(b), pack(token[at], back.astype(np.int32), place[at], ids[who], sizes[who])))
                member = np.array([(g, s) for g, (_, sigs) in groups.items() for s in sigs], np.int64)
                where = (member[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
                for b in np.unique(where):
                    out.append((int(b), pack(member[where == b, 0], member[where == b, 1])))
                yield pa.record_batch([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "blob"])

    names = ["token", "grp", "n", "place", "before", "before_n", "before_place", "whole", "sig"]

    def lists(group: pa.Table) -> pa.Table:
        entries, members = [], []
        for blob in group.column("blob").to_pylist():
            arrays = unpack(blob)
            if len(arrays) == 2:
                members.append(arrays)
                continue
            token, owner, place, ids, sizes = arrays
            entries.append((token, ids[owner], sizes[owner].astype(np.int64), place.astype(np.int64)))
        columns: list[list[pa.Array]] = []
        if entries:
            token, ids, sizes, place = (np.concatenate(x) for x in zip(*entries))
            order = np.lexsort((ids, sizes, token))
            token, ids, sizes, place = token[order], ids[order], sizes[order], place[order]
            copy = np.zeros(token.size, bool)
            copy[1:] = (token[1:] == token[:-1]) & (ids[1:] == ids[:-1])
            token, ids, sizes, place = token[~copy], ids[~copy], sizes[~copy], place[~copy]
            same = token[1:] == token[:-1]
            many = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            first = ~np.concatenate([[False], same])[many]
            token, ids, sizes, place = token[many], ids[many], sizes[many], place[many]
            if not token.size:
                first = np.zeros(0, bool)
            starts = np.flatnonzero(first)
            whole = np.add.reduceat(mix(ids.view(np.uint64)), starts) if token.size else token
            whole = np.repeat(mix(whole), np.diff(np.concatenate([starts, [token.size]]))).view(np.int64) if token.size else token.view(np.int64)
            stay = _may_lead(token, sizes, place, percent)
            token, ids, sizes, place, whole = token[stay], ids[stay], sizes[stay], place[stay], whole[stay]
            first = np.concatenate([[True], token[1:] != token[:-1]])[: token.size]
            before = [pa.array(np.roll(x, 1), pa.int64(), mask=first) for x in (ids, sizes, place)]
            columns.append([pa.array(token.view(np.int64)), pa.array(ids), pa.array(sizes), pa.array(place), *before, pa.array(whole), pa.nulls(token.size, pa.int64())])
        if members:
            pairs = np.unique(np.stack([np.concatenate(x) for x in zip(*members)]), axis=1)
            none = pa.nulls(pairs.shape[1], pa.int64())
            columns.append([none, pa.array(pairs[0]), none, none, none, none, none, none, pa.array(pairs[1])])
        return pa.concat_tables([pa.table(c, names) for c in columns])

    packed = blocks.select("texts").mapInArrow(prefixes, sent)
    return packed.groupBy("bucket").applyInArrow(lists, ", ".join(f"{name} bigint" for name in names))


def _sets(blocks: DataFrame, wanted: DataFrame, n: int, sketched: bool) -> DataFrame:
    """(sig, items) of the sets in ``wanted`` (sig, block, doc), or their sketches (sig, size, near, carried, items) if ``sketched``."""
    names = ["sig", "size", "near", "carried", "items"] if sketched else ["sig", "items"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(sets: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
            columns = [pa.array([sig for sig, _ in sets], pa.int64())]
            kind = pa.list_(pa.int64())
            if sketched:
                columns.append(pa.array([items.size for _, items in sets], pa.int64()))
                columns.append(pa.array([least_hashes(items) for _, items in sets], kind))
                columns.append(pa.array([carried_sketch(items) for _, items in sets], kind))
            columns.append(pa.array([parity_sketch(items) if sketched else items.view(np.int64) for _, items in sets], kind))
            return pa.record_batch(columns, names)

        let_go()
        for batch in batches:
            for blob, replies in zip(batch.column("texts").to_pylist(), batch.column("replies").to_pylist()):
                ids, bounds, data = read_block(blob)
                texts = [data[bounds[i] : bounds[i + 1]] for i in sorted({r["bucket"] for r in replies})]
                cuts = np.concatenate([[0], np.cumsum([t.size for t in texts])]).astype(np.int64)
                sets, held = [], 0
                for _, items in shingle_sets(np.concatenate(texts), cuts, n):
                    sets.append((signature(items), items))
                    held += items.size
                    if held > 1 << 19:
                        yield made(sets)
                        sets, held = [], 0
                yield made(sets)

    asked = wanted.select("block", F.col("doc").alias("bucket"), F.lit(None).cast("binary").alias("blob"))
    found = with_replies(blocks.select("block", "texts"), asked).where("replies IS NOT NULL")
    kinds = {"sig": "bigint", "size": "bigint", "near": "array<bigint>", "carried": "array<bigint>", "items": "array<bigint>"}
    return found.mapInArrow(pick, ", ".join(f"{name} {kinds[name]}" for name in names))


def _placed(sigs: DataFrame, where: DataFrame) -> DataFrame:
    return sigs.distinct().join(where, "sig").select("sig", "at.block", "at.doc")


def _verified(pairs: DataFrame, blocks: DataFrame, where: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough, by exact intersection; only their sets are fetched."""
    pairs = stored(pairs, "pairs")
    asked = _placed(pairs.select(F.explode(F.array("u", "v")).alias("sig")), where)
    sets = stored(_sets(blocks, asked, n, False), "sets")
    left = sets.select(F.col("sig").alias("u"), F.col("items").alias("a"))
    right = sets.select(F.col("sig").alias("v"), F.col("items").alias("b"))
    both = F.size(F.array_intersect("a", "b")).cast("bigint")
    alike = both * (100 + percent) >= (F.size("a") + F.size("b")) * percent
    found = stored(pairs.join(left, "u").join(right, "v").where(alike).select("u", "v"), "links")
    freed(pairs, sets)
    return found


def _alike(a: str, b: str, n: str, other_n: str, percent: int) -> str:
    """SQL condition: the sets of two sketches may differ in few enough items for the threshold.

    Sizes within the threshold differ by less than half, so one sketch is at most twice the other.
    """

    def halved(x: str) -> str:
        half = f"CAST(size({x}) / 2 AS INT)"
        return f"zip_with(slice({x}, 1, {half}), slice({x}, {half} + 1, {half}), (p, q) -> p ^ q)"

    def bits(x: str, y: str) -> str:
        return f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0L, (t, c) -> t + c)"

    least = (
        f"CASE WHEN size({a}) = size({b}) THEN {bits(a, b)} WHEN size({a}) > size({b}) THEN {bits(halved(a), b)} "
        f"ELSE {bits(a, halved(b))} END"
    )
    return f"{100 + percent} * ({least}) <= {100 - percent} * ({n} + {other_n})"


def _possible(n: str, place: str, other_n: str, other_place: str, percent: int) -> str:
    """SQL condition: sizes and places of a shared shingle leave room for the threshold."""
    return (
        f"100 * least({n}, {other_n}) >= {percent} * greatest({n}, {other_n}) AND "
        f"{100 + percent} * (least({place}, {other_place}) + least({n} - {place}, {other_n} - {other_place})) >= {percent} * ({n} + {other_n})"
    )


def _first_shared(n: str, place: str, other_n: str, other_place: str, percent: int) -> str:
    """SQL condition: the sets may be similar enough if this is the first shingle they share, in the order by frequency.

    What they share then stands at or behind it in both. Every pair that is similar enough meets the condition in the list of
    the first shingle it shares, so no other list need name the pair.
    """
    return (
        f"100 * least({n}, {other_n}) >= {percent} * greatest({n}, {other_n}) AND "
        f"{100 + percent} * least({n} - {place}, {other_n} - {other_place}) >= {percent} * ({n} + {other_n})"
    )


def jaccard_classes(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: classes of documents linked by a Jaccard similarity of ``percent`` or more.

    component_id is the smallest doc_id that links lead to. Words are runs of anything but ASCII
    white space, A-Z lower-cased; a set holds the distinct ``n``-word shingles, or the whole sequence
    of fewer words. A null or empty text has an empty set, no links and is its own class. Rows with
    one doc_id count as documents of their own; a null doc_id counts as largest, and a class of only such
    rows has a null component_id. An empty table gives an empty result; other columns are not read.
    """
    sets_of = _classed(store_blocks(id_and_text(docs), []), n, percent)
    least = sets_of.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least")).withColumnRenamed("root", "of")
    return sets_of.join(least, F.col("root") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def one_of_each_class(docs: DataFrame, n: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those of a class (see ``jaccard_classes``) that has another row before.

    Exactly one row of each class stays: that with the smallest doc_id, null being the largest, and of rows
    with equal ids the first by its set and stored place. Rows are told apart by their place in the
    stored blocks, not by doc_id, which may be null or repeated. A row without words is its own class.
    """
    columns = docs.columns
    # The caller's columns are in a struct of their own, so their names meet none of ours.
    given = [F.struct(*[col(c) for c in columns if c != "text"]).alias("given")]
    row = F.struct(F.col("text").isNull().alias("none"), *given).alias("row")
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), row)
    blocks = store_blocks(plain, ["row"])
    sets_of = _classed(blocks, n, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "sig", "block", "doc")).alias("at")
    ones = sets_of.where("root IS NOT NULL").groupBy("root").agg(first).select("at.block", "at.doc")
    ones = ones.unionByName(sets_of.where("root IS NULL").select("block", "doc"))
    # A block has a bounded number of bytes; its rows that stay are a list of places.
    gathered = ones.groupBy("block").agg(F.collect_list("doc").alias("stay"))
    made = StructType([StructField("text", BinaryType()), StructField("row", plain.schema["row"].dataType)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, extra, stay in zip(*(batch.column(c).to_pylist() for c in ("texts", "extra", "stay"))):
                _, bounds, data = read_block(blob)
                at = np.sort(np.array(stay, np.int64))
                rows = read_extra(extra).column("row").combine_chunks()
                raw = data.tobytes()
                for begin in range(0, at.size, 2000):
                    own = at[begin : begin + 2000]
                    texts = [raw[a:b] for a, b in zip(bounds[own].tolist(), bounds[own + 1].tolist())]
                    yield pa.record_batch([pa.array(texts, pa.binary()), rows.take(pa.array(own))], ["text", "row"])

    found = blocks.join(gathered, "block").select("texts", "extra", "stay").mapInArrow(cut, made)
    text = F.when(~F.col("row.none"), F.col("text").cast("string")).alias("text")
    return found.select(*[text if c == "text" else col(c, "row.given").alias(c) for c in columns])


def _classed(blocks: DataFrame, n: int, percent: int) -> DataFrame:
    """(block, doc, doc_id, n, sig, root) of every row of the blocks; root names its class, null without words."""
    profiles = stored(_profiles(blocks, n), "profiles")
    rows = profiles.where("part IS NULL").select("block", "doc", "doc_id", "sig", "n")
    links = _prefix_lists(blocks, _frequencies(profiles), n, percent)
    links = stored(links, "prefixes")
    every = links.where("token IS NOT NULL").drop("sig")
    # Of shingles with the same list one stays, with the number of them. Each alone is a complete
    # condition for a pair, so the others add no candidate. It is the first of them in the order by frequency,
    # which is the same in every group, so that the first list a pair shares keeps its place.
    chosen = every.groupBy("whole").agg(F.min(F.struct("place", "token")).getField("token").alias("one"), F.count_distinct("token").alias("weight")).withColumnRenamed("whole", "list")
    lists = stored(every.join(chosen, (F.col("whole") == F.col("list")) & (F.col("token") == F.col("one"))).drop("whole", "list", "one"), "lists")
    members = links.where("sig IS NOT NULL").select("grp", "sig").distinct()
    # A group of several sets is a list of its own: its sets share the whole prefix.
    inside = members.groupBy("grp").agg(F.count("*").alias("c")).where("c > 1").select("grp")
    listed = lists.select("grp").distinct()
    involved = stored(members.join(listed.unionByName(inside).distinct(), "grp", "left_semi"), "members")
    where = stored(rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min(F.struct("block", "doc")).alias("at"), F.first("n").alias("n")), "places")

    # Each set's parity sketch, which bounds its difference from any other: few pairs of sets that are not
    # similar get past it, so that little more is fetched than what is linked.
    sketches = stored(_sets(blocks, _placed(involved.select("sig"), where), n, True), "sketches")

    # First: each group with its closest neighbour, and the sets of a group in a chain.
    possible = _possible("n", "place", "before_n", "before_place", percent)
    near = lists.where(f"before IS NOT NULL AND {possible}").groupBy("grp", "before").agg(F.sum("weight").alias("c"))
    best = near.groupBy("grp").agg(F.max(F.struct("c", "before")).alias("b")).select("grp", "b.before")
    lead = involved.groupBy("grp").agg(F.min("sig").alias("lead"))
    ahead = lead.select(F.col("grp").alias("before"), F.col("lead").alias("u"))
    pairs = best.join(lead, "grp").join(ahead, "before").select("u", F.col("lead").alias("v"))
    own = involved.join(lead, "grp").where("sig <> lead").select(F.col("lead").alias("u"), F.col("sig").alias("v"))
    pairs = pairs.unionByName(own).where("u <> v").distinct()

    def admitted(pairs: DataFrame) -> DataFrame:
        """The pairs that the sketches do not exclude."""
        left = sketches.selectExpr("sig AS u", "size AS m", "items AS a")
        right = sketches.selectExpr("sig AS v", "size AS other_m", "items AS b")
        close = f"100 * least(m, other_m) >= {percent} * greatest(m, other_m)"
        return pairs.join(left, "u").join(right, "v").where(f"{close} AND {_alike('a', 'b', 'm', 'other_m', percent)}").select("u", "v")

    first = _verified(admitted(pairs), blocks, where, n, percent)

    sized = lists.select("token", "grp", "n", "place")
    whole = involved.join(inside, "grp", "left_semi").join(where.select("sig", "n"), "sig").selectExpr("grp AS token", "sig", "n", "0L AS place")
    entries = sized.join(involved, "grp").select("token", "sig", "n", "place").unionByName(whole)
    entries = stored(entries, "entries")
    freed(links, lists)  # all that reads them is stored

    def apart(turn: int) -> DataFrame:
        """Entries of lists that hold sets of several components, with their components and a least hash to order by.

        Which of its least hashes goes by the list and the turn, so that a set meets other neighbours in each of its lists.
        """
        near = sketches.select(F.col("sig").alias("of"), F.col("near").alias("hashes"))
        held = entries.join(rooted(links), F.col("sig") == F.col("node"), "left").select("token", "sig", "n", "place", F.coalesce("root", "sig").alias("root"))
        mixed = held.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
        both = held.join(mixed, "token", "left_semi").join(near, F.col("sig") == F.col("of"))
        return stored(both.selectExpr("token", "sig", "n", "place", "root", f"hashes[CAST(pmod(token + {turn}, {_ORDERS}) AS INT)] AS near"), "mixed")

    def joined(links: DataFrame, more: DataFrame) -> DataFrame:
        """Stars of both: what ``links`` holds are stars already, so only what ``more`` connects takes rounds."""
        made = stars(links.unionByName(more))
        freed(links, more)
        return made

    possible = _possible("n", "place", "other.n", "other.place", percent)
    links = stars(first)
    freed(first)
    turn = 0
    while True:
        mixed = apart(turn)
        window = f"OVER (PARTITION BY token ORDER BY near, xxhash64(sig, token, {turn}), sig)"
        others = ", ".join(f"lag(struct(sig, n, place, root), {i}) {window}" for i in range(1, _NEIGHBOURS + 1))
        near = mixed.selectExpr("*", f"array({others}) AS others").select("sig", "n", "place", "root", F.explode("others").alias("other"))
        near = near.where("root <> other.root AND " + possible).select(F.least("sig", "other.sig").alias("u"), F.greatest("sig", "other.sig").alias("v")).distinct()
        more = _verified(admitted(near), blocks, where, n, percent)
        turn += 1
        new, seen = more.count(), mixed.count()
        if not new:  # components and mixed lists are what they were
            break
        links = joined(links, more)
        freed(mixed)
        # A turn that links few of what it has seen is the last. Each but the last so takes a share of the components.
        if new * _WORTHWHILE <= seen:
            mixed = apart(turn)
            break
    possible = _possible("n", "place", "other_n", "other_place", percent)

    # Then: all candidates in different components.
    left = mixed.drop("near").join(sketches.select("sig", "carried"), "sig")
    other = left.selectExpr("token", "sig AS v", "root AS other_root", "n AS other_n", "place AS other_place", "carried AS other_carried")
    may = f"{_first_shared('n', 'place', 'other_n', 'other_place', percent)} AND {_alike('carried', 'other_carried', 'n', 'other_n', percent)}"
    pairs = left.join(other, "token").where(f"root < other_root AND {may}")
    last = _verified(admitted(pairs.select(F.col("sig").alias("u"), "v").distinct()), blocks, where, n, percent)
    freed(mixed, entries, sketches)
    if not last.isEmpty():
        links = joined(links, last)

    return rows.join(rooted(links), F.col("sig") == F.col("node"), "left").select("block", "doc", "doc_id", "n", "sig", F.coalesce("root", "sig").alias("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return jaccard_classes(table(spark, sf_dir, "documents"))
