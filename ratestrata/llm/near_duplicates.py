"""MinHash near-duplicates by a multi-index Hamming join.

Every distinct shingle set gets a signature of `SLOTS` b-bit MinHash values. Two sets of Jaccard similarity 0.8
differ in a fifth of the slots on average; `MOST_DIFFERENT` lies almost five standard deviations above. The join
finds *all* pairs of signatures within that distance: the slots are cut into so many chunks that some chunk
holds at most one difference (pigeonhole), and each chunk is indexed once for each slot left out (all
errors allowed in it). What shares a key is then compared by signature and confirmed on the full shingle sets.

Groups of copies never make all their pairs. Equal sets collapse into one class first. Then each key links
its sets to two of their number, the smallest and the one that shares most keys with others, which finds large
groups in a linear number of pairs. Only sets that share a key and are still in different components afterwards are paired with each other,
behind a bit sketch compared inside the join; this last step makes the result whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratestrata.llm.common import (
    U64, Workspace, binary_array, grams, mixed, raw_texts, signed, slices, texts_of, words_of,
)
from ratestrata.llm.components import connected_components

SLOTS = 80
#: The least similarity in percent that the distance is made for: Binomial(80, 0.2) exceeds it with probability 4e-6.
LEAST_PERCENT = 80
MOST_DIFFERENT = 33
CHUNKS = MOST_DIFFERENT // 2 + 1
#: One bit of each of 64 slots: similar sets differ in 6.4 bits on average (deviation 2.4), unrelated ones in 32.
MOST_BITS = 19
#: Members compared with one center at a time when sets are confirmed, and rows of a block of a contested key.
GROUP, BLOCK = 64, 512
STRIP = 64
#: A contested key of more sets than this is split by further slots.
SPLIT = 32 * BLOCK

_random = np.random.default_rng(9)
_FLIPS = _random.integers(0, 1 << 64, SLOTS, dtype=np.uint64)
_FACTORS = _random.integers(0, 1 << 64, SLOTS, dtype=np.uint64) | U64(1)
_CHUNKS = [chunk.tolist() for chunk in np.array_split(np.arange(SLOTS), CHUNKS)]
#: For each chunk the other slots in more groups than there can be differences: a pair within the distance agrees in some whole group.
_OTHERS = [
    [group.tolist() for group in np.array_split(np.setdiff1d(np.arange(SLOTS), chunk), MOST_DIFFERENT + 1)] for chunk in _CHUNKS
]


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text. Fewer words than `width` make one shingle, none make none."""
    words = words_of(texts, lower=True)
    hashes = words.hashes()
    shingles = grams(hashes, width)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(shingles[a : b - width + 1]))
        elif b > a:
            out.append(grams(hashes[a:b], b - a) ^ U64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """`SLOTS` 16-bit values for each non-empty set."""
    values = np.concatenate(sets)
    firsts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SLOTS), np.uint16)
    scratch = np.empty_like(values)
    for k in range(SLOTS):
        np.bitwise_xor(values, _FLIPS[k], out=scratch)
        np.multiply(scratch, _FACTORS[k], out=scratch)
        out[:, k] = mixed(np.minimum.reduceat(scratch, firsts)) >> U64(48)
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """One key per chunk and slot left out of it: equal where the remaining slots of the chunk are equal."""
    slots = signature.astype(np.uint64)
    keys = []
    for c, chunk in enumerate(_CHUNKS):
        for left_out in chunk:
            key = np.full(len(slots), c * SLOTS + left_out + 1, np.uint64)
            for slot in chunk:
                if slot != left_out:
                    key = (key ^ slots[:, slot]) * U64(0x9E3779B97F4A7C15)
                    key ^= key >> U64(32)
            keys.append(mixed(key))
    return np.stack(keys, axis=1)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    return divmod(xxhash.xxh3_128_intdigest(shingles.tobytes()), 1 << 64)


def _sketches(width: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_1", pa.int64()), ("set_2", pa.int64()),
        ("bits", pa.int64()), ("signature", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(raw_texts(batch), width)
            sizes = np.array([len(s) for s in sets], np.int64)
            digests = np.array([_digest(s) for s in sets], np.uint64).reshape(-1, 2)
            bits, packed = np.zeros(len(sets), np.uint64), [b""] * len(sets)
            filled = np.flatnonzero(sizes)
            if len(filled):
                found = signatures([sets[i] for i in filled])
                for slot in range(64):
                    bits[filled] |= (found[:, slot].astype(np.uint64) & U64(1)) << U64(slot)
                for i, row in zip(filled.tolist(), found):
                    packed[i] = row.tobytes()
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(sizes), pa.array(signed(digests[:, 0].copy())),
                pa.array(signed(digests[:, 1].copy())), pa.array(signed(bits)), binary_array(packed),
            ], schema=schema)

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        found = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, SLOTS)
        keys = signed(np.ascontiguousarray(chunk_keys(found)).reshape(-1))
        offsets = np.arange(0, len(keys) + 1, SLOTS, dtype=np.int32)
        yield pa.record_batch(
            [batch.column("rep"), batch.column("n_shingles"), batch.column("bits"), pa.ListArray.from_arrays(offsets, keys)],
            names=["rep", "n_shingles", "bits", "keys"],
        )


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures are within the distance."""
    for batch in batches:
        if batch.num_rows:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SLOTS) for c in ("sig_a", "sig_b")
            )
            near = (left != right).sum(axis=1) <= MOST_DIFFERENT
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))


def _split_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of very large keys under finer keys: the key and the values of one group of slots outside its chunk."""
    for batch in batches:
        if not batch.num_rows:
            continue
        slots = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, SLOTS)
        key = batch.column("key").to_numpy().view(np.uint64)
        column = (chunk_keys(slots) == key[:, None]).argmax(axis=1)
        chunk_of = np.repeat(np.arange(CHUNKS), [len(chunk) for chunk in _CHUNKS])[column]
        for c in np.unique(chunk_of).tolist():
            own = np.flatnonzero(chunk_of == c)
            for g, group in enumerate(_OTHERS[c]):
                finer = key[own] ^ mixed(np.full(len(own), g + 1, np.uint64))
                for slot in group:
                    finer = (finer ^ slots[own, slot].astype(np.uint64)) * U64(0x9E3779B97F4A7C15)
                    finer ^= finer >> U64(32)
                yield pa.record_batch(
                    [pa.array(signed(mixed(finer))), batch.column("rep").take(pa.array(own)), batch.column("component").take(pa.array(own))],
                    names=["key", "rep", "component"],
                )


def _packed(width: int):
    """Sets of the texts that the class was made from; a document repeated with the same text comes once where its rows are together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in slices(batches):
            docs, packed = [], []
            wanted = batch.column("set_1").to_numpy().view(np.uint64).tolist()
            for doc, shingles, first in zip(batch.column("doc_id").to_pylist(), shingle_sets(raw_texts(batch), width), wanted):
                if doc != before and _digest(shingles)[0] == first:
                    docs.append(doc)
                    packed.append(shingles.tobytes())
                    before = doc
            yield pa.record_batch([pa.array(docs, pa.int64()), binary_array(packed)], names=["doc_id", "shingles"])

    return run


def _sets_of(docs: DataFrame, needed: DataFrame, sketch: DataFrame, width: int) -> DataFrame:
    """`(doc_id, shingles)` of the classes named in `needed(doc_id)`. Their number has no bound: nothing is broadcast."""
    chosen = sketch.select(F.col("rep").alias("doc_id"), "set_1").join(needed.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    return docs.join(chosen.hint("merge"), "doc_id").select("doc_id", "text", "set_1").mapInArrow(_packed(width), "doc_id long, shingles binary")


def _confirmed(percent: int):
    """Sorted rows: a center, then the members it is compared with. Only the center's set is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, center_set = None, None
        for batch in batches:
            a, b = [], []
            for group, salt, doc, packed in zip(*(batch.column(c).to_pylist() for c in ("center", "salt", "doc_id", "shingles"))):
                own = np.frombuffer(packed, np.uint64)
                if doc == group:
                    center, center_set = (group, salt), own
                elif center == (group, salt):
                    shared = len(np.intersect1d(own, center_set, assume_unique=True))
                    if 100 * shared >= percent * (len(own) + len(center_set) - shared):
                        a.append(group)
                        b.append(doc)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Sorted rows by key and pair of blocks; a group holds two blocks of `BLOCK` rows at most, about."""
    at, rows = None, []
    for batch in batches:
        for key, low, high, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "low", "high", *columns))):
            if at != (key, low, high):
                if rows:
                    yield at, rows
                at, rows = (key, low, high), []
            rows.append(row)
    if rows:
        yield at, rows


_PLACE = "key long, low int, high int, rep long, component long, block int"


def _promising(percent: int):
    """Members that have a partner: of another component, of the right size, within the distance, and met here first."""

    def members(groups: list[tuple[tuple, list[tuple]]]) -> list[tuple]:
        out = []
        all_slots = np.frombuffer(b"".join(r[4] for _, rows in groups for r in rows), np.uint16).reshape(-1, SLOTS)
        all_keys, first = chunk_keys(all_slots), 0
        for (key, low, high), rows in groups:
            n = len(rows)
            slots, keys = all_slots[first : first + n], all_keys[first : first + n]
            first += n
            components, blocks, sizes = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
            column = np.flatnonzero(keys[0] == np.uint64(key & 0xFFFFFFFFFFFFFFFF))
            found = np.zeros(n, bool)
            for top in range(0, n, STRIP):  # some rows against all later ones at a time
                end = min(n, top + STRIP)
                able = np.triu(components[top:end, None] != components[None, top:], 1)
                if low != high:
                    able &= blocks[top:end, None] != blocks[None, top:]
                able &= 100 * np.minimum.outer(sizes[top:end], sizes[top:]) >= percent * np.maximum.outer(sizes[top:end], sizes[top:])
                left, right = np.nonzero(able)
                for i in range(0, len(left), 1 << 14):
                    x, y = top + left[i : i + (1 << 14)], top + right[i : i + (1 << 14)]
                    near = (slots[x] != slots[y]).sum(axis=1) <= MOST_DIFFERENT
                    x, y = x[near], y[near]
                    if len(column):  # a pair is met under its first common key; finer keys may meet it again
                        here = (keys[x] == keys[y]).argmax(axis=1) == column[0]
                        x, y = x[here], y[here]
                    found[x] = found[y] = True
            out += [(key, low, high, *rows[i][:3]) for i in np.flatnonzero(found).tolist()]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for at, rows in _groups(batches, ("rep", "component", "block", "n_shingles", "signature")):
            waiting.append((at, rows))
            n += len(rows)
            if n > 2000:
                if out := members(waiting):
                    yield _places(out)
                waiting, n = [], 0
        if waiting and (out := members(waiting)):
            yield _places(out)

    return run


def _places(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", "low", "high", "rep", "component", "block"])


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets: products of their membership, a range of columns at a time."""
    values, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.zeros((len(sets), len(sets)))
    for first in range(0, len(values), 1 << 11):
        own = (number >= first) & (number < first + (1 << 11))
        member = np.zeros((len(sets), min(1 << 11, len(values) - first)), np.float32)
        member[owner[own], number[own] - first] = 1
        out += member @ member.T
    return out


def _confirmed_among(percent: int):
    """Pairs of a group that hold on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), rows in _groups(batches, ("rep", "component", "block", "shingles")):
            sets = [np.frombuffer(r[3], np.uint64) for r in rows]
            reps, components, blocks = (np.array([r[i] for r in rows]) for i in range(3))
            sizes, shared = np.array([len(s) for s in sets]), _shared(sets)
            holds = 100 * shared >= percent * (np.add.outer(sizes, sizes) - shared)
            holds &= np.triu(components[:, None] != components[None, :], 1)
            if low != high:
                holds &= blocks[:, None] != blocks[None, :]
            x, y = np.nonzero(holds)
            if len(x):
                yield pa.record_batch(
                    [pa.array(np.minimum(reps[x], reps[y])), pa.array(np.maximum(reps[x], reps[y]))], names=["a", "b"]
                )

    return run


def _contested(work: Workspace, name: str, placed: DataFrame) -> DataFrame:
    """Rows `(key, rep, component)` of keys that more than one component holds, with `n`, the rows of the key,
    `home`, the component that most of them are of, and `own`, the rows of that."""
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("rows"))
    keys = parts.groupBy("key").agg(
        F.sum("rows").alias("n"), F.count("*").alias("components"), F.max(F.struct("rows", "component")).alias("most")
    ).where("components > 1").select("key", "n", F.col("most.component").alias("home"), F.col("most.rows").alias("own"))
    return placed.join(work.store(keys, name), "key")


def _links_apart(work: Workspace, docs: DataFrame, placed: DataFrame, sketch: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between sets that share a key but no component, from `placed(key, rep, component)`.

    Pairs are compared inside tasks, and only what holds leaves them. A key's rows are dealt to blocks, those of its largest component apart from
    the others, and every two blocks that can hold a pair meet in a group of their own: so a row of the largest component is there once for each
    block of the others, which are few, and no task sees a whole key. First signatures are compared, which leaves the
    members that have a partner; only their full sets travel.
    """
    contested = work.store(_contested(work, "contested-keys", placed), "contested")
    signature = sketch.select("rep", "signature")
    large = contested.where(F.col("n") > SPLIT).join(signature, "rep").select("key", "rep", "component", "signature")
    finer = work.store(large.mapInArrow(_split_keys, "key long, rep long, component long"), "finer")
    columns = ["key", "rep", "component", "n", "home", "own"]
    contested = contested.where(F.col("n") <= SPLIT).select(*columns).unionByName(_contested(work, "finer-keys", finer).select(*columns))

    blocks = lambda rows: F.ceil(rows / BLOCK).cast("int")
    at_home, homes, others = F.col("component") == F.col("home"), blocks(F.col("own")), blocks(F.col("n") - F.col("own"))
    spread = F.xxhash64("rep")
    dealt = contested.withColumn(
        "block", F.when(at_home, F.pmod(spread, homes)).otherwise(homes + F.pmod(spread, others)).cast("int")
    ).withColumn(
        "other", F.explode(F.sequence(F.when(at_home, homes).otherwise(F.lit(0)), homes + others - 1))
    ).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    rows = dealt.join(sketch.select("rep", "n_shingles", "signature"), "rep").select(
        "key", "low", "high", "rep", "component", "block", "n_shingles", "signature"
    )
    at = ["key", "low", "high"]
    promising = rows.repartition(*at).sortWithinPartitions(*at, "rep").mapInArrow(_promising(percent), _PLACE)
    promising = work.store(promising, "promising").withColumnRenamed("rep", "doc_id")
    sets = promising.join(_sets_of(docs, promising, sketch, width), "doc_id").select(
        *at, F.col("doc_id").alias("rep"), "component", "block", "shingles"
    )
    links = sets.repartition(*at).sortWithinPartitions(*at, "rep").mapInArrow(_confirmed_among(percent), "a long, b long")
    return work.store(links.distinct(), "links-apart")


def _links(work: Workspace, name: str, docs: DataFrame, pairs: DataFrame, sketch: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs `(a, b)` of classes that hold on signatures and on full sets.

    A center with many members is repeated for every `GROUP` of them, so that no task meets them all.
    """
    signature = sketch.select("rep", "signature")
    close = (
        pairs.join(signature.toDF("a", "sig_a"), "a").join(signature.toDF("b", "sig_b"), "b")
        .select("a", "b", "sig_a", "sig_b").mapInArrow(_close, "a long, b long")
    )
    close = work.store(close, f"{name}-close")
    sizes = close.groupBy("a").agg(F.count("*").alias("members"))
    members = close.join(sizes, "a").select(
        F.col("a").alias("center"), F.col("b").alias("doc_id"), "members",
        F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / GROUP)).cast("int").alias("salt"),
    )
    centers = sizes.select(
        F.col("a").alias("center"), F.col("a").alias("doc_id"),
        F.explode(F.sequence(F.lit(0), (F.ceil(F.col("members") / GROUP) - 1).cast("int"))).alias("salt"),
    )
    needs = members.select("center", "salt", "doc_id").unionByName(centers.select("center", "salt", "doc_id"))
    sets = needs.join(_sets_of(docs, needs, sketch, width), "doc_id")
    confirmed = (
        sets.withColumn("is_member", F.col("doc_id") != F.col("center"))
        .repartition("center", "salt").sortWithinPartitions("center", "salt", "is_member", "doc_id")
        .select("center", "salt", "doc_id", "shingles").mapInArrow(_confirmed(percent), "a long, b long")
    )
    return work.store(confirmed, name)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs(doc_id, text, ...)`: `doc_id, n_shingles, component_id, n_links`.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; sets hold the distinct shingles of
    `width` words, or the whole sequence where there are fewer. Sets with 100 * intersection >= `percent` * union
    are linked; `component_id` is the smallest doc_id reachable and `n_links` counts links found of the class.
    Null, empty and blank texts have no shingles and link with nothing. Rows that repeat a doc_id are one
    document; should their texts differ, the one whose set has the smallest digest counts. A null doc_id links with nothing and has a null component.

    `percent` is 80 to 100: a pair of similarity exactly 0.8 is missed with probability 4e-6, but the distance would
    lose 1.2 % of those of 0.7 and most of 0.5, so less is refused.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be {LEAST_PERCENT} to 100, not {percent}: signatures are compared for that similarity only")
    spark = docs.sparkSession
    work = Workspace(spark, "near-duplicates")
    docs = texts_of(docs)
    schema = "doc_id long, n_shingles long, set_1 long, set_2 long, bits long, signature binary"
    all_rows = work.store(docs.mapInArrow(_sketches(width), schema), "sketches")
    own = all_rows.where("doc_id is not null and n_shingles > 0")
    sets = own.groupBy("doc_id").agg(F.min(F.struct("set_1", "set_2")).alias("set")).select("doc_id", "set.set_1", "set.set_2")
    sets = work.store(sets, "sets")
    classes = work.store(sets.groupBy("set_1", "set_2").agg(F.min("doc_id").alias("rep")), "reps")
    member = work.store(sets.join(classes, ["set_1", "set_2"]).select("doc_id", "rep"), "members")
    # differing sets of similarity 0.8 have four shingles or more each
    least = -(-percent // (101 - percent)) if percent < 100 else 0
    sketch = work.store(
        own.where(F.col("n_shingles") >= least).join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_1", "set_2"])
        .select(F.col("doc_id").alias("rep"), "n_shingles", "bits", "signature", "set_1").dropDuplicates(["rep"]),
        "classes",
    )

    # Where a key is hot, adaptive execution splits it, but only in joins that shuffle both sides; so what is aggregated by a
    # key is stored before it is joined on that key.
    keyed = sketch.mapInArrow(_keys, "rep long, n_shingles long, bits long, keys array<long>").select(
        F.explode("keys").alias("key"), "rep", "n_shingles", "bits"
    )
    repeated = work.store(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeated-keys")
    shared = work.store(keyed.join(repeated, "key"), "shared-keys")
    # the set that shares most with others is the likely origin of a group of near copies
    weight = work.store(shared.groupBy("rep").agg(F.sum("n").alias("weight")), "weights")
    order = F.col("weight") * (1 << 20) + F.pmod(F.xxhash64("rep"), F.lit(1 << 20))
    centers = shared.join(weight, "rep").withColumn("order", order).groupBy("key").agg(
        *(F.min_by(c, "rep").alias(f"low_{c}") for c in ("rep", "n_shingles", "bits")),
        *(F.max_by(c, "order").alias(f"mid_{c}") for c in ("rep", "n_shingles", "bits")),
    )
    centers = work.store(centers, "centers")
    of = [F.struct(*(F.col(f"{kind}_{c}").alias(f"{c}_b") for c in ("rep", "n_shingles", "bits"))) for kind in ("low", "mid")]
    pairs = shared.join(centers, "key").select("rep", "n_shingles", "bits", F.inline(F.array(*of))).toDF(
        *(f"{c}_{side}" for side in "ab" for c in ("rep", "n_shingles", "bits"))
    )
    similar = F.expr(
        f"rep_a != rep_b and bit_count(bits_a ^ bits_b) <= {MOST_BITS}"
        f" and 100 * least(n_shingles_a, n_shingles_b) >= {percent} * greatest(n_shingles_a, n_shingles_b)"
    )
    pairs = pairs.where(similar).select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
    first = _links(work, "links-first", docs, pairs, sketch, width, percent)
    found = connected_components(spark, first)

    # what shares a key but no component yet
    placed = shared.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    placed = work.store(placed, "placed")
    second = _links_apart(work, docs, placed, sketch, width, percent)

    links = first.unionByName(second).distinct()
    # the second links join components of the first, of which few are left apart
    ends = second.join(found.toDF("a", "root_a"), "a", "left").join(found.toDF("b", "root_b"), "b", "left")
    ends = ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = connected_components(spark, ends)
    late = second.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(found, "node", "left_anti")
    named = found.unionByName(late.withColumn("component", F.col("node"))).join(joined.toDF("component", "top"), "component", "left")
    named = named.select("node", F.coalesce("top", "component").alias("component"))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    of_doc = (
        member.join(named.select(F.col("node").alias("rep"), "component"), "rep", "left").join(degree, "rep", "left")
        .select("doc_id", F.coalesce("component", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
        .groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.max("n_links").alias("n_links"))
    )
    return all_rows.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of `docs`, all columns, of which one stays for each component: the one of the smallest doc_id.

    Of rows that repeat that doc_id one stays. Rows without a doc_id stay, as nothing tells them apart.
    """
    found = near_duplicates(docs, width, percent).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    same = Window.partitionBy("doc_id").orderBy(*docs.columns)
    kept = docs.where("doc_id is not null").join(found, F.col("doc_id") == F.col("__kept"), "left_semi")
    kept = kept.withColumn("__row", F.row_number().over(same)).where("__row = 1").drop("__row")
    return kept.unionByName(docs.where("doc_id is null"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"))


OP9_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), classes AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), member AS (
  SELECT doc_id, c.rep FROM sets JOIN classes c ON list_sort(sets.s) = c.s
), items AS (
  SELECT rep, len(s) AS n, unnest(s) AS x FROM classes
), linked AS (
  SELECT a.rep AS a, b.rep AS b FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach AS (
  WITH RECURSIVE r(a, b) AS (
    SELECT rep, rep FROM classes UNION SELECT r.a, ways.b FROM r JOIN ways ON r.b = ways.a
  ) SELECT a, min(b) AS low FROM r GROUP BY a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(r.low, s.doc_id) AS component_id,
  s.doc_id = coalesce(r.low, s.doc_id) AS kept
FROM sets s LEFT JOIN member m ON s.doc_id = m.doc_id LEFT JOIN reach r ON m.rep = r.a
"""
